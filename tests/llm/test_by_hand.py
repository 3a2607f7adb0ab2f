"""Sharding, language ID and the pipeline against plain Python: draws, compressed sizes and selections worked out anew."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
import xxhash
import zstandard

import corpus_pipeline
from kinetable.llm import langid, sharding

SMALL = "/root/testdata/sf0.001"


def spark_hash(*values):
    """Spark's xxhash64 of values given as (number, bytes) or text: each is hashed with the hash before as its seed."""
    h = 42
    for v in values:
        if v is None:
            continue
        raw = v.encode() if isinstance(v, str) else v[0].to_bytes(v[1], "little", signed=True)
        h = xxhash.xxh64_intdigest(raw, seed=h)
    return h


# ---------------------------------------------------------------- sharding

def shard_by_hand(key, tree):
    at, left = None, [s for s in tree if s.weight > 0]
    for level, name in enumerate(("region", "rack", "shard")):
        weights = defaultdict(float)
        for s in left:
            weights[getattr(s, name)] += s.weight

        def draw(child):
            bits = spark_hash(None if key is None else (key, 8), (level, 4), (child, 4)) >> 11
            return -math.log((bits + 0.5) / (1 << 53)) / weights[child], child

        at = min(map(draw, weights))[1]
        left = [s for s in left if getattr(s, name) == at]
    return at


@pytest.mark.parametrize("tree", [
    sharding.topology(40), sharding.topology(41), sharding.topology(1), [sharding.Shard(s % 3, 10 + s % 6, 100 + s, s % 4 * 0.7) for s in range(24)],
], ids=["40", "41", "one", "weights"])
def test_draws(spark, tree):
    keys = [*range(-20, 1500), 1 << 60, None]
    docs = spark.createDataFrame([(k, "x") for k in keys for _ in range(1 + (k == 7))], "doc_id long, shard string")
    got = sharding.assign(docs, tree).collect()
    assert Counter((r.doc_id, r.shard) for r in got) == Counter((k, shard_by_hand(k, tree)) for k in keys for _ in range(1 + (k == 7)))
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


# ---------------------------------------------------------------- language ID

def clean_by_hand(text):
    return " ".join(re.findall(r"[^\W\d_]+", text.lower()))


def dictionaries_by_hand(rows, docs_per_lang=400, chars=1500, most=1 << 17):
    by = defaultdict(list)
    for key, text, lang in rows:
        if None not in (key, text, lang):
            h = spark_hash((key, 8))
            by[lang].append((h - (1 << 64) if h >> 63 else h, key, text[:chars]))
    made = {}
    for lang, found in sorted(by.items()):
        first = {}
        for h, _, t in sorted(found)[:docs_per_lang]:
            first.setdefault(t, h)
        parts = [p for _, t in sorted((h, t) for t, h in first.items()) if (p := clean_by_hand(t).encode())]
        share = max(map(len, parts))
        while sum(min(len(p), share) for p in parts) + len(parts) - 1 > most:  # the largest equal share that fits
            share -= 1
        made[lang] = b" ".join(p[:share].decode(errors="ignore").encode() for p in parts)
    return made


def language_by_hand(text, dictionaries, piece=512, lead=1.2):
    clean = clean_by_hand(text or "").encode()
    if not clean:
        return "und", 0.0
    total = Counter()
    for i in range(0, len(clean), piece):
        size = {}
        for lang, raw in dictionaries.items():
            known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
            size[lang] = len(coder.compress(clean[i : i + piece]))
        for lang, n in size.items():
            total[lang] += min(n, lead * min(size.values()))
    (a, name), (b, _) = sorted((n, lang) for lang, n in total.items())[:2]
    return name, max(0.0, 1 - a / b)


def documents():
    return pq.read_table(f"{SMALL}/documents.parquet").to_pylist()


def test_languages(spark):
    rows = [(d["doc_id"], d["text"], d["lang"]) for d in documents()]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    made = dictionaries_by_hand(rows)
    assert model.dictionaries == made
    asked = [(i, t) for i, t, _ in rows[:60]] + [(-1, None), (-2, ""), (-3, "12 _"), (-4, "Ünd nicht"), (-5, rows[0][1] * 20)]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()}
    for i, t in asked:
        name, margin = language_by_hand(t, made)
        assert got[i].lang_pred == name and abs(got[i].score - margin) < 1e-9 and got[i].rejected == (name == "und" or margin < 0.002)


# ---------------------------------------------------------------- pipeline

def words_by_hand(pattern, text):
    return re.findall(pattern, (text or "").translate({c: c + 32 for c in range(65, 91)}))


def representatives_by_hand(docs):
    sets = []
    for d in docs:
        w = words_by_hand(r"[^\x20\x09-\x0D]+", d["text"])
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = [d["doc_id"] for d in docs]
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(sets):
            for j in range(i):
                n = len(x & sets[j]) if label[i] != label[j] else 0
                if n and 100 * n >= 80 * (len(x) + len(sets[j]) - n):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return [d for d, x in zip(docs, label, strict=True) if d["doc_id"] == x]


def clean_documents_by_hand(docs, items):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for text in items:
        w = words_by_hand(word, text)
        n = min(13, len(w))
        windows.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n)
    lengths, kept = {len(w) for w in windows}, []
    for d in docs:
        w, hit = words_by_hand(word, d["text"]), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
        if not hit or 20 * len(hit) < len(w):
            kept.append(d)
    return kept


def mixture_by_hand(docs):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")) for d in docs]
    have = Counter()
    for d, n in zip(docs, size, strict=True):
        have[d["source"]] += n
    order = sorted(have, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, left, free = {}, sum(size), set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 3 * have[s]}
        target.update({s: 3 * have[s] if full else weight[s] * level for s in full or free})
        left -= sum(3 * have[s] for s in full)
        free -= full or free
    taken = []
    for s in order:
        own = [(spark_hash((7, 4), (d["doc_id"], 8), (text_hash(d["text"]), 8)), n, d) for d, n in zip(docs, size, strict=True) if d["source"] == s]
        passes = math.floor(target[s] / have[s] + 1e-9) if have[s] else 0
        rest, upto = target[s] - passes * have[s], 0
        for _, n, d in sorted(own, key=lambda x: x[0]):
            taken += [d] * (passes + (upto + n / 2 < rest))
            upto += n
    return taken


def text_hash(text):
    h = spark_hash(text)
    return h - (1 << 64) if h >> 63 else h


def test_pipeline_by_hand(spark):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    rows = documents()
    known = [d for d in rows if d["text"] and len(d["text"]) > 300]
    bench = pq.read_table(f"{SMALL}/benchmark.parquet")["text"].to_pylist()
    rows += [{**known[0], "doc_id": 900_001}, {**known[1], "doc_id": 900_002, "text": known[1]["text"] + " extra"}, {**known[2], "doc_id": 900_003, "text": None}]
    rows += [{**known[3], "doc_id": 900_004, "text": max((b for b in bench if b), key=len)}, {**known[4], "doc_id": 900_005, "source": None, "text": "the 12 of it"}]
    made = dictionaries_by_hand((d["doc_id"], d["text"], d["lang"]) for d in rows if crc_of(d["doc_id"]) != 2)
    told = [(d, *language_by_hand(d["text"], made)) for d in rows]
    want = [[d for d, name, margin in told if name != "und" and margin >= 0.002]]
    want.append(representatives_by_hand(want[-1]))
    want.append(clean_documents_by_hand(want[-1], bench))
    want.append(mixture_by_hand(want[-1]))
    docs = spark.createDataFrame([tuple(d[f.name] for f in schema) for d in rows], schema)
    view = lambda d: (d["doc_id"], d["text"], d["lang"], d["source"], d["n_chars"])
    for (name, stage), hand in zip(corpus_pipeline.STAGES, [*want, want[-1]], strict=True):
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SMALL))
        got = docs.collect()
        assert Counter(map(view, got)) == Counter(map(view, hand)), name
    tree = sharding.topology(40)
    assert all(r.shard == shard_by_hand(r.doc_id, tree) for r in got)
    assert not {900_001, 900_003} & {d["doc_id"] for d in want[1]} and 900_004 not in {d["doc_id"] for d in want[2]}
    assert len(want[0]) < len(rows) and len(want[1]) < len(want[0]) and len(want[2]) < len(want[1])


def crc_of(key):
    return zlib.crc32(str(key).encode()) % 4
