"""Manifest, divergence audit and chat formatting against brute force, and their defined results for odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetable.llm import chat, divergence, manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree int, index int, node string, leaf int, root int, witness int, leaves int, term int, c int, value int, rank int, n int, part int"


def frame(spark, rows):
    """(doc_id, text, lang, source, n_chars) with extra columns of the names that the operators use inside."""
    return spark.createDataFrame([(*r, *([1, 1, "x"] + [1] * 10)) for r in rows], DOCS)


# ---------------------------------------------------------------- op11

def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([H(*at[i : i + 2]) for i in range(0, len(at), 2)])
    return levels


def path(levels, i):
    """(sibling, before) of every level below the last."""
    out = []
    for at in levels[:-1]:
        out.append((at[i ^ 1] if i ^ 1 < len(at) else None, bool(i & 1)))
        i >>= 1
    return out


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def brute(rows):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for d, text, lang, source, n in rows:
        groups.setdefault(lang, []).append((d is None, d or 0, H(*map(enc, (d, source, lang, n, text)))))
    low = {g: tree([x[2] for x in sorted(v)]) for g, v in groups.items()}
    names = sorted(low, key=lambda g: (g is not None, (g or "").encode()))
    high = tree([low[g][-1][0] for g in names])
    return sorted(
        (str(x[1]) if not x[0] else "None", x[2], low[g][-1][0], high[-1][0], str(path(low[g], i) + path(high, k)))
        for k, g in enumerate(names) for i, x in enumerate(sorted(groups[g]))
    )


def manifested(df, **options):
    got = manifest.manifest(df, FIELDS, **options).collect()
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, str([(w.sibling, w.before) for w in r.witness])) for r in got)


ODD = [(1, None, "en", "a", None), (2, "", "en", None, 0), (2, "", "en", None, 0), (None, "é: 1:x", None, "a", 3), (None, None, None, None, None),
       (3, "long " * 20_000, "de", "a", 5), (7, "x", "", "", -1), (-5, "neg", "en", "b", 1)]


@pytest.mark.parametrize("levels", [1, 2, 11])
def test_manifest(spark, levels):
    rng = random.Random(levels)
    rows = ODD + [(rng.randrange(500), f"t{rng.random()}", rng.choice(["en", "en", "en", "fr", "es", "é"]), "s", i) for i in range(120)]
    assert manifested(frame(spark, rows), levels=levels) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9])
def test_manifest_sizes(spark, n):
    rows = [(i, str(i), "en", "a", i) for i in range(n)]
    assert manifested(frame(spark, rows), levels=1) == brute(rows)


def test_appender():
    for n in range(1, 40):
        leaves = [H(str(i)).encode() for i in range(n)]
        top = max(0, (n - 1).bit_length())
        for height in (top, top + 2):
            own = manifest.Appender(n, height)
            for x in leaves:
                own.append(x)
                assert len(own.open) == bin(own.n).count("1")  # one open subtree for each bit
            levels = tree([x.decode() for x in leaves])
            want = levels[-1][0]
            for _ in range(height - top):
                want = H(want)
            assert own.close(height).decode() == want
            for i in range(n):
                assert [(x.decode() or None) for x in own.seen[:top, i]] == [s for s, _ in path(levels, i)]


def test_manifest_tampering(spark):
    rows = [(i, f"t{i}", "en" if i % 3 else "fr", "a", i) for i in range(20)]
    other = manifest.digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + F.when(F.col("doc_id") == 4, 1).otherwise(0), F.col("text"))
    got = manifest.manifest(frame(spark, rows), FIELDS, keep={"other": other}, levels=2)
    bad = got.where(manifest.folded(F.col("other"), F.col("witness")) != F.col("root"))
    assert [r.doc_id for r in bad.collect()] == [4]


def test_manifest_of_nothing(spark):
    assert manifest.manifest(frame(spark, []), FIELDS).count() == 0


# ---------------------------------------------------------------- op12

def audited(rows, k, min_docs):
    docs = [("" if lang is None else lang, "" if source is None else source,
             re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source, _ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        held, count = Counter(), {}
        for g, s, w in docs:
            if g == lang:
                held.update(set(w))
                count.setdefault(s, Counter()).update(w)
        kept = sorted((t for t in held if held[t] >= min_docs), key=str.encode)
        v = len(kept)
        whole = sum(count.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * v) for t in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        for s in p:
            far = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in p if o != s), key=lambda x: (x[0], x[1].encode()))
            out += [(lang, s, "pair", o, -f, i + 1) for i, (f, o) in enumerate(far)]
            over = sorted(((q[t] - p[s][t], t) for t in kept if count[s][t] and p[s][t] > q[t]), key=lambda x: (x[0], x[1].encode()))
            out += [(lang, s, "term", t, -f, i + 1) for i, (f, t) in enumerate(over[:k])]
    return sorted(out)


def words(rng, n, many):
    return " ".join(rng.choice(["Der", "été", "x1y", "a-b", "日本"]) if rng.random() < 0.2 else f"w{chr(97 + int(rng.paretovariate(0.7)) % 26)}{chr(97 + rng.randrange(many))}" for _ in range(n))


@pytest.mark.parametrize("k, min_docs, piece, tile, dense", [(50, 1, 8_192, 64, 2_000_000), (3, 2, 16, 2, 30), (5, 3, 4, 1, 7)])
def test_divergence(spark, monkeypatch, k, min_docs, piece, tile, dense):
    for name, value in (("PIECE", piece), ("TILE", tile), ("DENSE", dense), ("TILE_ROWS", 50 if piece < 100 else 100_000), ("FLUSH", 40)):
        monkeypatch.setattr(divergence, name, value)
    rng = random.Random(k)
    rows = [(i, words(rng, rng.randrange(40), 9), rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", "c", "é", None, "d"]), 0) for i in range(80)]
    rows += [(1, None, "en", "only null", 0), (2, "", "xx", "a", 0), (3, "12 34", "xx", "b", 0), (4, "zz " * 30_000, "en", "a", 0), (4, "zz " * 30_000, "en", "a", 0), (None, "lone", "yy", "a", 0)]
    got = divergence.audit(frame(spark, rows), k, min_docs).collect()
    assert sorted(tuple(r) for r in got) == audited(rows, k, min_docs)


def test_divergence_of_nothing(spark):
    assert divergence.audit(frame(spark, [])).count() == 0


@pytest.mark.parametrize("k", [1, 3, 20])
def test_skyband(k):
    rng = np.random.default_rng(k)
    for n in (1, 40, 700):
        c, lang = rng.integers(1, 30, n), rng.integers(1, 60, n)
        lead = (c[None, :] >= c[:, None]) & (lang[None, :] <= lang[:, None]) & (np.arange(n)[None, :] < np.arange(n)[:, None])
        assert (divergence.skyband(c, lang, k) == (lead.sum(axis=1) < k)).all()


def test_shares_are_exact(spark):
    c, n, v = 10**15, 3 * 10**15 + 7, 10**6
    got = spark.range(1).select(divergence.share(F.lit(c), F.lit(n), F.lit(v))).first()[0]
    assert got == 1 + 10**9 * (c + 5) // (n + 5 * v)


# ---------------------------------------------------------------- op13

TURNS = "conv_id long, turn long, role string, text string, place int, state string, segments int, formatted string, t int"
NASTY = ["", "</s>", "<s>[INST] x [/INST]", "\\", "\\\\</s>", "<\\/s>", "<", "[", "</s", "[/INST", "\n", " ", "<<SYS>>\n", "\n<</SYS>>\n\n", "<turn>a<text>b</turn>",
         "é😀", "<\\<SYS>>", "<<s>", "<</s>>", "</s></s>", "[INST][/INST]"]


def said(spark, rows, template=chat.INSTRUCT):
    df = spark.createDataFrame([(*r, 1, "x", 1, "x", 1) for r in rows], TURNS)
    got = chat.conversations(df, template).withColumns({"turns": chat.read_turns(F.col("formatted"), template), "loss": chat.read_loss(F.col("segments"), template)})
    return {r.conv: r for r in got.collect()}


def test_round_trip(spark):
    rng = random.Random(5)
    rows = []
    for conv in range(300):
        roles = [["system", "user", "assistant"], ["user", "assistant", "user"], [rng.choice(["system", "user", "assistant", "tool", "", "</s>", "<text>"]) for _ in range(rng.randrange(1, 7))]][conv % 3]
        rows += [(conv, i, r, "".join(rng.choice(NASTY) for _ in range(rng.randrange(4)))) for i, r in enumerate(roles)]
    rng.shuffle(rows)
    got = said(spark, rows)
    for conv in range(300):
        turns = [(r, t) for _, _, r, t in sorted(x for x in rows if x[0] == conv)]
        assert [(t.role, t.text) for t in got[conv].turns] == turns
        assert got[conv].loss == "".join(t for r, t in turns if r == "assistant")
        assert got[conv].formatted == "".join(s.text for s in got[conv].segments)
    plain = [c for c in chat.INSTRUCT.control if c not in ("<turn>", "<text>", "</turn>")]
    count = lambda c: sum(got[0].formatted.count(x) for x in plain)
    assert count(0) == 6  # marks of a system, a user and an assistant turn and nothing else


def test_order_of_turns(spark):
    rows = {
        1: ["user", "assistant"], 2: ["system", "user"], 3: ["system", "user", "assistant", "user", "assistant"],
        -1: ["assistant", "user"], -2: ["user", "user"], -3: ["user", "system"], -4: ["system"], -5: ["user", "assistant", "system", "user"], -6: ["tool"], -7: ["", "user"],
    }
    got = said(spark, [(c, i, r, "x") for c, rs in rows.items() for i, r in enumerate(rs)])
    assert {c: r.valid for c, r in got.items()} == {c: c > 0 for c in rows}


def test_exact_format(spark):
    got = said(spark, [(1, 0, "system", "Be."), (1, 1, "user", "Hi</s>"), (1, 2, "assistant", "Yo\\"), (1, 3, "user", None), (2, 0, "bot", "b")])
    assert got[1].formatted == "<s>[INST] <<SYS>>\nBe.\n<</SYS>>\n\nHi<\\/s> [/INST] Yo\\\\ </s><s>[INST]  [/INST]"
    assert [s.text for s in got[1].segments if s.loss] == ["Yo\\\\"] and got[2].formatted == "<turn>bot<text>b</turn>"


def test_odd_turns(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (5, None, "assistant", "last"), (5, 3, "user", "first"), (6, 0, None, None), (7, 0, "user", "s"), (7, 0, "user", "s"),
            (8, 0, "user", "x" * 200_000), *((9, i, "assistant" if i % 2 else "user", "y") for i in range(3_000))]
    got = said(spark, rows)
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "a"), ("assistant", "b")] and got[None].valid
    assert [t.text for t in got[5].turns] == ["first", "last"] and [(t.role, t.text) for t in got[6].turns] == [("", "")] and len(got[7].turns) == 2
    assert got[8].turns[0].text == "x" * 200_000 and len(got[9].turns) == 3_000 and got[9].valid
    assert said(spark, []) == {}


@pytest.mark.parametrize("change", [{"escape": "<"}, {"control": ("<s>", "s>x")}, {"foreign": ("a", "b", "c")}, {"escape": "ab"}])
def test_bad_templates(change):
    with pytest.raises(ValueError):
        chat.Template(**{**{f: getattr(chat.INSTRUCT, f) for f in ("turns", "control", "foreign", "escape", "final")}, **change})


def test_chat_is_native(spark):
    plan = chat.conversations(spark.createDataFrame([], TURNS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange hashpartitioning") == 1
