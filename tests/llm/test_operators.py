"""The dealt operators against brute force, and their defined results for odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetable.llm import decontam, embeddings, langid, linedup, minhash, mixing, packing, pagetext, sharding, suffix
from kinetable.llm import common
from kinetable.llm.queries import QUERIES, VOCABULARY

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, id long, hash long, n int, spans string, copies int, "
        "plan int, ranges int, quotas int, partner int")


def frame(spark, texts, sources=None):
    """Documents with extra columns whose names the operators use inside."""
    rows = [(i, t, "en", (sources or ["a"] * len(texts))[k], 0, 7, 7, 7, "x", 7, 7, 7, 7, 7) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [(1, None), (2, ""), (3, " \n "), (4, "word"), (5, "word"), (5, "word"), (None, "alone here"), (6, "x" * 50_000), (7, "y z " * 9_000)]


# ---------------------------------------------------------------- op1

@pytest.mark.parametrize("page, text", [
    ("<body><nav><a href=a>Home</a></nav><article><h1>T &amp; U</h1><p>One,\n two.<br>three <p><b>Four. Five, six.</article><footer>F</footer>",
     "T & U\n\nOne, two. three\n\nFour. Five, six."),
    ("<div class=sidebar>Side, bar.</div><div id=content><h2>H</h2><p>A long text, with marks. It goes on, and on, for some time.</p><p>Another text, with marks. It goes on as well.</p></div>"
     "<div class='comments'><p>I like it, a lot. Really, I do.</p></div><div>Made by us</div>", "H\n\nA long text, with marks. It goes on, and on, for some time.\n\nAnother text, with marks. It goes on as well."),
    ("<main><p>Kept. Text, here.<script>var t='</p>';</script><style>p{}</style><form><p>Name</p></form><aside>No</aside><ul><li>a<li>b</ul></main>",
     "Kept. Text, here.\n\na\n\nb"),
    ("<article><header><h1>Title</h1><p>by me</p></header><p>Body, text. More&nbsp;&#x41;.</p></article>", "Title\n\nBody, text. More A."),
    ("<div class='has-sidebar post'><p>Only, this. Text here.</p></div><div role=navigation>menu</div><p hidden>no</p><!-- <p>no -->", "Only, this. Text here."),
    ("plain < text", "plain < text"), ("", ""), (None, ""), ("<p>unclosed <b", "unclosed <b"), ("<nav>only</nav>", ""),
])
def test_pages(page, text):
    assert pagetext.main_text(page, 0.2, 1) == text


_P = "<p>A long text, with marks. It goes on, and on, for some time.</p><p>Another text, with marks. It goes on as well.</p>"
_T = "A long text, with marks. It goes on, and on, for some time.\n\nAnother text, with marks. It goes on as well."


@pytest.mark.parametrize("page, text", [
    (f"<div class='content-sidebar-wrap'><main>{_P}</main></div>", _T),
    (f"<div class='post type-post category-social tag-legal'>{_P}<div class=sharebar>Share, this.</div></div><div>Made by us</div>", _T),
    (f"<form id=form1>{_P}</form>", _T),
    (f"<div class=post><div class='post-header'><h1>Title</h1></div><div class=body>{_P}</div></div>", f"Title\n\n{_T}"),
    (f"<div class=post><div class='post-header'><h1>Title</h1></div>{_P}</div>", f"Title\n\n{_T}"),
    (f"<div id=x>{_P}<span class=z></span><div class=meta>5 min</div><h2>H</h2>{_P}</div>", f"{_T}\n\nH\n\n{_T}"),
    (f"<div id=x>{_P}</div><div class=comments>{'<p>I like it, a lot. Really, I do, and so do many others.</p>' * 5}</div>", _T),
])
def test_names_lower_scores(page, text):
    assert pagetext.main_text(page, 0.2, 1) == text


@pytest.mark.parametrize("name", ["related-work", "search-results", "legal-basis", "social-impact", "comment-on-theory", "plain"])
@pytest.mark.parametrize("attr", ["class", "id"])
def test_names_in_part_need_furniture(name, attr):
    section = "A part of the article, with a heading of its own. It has sentences, like the others."
    page = f"<article>{_P * 5}<section {attr}='{name}'><h2>Part</h2><p>{section}</p></section>{_P}</article>"
    assert pagetext.main_text(page, 0.2, 1) == "\n\n".join([_T] * 5 + ["Part", section, _T])
    if name != "plain":
        links = f"<ul {attr}='{name}'><li><a href=a>One of the other pages, here.</a></li><li><a href=b>Two of the other pages, here.</a></li></ul>"
        assert pagetext.main_text(f"<article>{_P * 5}{links}</article>", 0.2, 1) == "\n\n".join([_T] * 5)


@pytest.mark.parametrize("name", ["comments", "reader-comments", "comment-list", "cookie-banner", "ad-slot-3", "sidebar-left", "related-posts"])
def test_names_that_end_in_furniture(name):
    page = f"<article>{_P * 5}<section class='{name}'><h2>Part</h2><p>It has sentences, like the others. It leaves, all the same.</p></section></article>"
    assert pagetext.main_text(page, 0.2, 1) == "\n\n".join([_T] * 5)


@pytest.mark.parametrize("page", [
    "<a " * 100_000, "<div>x, y.\n" * 30_000, "<div>" * 50_000 + "</section>" * 50_000, '<a "x>" ' * 60_000 + "'", "<script>" + "</script " * 60_000,
    "<div class=ad>x<h2>y</h2>" * 20_000, "<table><tr><td>x" * 30_000, "<article><header class=ad>x" * 20_000, "<!--" * 100_000, "<ul><li>a." * 40_000,
], ids=range(10))
def test_hostile_pages_take_linear_time(page):
    start = time.process_time()
    pagetext.main_text(page, 0.2, 1)
    assert time.process_time() - start < 10  # a quadratic reader needs minutes


def blocks_by_hand(node, above=()):
    """Text under each path of a made page: (labels from the root on, text), menus left out."""
    found = []
    for child in node[1:]:
        if isinstance(child, str):
            found.append((above, child))
        elif child[0] != "nav":
            found += blocks_by_hand(child, (*above, child[0]))
    return found


def test_page_trees():
    rng = random.Random(8)

    def grow(depth):
        made = []
        for _ in range(rng.randint(0, 4)):
            if depth and rng.random() < 0.6:
                made.append((rng.choice(["div", "section", "blockquote", "nav", "article"]), *grow(depth - 1)))
            else:
                made.append(("p", rng.choice(["One, two.", "Three & four", "five"])))
        return made

    def render(node):
        if isinstance(node, str):
            return rng.choice([" ", "\n", ""]) + node.replace("&", rng.choice(["&amp;", "&#38;", "&"])) + rng.choice([" ", "<!-- > -->", ""])
        close = "" if node[0] == "p" and rng.random() < 0.5 else f"</{node[0]}>"
        return f"<{node[0]}{rng.choice(['', ' title=\'a>b\'', ' x=1'])}>" + "".join(map(render, node[1:])) + close

    for _ in range(300):
        tree = ("", *grow(5))
        page = pagetext.parse("".join(map(render, tree[1:])))
        names = {v: k for k, v in page.paths.items()}

        def path(i):
            return (*path(names[i][0]), names[i][1]) if i else ()

        assert [(path(page.path[b[0]]), b[2]) for b in page.blocks] == blocks_by_hand(tree)
        for b in page.blocks:  # what holds a block is numbered around it
            i = b[0]
            while i:
                assert page.parent[i] <= b[0] <= page.end[page.parent[i]]
                i = page.parent[i]


def test_extract_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<p>Aé, b.</p>", "old"), (None, None, None, None)], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in pagetext.extract(pages).collect()}
    assert got == {1: ("Aé, b.", 6), None: ("", 0)}
    assert pagetext.extract(pages.limit(0)).count() == 0
    twice = pagetext.extract(pages.union(pages)).groupBy("page_id", "url", "text", "n_chars").count().collect()
    assert sorted(r["count"] for r in twice) == [2, 2]


# ---------------------------------------------------------------- op2

def hits_by_hand(text, items, width):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    own, hit, found = low(text), set(), set()
    for item, passage in items:
        p = low(passage)
        n = min(width, len(p))
        for k in range(len(p) - n + 1) if p else []:
            for i in range(len(own) - n + 1):
                if own[i : i + n] == p[k : k + n]:
                    hit.update(range(i, i + n))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("block", [32 << 20, 40])
def test_decontamination(spark, block):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(["A", "b", "ÉE", "c1", "d,"]) for _ in range(n))
    items = [(i, say(rng.randint(1, 7))) for i in range(12)] + [(12, None), (13, ""), (None, "b c1 b")]
    docs = ODD + [(100 + i, say(rng.randint(0, 40))) for i in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find(frame(spark, docs), bench, width=4, block_bytes=block).select("doc_id", "text", "found").collect()
    named = [("null" if i is None else i, t) for i, t in items]
    for r in got:
        n, hit, found = hits_by_hand(r.text, named, 4)
        assert (r.found.n_words, sum(x.end - x.first for x in r.found.runs), list(r.found["items"])) == (n, hit, found)
        for s in r.found.spans:  # offsets of the original text
            assert not r.text[s.first : s.end].startswith(" ") and len(r.text[s.first : s.end].split()) >= 1
    assert len(got) == len(docs)
    assert decontam.find(frame(spark, docs), bench.limit(0)).where(decontam.hits(F.col("found")) > 0).count() == 0
    assert decontam.strip(frame(spark, []), bench).count() == 0


# ---------------------------------------------------------------- op3

def test_best_fit():
    rng = random.Random(2)
    for _ in range(200):
        most = rng.randint(1, 30)
        lengths = [rng.randint(1, most) for _ in range(rng.randint(0, 60))]
        rows = packing.best_fit(lengths, most)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        free = []
        for n in sorted(lengths, reverse=True):  # the same by looking at every row
            room = [f for f in free if f >= n]
            if room:
                free.remove(min(room))
            free.append((min(room) if room else most) - n)
        assert sorted(most - sum(lengths[i] for i in r) for r in rows) == sorted(free)


@pytest.mark.parametrize("buffer", [8 << 20, 300])
def test_packing_round_trip(spark, buffer):
    docs = ODD + [(100 + i, f"Some text {i}, naïve 漢字. " * (i % 40)) for i in range(80)]
    ranks = packing.vocabulary(spark, VOCABULARY)
    rows = packing.pack(frame(spark, docs).repartition(3), ranks, width=64, buffer_tokens=buffer).collect()
    assert len({r.pack_id for r in rows}) == len(rows)
    found = defaultdict(list)
    for r in rows:
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 64
        assert (ids[r.n_tokens :] == 50256).all()
        for k, piece, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b].tolist() == list(range(b - a))
            found[k].append((piece, ids[a:b].tolist()))
    encoding = packing.encoder(ranks, packing.PATTERN)
    texts = defaultdict(list)
    for k, t in docs:
        texts[k].append(t or "")
    for k, want in texts.items():
        pieces = sorted(found[k])
        if len(want) == 1:
            ids = [x for _, part in pieces for x in part]
            assert ids[-1] == 50256 and encoding.decode(ids[:-1]) == want[0]
            assert [n for n, _ in pieces] == list(range(len(pieces)))
        else:
            assert len(pieces) == len(want)
    assert packing.pack(frame(spark, []), ranks).count() == 0


# ---------------------------------------------------------------- op4

def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 64)  # several blocks a list
    draw = np.random.default_rng(4)
    base = draw.normal(size=(300, 16))
    near = np.repeat(base[:20], 12, axis=0) + draw.normal(scale=0.09, size=(240, 16))
    hot = np.repeat(base[:1], 40, axis=0)
    rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(np.vstack([base, near, hot]))]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [float("inf")] + [1.0] * 15), (904, [None] * 16), (905, [1.0]), (906, [])]
    odd += [(907, [0.0, 1.0])]
    short = [(910, [1.0, 2.0, 2.0], 2), (911, [2.0, 4.0, 4.0], 2), (912, [2.0, 4.0, 4.0], 2), (913, [2.0, -4.0, 1.0], 2)]  # another length links within itself
    vectors = spark.createDataFrame(rows + [(i, v, 2) for i, v in odd] + short, "vec_id long, embedding array<float>, sid int").repartition(4)
    got = {r.id: r for r in embeddings.link(vectors, probes=6).collect()}
    whole = np.array([v for _, v, _ in rows], np.float64)
    unit = whole / np.linalg.norm(whole, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.9
    np.fill_diagonal(links, False)
    n = np.array([got[i].n_links for i in range(len(rows))])
    assert (n <= links.sum(axis=1)).all() and n.sum() >= 0.97 * links.sum()
    label = list(range(len(rows)))
    for _ in rows:
        label = [min([label[i], *(label[j] for j in np.flatnonzero(links[i]))]) for i in range(len(rows))]
        if all(label[i] == label[j] for i, j in zip(*np.nonzero(links), strict=True)):
            break
    assert np.mean([got[i].component_id == label[i] for i in range(len(rows))]) > 0.97
    assert all(r.kept == (r.id == r.component_id) for r in got.values())
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _ in odd)
    assert [(got[i].n_links, got[i].component_id) for i in range(910, 914)] == [(2, 910)] * 3 + [(0, 913)]
    assert embeddings.link(vectors.where("vec_id > 899 and vec_id < 905")).count() == 5
    assert embeddings.link(vectors.limit(0)).count() == 0


# ---------------------------------------------------------------- op5

def removed_by_hand(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(x[i : i + length] for x in raw for i in range(len(x) - length + 1))
    for x in raw:
        gone = np.zeros(len(x) + 1, bool)
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0)).tolist()
        kept = bytes(b for b, g in zip(x, gone) if not g)
        yield len(x), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("shard", [1_000_000, 60])
def test_suffix_dedup(spark, monkeypatch, shard):
    monkeypatch.setattr(suffix, "SHARD_BYTES", shard)  # 60: every anchor is larger than a shard
    rng = random.Random(9)
    say = lambda n: "".join(rng.choice("ab é") for _ in range(n))
    passages = [say(60) for _ in range(3)]
    docs = [(1, None), (2, ""), (3, "ab" * 40), (4, "same text, twice over " * 3), (5, "same text, twice over " * 3), (5, "same text, twice over " * 3), (None, "q" * 100), (6, "ab" * 25 + "X" + "ba" * 25)]
    docs += [(10 + i, say(rng.randint(0, 60)) + rng.choice(passages)[rng.randint(0, 20) :] + say(rng.randint(0, 50))) for i in range(40)]
    got = suffix.repeats(frame(spark, docs).repartition(3), length=30).select("doc_id", "text", suffix.digest().alias("d")).collect()
    want = {(i, t): w for (i, t), w in zip(docs, removed_by_hand([t for _, t in docs], 30))}
    assert len(got) == len(docs)
    assert all(tuple(r.d) == want[r.doc_id, r.text] for r in got)
    assert suffix.repeats(frame(spark, [])).count() == 0


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(150):
        text = np.array([rng.randint(1, rng.choice([1, 2, 20])) for _ in range(rng.randint(1, 60))] + [0], np.int16)
        order = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        array = suffix.suffix_array(text)
        assert array.tolist() == order
        shared = suffix.common_prefixes(text, array)
        for a, b in zip(order, order[1:]):
            n = 0
            while text[a + n] == text[b + n]:
                n += 1
            assert shared[b] == n


# ---------------------------------------------------------------- op6

def test_shards(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(9).alias("shard")).union(spark.createDataFrame([(None, 1), (None, 1)], "a long, b int"))
    got = sharding.assign(docs, sharding.topology(40)).withColumn("grown", sharding.shard_of([F.col("doc_id")], sharding.topology(41))).cache()
    sizes = got.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.countDistinct("slot").alias("d")).collect()
    assert {r.shard for r in sizes} == set(range(40)) and all(400 < r.n < 600 and (r.lo, r.hi, r.d) == (0, r.n - 1, r.n) for r in sizes)
    moved = got.where("grown <> shard").groupBy("grown").count().collect()
    assert [r.grown for r in moved] == [40] and 350 < moved[0]["count"] < 650
    assert got.where("doc_id is null").select("shard").distinct().count() == 1
    assert sharding.assign(docs.limit(0), sharding.topology(3)).count() == 0
    # a heavier shard draws rows into its region, its rack and itself only
    tree = sharding.topology(40)
    heavy = [sharding.Shard(s.region, s.rack, s.shard, 3.0 if s.shard == 7 else 1.0) for s in tree]
    both = docs.select(sharding.shard_of([F.col("doc_id")], tree).alias("a"), sharding.shard_of([F.col("doc_id")], heavy).alias("b"))
    at = {s.shard: s for s in tree}
    for r in both.where("a <> b").distinct().collect():
        assert at[r.b].region == 0 and (at[r.a].region != 0 or at[r.b].rack == 1) and (at[r.a].rack != 1 or r.b == 7)


# ---------------------------------------------------------------- op7

def test_mixing(spark):
    rng = random.Random(6)
    names = ["a", "b", None, "é", "B"]
    rows = [(i, " ".join("w" * rng.randint(1, 30))) for i in range(3_000)] + [(None, None), (7, ""), (7, "")]
    sources = [rng.choices(names, [60, 10, 2, 20, 8])[0] for _ in rows]
    docs = frame(spark, rows, sources).withColumn("size", mixing.word_count())
    mixed = mixing.mix(docs, F.array("source"), [F.col("doc_id"), F.col("text")], F.col("size"), repeats=3).cache()
    size = Counter()
    for (_, t), s in zip(rows, sources):
        size[s] += len((t or "").split())
    order = ["B", "a", "b", "é", None]
    weight = dict(zip(order, [1, 2, 3, 1, 2]))
    target, left, free = {}, sum(size.values()), set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 3 * size[s]}
        for s in full or free:
            target[s] = 3 * size[s] if full else weight[s] * level
        left -= sum(3 * size[s] for s in full)
        free -= full or free
    got = mixed.select("source", "size", "copies", F.element_at("quotas", 1).alias("q")).collect()
    taken = Counter()
    for r in got:
        assert 0 <= r.copies <= 3 and r.q.size == size[r.source] and abs(r.q.target - target[r.source]) < 1e-6 * max(1, target[r.source])
        taken[r.source] += r.copies * r["size"]
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= 31 for s in order)
    again = mixing.mix(docs.repartition(5), F.array("source"), [F.col("doc_id"), F.col("text")], F.col("size"), broadcast_bytes=0)
    assert sorted(map(str, again.select("doc_id", "source", "copies").collect())) == sorted(map(str, mixed.select("doc_id", "source", "copies").collect()))
    whole = mixing.repeat(docs, sources=F.array("source"), key=[F.col("doc_id"), F.col("text")], size=F.col("size"))
    assert whole.columns == docs.columns and whole.where("copies <> 7 OR plan <> 7 OR quotas <> 7").count() == 0
    assert whole.columns == docs.columns and whole.count() == sum(r.copies for r in got)
    assert mixing.mix(docs.limit(0), F.array("source"), [F.col("doc_id")], F.col("size")).count() == 0


def test_overlapping_sources(spark):
    # the two-source pattern goes where the single ones fall short
    assert mixing.flow([(10.0, [0]), (10.0, [0, 1]), (5.0, [1])], [20.0, 5.0], 3) == [{0: 10.0}, {0: 10.0, 1: 0.0}, {1: 5.0}]
    rows = [(i, ["x"]) for i in range(200)] + [(i, ["y", "x", "y"]) for i in range(200, 400)] + [(400, None), (401, []), (402, [None])]
    docs = spark.createDataFrame(rows, "doc_id long, of array<string>")
    mixed = mixing.mix(docs, F.col("of"), [F.col("doc_id")], F.lit(10).cast("long"), cycle=(1.0, 3.0), repeats=2)
    taken = Counter()
    for r in mixed.collect():
        assert r.copies == sum(s.copies for s in r.shares) <= 2
        for s in r.shares:
            taken[s.source] += 10 * s.copies
    targets = {q.source: q.target for r in mixed.collect() for q in r.quotas}
    assert all(abs(taken[s] - t) <= 20 for s, t in targets.items()), (taken, targets)


# ---------------------------------------------------------------- op8

def test_language(spark):
    rng = random.Random(8)
    words = {"en": ["the", "house", "with", "and", "thing", "over"], "de": ["und", "haus", "über", "nicht", "schön", "ein"]}
    say = lambda l, n: " ".join(rng.choice(words[l]) for _ in range(n))
    rows = [(i, say(l, 30), l) for i in range(200) for l in ("en", "de")]
    known = spark.createDataFrame(rows + [(None, "x", "en"), (1, None, "en"), (2, "the", None)], "doc_id long, text string, lang string")
    model = langid.fit(known)
    asked = [(i, say(l, 12), l, 3) for i in range(60) for l in ("en", "de")] + [(i, t, None, 3) for i, t in ODD] + [(8, "12 _ ?!", None, 3)]
    docs = spark.createDataFrame(asked, "doc_id long, text string, lang string, score int")
    got = langid.identify(docs, model).collect()
    assert all(r.lang_pred == r.lang for r in got if r.lang)
    assert all(0 <= r.score <= 1 for r in got) and {r.lang_pred for r in got} <= {"en", "de", "und"}
    assert all((r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) for r in got)
    assert all(r.rejected for r in got if r.lang_pred == "und")
    one = langid.identify(docs, langid.fit(known.where("lang = 'en'"))).where("lang is not null").select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in one] == ["en"]
    none = langid.identify(docs, langid.fit(known.limit(0)))
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_language_sample_is_shared_out(spark):
    word = lambda i: "".join(chr(97 + int(d)) for d in f"{i:03}")
    rows = [(i, f"{'a' if i % 2 else 'z'} {word(i)} " + f"filler{word(i)} " * 140, "en") for i in range(100)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), dict_bytes=10_000)
    made = model.dictionaries["en"]
    assert len(made) <= 10_000 and all(f"{'a' if i % 2 else 'z'} {word(i)} ".encode() in made for i in range(100))
    assert langid.shared_out([b"ab", b"cdefgh", b"ijklmn"], 12) == b"ab cdef ijkl" and langid.shared_out([b"ab", b"cd"], 9) == b"ab cd"
    assert langid.shared_out(["\u00e9\u00e9\u00e9".encode()], 5) == "\u00e9\u00e9".encode()


def test_language_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = QUERIES["op8_language_id"](spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.where("held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


# ---------------------------------------------------------------- op9

def test_patience():
    assert linedup.patience([1, 2, 3, 4], [1, 9, 3, 4, 2]) == [(0, 0), (2, 2), (3, 3)]
    assert linedup.patience([5, 5, 1, 5], [5, 1, 5, 5]) == [(0, 0), (3, 3)] or linedup.patience([5, 5, 1, 5], [5, 1, 5, 5])
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randint(1, 8) for _ in range(rng.randint(0, 12))] for _ in "ab")
        found = linedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in found) and all(x < y and u < v for (x, u), (y, v) in zip(found, found[1:]))


def test_line_dedup(spark):
    block = [f"a shared line, number {i}, long enough to count as one" for i in range(4)]
    own = lambda n: [f"only document {n} says this, line {i}, nobody else does" for i in range(3)]
    rows = [
        (1, "\n".join(own(1)[:1] + block + own(1)[1:])), (2, "\n".join(own(2) + block[1:3] + ["x"])), (3, "\n".join(block)), (3, "\n".join(block)),
        (4, "\n".join(["short", "lines", "that together are long enough for this"])), (5, "\n".join(["q", "short", "lines", "that together are long enough for this"])),
        (None, "\n".join(block)), *[(10 + i, t) for i, (_, t) in enumerate(ODD)],
    ]
    got = {}
    for r in linedup.dedup(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_lines, [tuple(x) for x in r.removed], r.partners))
    assert got[1] == [(rows[0][1], 7, [], [])]
    assert got[2] == [("\n".join([*own(2), "x"]), 6, [(3, 5)], [1])]
    assert got[3] == [("", 4, [(0, 4)], [1])] * 2
    assert got[5] == [("q", 4, [(1, 4)], [4])] and got[None][0][0] == "\n".join(block)
    assert got[10] == [(None, 0, [], [])] and len(got) == 15
    assert linedup.dedup(frame(spark, [])).count() == 0


def test_line_dedup_beyond_first_holder(spark):
    long = "a line that is long enough by itself to be a block"
    s = [f"short line {i:04}" for i in range(4)]
    fixtures = [
        [s[1:3], s[2:4], ["p", *s[1:4], "q"], ["r", *s[1:4], "t"]],
        [["x", long, "y", long, "z"], ["p", long, "q"], ["u", long, "v"], ["w", long]],
    ]
    rng = random.Random(7)
    for _ in range(6):
        say = lambda: rng.choice([f"{rng.randint(0, 5)} short text", f"{rng.randint(0, 9)} {long}", "", f"own {rng.random()}"])
        fixtures.append([[say() for _ in range(rng.randint(1, 14))] for _ in range(25)])
    for _ in range(4):  # lines that stand several times, few that stand once
        say = lambda: rng.choice([f"{rng.randint(0, 1)} {long}"] * 3 + ["", "", f"{rng.randint(0, 3)} short text", f"own {rng.random()}"])
        fixtures.append([[say() for _ in range(rng.randint(1, 12))] for _ in range(25)])
    rows = [(100 * i + j, "\n".join([f"# {i} " + x if x else "" for x in d])) for i, docs in enumerate(fixtures) for j, d in enumerate(docs)]
    made = {i: linedup.line_hashes(t) for i, t in rows}
    want = {}
    for b in made:  # every pair of documents
        gone = set()
        for a in made:
            if a < b:
                for x, y in linedup.common_blocks(made[a][0], *made[b], 40):
                    gone.update(range(x, y))
        want[b] = gone
    got = {r.doc_id: {x for o in r.removed for x in range(o.first, o.end)} for r in linedup.dedup(frame(spark, rows)).collect()}
    assert got == want
    assert want[3] == {1, 2, 3} and want[102] == {1} and want[103] == {1}


def test_ruler_lines_form_no_pairs(spark, monkeypatch):
    ruler, pairs = "=" * 60, []
    real = linedup.aligned
    monkeypatch.setattr(linedup, "aligned", lambda lines, both, least: pairs.append(both.count()) or real(lines, both, least))
    rows = [(i, "\n".join([f"first {i}", ruler, f"middle {i}", ruler, f"last {i}"])) for i in range(120)]
    got = linedup.dedup(frame(spark, rows)).collect()
    assert all(not r.removed for r in got) and sum(pairs) == 119  # each with the first holder, no others
    rows += [(200, "\n".join(["first 7", ruler, "own", ruler])), (201, "\n".join(["x", ruler, "middle 9", ruler, "y"]))]
    got = {r.doc_id: [tuple(x) for x in r.removed] for r in linedup.dedup(frame(spark, rows)).collect() if r.removed}
    pairs.clear()
    blank = [(i, "\n".join([f"first {i}", ruler, f"a {i}", "", f"b {i}", ruler, f"last {i}"])) for i in range(60)]
    blank += [(300 + i, "\n".join(["", "", f"one {i}", ruler, f"two {i}", ruler, f"three {i}", ""])) for i in range(60)]
    assert not any(r.removed for r in linedup.dedup(frame(spark, blank)).collect()) and sum(pairs) == 119  # blank lines lead nobody together
    assert linedup.patience([1, 0, 2, 1], [3, 1, 1, 0, 4, 1, 3]) == [] and linedup.patience([5, 0, 2], [6, 5, 0, 3]) == [(0, 1), (1, 2)]
    made = [(i, *linedup.line_hashes(t)) for i, t in rows]
    want = {b[0]: [x for a in made if a[0] < b[0] for x in linedup.common_blocks(a[1], b[1], b[2], 40)] for b in made[-2:]}
    assert got == want == {200: [(0, 2), (3, 4)], 201: [(1, 4)]}  # without the shared start the second ruler is unique in both


# ---------------------------------------------------------------- op10

def groups_by_hand(docs, width, percent):
    sets = []
    for _, t in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) if x]
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    label = [i for i, _ in docs]
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(sets):
            for j in range(i):
                n = len(x & sets[j])
                if n and 100 * n >= percent * (len(x) + len(sets[j]) - n) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return [len(s) for s in sets], label


@pytest.mark.parametrize("width", [2, 5])
def test_minhash(spark, monkeypatch, width):
    monkeypatch.setattr(minhash, "BLOCK", 4)  # groups of several blocks
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 60))] for _ in range(12)]
    docs = [(i, t) for i, t in ODD if i is not None]
    for i in range(150):
        words = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        docs.append((1000 - i, rng.choice([" ", "\n"]).join(words).upper() if i % 2 else " ".join(words)))
    got = minhash.group(frame(spark, docs).repartition(3), width=width).collect()
    n, label = groups_by_hand(docs, width, 80)
    want = Counter(((i, a, b, i == b) for (i, _), a, b in zip(docs, n, label)))
    assert Counter((r.id, r.n_shingles, r.component_id, r.kept) for r in got) == want
    keep = minhash.representatives(frame(spark, docs), width=width)
    assert Counter(r.doc_id for r in keep.collect()) == Counter({i for (i, _), b in zip(docs, label) if i == b})
    assert minhash.group(frame(spark, [(None, "a b c"), (None, "a b c"), (9, "A b c")])).where("component_id = 9").count() == 3
    assert minhash.group(frame(spark, [])).count() == 0


def test_one_representative_of_equal_keys(spark):
    base = " ".join(f"w{i}" for i in range(60))
    docs = [(1, base), (1, base + " x"), (1, base + " y"), (2, base + " z"), (5, "something else entirely, all alone here"), (5, "and another text that has nothing in common")]
    other = " ".join(f"v{i}" for i in range(60))
    docs += [(None, other), (None, other + " x"), (None, other + " x"), (None, other + " y"), (None, None), (7, None)]
    kept = [(r.doc_id, (r.text or "")[:2]) for r in minhash.representatives(frame(spark, docs), width=5).collect()]
    assert Counter(kept) == Counter([(1, "w0"), (5, "so"), (5, "an"), (None, "v0"), (None, ""), (7, "")])


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(300)] + [(1000 + rng.randint(0, 80), 1000 + rng.randint(0, 80)) for _ in range(60)] + [(5000, i) for i in range(5001, 5200)]
    got = {r.id: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {x: x for ab in links for x in ab}
    for _ in range(400):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    loops = {x for x in label if all(a == b for a, b in links if x in (a, b))}
    assert got == {x: y for x, y in label.items() if x not in loops}
