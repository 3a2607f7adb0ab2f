"""How the terms of a source diverge from its language: exact distances of sources, and the terms a source overuses."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetable.session import cut_lineage

from .common import ship_by_value, sized_broadcast

ship_by_value(__name__)

FLUSH = 400_000  # (lang, source, term) entries or
FLUSH_BYTES = 64 << 20  # bytes of text that a task counts before it hands sums on
PIECE = 8_192  # terms of a group whose dominance is judged in one task
TILE = 64  # sources of one side of a tile
TILE_ROWS = 100_000  # counts that are handed to a tile's task
DENSE = 2_000_000  # shares of a tile that are laid out at once
# letters and everything beyond ASCII stay, A-Z in lower case; all else separates terms
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, term, c, docs)``: occurrences in the group and documents that hold the term; null is ''.

    Terms are runs of letters and of characters beyond ASCII, A-Z lower-cased. A task counts what it reads and hands on
    sums, so a frequent term or group is shuffled as one row for each task.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        entries = size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (g, s), (total, seen) in held.items():
                n = len(total)
                columns = [pa.array([x] * n, pa.string()) for x in (g, s)] + [pa.array(list(total), pa.binary())]
                sums = [np.fromiter(total.values(), np.int64, n), np.fromiter(map(seen.__getitem__, total), np.int64, n)]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(x) for x in sums], ["lang", "source", "term", "c", "docs"])

        for batch in batches:
            for g, s, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = t.translate(_TERM_BYTES).split()
                total, seen = held.setdefault((g, s), (Counter(), Counter()))
                entries -= len(total)
                total.update(found)
                seen.update(set(found))
                entries += len(total)
                size += len(t)
                if entries > FLUSH or size > FLUSH_BYTES:
                    yield from flush()
                    held, entries, size = {}, 0, 0
        yield from flush()

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))],
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    counted = rows.mapInArrow(work, "lang string, source string, term binary, c long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("docs").alias("docs"))


def kept_counts(docs: DataFrame, min_docs: int = 30, **columns: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored ``counts(lang, source, term, c, in_lang)`` of the terms in at least ``min_docs`` documents of their language,
    ``groups(lang, source, n)`` of every group that occurs, and ``langs(lang, v, n_lang)``.
    """
    counted = cut_lineage(term_counts(docs, **columns))
    known = counted.groupBy("lang", "term").agg(F.sum("c").alias("in_lang"), F.sum("docs").alias("_d")).where(F.col("_d") >= min_docs).drop("_d")
    known = cut_lineage(known)
    counts = cut_lineage(counted.drop("docs").join(known, ["lang", "term"]))
    named = [F.coalesce(F.col(columns.get(c, c)).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    sums = counts.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    groups = docs.select(*named).distinct().join(sums, ["lang", "source"], "left").fillna(0, ["n"])
    groups = cut_lineage(groups)
    terms = known.groupBy("lang").agg(F.count("*").alias("v"), F.sum("in_lang").alias("n_lang"))
    langs = groups.select("lang").distinct().join(terms, "lang", "left").fillna(0, ["v", "n_lang"])
    return counts, groups, cut_lineage(langs)


def share(c: Column, n: Column, v: Column) -> Column:
    """``1 + floor(10 ** 9 * (c + 5) / (n + 5 * v))``, exact for counts of any size; null without terms."""
    wide = [x.cast("decimal(20,0)") for x in (c, n, v)]
    return F.when(v > 0, 1 + F.call_function("div", F.lit(10**9).cast("decimal(10,0)") * (wide[0] + 5), wide[1] + 5 * wide[2]))


def skyband(c: np.ndarray, in_lang: np.ndarray, k: int) -> np.ndarray:
    """Of terms in UTF-8 order: which are dominated by fewer than ``k`` others, as a mask.

    One dominates another if its count in the group is not lower, its count in the language not higher and it stands earlier;
    whatever the totals are, it then ranks before the other.
    """
    order = np.lexsort((np.arange(len(c)), in_lang, -c))  # everything that dominates a term stands before it
    keep = np.zeros(len(c), bool)
    rivals = np.empty((2, 0), np.int64)
    for at in range(0, len(order), 256):
        some = order[at : at + 256]
        mine = np.stack([in_lang[some], some])
        ahead = ((rivals[0][None, :] <= mine[0][:, None]) & (rivals[1][None, :] < mine[1][:, None])).sum(axis=1)
        inside = (mine[0][None, :] <= mine[0][:, None]) & (mine[1][None, :] < mine[1][:, None])
        # at most k rivals that are kept themselves are enough to tell; within the chunk all are counted
        keep[some] = ahead + np.tril(inside, -1).sum(axis=1) < k
        rivals = np.concatenate([rivals, mine[:, keep[some]]], axis=1)
    return keep


def _band(rows: pa.Table, k: int) -> pa.Table:
    rows = rows.sort_by("term")
    return rows.filter(pa.array(skyband(rows.column("c").to_numpy(), rows.column("in_lang").to_numpy(), k)))


def overused(counts: DataFrame, groups: DataFrame, langs: DataFrame, k: int = 50) -> DataFrame:
    """``(lang, source, term, value, rank)``: the ``k`` terms whose share in the group exceeds that in the language most.

    Groups are cut into pieces of some ``PIECE`` terms; each keeps its skyband, the terms that fewer than ``k``
    others dominate, which holds every term that can rank. Bands are merged, fewer pieces each round, while that
    leaves terms out; what remains is ranked exactly, ties by UTF-8.
    """

    def work(rows: pa.Table) -> pa.Table:
        return _band(rows, k)

    band, pieces = counts, 0
    while True:
        largest = band.groupBy("lang", "source").agg(F.count("*").alias("m")).agg(F.max("m"), F.sum("m")).first()
        before, pieces = pieces, -(-(largest[0] or 0) // PIECE)
        if not largest[0] or pieces == before:
            break
        sizes = sized_broadcast(cut_lineage(band.groupBy("lang", "source").agg(F.ceil(F.count("*") / PIECE).alias("_p"))), 200_000)
        piece = F.pmod(F.xxhash64("term"), F.col("_p")).alias("_piece")
        dealt = band.join(sizes, ["lang", "source"]).select(*counts.columns, piece)
        banded = dealt.groupBy("lang", "source", "_piece").applyInArrow(lambda rows: work(rows.drop_columns(["_piece"])), counts.schema)
        band = cut_lineage(banded)
        if pieces == 1:
            break
    sums = sized_broadcast(cut_lineage(groups.join(langs, "lang")), 200_000)
    more = band.join(sums, ["lang", "source"]).withColumn(
        "value", share(F.col("c"), F.col("n"), F.col("v")) - share(F.col("in_lang"), F.col("n_lang"), F.col("v")))
    place = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "term")
    ranked = more.where("value > 0").withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("lang", "source", "term", "value", "rank")


def _tile(rows: pa.Table) -> pa.Table:
    """Sums of |p - q| over the terms of a tile for its ordered pairs of sources, and how many terms these are.

    Every source of the tile has one row without a term, so that one without any of the terms counts too.
    """
    heads = rows.filter(pc.is_null(rows.column("term")))
    rows = rows.filter(pc.is_valid(rows.column("term")))
    source, base, left = heads.column("source"), heads.column("p_none").to_numpy(), heads.column("left").to_numpy(zero_copy_only=False)
    n, both = len(source), heads.column("diagonal")[0].as_py()
    at_source = pc.index_in(rows.column("source"), source.combine_chunks()).to_numpy().astype(np.int64)
    coded = rows.column("term").combine_chunks().dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    at_term, terms, p = coded.indices.to_numpy(), len(coded.dictionary), rows.column("p").to_numpy()
    sums = np.zeros((n, n), np.int64)
    step = max(1, DENSE // n)
    order = np.argsort(at_term, kind="stable")
    for first in range(0, terms, step):
        some = order[slice(*np.searchsorted(at_term[order], [first, first + step]))]
        dense = np.repeat(base[None, :], min(step, terms - first), axis=0)
        dense[at_term[some] - first, at_source[some]] = p[some]
        for i in np.flatnonzero(left):
            sums[i] += np.abs(dense - dense[:, i : i + 1]).sum(axis=0)
    a, b = np.nonzero(left[:, None] & (np.ones(n, bool) if both else ~left)[None, :] & ~np.eye(n, dtype=bool))
    lang = pa.array([heads.column("lang")[0].as_py()] * len(a), pa.string())
    columns = [lang, source.take(pa.array(a)), source.take(pa.array(b)), pa.array(sums[a, b], pa.int64()), pa.array(np.full(len(a), terms), pa.int64())]
    return pa.table(columns, ["lang", "source", "other", "value", "terms"])


def distances(counts: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """``(lang, source, other, value)``: for each ordered pair of a language's sources the sum of |p - q| over all kept terms.

    Sources stand in blocks of ``TILE``; two blocks and a share of the terms make a tile, in which one task holds a bounded
    number of counts. Terms that neither source holds all differ by the same, so they are counted instead of listed.
    """
    rows = counts.groupBy("lang").agg(F.count("*").alias("_m"))
    named = groups.join(langs, "lang").join(rows, "lang", "left")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    none = F.coalesce(share(F.lit(0), F.col("n"), F.col("v")), F.lit(0).cast("long"))
    named = named.withColumns({"block": F.floor(place / TILE).cast("int"), "p_none": none, "parts": F.ceil(F.coalesce("_m", F.lit(1)) / TILE_ROWS).cast("int")})
    named = named.withColumn("blocks", F.max("block").over(Window.partitionBy("lang")) + 1)
    named = cut_lineage(named.select("lang", "source", "n", "v", "block", "blocks", "parts", "p_none"))
    listed = counts.join(sized_broadcast(named, 200_000), ["lang", "source"])
    listed = listed.select("lang", "source", "term", share(F.col("c"), F.col("n"), F.col("v")).alias("p"), "p_none", "block", "blocks",
                           F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("part"))
    heads = named.select("lang", "source", F.lit(None).cast("binary").alias("term"), F.col("p_none").alias("p"), "p_none", "block", "blocks",
                         F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    dealt = listed.unionByName(heads).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("block", "y"), F.greatest("block", "y")
    dealt = dealt.select("lang", "source", "term", "p", "p_none", "part", i.alias("i"), j.alias("j"),
                         (F.col("block") == i).alias("left"), (i == j).alias("diagonal"))
    tiled = dealt.groupBy("lang", "i", "j", "part").applyInArrow(_tile, "lang string, source string, other string, value long, terms long")
    summed = tiled.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    summed = cut_lineage(summed)
    back = summed.join(summed.select("lang", F.col("source").alias("other"), F.col("other").alias("source"), F.lit(True).alias("_both")),
                       ["lang", "source", "other"], "left_anti")
    turned = back.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value", "terms")
    one = named.select("lang", "source", "p_none", "v")
    two = sized_broadcast(named.select("lang", F.col("source").alias("other"), F.col("p_none").alias("q_none")), 200_000)
    pairs = summed.unionByName(turned).join(sized_broadcast(one, 200_000), ["lang", "source"]).join(two, ["lang", "other"])
    rest = (F.col("v") - F.col("terms")) * F.abs(F.col("p_none") - F.col("q_none"))
    return pairs.select("lang", "source", "other", (F.col("value") + rest).alias("value"))


def audit(docs: DataFrame, k: int = 50, min_docs: int = 30, **columns: str) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of every group (language, source).

    Part ``pair``: the other sources of the language by the sum of |p - q| over the language's kept terms, p and q the
    smoothed shares of a term in either. Part ``term``: the ``k`` terms whose share in the group exceeds the
    language's most. Value descending, item ascending by UTF-8. ``columns`` name text, lang and source; null is ''. A group
    without terms takes part with smoothed shares alone; repeated rows count as often as they stand; other columns play no part.
    """
    counts, groups, langs = kept_counts(docs, min_docs, **columns)
    terms = overused(counts, groups, langs, k).select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank")
    pairs = distances(counts, groups, langs)
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "other"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", place.alias("rank"))
    return pairs.unionByName(terms)
