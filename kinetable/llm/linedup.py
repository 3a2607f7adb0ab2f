"""Line dedup by pairwise patience alignment."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetable.session import cut_lineage

from .common import ship_by_value, sized_broadcast

ship_by_value(__name__)


def line_hashes(text: str | None) -> tuple[list[int], list[int]]:
    """64-bit hash and length of every line without the white space around it; blank lines have hash 0."""
    lines = [x.strip() for x in text.split("\n")] if text else []
    return [xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63) if x else 0 for x in lines], [len(x) for x in lines]


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs rising in both members; ``pairs`` rise in the first."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        if at == len(tops):
            tops.append(b)
            ends.append(i)
        else:
            tops[at], ends[at] = b, i
        back.append(ends[at - 1] if at else -1)
    chain, i = [], ends[-1] if ends else -1
    while i >= 0:
        chain.append(pairs[i])
        i = back[i]
    return chain[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of two lists: lines unique in both, in rising order, grown over equal neighbours, and the
    same again between them. Blank lines (0) extend what is aligned and start nothing.
    """
    found: list[tuple[int, int]] = []
    stack = [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        many_a, many_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {x: j for j, x in enumerate(b[b0:b1], b0) if many_b[x] == 1 and x}
        chain = _rising([(i, at[x]) for i, x in enumerate(a[a0:a1], a0) if many_a[x] == 1 and x in at])
        if chain:
            edges = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
            found.extend(chain)
            stack.extend((x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:], strict=False))
    return sorted(found)


def common_blocks(a: list[int], b: list[int], sizes: list[int], least: int) -> list[tuple[int, int]]:
    """Ranges of ``b`` aligned with consecutive lines of ``a`` and holding at least ``least`` characters."""
    blocks: list[list[int]] = []
    last = (-2, -2)
    for i, j in patience(a, b):
        if (i - 1, j - 1) == last:
            blocks[-1][1] = j + 1
        else:
            blocks.append([j, j + 1])
        last = (i, j)
    return [(x, y) for x, y in blocks if sum(sizes[x:y]) >= least]


def _lines(docs: DataFrame, text: str) -> DataFrame:
    """``(id, hashes, sizes)`` of every document with a key."""
    kind = docs.schema["id"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [line_hashes(t.as_py()) for t in batch.column("t")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([m[0] for m in made], pa.list_(pa.int64())), pa.array([m[1] for m in made], pa.list_(pa.int32()))],
                ["id", "hashes", "sizes"],
            )

    return docs.select("id", F.col(text).alias("t")).mapInArrow(work, f"id {kind.simpleString()}, hashes array<long>, sizes array<int>")


def aligned(lines: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """``(id, first, end, a)``: lines of a later document that are aligned with document ``a``."""
    left = lines.select(F.col("id").alias("a"), F.col("hashes").alias("ha"))
    right = lines.select(F.col("id").alias("b"), F.col("hashes").alias("hb"), "sizes")
    both = pairs.join(left, "a").join(right, "b")
    kind = lines.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["ha", "hb", "sizes"]).to_pydict()
            at, first, end = [], [], []
            for i, (x, y, z) in enumerate(zip(rows["ha"], rows["hb"], rows["sizes"], strict=True)):
                for a, b in common_blocks(x, y, z, least):
                    at.append(i)
                    first.append(a)
                    end.append(b)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("b").take(take), pa.array(first, pa.int32()), pa.array(end, pa.int32()), batch.column("a").take(take)], ["id", "first", "end", "a"]
            )

    return both.mapInArrow(work, f"id {kind}, first int, end int, a {kind}")


def windows(hashes: list[int], sizes: list[int], least: int) -> list[tuple[int, int]]:
    """The shortest ranges of at least ``least`` characters from every line on and up to every line: any run of so many
    characters is a union of such ranges.
    """
    found: set[tuple[int, int]] = set()
    j = total = 0
    for i in range(len(hashes)):
        while j < len(hashes) and (total < least or j == i):
            total += sizes[j]
            j += 1
        if total >= least:
            found.add((i, j))
        total -= sizes[i]
    i, total = len(hashes), 0
    for j in range(len(hashes), 0, -1):
        while i > 0 and (total < least or i == j):
            i -= 1
            total += sizes[i]
        if total >= least:
            found.add((i, j))
        total -= sizes[j - 1]
    return sorted(found)


def postings(lines: DataFrame, least: int) -> DataFrame:
    """``(k, id, first, end)``: the windows of every document; equal lines have the same ``k``."""
    kind = lines.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, key, first, end = [], [], [], []
            for i, (h, z) in enumerate(zip(batch.column("hashes").to_pylist(), batch.column("sizes").to_pylist(), strict=True)):
                raw = np.array(h, np.int64).tobytes()
                for a, b in windows(h, z, least):
                    at.append(i)
                    key.append(h[a] if b == a + 1 else xxhash.xxh3_64_intdigest(raw[8 * a : 8 * b]) - (1 << 63))
                    first.append(a)
                    end.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), batch.column("id").take(pa.array(at, pa.int64())), pa.array(first, pa.int32()), pa.array(end, pa.int32())],
                ["k", "id", "first", "end"],
            )

    return lines.select("id", "hashes", "sizes").mapInArrow(work, f"k long, id {kind}, first int, end int")


def uncovered(posted: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of ``posted`` with a line that is in no range of ``found``."""
    kind = posted.schema["id"].dataType.simpleString()
    own = posted.groupBy("id").agg(F.collect_list(F.struct("k", "first", "end")).alias("own"))
    gone = found.groupBy("id").agg(F.collect_set(F.struct("first", "end")).alias("gone"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, (own, gone) in enumerate(zip(batch.column("own").to_pylist(), batch.column("gone").to_pylist(), strict=True)):
                out = np.zeros(max(w["end"] for w in own) + 1, np.int64)
                for r in gone or ():
                    out[r["first"] : r["end"]] = 1
                before = np.concatenate([[0], np.cumsum(out)])
                left = [w for w in own if before[w["end"]] - before[w["first"]] < w["end"] - w["first"]]
                at.extend([i] * len(left))
                rows.extend(left)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w["k"] for w in rows], pa.int64()), batch.column("id").take(pa.array(at, pa.int64())),
                    pa.array([w["first"] for w in rows], pa.int32()), pa.array([w["end"] for w in rows], pa.int32()),
                ],
                ["k", "id", "first", "end"],
            )

    return own.join(gone, "id", "left").select("id", "own", "gone").mapInArrow(work, f"k long, id {kind}, first int, end int")


def anchors(lines: DataFrame) -> DataFrame:
    """``(id, e)``: what an alignment of a document can start from: its first and its last line that are not blank, with the number
    of blank ones outside, and each line that it holds once and that is not blank. Patience alignment of two documents
    without a common ``e`` finds blank lines at most. Only an ``e`` of several documents is kept.
    """
    kind = lines.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, key = [], []
            for row, hashes in enumerate(batch.column("hashes").to_pylist()):
                ends = []
                for end, way in (("first", hashes), ("last", hashes[::-1])):
                    blank, line = next(((i, h) for i, h in enumerate(way) if h), (0, 0))
                    if line:
                        ends.append(xxhash.xxh3_64_intdigest(f"{end} {blank} {line}") - (1 << 63))
                once = [h for h, n in Counter(hashes).items() if n == 1 and h]
                at.extend([row] * (len(ends) + len(once)))
                key.extend(ends + once)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at, pa.int64())), pa.array(key, pa.int64())], ["id", "e"])

    every = cut_lineage(lines.select("id", "hashes").mapInArrow(work, f"id {kind}, e long"))
    common = every.groupBy("e").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("e")
    return every.join(cut_lineage(common), "e", "left_semi").select("id", "e")


def _level() -> Column:
    """Zero bits at the end of a hash of ``id``: every level has half as many ids as the level below."""
    h = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    return F.bit_count(h.bitwiseAND(-h) - 1)


def shared_blocks(lines: DataFrame, least: int) -> DataFrame:
    """``(id, first, end, a)``: lines of a later document that are aligned with document ``a``; ``lines`` has an id once.

    The lines are those that aligning every pair of documents would find. Holders of a window are aligned with its
    first holder. Where a window then isn't covered, its document is aligned with the window's other earlier
    holders that an alignment could start with (see ``anchors``), few at first and four times as many each round,
    until it is covered or none is left.
    """
    posted = cut_lineage(postings(lines, least))
    firsts = posted.groupBy("k").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("k", "a")
    firsts = cut_lineage(firsts)  # read from files, the join can split a window that many documents share
    later = cut_lineage(posted.join(firsts, "k").where("a < id"))
    found = cut_lineage(aligned(lines, later.select("a", F.col("id").alias("b")).distinct(), least))
    left = cut_lineage(uncovered(later.select("k", "id", "first", "end"), found))
    if left.isEmpty():
        return found
    wanted = sized_broadcast(cut_lineage(left.select("k").distinct()))
    holders = cut_lineage(posted.join(wanted, "k", "left_semi").select("k", "id").distinct().withColumn("level", _level()))
    owners = holders.select("id").distinct()
    lines = cut_lineage(lines.join(sized_broadcast(cut_lineage(owners)), "id", "left_semi"))
    starts = cut_lineage(anchors(lines))
    holders = holders.join(starts, "id")
    both = holders.groupBy("k", "e").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("k", "e")
    holders = cut_lineage(holders.join(cut_lineage(both), ["k", "e"], "left_semi"))
    have = cut_lineage(found.join(left.select("id").distinct(), "id", "left_semi").select("id", "first", "end"))
    most = holders.groupBy("k", "e").count().agg(F.max("count")).first()[0] or 1
    high, low = 65, min(most.bit_length() - 1, 30)
    while not left.isEmpty():
        some = holders.where((F.col("level") >= low) & (F.col("level") < high)).select("k", "e", F.col("id").alias("a"))
        open_ = left.select("k", "id").distinct().join(holders.select("k", "id", "e"), ["k", "id"])
        pairs = cut_lineage(open_.join(some, ["k", "e"]).where("a < id").select("a", F.col("id").alias("b")).distinct())
        if not pairs.isEmpty():
            more = cut_lineage(aligned(lines, pairs, least))
            found = found.unionByName(more)
            have = have.unionByName(more.select("id", "first", "end"))
            left = cut_lineage(uncovered(left, have))
        if low == 0:
            break
        high, low = low, max(0, low - 2)
    return found


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 40, broadcast_rows: int = 200_000) -> DataFrame:
    """``docs`` with ``text`` without the lines that an earlier document has, and ``n_lines``, ``removed`` (line
    ranges, end exclusive) and ``partners`` (keys of the documents they are aligned with).

    Documents are ordered by key and, for equal keys, by a hash of the text; equal rows are one document and don't
    touch each other. Blank lines are aligned beside other lines only. Of every aligned pair the common blocks of at least ``least`` characters leave
    the later document; blocks are judged on the input. Removed are the lines that all pairs of documents would give;
    a document is aligned with further partners only as long as it shares a run that is still there. Rows with a null key or text stay as they are (null text: no
    lines). Columns of these names are replaced.
    """
    seen = docs.drop("n_lines", "removed", "partners", "_id")
    ident = F.when(F.col(key).isNotNull() & F.col(text).isNotNull(), F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("hash")))
    seen = seen.withColumn("_id", ident)
    lines = _lines(docs.select(ident.alias("id"), text).where("id is not null"), text)
    lines = cut_lineage(lines)
    unique = cut_lineage(lines.groupBy("id").agg(F.first("hashes").alias("hashes"), F.first("sizes").alias("sizes")))
    found = shared_blocks(unique, least)
    gone = found.groupBy("id").agg(
        F.array_sort(F.collect_set(F.struct("first", "end"))).alias("_ranges"), F.array_sort(F.collect_set("a.key")).alias("partners")
    )
    gone = cut_lineage(gone)
    few = gone.limit(broadcast_rows + 1).count() <= broadcast_rows and (gone.agg(F.sum(F.size("_ranges") + F.size("partners"))).first()[0] or 0) <= 10 * broadcast_rows
    joined = seen.join(F.broadcast(gone) if few else gone, F.col("_id") == F.col("id"), "left") if "id" not in seen.columns else seen.join(
        (F.broadcast(gone) if few else gone).withColumnRenamed("id", "_id"), "_id", "left")

    @F.pandas_udf("text string, n_lines long, removed array<struct<first:int,end:int>>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, ranges in batches:
            rows = []
            for t, own in zip(texts, ranges, strict=True):
                whole = [] if t is None else t.split("\n")
                out = np.zeros(len(whole) + 1, bool)
                for r in [] if own is None else own:
                    out[r["first"] : r["end"]] = True
                edges = np.flatnonzero(np.diff(out.astype(np.int8), prepend=0)).tolist()
                runs = [{"first": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]
                rows.append((None if t is None else "\n".join(x for x, o in zip(whole, out, strict=False) if not o), len(whole), runs))
            yield pd.DataFrame(rows, columns=["text", "n_lines", "removed"])

    made = joined.withColumn("_cut", cut(F.col(text), F.col("_ranges")))
    return made.withColumns({
        text: F.col("_cut.text"), "n_lines": F.col("_cut.n_lines"), "removed": F.col("_cut.removed"),
        "partners": F.coalesce("partners", F.array().cast(f"array<{docs.schema[key].dataType.simpleString()}>")),
    }).drop("_cut", "_id", "_ranges", *(["id"] if "id" not in seen.columns else []))


def removed_lines(removed: Column) -> Column:
    return F.aggregate(removed, F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["first"]))
