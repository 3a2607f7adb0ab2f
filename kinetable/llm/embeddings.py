"""Near-duplicate vectors by product quantisation under coarse inverted lists, reranked exactly."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetable.session import cut_lineage

from .common import components, ship_by_value

ship_by_value(__name__)

SAMPLE_ROWS = 16_384  # the index is fitted on so many vectors at most; every vector is indexed
MAX_LISTS = 4_096
SUBSPACES, CODES = 8, 256
BLOCK = 4_096  # members or queries of a list that one task compares


@dataclass(frozen=True)
class Index:
    """Coarse centroids (lists x dimension) and a codebook of residuals per subspace."""

    centroids: np.ndarray
    books: list[np.ndarray]


def _nearest(points: np.ndarray, centres: np.ndarray, k: int = 1) -> np.ndarray:
    """Indexes of each point's ``k`` nearest centres, nearest first."""
    found = np.empty((len(points), k), np.int64)
    norms = (centres * centres).sum(axis=1)
    for i in range(0, len(points), 2048):
        far = norms - 2 * points[i : i + 2048] @ centres.T
        part = np.argpartition(far, k - 1, axis=1)[:, :k] if k < len(centres) else np.broadcast_to(np.arange(k), far.shape)
        order = np.argsort(np.take_along_axis(far, part, axis=1), axis=1, kind="stable")
        found[i : i + 2048] = np.take_along_axis(part, order, axis=1)
    return found


def _means(points: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    centres = points[draw.permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        near = _nearest(points, centres)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _splits(dimension: int) -> list[tuple[int, int]]:
    edges = np.linspace(0, dimension, min(SUBSPACES, dimension) + 1).astype(int)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))


def fit(sample: np.ndarray, lists: int) -> Index:
    """Centroids and codebooks from a bounded sample of unit vectors."""
    points = sample.astype(np.float32)
    centroids = _means(points, min(lists, len(points)), 8, 1)
    left = points - centroids[_nearest(points, centroids)[:, 0]]
    books = [_means(np.ascontiguousarray(left[:, a:b]), min(CODES, len(left)), 8, 2 + a) for a, b in _splits(points.shape[1])]
    return Index(centroids, books)


def _units(raw: np.ndarray) -> np.ndarray:
    whole = raw.astype(np.float64)
    whole = whole / np.abs(whole).max(axis=1, keepdims=True)  # squares of any finite vector stay finite
    return whole / np.sqrt((whole * whole).sum(axis=1, keepdims=True))


def place(vectors: DataFrame, index: Index, probes: int, kind: np.dtype) -> DataFrame:
    """``(sid, w, vec, list, probe, code, err)``: own list, lists to search, residual codes and their error."""
    centroids, books = index.centroids, index.books
    probes = min(probes, len(centroids))
    dimension = centroids.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.asarray(batch.column("vec").flatten()).reshape(batch.num_rows, dimension)
            units = _units(raw)
            near = _nearest(units.astype(np.float32), centroids, probes)
            left = units - centroids[near[:, 0]]
            codes = np.empty((len(raw), len(books)), np.uint8)
            back = np.empty_like(left)
            for m, (a, b) in enumerate(_splits(dimension)):
                own = _nearest(left[:, a:b].astype(np.float32), books[m])[:, 0]
                codes[:, m], back[:, a:b] = own, books[m][own]
            err = np.sqrt(((left - back) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("sid"), batch.column("w"), pa.array([r.tobytes() for r in raw.astype(kind)], pa.binary()),
                    pa.array(near[:, 0], pa.int32()), pa.array(list(near.astype(np.int32)), pa.list_(pa.int32())),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(err, pa.float64()),
                ],
                ["sid", "w", "vec", "list", "probe", "code", "err"],
            )

    return vectors.mapInArrow(work, "sid long, w long, vec binary, list int, probe array<int>, code binary, err double")


def compare(queries: dict, members: dict, index: Index, kind: np.dtype, least: float) -> tuple[dict, list]:
    """Links between one block of queries and one block of members of a list: what each vector's count grows by,
    and links that connect whatever the block's links connect.
    """
    centre = index.centroids[members["list"][0]].astype(np.float64)
    books = [b.astype(np.float64) for b in index.books]
    splits = _splits(len(centre))
    own = _units(np.frombuffer(b"".join(members["vec"]), kind).reshape(-1, len(centre)))
    codes = np.frombuffer(b"".join(members["code"]), np.uint8).reshape(-1, len(books))
    reach = (sqrt(max(0.0, 2 - 2 * least)) + np.asarray(members["err"]) + 1e-6) ** 2
    back = {s: j for j, s in enumerate(members["sid"])}
    member_probes = [set(p) for p in members["probe"]]
    counts: dict[int, int] = {}
    label = np.arange(len(own))  # members joined by a query so far
    joins: list[tuple[int, int]] = []
    for at in range(0, len(queries["sid"]), 256):
        ids = queries["sid"][at : at + 256]
        asked = _units(np.frombuffer(b"".join(queries["vec"][at : at + 256]), kind).reshape(-1, len(centre)))
        moved = asked - centre
        far = np.zeros((len(asked), len(own)))
        for m, (a, b) in enumerate(splits):  # asymmetric distances: one table of the query's distances to all codes
            table = ((moved[:, None, a:b] - books[m][None]) ** 2).sum(axis=2)
            far += table[:, codes[:, m]]
        near = far <= reach
        rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(rows):
            continue
        sure = (asked[rows] @ own[cols].T >= least) & near[np.ix_(rows, cols)]
        for i, row in zip(rows, sure, strict=True):
            sid, home = ids[i], queries["list"][at + i]
            found = cols[row]
            found = found[found != back.get(sid, -1)]
            if not len(found):
                continue
            w = queries["w"][at + i]
            for j in found:
                counts[sid] = counts.get(sid, 0) + members["w"][j]
                if home not in member_probes[j]:  # the other side doesn't see this link
                    other = members["sid"][j]
                    counts[other] = counts.get(other, 0) + w
            roots = np.unique(label[found])
            joins.append((sid, members["sid"][roots[0]]))
            if len(roots) > 1:
                label[np.isin(label, roots[1:])] = roots[0]
                joins.extend((sid, members["sid"][r]) for r in roots[1:])
    return counts, joins


def search(placed: DataFrame, index: Index, kind: np.dtype, least: float) -> DataFrame:
    """``(sid, n, a, b)``: counts (a null) and links (sid null). A list of any size is compared in blocks."""
    sizes = placed.select(F.explode("probe").alias("list")).groupBy("list").agg(F.count("*").alias("asked"))
    held = placed.groupBy("list").agg(F.count("*").alias("held"))
    blocks = held.join(sizes, "list").select(
        "list", F.ceil(F.col("held") / BLOCK).cast("int").alias("mb"), F.ceil(F.col("asked") / BLOCK).cast("int").alias("qb")
    )
    blocks = F.broadcast(blocks)  # a row per list, MAX_LISTS at most
    cell = lambda n: F.pmod(F.xxhash64("sid"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = placed.join(blocks, "list").select("list", cell("mb").alias("mblock"), spread("qb").alias("qblock"), "sid", "w", "vec", "probe", "code", "err")
    queries = placed.select(F.col("list").alias("home"), "sid", "w", "vec", F.explode("probe").alias("list")).join(blocks, "list")
    queries = queries.select("list", cell("qb").alias("qblock"), spread("mb").alias("mblock"), "sid", "w", "vec", "home")
    queries = queries.select(*(F.col(c).alias(c) for c in queries.columns))  # columns of their own beside the members'

    def work(asked: pa.Table, own: pa.Table) -> pa.Table:
        counts: dict = {}
        joins: list = []
        if asked.num_rows and own.num_rows:
            q, m = asked.to_pydict(), own.to_pydict()
            q["list"] = q["home"]
            counts, joins = compare(q, m, index, kind, least)
        rows = [(s, n, None, None) for s, n in counts.items()] + [(None, None, a, b) for a, b in joins]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["sid", "n", "a", "b"])

    by = ["list", "mblock", "qblock"]
    return queries.groupBy(by).cogroup(members.groupBy(by)).applyInArrow(work, "sid long, n long, a long, b long")


def link(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9, probes: int = 12, lists: int | None = None,
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row of ``table``.

    Equal vectors are one entry with a weight. A bounded sample (``SAMPLE_ROWS`` by hash) fits coarse lists,
    2 x sqrt(n) unless given, and residual codebooks; every vector is indexed and searches its ``probes``
    nearest lists. A pair is found if either side searches the other's list. The distance to the
    codes is taken from per-query tables; a vector can only be left out by it if its stored code error
    proves the distance too large, so all loss is from unsearched lists. What remains is
    decided by cosine in double precision. Vectors of each length, of which there are few, have an index of their own. Vectors
    that are null, zero or hold null or non-finite components are linked with nothing. Rows with a null key take the
    smallest key of their component, null if there is none.
    """
    spark = table.sparkSession
    element = table.schema[vector].dataType.elementType.simpleString()
    kind = np.dtype("<f8" if element == "double" else "<f4")
    sound = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = table.select(F.col(key).alias("id"), F.col(vector).cast("array<double>" if element not in ("float", "double") else f"array<{element}>").alias("vec"))
    rows = rows.withColumn("ok", F.coalesce(sound, F.lit(False)))
    if rows.where("ok").isEmpty():
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    rows = rows.withColumn("sid", F.when(F.col("ok"), F.xxhash64("vec")))
    unique = cut_lineage(rows.where("sid is not null").groupBy("sid").agg(F.first("vec").alias("vec"), F.count("*").alias("w"), F.min("id").alias("rep")))
    searched = []
    for d, n in unique.groupBy(F.size("vec").alias("d")).count().orderBy("d").collect():
        own = unique.where(F.size("vec") == d)
        sample = own.orderBy(F.xxhash64("sid")).limit(SAMPLE_ROWS).select("vec").collect()
        index = fit(_units(np.array([r.vec for r in sample], np.float64)), lists or min(MAX_LISTS, ceil(2 * sqrt(n))))
        placed = cut_lineage(place(own.select("sid", "w", "vec"), index, probes, kind))
        searched.append(cut_lineage(search(placed, index, kind, least)))
    found = reduce(DataFrame.unionByName, searched)
    labels = components(found.where("a is not null").select("a", "b").distinct())
    counts = found.where("sid is not null").groupBy("sid").agg(F.sum("n").alias("n"))
    named = unique.select("sid", "w", "rep").join(labels, F.col("sid") == F.col("id"), "left").withColumn("c", F.coalesce("component", "sid"))
    least_id = named.groupBy("c").agg(F.min("rep").alias("component_id"))
    named = named.join(least_id, "c").join(counts, "sid", "left").select("sid", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n"), "component_id")
    out = rows.select("id", "sid").join(named, "sid", "left")
    whole = F.coalesce("component_id", "id")
    return out.select("id", F.coalesce("n", F.lit(0)).alias("n_links"), whole.alias("component_id"), F.col("id").eqNullSafe(whole).alias("kept"))
