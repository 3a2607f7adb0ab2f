"""Quantiles under many weightings of the same rows, by one sorted sweep."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from kinetable.plans.skew import add_chunks, hot_rows, same
from kinetable.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

SWEEP_ROWS = 50_000  # rows of a group that one task sweeps: 40 MB of running weights for 200 lanes
HELD_SUMS = 10_000  # ranges whose sums a task holds before it passes them on: 16 MB for 200 lanes


def _repeated(rows: pa.Table, columns: Sequence[str], n: int) -> list[pa.Array]:
    """The first row's values ``n`` times."""
    return [pa.array([rows.column(c)[0].as_py()] * n, rows.schema.field(c).type) for c in columns]


def _counted(lists: pa.Array, lanes: int) -> np.ndarray:
    """Rows x lanes: how often a list names a lane; lane 0 holds every row once."""
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    dense = np.bincount(row * lanes + lists.flatten().to_numpy(), minlength=len(lists) * lanes).reshape(-1, lanes)
    dense[:, 0] = 1
    return dense


def _packed(df: DataFrame, columns: Sequence[str], held: str, lanes: int) -> DataFrame:
    """``columns`` and ``_w``, the counts of all lanes one after the other, in as few bytes each as a batch of rows needs."""
    rows = df.select(*columns, F.coalesce(F.col(held), F.array().cast("array<int>")).alias("_w"))

    def pack(batches):
        for batch in batches:
            dense = _counted(batch.column("_w"), lanes)
            dense = dense.astype(np.min_scalar_type(dense.max(initial=1)))
            width = lanes * dense.itemsize
            ends = pa.py_buffer(np.arange(batch.num_rows + 1, dtype=np.int32) * np.int32(width))
            packed = pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(dense.tobytes())])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], packed], [*columns, "_w"])

    return rows.mapInArrow(pack, f"{_typed(rows, columns)}, _w binary")


def _typed(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def _weights(rows: pa.Table, lanes: int) -> np.ndarray:
    """Rows x lanes from packed counts; a row without counts is held by lane 0 only."""
    held = rows.column("_w").cast(pa.large_binary()).combine_chunks()
    held = pc.fill_null(held.chunk(0) if isinstance(held, pa.ChunkedArray) else held, b"")
    ends = np.frombuffer(held.buffers()[1], np.int64)[held.offset: held.offset + len(held) + 1]
    width, data = np.diff(ends), np.frombuffer(held.buffers()[2] or b"", np.uint8)
    kinds = np.unique(width[width > 0])
    if len(kinds) == 1 and (width > 0).all():
        return data[ends[0]: ends[-1]].view(f"u{kinds[0] // lanes}").reshape(-1, lanes)
    dense = np.zeros((len(held), lanes), np.int64)
    dense[:, 0] = 1
    for kind in kinds:
        own = np.flatnonzero(width == kind)
        dense[own] = data[ends[own][:, None] + np.arange(kind)].view(f"u{kind // lanes}")
    return dense


def _asked(total: np.ndarray, probs: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    """Ranks (from 1) below each quantile and how far it lies towards the next: type 7; lanes x probs."""
    h = np.maximum(total[:, None] - 1, 0) * np.asarray(probs)[None, :]
    low = np.floor(h)
    return low.astype(np.int64) + 1, h - low


def _swept(rows: pa.Table, by: Sequence[str], lanes: int, probs: Sequence[float]) -> pa.Table:
    """One group: running weights of all lanes along the sorted values, and the quantiles that they pass."""
    value = rows.column("_v").to_numpy()
    order = np.argsort(value, kind="stable")
    value = value[order]
    upto = np.cumsum(_weights(rows, lanes)[order].T, axis=1, dtype=np.int64)
    total = upto[:, -1]
    rank, part = _asked(total, probs)
    found = np.full((lanes, len(probs)), np.nan)
    for lane in np.flatnonzero(total > 0):
        ends = np.minimum(np.stack([rank[lane], rank[lane] + 1]), total[lane])
        low, high = value[np.searchsorted(upto[lane], ends)]
        found[lane] = low + (high - low) * part[lane]
    marks = [pa.array(found[:, i], pa.float64(), mask=np.isnan(found[:, i])) for i in range(len(probs))]
    return pa.table([*_repeated(rows, by, lanes), pa.array(np.arange(lanes, dtype=np.int32)), *marks], [*by, "lane", *[f"_q{i}" for i in range(len(probs))]])


def lane_quantiles(df: DataFrame, by: Sequence[str], value: str, held: str, lanes: int, probs: Mapping[str, float],
                   lists: DataFrame | None = None, on: Sequence[str] = ()) -> DataFrame:
    """``by``, ``lane`` and a column for each of ``probs``: the quantile of ``value`` among the rows of a lane.

    ``held`` lists the lanes 1 to ``lanes`` - 1 that hold a row, once for each time it stands there (NULL: none); lane 0 holds every
    row once. It is a column of ``df``, or of ``lists``, which has one row for each value of its columns ``on``. Rows meet once, whatever
    the number of lanes, and no copies are formed. A lane without rows has NULL. Missing values are left out. Groups
    above ``SWEEP_ROWS`` are swept in ranges: each adds up its weights, and only ranges that hold a wanted rank are read again.
    Rows are sorted and stored without their weights, which are joined where they are added up.
    """
    own = list(dict.fromkeys([*by, *on]))
    rows = df.withColumn("_v", F.col(value).cast("double")).filter("_v IS NOT NULL")
    if lists is None:
        rows, weighed = _packed(rows, [*own, "_v"], held, lanes), lambda d: d
    else:
        rows, packed = rows.select(*own, "_v"), cut_lineage(_packed(lists, on, held, lanes))
        weighed = lambda d: same(d, packed, on, "left")
    limit, marks = min(SWEEP_ROWS, hot_rows(df.sparkSession)), list(probs.values())
    schema = f"{_typed(rows, by)}, lane int, " + ", ".join(f"_q{i} double" for i in range(len(marks)))

    def task(t: pa.Table) -> pa.Table:
        return _swept(t, by, lanes, marks)

    def swept(d: DataFrame) -> DataFrame:
        named = [*by, "lane", *[F.col(f"_q{i}").alias(n) for i, n in enumerate(probs)]]
        return weighed(d).select(*by, "_v", "_w").groupBy(*by).applyInArrow(task, schema).select(*named)

    large = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_m")).filter(F.col("_m") > limit).select(*by)
    if large.isEmpty():
        return swept(rows)
    large = F.broadcast(cut_lineage(large))  # at most rows / limit groups
    return swept(same(rows, large, by, "left_anti")).unionByName(_in_ranges(same(rows, large, by, "left_semi"), by, lanes, probs, limit, weighed))


def _in_ranges(rows: DataFrame, by: Sequence[str], lanes: int, probs: Mapping[str, float], limit: int, weighed) -> DataFrame:
    cut = add_chunks(rows, by, [("_v", False)], limit)
    within = [*by, "_c"]

    def add_up(batches):
        """The sums of each range over the rows of a task, which may hold a few rows of every range."""
        found = {}

        def told():
            at = list(found)
            sums = pa.array([found[k].tolist() for k in at], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([*[pa.array([k[i] for k in at], kind) for i, kind in enumerate(kinds)], sums], [*within, "sums"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            kinds = [t.schema.field(c).type for c in within]
            places = t.select(within).append_column("_i", pa.array(np.arange(t.num_rows))).group_by(within).aggregate([("_i", "list")])
            order = places.column("_i_list").combine_chunks()
            order = order.chunk(0) if isinstance(order, pa.ChunkedArray) else order
            starts = order.offsets.to_numpy()[:-1]
            if not len(starts):
                continue
            sums = np.add.reduceat(_weights(t, lanes)[order.flatten().to_numpy()], starts, axis=0, dtype=np.int64)
            for k, s in zip(zip(*[places.column(c).to_pylist() for c in within]), sums):
                found[k] = found[k] + s if k in found else s
            if len(found) > HELD_SUMS:
                yield told()
                found.clear()
        if found:
            yield told()

    partial = weighed(cut).select(*within, "_w").mapInArrow(add_up, f"{_typed(cut, within)}, sums array<bigint>")
    sums = partial.select(*within, F.posexplode("sums").alias("lane", "_s")).groupBy(*within, "lane").agg(F.sum("_s").alias("_s"))
    along = Window.partitionBy(*by, "lane").orderBy("_c")
    placed = sums.withColumns({"_upto": F.sum("_s").over(along), "_all": F.sum("_s").over(Window.partitionBy(*by, "lane"))})
    asks = []
    for i, p in enumerate(probs.values()):
        h = F.greatest(F.col("_all") - 1, F.lit(0)) * F.lit(float(p))
        low = F.floor(h)
        asks += [F.struct(F.lit(i).alias("q"), (low + 1).alias("rank"), (1 - (h - low)).alias("part")),
                 F.struct(F.lit(i).alias("q"), (low + 2).alias("rank"), (h - low).alias("part"))]
    wanted = placed.filter("_all > 0").withColumn("_a", F.explode(F.array(*asks))).filter(
        "_a.part > 0 AND _a.rank <= _upto AND _a.rank > _upto - _s")
    wanted = cut_lineage(wanted.select(*within, F.struct("lane", F.col("_a.q").alias("q"), F.col("_a.part").alias("part"),
                                                         (F.col("_a.rank") - (F.col("_upto") - F.col("_s"))).alias("rank")).alias("_a")))
    touched = weighed(same(cut, wanted.select(*within).distinct(), within, "left_semi")).select(*within, "_at", "_v", "_w")

    def look_up(t: pa.Table, asks: pa.Table) -> pa.Table:
        asked = asks.column("_a").to_pylist()  # two ranks for each lane and quantile at most
        order = np.argsort(t.column("_at").to_numpy(), kind="stable")
        value = t.column("_v").to_numpy()[order]
        upto = np.cumsum(_weights(t, lanes)[order].T, axis=1, dtype=np.int64)
        got = [a["part"] * float(value[np.searchsorted(upto[a["lane"]], a["rank"])]) for a in asked]
        return pa.table([*_repeated(t, by, len(asked)), pa.array([a["lane"] for a in asked], pa.int32()), pa.array([a["q"] for a in asked], pa.int32()),
                         pa.array(got, pa.float64())], [*by, "lane", "q", "x"])

    found = touched.groupBy(*within).cogroup(wanted.groupBy(*within)).applyInArrow(look_up, f"{_typed(cut, by)}, lane int, q int, x double")
    quantiles = found.groupBy(*by, "lane").agg(*[F.sum(F.when(F.col("q") == i, F.col("x"))).alias(n) for i, n in enumerate(probs)])
    every = placed.select(*by, "lane").distinct()
    return same(every, quantiles, [*by, "lane"], "left")
