"""Order statistics of all differences x - y between two samples, without forming them, for samples of any size."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from kinetable.plans.skew import add_chunks, hot_rows, same
from kinetable.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

Z95 = 1.6448536269514722  # fixed value: 0.95 quantile of the standard normal
EXACT = 4_000_000  # steps of the exact null distribution: both samples up to about 200
CELLS = 64  # cells of a range in the summary that gives the first brackets
PROBES = 64  # thresholds tried at once, evenly by value and again by representation


# ---- inside a task ----

def _ordered(v: float) -> int:
    """Doubles as integers in the same order."""
    i = int(np.float64(v + 0.0).view(np.int64))
    return i if i >= 0 else -(i & 0x7FFF_FFFF_FFFF_FFFF)


def _double(i: int) -> float:
    bits = i if i >= 0 else (-i) | (1 << 63)
    return float(np.uint64(bits).view(np.float64))


def first_at_most(x: np.ndarray, y: np.ndarray, v: float) -> np.ndarray:
    """For each x the first place in sorted y from which x - y, as rounded, is at most v."""
    at = np.searchsorted(y, x - v)
    while len(late := np.flatnonzero((at < len(y)) & (x - y[np.minimum(at, len(y) - 1)] > v))):
        at[late] = np.searchsorted(y, y[at[late]], side="right")
    while len(early := np.flatnonzero((at > 0) & (x - y[np.maximum(at, 1) - 1] <= v))):
        at[early] = np.searchsorted(y, y[at[early] - 1])
    return at


def kth_difference(x: np.ndarray, y: np.ndarray, k: int) -> float:
    """k-th smallest (from 1) of all x_i - y_j, for sorted y; between steps the ends move to actual differences."""
    low, high = float(x.min() - y[-1]), float(x.max() - y[0])
    while low < high:
        mid = low + (high - low) / 2
        if not low <= mid < high:
            mid = low
        at = first_at_most(x, y, mid)
        if len(x) * len(y) - int(at.sum()) >= k:
            has = at < len(y)
            high = float((x[has] - y[at[has]]).max())
        else:
            has = at > 0
            low = float((x[has] - y[at[has] - 1]).min())
    return low


@lru_cache(maxsize=4096)
def limit_rank(m: int, n: int) -> tuple[int, float]:
    """The rank of the lower 90 % limit among m n ordered differences, and the level that it reaches.

    The largest k with P(U < k) at most 0.05 under the rank-sum null distribution, at least 1. The distribution is counted exactly,
    one sample member after the other, with whole numbers; for samples whose count would take more than ``EXACT``
    steps it is the normal one with its kurtosis term.
    """
    m, n = min(m, n), max(m, n)
    if m * m * n <= EXACT:
        ways = np.zeros(m * n // 2 + 1, dtype=object)
        ways[0] = 1
        for i in range(1, m + 1):
            if n + i < len(ways):
                ways[n + i :] = ways[n + i :] - ways[: -(n + i)]
            for start in range(min(i, len(ways))):
                ways[start::i] = np.cumsum(ways[start::i])
        below, total = np.cumsum(ways), math.comb(m + n, m)
        k = max(1, int(sum(20 * w <= total for w in below)))
        return k, 1 - 2 * float(below[k - 1] / total)
    mean, sd = m * n / 2, math.sqrt(m * n * (m + n + 1) / 12)
    kurtosis = -1.2 * (m * m + n * n + m * n + m + n) / (m * n * (m + n + 1))
    k = math.floor(mean + sd * (-Z95 + kurtosis * (-(Z95**3) + 3 * Z95) / 24) - 0.5) + 1
    x = (k - 0.5 - mean) / sd
    tail = math.erfc(-x / math.sqrt(2)) / 2 - math.exp(-x * x / 2) / math.sqrt(2 * math.pi) * kurtosis / 24 * (x**3 - 3 * x)
    return k, 1 - 2 * tail


def wanted_ranks(m: int, n: int) -> list[int]:
    """Both middle ranks, then those of the lower and the upper limit."""
    k = limit_rank(m, n)[0]
    return [(m * n + 1) // 2, m * n // 2 + 1, k, m * n + 1 - k]


def _probes(low: float, high: float) -> np.ndarray:
    """Thresholds above ``low``, up to ``high``."""
    steps = np.arange(1, PROBES) / PROBES
    a, b = _ordered(low), _ordered(high)
    found = {float(v) for v in low + (high - low) * steps} | {_double(a + (b - a) * i // PROBES) for i in range(1, PROBES)}
    return np.array(sorted(v for v in found if low < v < high) + [high])


# ---- over all tasks ----

def _array(t: pa.Table, c: str) -> np.ndarray:
    return t.column(c).to_numpy()


def _dot(a: np.ndarray, b: np.ndarray) -> int:
    """The exact sum of products of counts."""
    return (int(np.dot(a, b >> 20)) << 20) + int(np.dot(a, b & 0xFFFFF))


def _heads(t: pa.Table, keys: Sequence[str], n: int) -> list[pa.Array]:
    return [pa.array([t.column(k)[0].as_py()] * n, t.schema.field(k).type) for k in keys]


def _bracket(cells: pa.Table, keys: Sequence[str]) -> pa.Table:
    """For each wanted rank of one pair of samples: differences are above ``lo`` and at most ``hi``, by the cells alone."""
    cells = cells.sort_by([("lo", "ascending"), ("hi", "ascending")])
    is_x = _array(cells, "x").astype(bool)
    (xn, xlo, xhi), (yn, ylo, yhi) = ([_array(cells, c)[s] for c in ("n", "lo", "hi")] for s in (is_x, ~is_x))
    ranks = wanted_ranks(int(xn.sum()), int(yn.sum())) if len(xn) and len(yn) else []
    after = np.concatenate([np.cumsum(yn[::-1])[::-1], [0]])

    def pairs(x: np.ndarray, y: np.ndarray, v: float) -> int:
        return _dot(xn, after[first_at_most(x, y, v)])

    def least(enough, a: int, b: int) -> int:
        while a < b:
            mid = (a + b) // 2
            a, b = (a, mid) if enough(_double(mid)) else (mid + 1, b)
        return a

    out = []
    for k in ranks:
        a, b = _ordered(float(xlo.min() - yhi.max())), _ordered(float(xhi.max() - ylo.min()))
        low = least(lambda v: pairs(xlo, yhi, v) >= k, a, b)  # the first value that enough pairs may not exceed
        high = least(lambda v: pairs(xhi, ylo, v) >= k, low, b)
        out.append((_double(low - 1), _double(high)))
    cols = [pa.array(range(len(ranks)), pa.int32()), pa.array(ranks, pa.int64()), *[pa.array([o[i] for o in out], pa.float64()) for i in (0, 1)]]
    return pa.table([*(_heads(cells, keys, len(ranks)) if ranks else [pa.array([], cells.schema.field(k).type) for k in keys]), *cols], [*keys, "id", "k", "lo", "hi"])


def _doubts(ranges: pa.Table, state: pa.Table, keys: Sequence[str]) -> pa.Table:
    """Pairs of ranges that may hold a difference inside a bracket, and how many pairs of others lie below it."""
    ranges = ranges.sort_by([("lo", "ascending"), ("hi", "ascending")])
    is_x = _array(ranges, "x").astype(bool)
    (xc, xn, xlo, xhi), (yc, yn, ylo, yhi) = ([_array(ranges, c)[s] for c in ("_c", "n", "lo", "hi")] for s in (is_x, ~is_x))
    after = np.concatenate([np.cumsum(yn[::-1])[::-1], [0]])
    parts = []
    for s in state.select(["id", "k", "lo", "hi"]).to_pylist():
        stop, start = first_at_most(xhi, ylo, s["lo"]), first_at_most(xlo, yhi, s["hi"])
        base = _dot(xn, after[stop])
        many = np.maximum(stop - start, 0)
        a = np.repeat(np.arange(len(xn)), many)
        b = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start, many)
        same_ = [pa.array([s[c]] * len(a), t) for c, t in (("id", pa.int32()), ("k", pa.int64()), ("lo", pa.float64()), ("hi", pa.float64()))]
        parts.append(pa.table([*_heads(ranges, keys, len(a)), *same_, pa.array([base] * len(a), pa.int64()), pa.array(xc[a], pa.int64()), pa.array(yc[b], pa.int64())],
                              [*keys, "id", "k", "lo", "hi", "base", "a", "b"]))
    return pa.concat_tables(parts)


def _probed(rows: pa.Table, asks: pa.Table, keys: Sequence[str]) -> pa.Table:
    """One pair of ranges: for each bracket and threshold the pairs at most there, and the ends of the differences in between."""
    d, is_x = _array(rows, "d"), _array(rows, "x").astype(bool)
    x, y = d[is_x], np.sort(d[~is_x])
    found: list[tuple] = []
    for s in asks.select(["id", "lo", "hi"]).to_pylist():
        before = first_at_most(x, y, s["lo"])
        for t, v in enumerate(_probes(s["lo"], s["hi"])):
            at = first_at_most(x, y, v)
            has = at < before
            least, most = ((x[has] - y[before[has] - 1]).min(), (x[has] - y[at[has]]).max()) if has.any() else (None, None)
            below = None if least is None else float(np.nextafter(least, -np.inf))
            found.append((s["id"], t, len(x) * len(y) - int(at.sum()), below, least, most))
            before = at
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    return pa.table([*_heads(rows, keys, len(found)), *[pa.array(c, k) for c, k in zip(zip(*found), kinds)]], [*keys, "id", "t", "n", "below", "least", "most"])


def ranked_differences(samples: DataFrame, keys: Sequence[str], x: str, d: str) -> DataFrame:
    """``(keys, id, value)``: the differences at ``wanted_ranks`` of every group; ``x`` tells the samples apart, ``d`` is never null.

    For groups too large for a task. Rows are cut into sorted ranges once. Cells of the ranges bracket each rank; then, round by
    round, only pairs of ranges that can hold a difference inside a bracket meet in a task, about two for each range, which counts
    below many thresholds at once. A bracket ends on actual differences and closes on the one wanted, so the result
    is the same to the last bit as ``kth_difference`` gives. A group without one of the samples has no row.
    """
    keys, rows = list(keys), hot_rows(samples.sparkSession)
    kinds = ", ".join(f"`{k}` {samples.schema[k].dataType.simpleString()}" for k in keys)
    group = [*keys, "x"]
    cut = add_chunks(samples.select(*keys, F.col(x).alias("x"), F.col(d).cast("double").alias("d")), group, [("d", False)], rows)
    cell = F.floor(F.col("_at") / max(1, rows // CELLS))
    cells = cut.groupBy(*group, "_c", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi"))
    cells = cut_lineage(cells)
    ranges = cut_lineage(cells.groupBy(*group, "_c").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    state = cells.groupBy(*keys).applyInArrow(lambda t: _bracket(t, keys), f"{kinds}, id int, k long, lo double, hi double")
    state = cut_lineage(state.withColumn("value", F.lit(None).cast("double")))
    done = state.limit(0).select(*keys, "id", "value")
    while True:
        left = state.filter("value IS NULL").drop("value")
        done = done.unionByName(state.filter("value IS NOT NULL").select(*keys, "id", "value"))
        if left.isEmpty():
            return done
        doubts = ranges.groupBy(*keys).cogroup(left.groupBy(*keys)).applyInArrow(
            lambda r, s: _doubts(r, s, keys) if r.num_rows and s.num_rows else _no_rows(r, keys),
            f"{kinds}, id int, k long, lo double, hi double, base long, a long, b long")
        doubts = cut_lineage(doubts)
        meet = [*keys, "a", "b"]
        work = cut_lineage(doubts.select(*meet).distinct())
        dealt = same(cut.filter("x").withColumn("a", F.col("_c")), work, [*keys, "a"], "inner").select(*meet, "x", "d").unionByName(
            same(cut.filter("NOT x").withColumn("b", F.col("_c")), work, [*keys, "b"], "inner").select(*meet, "x", "d"))
        seen = dealt.groupBy(*meet).cogroup(doubts.groupBy(*meet)).applyInArrow(
            lambda r, s: _probed(r, s, keys), f"{kinds}, id int, t int, n long, below double, least double, most double")
        summed = seen.groupBy(*keys, "id", "t").agg(F.sum("n").alias("n"), F.min("below").alias("below"), F.min("least").alias("least"), F.max("most").alias("most"))
        asked = doubts.select(*keys, "id", "k", "base").distinct()
        enough = same(summed, asked, [*keys, "id"], "inner").filter(F.col("base") + F.col("n") >= F.col("k"))
        first = enough.groupBy(*keys, "id").agg(F.min("k").alias("k"), F.min_by(F.struct("below", "least", "most"), "t").alias("f"))
        state = cut_lineage(first.select(*keys, "id", "k", F.col("f.below").alias("lo"), F.col("f.most").alias("hi"),
                                         F.when(F.col("f.least") == F.col("f.most"), F.col("f.least")).alias("value")))


def _no_rows(t: pa.Table, keys: Sequence[str]) -> pa.Table:
    kinds = [("id", pa.int32()), ("k", pa.int64()), ("lo", pa.float64()), ("hi", pa.float64()), ("base", pa.int64()), ("a", pa.int64()), ("b", pa.int64())]
    return pa.schema([*[t.schema.field(k) for k in keys], *[pa.field(*x) for x in kinds]]).empty_table()
