"""Ordered passes over groups of any size.

A subject, study or stratum is normally small and an ordinary window over it is the best plan.
A key may however hold a third of all rows. ``by_heat`` counts rows per key first and keeps that
plan for every key at or below the limit; the rows of larger keys take a second plan, in which
each key is cut into contiguous ranges of its order column, ranges are processed in parallel, and
only one summary row per range is combined across the key. Both plans give the same rows.

The second plan reads its rows several times, so it writes them to the shared folder first; a lost
executor then costs a re-read instead of a recomputation of everything upstream.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kinetable.session import cut_lineage

HOT_ROWS_CONF = "kinetable.hotRows"
HOT_ROWS = 1_000_000

Order = Sequence[tuple[str, bool]]  # (column, descending)
Running = Mapping[str, tuple[str, Column]]  # name -> (sum | count | min | max, expression)

_FOLD = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def hot_rows(spark: SparkSession) -> int:
    """Most rows of one key that a single task may hold."""
    return int(spark.conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))


def same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, bounded: bool = False) -> DataFrame:
    """Join on equal keys where NULL equals NULL; keeps the left key columns only.

    ``bounded`` says that the right side has at most a few rows per ``hot_rows`` of input and may
    be broadcast.
    """
    if not keys:
        raise ValueError("same() needs keys")
    side = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    side = F.broadcast(side) if bounded else side
    cond = None
    for k in keys:
        part = left[k].eqNullSafe(side[f"_k_{k}"])
        cond = part if cond is None else cond & part
    return left.join(side, cond, how).drop(*[f"_k_{k}" for k in keys])


def attach(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], bounded: bool = False) -> DataFrame:
    """Group aggregates on every row, in place of like-named columns: partial aggregation, then a join back.

    Unlike a window over the whole group no task ever holds a group, and the join is one that
    adaptive execution can split when a key is hot. Without keys the one-row total is a subquery.
    """
    named = [c.alias(n) for n, c in aggs.items()]
    if keys:
        return same(df.drop(*aggs), df.groupBy(*keys).agg(*named), keys, "left", bounded)
    total = df.agg(*named).select(F.struct(*aggs).alias("_t")).scalar()
    out = df.withColumn("_t", total)
    return out.withColumns({n: F.col(f"_t.{n}") for n in aggs}).drop("_t")


def find_hot(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Keys above the limit, or None when there are none (one small job decides).

    At most total_rows / limit keys can exceed the limit, so the result is safe to broadcast.
    """
    hot = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_rows(df.sparkSession))
        .select(*keys)
    )
    return None if hot.isEmpty() else hot


def _sorts(order: Order) -> list[Column]:
    return [F.col(n).desc_nulls_last() if d else F.col(n).asc_nulls_last() for n, d in order]


def add_chunks(df: DataFrame, keys: Sequence[str], order: Order, rows: int) -> DataFrame:
    """``df`` stored with ``_c``, contiguous ranges of at most ``rows`` rows, and ``_at``, the place of a row.

    Rows are sorted over all partitions by keys and then the whole order, whatever the columns' types and
    missing last; each partition's rows are then counted off. Ranges are therefore exact for
    any distribution: outliers, bursts of one value, nothing but NULLs. Ascending ``_c`` and ``_at`` are the
    requested order within a key. What is read back is what was stored, so a lost task changes nothing.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    along = [*[F.col(k).asc_nulls_last() for k in keys], *_sorts(order)]
    placed = df.repartitionByRange(parts, *along).sortWithinPartitions(*along).withColumn("_at", F.monotonically_increasing_id())
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return cut_lineage(placed.withColumn("_c", F.shiftleft(part, 33) + F.floor(row / rows)))


@dataclass(frozen=True)
class Plain:
    """Windows over the whole key: for keys that fit one task."""

    def scan(
        self, df: DataFrame, keys: Sequence[str], order: Order,
        running: Running | None = None, prev: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Inclusive running folds and previous-row values along the order."""
        w = Window.partitionBy(*keys).orderBy(*_sorts(order))
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cols = {n: _FOLD[f](e).over(upto) for n, (f, e) in (running or {}).items()}
        cols |= {n: F.lag(c).over(w) for n, c in (prev or {}).items()}
        return df.withColumns(cols)

    def leading(self, df: DataFrame, keys: Sequence[str], order: Order, name: str) -> DataFrame:
        """The leading order column's value on the first row that has one, on every row from there on."""
        column, down = order[0]
        w = Window.partitionBy(*keys).orderBy(*_sorts(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(name, (F.max if down else F.min)(column).over(w))

    def group(self, df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
        """Group aggregates on every row."""
        w = Window.partitionBy(*keys)
        return df.withColumns({n: c.over(w) for n, c in aggs.items()})


@dataclass(frozen=True)
class Chunked:
    """The same passes with every key cut into ranges of about ``rows`` rows.

    ``hot`` names the columns by which the rows were found hot. A pass by just these has a bounded
    number of keys and ranges, whose summaries are broadcast; the rows are then shuffled once.
    """

    rows: int
    hot: tuple[str, ...] = ()

    def _bounded(self, keys: Sequence[str]) -> bool:
        return set(keys) <= set(self.hot)

    def scan(
        self, df: DataFrame, keys: Sequence[str], order: Order,
        running: Running | None = None, prev: Mapping[str, str] | None = None,
    ) -> DataFrame:
        running, prev = dict(running or {}), dict(prev or {})
        bounded = self._bounded(keys)
        cut = add_chunks(df, keys, order, self.rows)
        within = [*keys, "_c"]
        w = Window.partitionBy(*within).orderBy("_at")
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cols = {f"_l_{n}": _FOLD[f](e).over(upto) for n, (f, e) in running.items()}
        cols |= {f"_p_{n}": F.lag(c).over(w) for n, c in prev.items()}
        rows = cut.withColumns(cols | {"_rn": F.row_number().over(w)})

        # one row per range: its totals and its last row, then what all earlier ranges add up to
        ends = [_FOLD[f](e).alias(f"_t_{n}") for n, (f, e) in running.items()]
        if prev:
            ends.append(F.max_by(F.struct(*[F.col(c).alias(n) for n, c in prev.items()]), "_at").alias("_end"))
        side = cut.groupBy(*within).agg(*ends)
        across = Window.partitionBy(*keys).orderBy("_c")
        before = across.rowsBetween(Window.unboundedPreceding, -1)
        carry = {f"_b_{n}": _FOLD["sum" if f == "count" else f](f"_t_{n}").over(before) for n, (f, _) in running.items()}
        if prev:
            carry["_b_end"] = F.lag("_end").over(across)
        side = side.select(*within, *[c.alias(n) for n, c in carry.items()])

        out = same(rows, side, within, "left", bounded)
        done = {}
        for n, (f, _) in running.items():
            mine, earlier = F.col(f"_l_{n}"), F.col(f"_b_{n}")
            if f in ("sum", "count"):
                done[n] = F.coalesce(mine + earlier, mine, earlier)
            else:
                done[n] = (F.greatest if f == "max" else F.least)(mine, earlier)
        for n in prev:
            done[n] = F.when(F.col("_rn") == 1, F.col(f"_b_end.{n}")).otherwise(F.col(f"_p_{n}"))
        kept = [c for c in df.columns if c not in done]  # like-named columns are replaced, as in Plain
        return out.withColumns(done).select(*kept, *running, *prev)

    def leading(self, df: DataFrame, keys: Sequence[str], order: Order, name: str) -> DataFrame:
        column, down = order[0]
        return self.group(df, keys, {name: (F.max if down else F.min)(column)})

    def group(self, df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
        return attach(cut_lineage(df), keys, aggs, self._bounded(keys))


Scan = Plain | Chunked

LOOK = object()


def by_heat(
    df: DataFrame, keys: Sequence[str], build: Callable[[DataFrame, Scan], DataFrame], hot=LOOK
) -> DataFrame:
    """Run ``build`` with whole-key windows, and again in ranges for the keys above the limit.

    ``hot`` passes on what an earlier step over the same keys already found (a frame of keys, or
    None for "no hot key"). It may be a few keys too many, or name only some of the columns by which
    ``build`` groups, but its size must be bounded as in ``find_hot``: it is broadcast.
    """
    if hot is LOOK:
        hot = find_hot(df, keys)
    if hot is None:
        return build(df, Plain())
    names = hot.columns
    cold = build(same(df, F.broadcast(hot), names, "left_anti"), Plain())
    apart = cut_lineage(same(df, F.broadcast(hot), names, "left_semi"))
    warm = build(apart, Chunked(hot_rows(df.sparkSession), tuple(names)))
    return cold.unionByName(warm)


def row_number(df: DataFrame, order: Order, name: str, by: Sequence[str] = (), hot=LOOK) -> DataFrame:
    """Sequential number along the order, per ``by`` or over the whole table.

    The whole table counts as one group: within the row limit one task sorts it, beyond that it
    is numbered in ranges.
    """
    one = {name: ("count", F.lit(1))}
    if by:
        return by_heat(df, by, lambda d, s: s.scan(d, by, order, running=one), hot)
    limit = hot_rows(df.sparkSession)
    if df.count() <= limit:
        return Plain().scan(df.withColumn("_g", F.lit(0)), ["_g"], order, running=one).drop("_g")
    cut = add_chunks(df, [], order, max(1, limit // 8))
    local = Window.partitionBy("_c").orderBy("_at")
    sizes = cut.groupBy("_c").agg(F.count(F.lit(1)).alias("_m"))
    # one row per range, all on one key: ranges number a few per limit / 8 rows
    gathered = Window.partitionBy(F.lit(0)).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_m").over(gathered), F.lit(0))).drop("_m")
    numbered = same(cut.withColumn("_rn", F.row_number().over(local)), offsets, ["_c"], "left", bounded=True)
    return numbered.withColumn(name, F.col("_off") + F.col("_rn")).select(*df.columns, name)
