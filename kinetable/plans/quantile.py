"""Grouped statistics with exact quantiles for groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinetable.plans.skew import LOOK, add_chunks, find_hot, hot_rows, same
from kinetable.session import cut_lineage

def grouped(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    aggs: Mapping[str, Column],
    probs: Mapping[str, float],
    hot=LOOK,
) -> DataFrame:
    """``by`` + ordinary aggregates + linear-interpolated quantiles of ``value``.

    Groups within the row limit use the built-in exact percentile in one aggregation. Its buffer
    holds every distinct value of the group, so larger groups are ranked in ranges instead.
    """
    if not probs:
        return df.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()])
    keyed, keys = (df, list(by)) if by else (df.withColumn("_whole", F.lit(0)), ["_whole"])
    if hot is LOOK:
        hot = find_hot(keyed, keys)
    if hot is None:
        return _builtin(df, by, value, aggs, probs)
    cold = _builtin(same(keyed, F.broadcast(hot), keys, "left_anti"), keys, value, aggs, probs)
    warm = cut_lineage(same(keyed, F.broadcast(hot), keys, "left_semi"))
    named = [c.alias(n) for n, c in aggs.items()]
    plain = warm.groupBy(*keys).agg(*named) if named else warm.select(*keys).distinct()
    ranked = ranked_quantiles(warm, keys, value, probs, hot_rows(df.sparkSession))
    joined = same(plain, ranked, keys, "left")
    return cold.unionByName(joined.select(*keys, *aggs, *probs)).select(*by, *aggs, *probs)


def _builtin(df, by, value, aggs, probs):
    named = [c.alias(n) for n, c in aggs.items()]
    at = F.array(*[F.lit(float(p)) for p in probs.values()])
    out = df.groupBy(*by).agg(*named, F.percentile(F.col(value).cast("double"), at).alias("_q"))
    picks = [F.col("_q")[i].alias(n) for i, n in enumerate(probs)]
    return out.select(*by, *aggs, *picks)


def ranked_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float], rows: int
) -> DataFrame:
    """Exact quantiles by counting ranges and sorting only the ranges that hold a wanted rank."""
    v = F.col(value).cast("double")
    known = df.filter(v.isNotNull()).select(*by, v.alias("_v"))
    cut = add_chunks(known, by, [("_v", False)], rows)
    within = [*by, "_c"]
    along = Window.partitionBy(*by).orderBy("_c")
    sizes = (
        cut.groupBy(*within)
        .agg(F.count(F.lit(1)).alias("_m"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        .withColumns({
            "_before": F.coalesce(F.sum("_m").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_total": F.sum("_m").over(Window.partitionBy(*by)),
        })
    )
    asks = []
    for n, p in probs.items():
        h = F.lit(float(p)) * (F.col("_total") - 1)
        low = F.floor(h)
        asks.append(F.struct(F.lit(n).alias("q"), low.alias("rank"), (1 - (h - low)).alias("weight")))
        asks.append(F.struct(F.lit(n).alias("q"), (low + 1).alias("rank"), (h - low).alias("weight")))
    wanted = (
        sizes.withColumn("_ask", F.explode(F.array(*asks)))
        .filter("_ask.weight > 0 and _ask.rank >= _before and _ask.rank < _before + _m")
        .select(*within, "_lo", "_hi", F.col("_ask.q").alias("_q"), F.col("_ask.weight").alias("_weight"),
                (F.col("_ask.rank") - F.col("_before") + 1).alias("_local"))
    )
    flat = wanted.filter("_lo = _hi").select(*by, "_q", "_weight", F.col("_lo").alias("_v"))
    mixed = wanted.filter("_lo < _hi")
    touched = same(cut, mixed.select(*within).distinct(), within, "left_semi", bounded=True)
    placed = touched.withColumn("_local", F.row_number().over(Window.partitionBy(*within).orderBy("_at")))
    found = same(mixed.drop("_lo", "_hi"), placed, [*within, "_local"], "inner").select(*by, "_q", "_weight", "_v")
    return flat.unionByName(found).groupBy(*by).agg(
        *[F.sum(F.when(F.col("_q") == n, F.col("_weight") * F.col("_v"))).alias(n) for n in probs]
    )
