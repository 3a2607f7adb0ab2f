"""Summaries: statistics by column and by group, counts and shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kinetable.plans import skew
from kinetable.plans.quantile import grouped

# statistic name -> (aggregate, None) or (None, quantile)
_FOLDS = {
    "n": F.count,
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "geomean": lambda c: geomean(c),
    "nmissing": lambda c: F.count_if(F.col(c).isNull()),
}
_QUANTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def geomean(column: str) -> Column:
    """Geometric mean over positive values."""
    x = F.col(column)
    return F.exp(F.avg(F.when(x > 0, F.ln(x))))


def _expand(stats: Sequence[str]) -> list[str]:
    """``extrema`` stands for the pair min, max."""
    return [s for stat in stats for s in (("min", "max") if stat == "extrema" else (stat,))]


def stats_of(
    df: DataFrame, value: str, stats: Sequence[str], by: Sequence[str] = (), hot=skew.LOOK
) -> DataFrame:
    """One row per group with the named statistics of one column, quantiles exact."""
    stats = _expand(stats)
    folds = {s: _FOLDS[s](value) for s in stats if s in _FOLDS}
    probs = {s: _QUANTILES[s] for s in stats if s in _QUANTILES}
    return grouped(df, by, value, folds, probs, hot).select(*by, *stats)


def stack(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), kind: str | None = None) -> DataFrame:
    """Wide to long: ``variable``, ``value`` next to the kept columns."""
    if kind:
        df = df.withColumns({c: F.col(c).cast(kind) for c in columns})
    return df.unpivot(list(keep), list(columns), "variable", "value")


def scalar_stats(df: DataFrame, column: str) -> DataFrame:
    return stats_of(df, column, ["mean", "median", "max", "min", "std"])


def describe(df: DataFrame, columns: Sequence[str], stats: Sequence[str] = ("mean", "min", "median", "max", "nmissing"),
             hot=skew.LOOK) -> DataFrame:
    """One row per column with the chosen statistics."""
    return stats_of(stack(df, columns, kind="double"), "value", stats, ["variable"], hot)


def summary_stats(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    return stats_of(df, column, ["n", "nmissing", "mean", "min", "q25", "median", "q75", "max"], by)


def summarize(df: DataFrame, parameters: Sequence[str], stats: Sequence[str] = ("extrema", "mean", "std"),
              stratify_by: Sequence[str] = (), hot=skew.LOOK) -> DataFrame:
    """One row per stratum and parameter."""
    long = stack(df, parameters, stratify_by, "double").withColumnRenamed("variable", "parameter")
    return stats_of(long, "value", stats, [*stratify_by, "parameter"], hot)


def group_multi_agg(df: DataFrame, by: Sequence[str], columns: Sequence[str], stats: Sequence[str],
                    hot=skew.LOOK) -> DataFrame:
    """Columns x functions, named ``<column>_<function>``, one row per group."""
    stats = _expand(stats)
    names = [f"{c}_{s}" for c in columns for s in stats]
    quants = [s for s in stats if s in _QUANTILES]
    if quants and hot is skew.LOOK:
        hot = skew.find_hot(df, by)
    if not quants or hot is None:
        return df.groupBy(*by).agg(*[
            (_FOLDS[s](c) if s in _FOLDS else F.percentile(c, _QUANTILES[s])).alias(f"{c}_{s}")
            for c in columns for s in stats
        ])
    parts = [
        grouped(df, by, c, {f"{c}_{s}": _FOLDS[s](c) for s in stats if s in _FOLDS},
                {f"{c}_{s}": _QUANTILES[s] for s in quants}, hot)
        for c in columns
    ]
    return reduce(lambda a, b: skew.same(a, b, by, "inner"), parts).select(*by, *names)


def group_count(df: DataFrame, by: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def cat_summary(df: DataFrame, columns: Sequence[str], stratify_by: Sequence[str] = ()) -> DataFrame:
    """Count of each value and its share within the variable (and stratum)."""
    long = stack(df, columns, stratify_by, "string")
    counts = group_count(long, [*stratify_by, "variable", "value"])
    return group_share(counts, [*stratify_by, "variable"], "count", "prop")


def group_share(df: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    """``x / sum(x)`` per group, rows kept."""
    out = skew.attach(df, by, {"_sum": F.sum(column)})
    return out.withColumn(name, F.try_divide(F.col(column), F.col("_sum"))).drop("_sum")


def extrema(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    return stats_of(df, column, ["extrema"], by)
