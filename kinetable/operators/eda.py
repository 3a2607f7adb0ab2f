"""Tables behind exploratory plots."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window, functions as F

from kinetable.operators.agg import describe, stats_of
from kinetable.plans import skew


def box_stats(df: DataFrame, by: Sequence[str], value: str, hot=skew.LOOK) -> DataFrame:
    """Quartiles, whiskers (furthest points within 1.5 IQR) and outlier count per group."""
    q = stats_of(df, value, ["q25", "median", "q75"], by, hot)
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    v = F.col(value)
    inside = v.between(F.col("q25") - reach, F.col("q75") + reach)
    return skew.same(df.select(*by, value), q, by, "inner").groupBy(*by).agg(
        F.count(v).alias("n"), F.max("q25").alias("q25"), F.max("median").alias("median"),
        F.max("q75").alias("q75"), F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"), F.count_if(~inside).alias("outliers"))


def histogram(df: DataFrame, value: str, bins: int, facet: Sequence[str] = ()) -> DataFrame:
    """Counts in equal bins over the column's range, optionally per facet on the common bins."""
    v = F.col(value)
    d = skew.attach(df.select(*facet, value).filter(v.isNotNull()), [], {"_lo": F.min(v), "_hi": F.max(v)})
    width = (F.col("_hi") - F.col("_lo")) / bins
    bin_ = F.when(width > 0, F.least(F.floor((v - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0)
    d = d.withColumns({"bin": bin_.cast("long"), "_w": width})
    return d.groupBy(*facet, "bin").agg(
        F.min(F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_start"), F.count(F.lit(1)).alias("count"))


def density(df: DataFrame, by: Sequence[str], value: str, points: int = 32, hot=skew.LOOK) -> DataFrame:
    """Gaussian kernel density per group on an even grid over the group's range.

    Bandwidth: 0.9 min(sd, IQR / 1.34) n^(-1/5), with sd alone where the quartiles coincide. A group of one value
    or one row has no bandwidth: its points all lie at the value, with density NULL.
    """
    s = stats_of(df, value, ["n", "std", "min", "max", "q25", "q75"], by, hot)
    iqr = F.col("q75") - F.col("q25")
    h = 0.9 * F.least(F.col("std"), F.when(iqr > 0, iqr / 1.34)) * F.pow("n", F.lit(-0.2))
    s = s.select(*by, "n", "min", "max", F.when(F.col("max") > F.col("min"), h).alias("h"))
    rows = skew.same(df.select(*by, F.col(value).alias("_x")).filter(F.col("_x").isNotNull()), s, by, "inner")
    g = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    rows = rows.withColumn("point", g)
    at = F.col("min") + (F.col("max") - F.col("min")) * F.col("point") / (points - 1)
    z = (F.col("_x") - at) / F.col("h")
    # evaluations fold in the map-side partial aggregation: one row per group and grid point is shuffled
    return rows.groupBy(*by, "point").agg(
        F.min(at).alias("x"),
        F.sum(F.exp(-z * z / 2) / (F.col("h") * F.col("n") * math.sqrt(2 * math.pi))).alias("density"))


def covariates_check(df: DataFrame, id: str, order: Sequence[str], covariates: Sequence[str]) -> DataFrame:
    """First record of each subject, then the distribution of each covariate."""
    w = Window.partitionBy(id).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    first = df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return describe(first, covariates, ["n", "mean", "min", "median", "max"])


def pair_corr(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, one row per pair."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)
    ])
    return one.select(F.explode(rows).alias("p")).select("p.*")


def collinearity(df: DataFrame, flags: Sequence[str], value: str) -> DataFrame:
    """Box statistics of a continuous covariate by each yes/no covariate recoded to 1/0."""
    coded = df.select(F.col(value), *[F.when(F.col(f) == "yes", 1).otherwise(0).alias(f) for f in flags])
    long = coded.unpivot([value], list(flags), "covariate", "level")
    return box_stats(long, ["covariate", "level"], value)
