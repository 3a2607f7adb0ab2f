"""Resampling: bootstrap of subjects, its covariance, importance resampling, predictive bands.

Picks are a hash of (stratum, replicate, draw), so a recomputed task repeats them exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, functions as F

from kinetable.plans import skew, sweep
from kinetable.plans.quantile import grouped
from kinetable.session import cut_lineage

TASK_DRAWS = 500_000  # draws that one task makes or counts


def _picks(subjects: DataFrame, id: str, stratum: str, replicates: int, hot, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(stratum, id, columns, _rank) of the subjects, and (stratum, replicate, _rank) of every draw, dealt by stratum and rank.

    Subjects become ``replicates`` times as many draws, so a number of partitions that follows the draws is asked for
    on both sides: neither the few strata nor the small size of the subjects decides how many tasks there are.
    """
    base = subjects.select(id, stratum, *columns)
    if hot is skew.LOOK:
        hot = skew.find_hot(base, [stratum])
    ranked = skew.row_number(base, [(id, False)], "_rank", [stratum], hot)
    ranked = cut_lineage(ranked)
    sized = skew.attach(ranked, [stratum], {"_n": F.max("_rank")})
    parts = max(1, math.ceil(ranked.count() * replicates / TASK_DRAWS))
    rolled = sized.repartition(parts, stratum, "_rank").select(stratum, "_n", F.col("_rank").alias("_draw"), F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate"))
    key = F.concat_ws("|", F.col(stratum).cast("string"), F.col("replicate").cast("string"), F.col("_draw").cast("string"))
    hashed = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")
    picked = rolled.select(stratum, "replicate", (hashed % F.col("_n") + 1).alias("_rank"))
    return ranked, picked.repartition(parts, stratum, "_rank")


def draws(subjects: DataFrame, id: str, stratum: str, replicates: int, hot=skew.LOOK, columns: Sequence[str] = ()) -> DataFrame:
    """(stratum, replicate, id, columns, times): how often each replicate drew each subject.

    Every stratum is resampled to its own size. ``subjects`` holds one row per subject and is
    read several times.
    """
    ranked, picked = _picks(subjects, id, stratum, replicates, hot, columns)
    times = picked.groupBy(stratum, "replicate", "_rank").agg(F.count(F.lit(1)).alias("times"))
    return times.join(ranked, [stratum, "_rank"], "inner").select(stratum, "replicate", id, *columns, "times")


def draw_lists(subjects: DataFrame, id: str, stratum: str, replicates: int, hot=skew.LOOK) -> DataFrame:
    """(stratum, id, drawn): the replicates that drew a subject, once for each time: some ``replicates`` entries."""
    ranked, picked = _picks(subjects, id, stratum, replicates, hot, ())
    lists = picked.groupBy(stratum, "_rank").agg(F.collect_list("replicate").alias("drawn"))
    return lists.join(ranked, [stratum, "_rank"], "inner").select(stratum, id, "drawn")


def bootstrap(subjects: DataFrame, id: str, stratum: str, columns: Sequence[str], replicates: int,
              hot=skew.LOOK) -> DataFrame:
    """Mean of each column in every replicate. ``subjects`` is read several times: pass stored rows."""
    drawn = draws(subjects, id, stratum, replicates, hot, columns)
    times = F.col("times")
    return drawn.groupBy("replicate").agg(*[
        F.try_divide(F.sum(F.col(c) * times), F.sum(F.when(F.col(c).isNotNull(), times))).alias(c) for c in columns
    ])


def bootstrap_ci(replicated: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, standard deviation and 95 % percentile interval of each replicate statistic."""
    long = replicated.unpivot([], list(columns), "parameter", "value")
    return grouped(long, ["parameter"], "value", {"estimate": F.avg("value"), "se": F.stddev_samp("value")},
                   {"ci_low": 0.025, "ci_high": 0.975}, None)  # one row per replicate: small by construction


def bootstrap_vcov(replicated: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Covariance of every pair of replicate statistics."""
    pairs = list(combinations_with_replacement(columns, 2))
    one = replicated.agg(*[F.covar_samp(a, b).alias(f"v{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"v{i}").alias("covariance"))
        for i, (a, b) in enumerate(pairs)
    ])
    return one.select(F.explode(rows).alias("p")).select("p.*")


def normal_log_density(df: DataFrame, columns: Sequence[str], vcov: DataFrame, name: str) -> DataFrame:
    """Add the log density of each row under the normal distribution with the columns' means over ``df`` and covariance ``vcov``.

    ``vcov`` is ``bootstrap_vcov`` of the same columns. It is factored by Cholesky's method, a few expressions for a few columns on
    its one row; a row's residuals are solved forward through the factor. NULL where a column follows from the others
    to twelve digits.
    """
    k = len(columns)
    pair = {(a, b): F.max(F.when(((F.col("x") == a) & (F.col("y") == b)) | ((F.col("x") == b) & (F.col("y") == a)), F.col("covariance")))
            for i, a in enumerate(columns) for b in columns[: i + 1]}
    one = vcov.agg(*[e.alias(f"c{columns.index(a)}_{columns.index(b)}") for (a, b), e in pair.items()])
    for i in range(k):  # one column of the factor after the other, so that no expression repeats another
        for j in range(i + 1):
            rest = F.col(f"c{i}_{j}")
            for m in range(j):
                rest = rest - F.col(f"l{i}_{m}") * F.col(f"l{j}_{m}")
            one = one.withColumn(f"l{i}_{j}", F.when(rest > 1e-12 * F.col(f"c{i}_{i}"), F.sqrt(rest)) if i == j else F.try_divide(rest, F.col(f"l{j}_{j}")))
    factor = one.select(F.struct(*[f"l{i}_{j}" for i in range(k) for j in range(i + 1)]).alias("_l")).scalar()
    means = df.agg(F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).alias("_m")).scalar()
    out = df.withColumns({"_l": factor, "_m": means})
    total = F.lit(-k / 2 * math.log(2 * math.pi))
    for i, c in enumerate(columns):
        left = F.col(c) - F.col(f"_m.m{i}")
        for j in range(i):
            left = left - F.col(f"_l.l{i}_{j}") * F.col(f"_z{j}")
        out = out.withColumn(f"_z{i}", left / F.col(f"_l.l{i}_{i}"))
        total = total - F.ln(F.col(f"_l.l{i}_{i}")) - F.col(f"_z{i}") * F.col(f"_z{i}") / 2
    return out.withColumn(name, total).drop("_l", "_m", *[f"_z{i}" for i in range(k)])


def sir(candidates: DataFrame, id: str, loglik: str, resamples: int, hot=skew.LOOK, proposal: str | None = None) -> DataFrame:
    """Systematic resampling of candidates in proportion to exp(loglik), or to exp(loglik - proposal) with the log density
    that they were drawn from.

    Candidate i covers (W_(i-1), W_i] of the normalized cumulative weight; it is drawn once for
    each point (m - 1/2) / resamples inside. The points inside are counted directly from the two
    ends, so no join with the points is needed.
    """
    ratio = F.col(loglik) - F.col(proposal) if proposal else F.col(loglik)
    candidates = cut_lineage(candidates.withColumn("_ratio", ratio))  # the totals read them again
    topped = skew.attach(candidates, [], {"_top": F.max("_ratio")})
    weighted = topped.withColumn("_w", F.exp(F.col("_ratio") - F.col("_top"))).withColumn("_g", F.lit(0))
    summed = skew.by_heat(weighted, ["_g"], lambda d, s: s.scan(
        d, ["_g"], [(id, False)], running={"_cum": ("sum", F.col("_w"))}), hot)
    whole = skew.attach(summed, [], {"_all": F.max("_cum")})

    def upto(w):
        return F.floor(w * resamples + 0.5)

    high = F.col("_cum") / F.col("_all")
    low = (F.col("_cum") - F.col("_w")) / F.col("_all")
    return whole.select(id, loglik, (F.col("_w") / F.col("_all")).alias("weight"),
                        (upto(high) - upto(low)).cast("long").alias("drawn")).filter("drawn > 0")


def vpc_bands(observations: DataFrame, id: str, stratum: str, time_bin: str, dv: str, replicates: int,
              hot=skew.LOOK) -> DataFrame:
    """Observed 5/50/95 % per stratum and time bin, with replicate-based 95 % bands.

    Every observation meets the counts of the replicates that drew its subject, and one sorted sweep of a cell
    (stratum, time bin) gives the quantiles of all replicates; observations are never copied. A subject that no replicate
    drew counts among the observed only.
    """
    marks = {"p05": 0.05, "p50": 0.5, "p95": 0.95}
    base = cut_lineage(observations.select(id, stratum, time_bin, dv))
    cell = [stratum, time_bin]
    drawn = draw_lists(base.select(id, stratum).distinct(), id, stratum, replicates, hot)
    lanes = sweep.lane_quantiles(base, cell, dv, "drawn", replicates + 1, marks, drawn, [stratum, id])
    long = lanes.unpivot([*cell, "lane"], list(marks), "mark", "value")
    ends = F.percentile(F.when(F.col("lane") > 0, F.col("value")), F.array(F.lit(0.025), F.lit(0.975)))  # one value for each replicate
    bands = long.groupBy(*cell, "mark").agg(F.max(F.when(F.col("lane") == 0, F.col("value"))).alias("observed"), ends.alias("_b"))
    wide = base.groupBy(*cell).agg(F.count(dv).alias("n")).withColumn("mark", F.explode(F.array(*map(F.lit, marks))))
    out = skew.same(wide, bands, [*cell, "mark"], "left")
    return out.select(*cell, "n", "mark", "observed", F.col("_b")[0].alias("low"), F.col("_b")[1].alias("high"))
