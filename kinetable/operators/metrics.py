"""Residuals, likelihoods and model comparison tables for given predictions."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinetable.functions.dist import chi2_tail
from kinetable.operators.agg import group_multi_agg, stats_of
from kinetable.operators.eda import histogram
from kinetable.operators.rel import inner_join_many
from kinetable.plans import skew

ERRORS = ("additive", "proportional", "combined")


def variance(kind: str, pred: Column, add: float = 0.0, prop: float = 0.0) -> Column:
    if kind not in ERRORS:
        raise ValueError(f"error model must be one of {ERRORS}")
    scaled = pred * pred * prop
    return {"additive": F.lit(float(add)), "proportional": scaled, "combined": scaled + add}[kind]


def error_models(df: DataFrame, pred: str, add: float, prop: float) -> DataFrame:
    """Standard deviation of an observation under each residual error model."""
    return df.withColumns({f"sd_{k}": F.sqrt(variance(k, F.col(pred), add, prop)) for k in ERRORS})


def residual_table(df: DataFrame, dv: str, pred: str, kind: str, add: float, prop: float) -> DataFrame:
    """Residual and residual over its standard deviation."""
    res = F.col(dv) - F.col(pred)
    sd = F.sqrt(variance(kind, F.col(pred), add, prop))
    return df.withColumns({"residual": res, "iwres": F.try_divide(res, sd)})


def residual_series(df: DataFrame, axis: str, width: float, columns: Sequence[str] = ("residual", "iwres")) -> DataFrame:
    """Residual statistics in bins of an axis (time or prediction)."""
    binned = df.withColumn("bin", F.floor(F.col(axis) / width) * F.lit(float(width)))
    return group_multi_agg(binned, ["bin"], columns, ["n", "mean", "std"])


def loglik(dv: Column, pred: Column, var: Column) -> Column:
    """Normal log density of one observation; NULL at zero variance."""
    d = dv - pred
    return F.when(var > 0, -0.5 * (math.log(2 * math.pi) + F.ln(var) + d * d / var))


def pooled_loglik(df: DataFrame, dv: str, pred: str, kind: str, add: float, prop: float,
                  by: Sequence[str] = ()) -> DataFrame:
    """Sum over the observations that have a density, their number, and how many have none for zero variance."""
    ll = loglik(F.col(dv), F.col(pred), variance(kind, F.col(pred), add, prop))
    out = F.col(dv).isNotNull() & F.col(pred).isNotNull() & ll.isNull()
    return df.groupBy(*by).agg(F.sum(ll).alias("loglik"), F.count(ll).alias("n_obs"), F.count_if(out).alias("n_excluded"))


def fit_metrics(df: DataFrame, id: str, dv: str, pred: str, kind: str, add: float, prop: float,
                n_params: int) -> DataFrame:
    """Long (Metric, Value) table of the pooled fit."""
    per = pooled_loglik(df, dv, pred, kind, add, prop, [id])
    one = per.agg(F.sum("loglik").alias("ll"), F.sum("n_obs").cast("double").alias("n"),
                  F.sum("n_excluded").cast("double").alias("x"), F.count(F.lit(1)).cast("double").alias("s"))
    m2ll = -2 * F.col("ll")
    rows = {
        "LogLikelihood": F.col("ll"),
        "-2LL": m2ll,
        "AIC": m2ll + 2.0 * n_params,
        "BIC": m2ll + n_params * F.ln("n"),
        "Observations": F.col("n"),
        "Excluded": F.col("x"),
        "Subjects": F.col("s"),
        "Parameters": F.lit(float(n_params)),
    }
    table = F.array(*[F.struct(F.lit(k).alias("Metric"), v.alias("Value")) for k, v in rows.items()])
    return one.select(F.explode(table).alias("r")).select("r.*")


def compare_metrics(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One column of values per model."""
    return inner_join_many([t.withColumnRenamed("Value", name) for name, t in tables.items()], "Metric")


def compare_estimates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Parameter x model table from (parameter, estimate) tables; missing where a model lacks it."""
    long = reduce(lambda a, b: a.unionByName(b),
                  [t.select("parameter", "estimate", F.lit(name).alias("model")) for name, t in tables.items()])
    return long.groupBy("parameter").pivot("model", list(tables)).agg(F.first("estimate"))


def lr_test(small: DataFrame, large: DataFrame, df: int) -> DataFrame:
    """Likelihood ratio test of nested models from their metric tables."""
    def ll(t, name):
        return t.filter(F.col("Metric") == "LogLikelihood").select(F.lit(1).alias("_one"), F.col("Value").alias(name))

    both = ll(small, "ll0").join(ll(large, "ll1"), "_one")
    stat = F.greatest(2 * (F.col("ll1") - F.col("ll0")), F.lit(0.0))
    return both.select("ll0", "ll1", stat.alias("statistic"), F.lit(df).cast("long").alias("df"),
                       chi2_tail(stat, df).alias("p"))


def influential(df: DataFrame, id: str, dv: str, pred: str, kind: str, add: float, prop: float, k: int) -> DataFrame:
    """The k subjects contributing most to -2 log-likelihood."""
    per = pooled_loglik(df, dv, pred, kind, add, prop, [id]).select(id, (-2 * F.col("loglik")).alias("m2ll"))
    return per.orderBy(F.col("m2ll").desc_nulls_last(), F.col(id).asc()).limit(k)


def grid_fit_pooled(scored: DataFrame, dv: str, kind: str, add: float, prop: float) -> DataFrame:
    """Log-likelihood of each candidate over all data, the best one marked."""
    per = pooled_loglik(scored, dv, "pred", kind, add, prop, ["cand"])
    top = F.max_by("cand", F.struct("loglik", -F.col("cand"))).over(Window.partitionBy(F.lit(0)))  # a row per candidate
    return per.select("cand", "loglik", (F.col("cand") == top).alias("best"))


def grid_fit_each(scored: DataFrame, id: str, dv: str, kind: str, add: float, prop: float) -> DataFrame:
    """Best candidate of every subject; the lower number wins a tie."""
    per = pooled_loglik(scored, dv, "pred", kind, add, prop, [id, "cand"])
    return per.groupBy(id).agg(F.max_by("cand", F.struct("loglik", -F.col("cand"))).alias("cand"),
                               F.max("loglik").alias("loglik"))


def grid_fit_two_stage(best: DataFrame, candidates: Sequence[Mapping[str, float]]) -> DataFrame:
    """Mean and standard deviation across subjects of their best candidate's parameters."""
    names = sorted({n for p in candidates for n in p})
    sets = F.array(*[F.struct(*[F.lit(float(p[n])).alias(n) for n in names]) for p in candidates])
    each = best.select(sets[F.col("cand").cast("int")].alias("p")).select("p.*")
    return stats_of(each.unpivot([], names, "parameter", "value"), "value", ["n", "mean", "std"], ["parameter"])


def subject_deviation(params: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Log deviation of each positive parameter from its mean log: ``eta_<parameter>``."""
    ln = {c: F.when(F.col(c) > 0, F.ln(F.col(c))) for c in columns}
    out = skew.attach(params, [], {f"_m_{c}": F.avg(e) for c, e in ln.items()})
    return out.withColumns({f"eta_{c}": ln[c] - F.col(f"_m_{c}") for c in columns}).drop(*[f"_m_{c}" for c in columns])


def deviation_dist(deviations: DataFrame, column: str, bins: int) -> tuple[DataFrame, DataFrame]:
    """Histogram and moments of a deviation."""
    x = F.col(column)
    moments = deviations.agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                             F.skewness(x).alias("skewness"))
    return histogram(deviations, column, bins), moments


def deviation_vs_group(deviations: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Deviation statistics per level of a categorical covariate."""
    return group_multi_agg(deviations, by, columns, ["n", "mean", "std"])


def deviation_vs_value(deviations: DataFrame, columns: Sequence[str], covariate: str) -> DataFrame:
    """Slope and correlation of each deviation against a continuous covariate."""
    long = deviations.unpivot([covariate], list(columns), "parameter", "eta")
    return long.groupBy("parameter").agg(
        F.regr_slope("eta", covariate).alias("slope"), F.corr("eta", F.col(covariate).cast("double")).alias("r"))


def shrinkage(deviations: DataFrame, omega: Mapping[str, float]) -> DataFrame:
    """1 - sd(eta) / omega for each parameter."""
    one = deviations.agg(*[(1 - F.stddev_samp(f"eta_{p}") / F.lit(float(w))).alias(p) for p, w in omega.items()])
    return one.unpivot([], list(omega), "parameter", "shrinkage")


def cov_effect_size(params: DataFrame, by: str, column: str, baseline, hot=skew.LOOK) -> DataFrame:
    """Parameter statistics per covariate level and the change of the mean against the baseline level."""
    out = stats_of(params, column, ["mean", "median", "min", "max", "std"], [by], hot)
    base = F.max(F.when(F.col(by) == baseline, F.col("mean"))).over(Window.partitionBy(F.lit(0)))  # a row per level
    return out.withColumn("percent_change", F.try_divide(100 * (F.col("mean") - base), base))


def bsv_percent(omegas: DataFrame, before: str, after: str) -> DataFrame:
    """Between-subject variability in percent from two variance columns, and the change."""
    def pct(c):
        return 100 * F.sqrt(F.col(c))

    return omegas.withColumns({"bsv_before": pct(before), "bsv_after": pct(after),
                               "bsv_change": pct(after) - pct(before)})


def coef_table(params: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Estimate, standard error, relative error and 95 % interval over per-subject parameters."""
    long = params.unpivot([], list(columns), "parameter", "value")
    s = stats_of(long, "value", ["n", "mean", "std"], ["parameter"])
    se = F.col("std") / F.sqrt("n")
    z = 1.959963984540054  # fixed value: 0.975 quantile of the standard normal
    return s.select("parameter", F.col("mean").alias("estimate"), se.alias("se"),
                    F.try_divide(100 * se, F.col("mean")).alias("rse"),
                    (F.col("mean") - z * se).alias("ci_low"), (F.col("mean") + z * se).alias("ci_high"))


def model_registry(tables: Mapping[str, DataFrame], selected: Sequence[str] | None = None) -> DataFrame:
    """Metric tables of several models stacked with their names, optionally only some of them."""
    names = list(tables) if selected is None else list(selected)
    return reduce(lambda a, b: a.unionByName(b), [tables[n].withColumn("model", F.lit(n)) for n in names])
