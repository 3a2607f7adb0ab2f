"""Two-period, two-sequence crossover bioequivalence, many studies and endpoints at once.

Every function groups by ``[*by, "endpoint"]``; one study is the case ``by=[]``.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from kinetable.functions.dist import t_quantile95, t_two_sided_p
from kinetable.operators.agg import stats_of
from kinetable.plans import pairs, skew
from kinetable.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

LIMITS = {"80-125": (0.80, 1.25), "90-110": (0.90, 1.10)}  # fixed values: acceptance ranges


def be_input(df: DataFrame, endpoints: Sequence[str], id: str = "id", sequence: str = "sequence",
             period: str = "period", by: Sequence[str] = ()) -> DataFrame:
    """Long table (by, id, sequence, period, formulation, endpoint, y).

    The formulation is the letter of the sequence at the period.
    """
    wide = df.select(
        *by, F.col(id).alias("id"), F.col(sequence).alias("sequence"), F.col(period).cast("int").alias("period"),
        F.expr(f"substring(`{sequence}`, cast(`{period}` as int), 1)").alias("formulation"),
        *[F.col(e).cast("double").alias(e) for e in endpoints])
    return wide.unpivot([*by, "id", "sequence", "period", "formulation"], list(endpoints), "endpoint", "y")


def be_design(data: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per endpoint and sequence: periods and number of subjects."""
    one = data.groupBy(*by, "endpoint", "sequence", "id").agg(F.max("period").alias("p"))
    return one.groupBy(*by, "endpoint", "sequence").agg(
        F.max("p").cast("long").alias("periods"), F.count(F.lit(1)).alias("subjects"))


def be_stats(data: DataFrame, factor: str, by: Sequence[str] = (), hot=skew.LOOK) -> DataFrame:
    """Endpoint statistics by formulation, sequence or period."""
    return stats_of(data, "y", ["n", "mean", "std", "min", "median", "max", "geomean"], [*by, "endpoint", factor], hot)


def subject_contrasts(data: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Complete subjects: ``d`` = ln y1 - ln y2 and ``m`` = their mean; raw difference ``dy``."""
    ln1 = F.max(F.when((F.col("period") == 1) & (F.col("y") > 0), F.ln("y")))
    ln2 = F.max(F.when((F.col("period") == 2) & (F.col("y") > 0), F.ln("y")))
    y1 = F.max(F.when(F.col("period") == 1, F.col("y")))
    y2 = F.max(F.when(F.col("period") == 2, F.col("y")))
    one = data.groupBy(*by, "endpoint", "sequence", "id").agg(
        ln1.alias("l1"), ln2.alias("l2"), y1.alias("y1"), y2.alias("y2"))
    return one.select(*by, "endpoint", "sequence", "id", (F.col("l1") - F.col("l2")).alias("d"),
                      ((F.col("l1") + F.col("l2")) / 2).alias("m"), (F.col("y1") - F.col("y2")).alias("dy"),
                      "l1", "l2")


def _moments(data: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per study and endpoint: counts, means and sums of squares of both sequences."""
    both = subject_contrasts(data, by).filter(F.col("d").isNotNull())
    cell = both.groupBy(*by, "endpoint", "sequence").agg(
        F.count("d").alias("n"), F.avg("d").alias("d"), F.var_samp("d").alias("vd"), F.avg("m").alias("m"),
        F.var_samp("m").alias("vm"), F.avg("l1").alias("l1"), F.avg("l2").alias("l2"))

    def of(seq, c):
        return F.max(F.when(F.col("sequence") == seq, F.col(c))).alias(f"{c}_{seq.lower()}")

    wide = cell.groupBy(*by, "endpoint").agg(
        *[of(s, c) for s in ("RT", "TR") for c in ("n", "d", "vd", "m", "vm", "l1", "l2")])
    n1, n2 = F.col("n_rt"), F.col("n_tr")

    def pooled(v):
        ss = (n1 - 1) * F.coalesce(f"{v}_rt", F.lit(0.0)) + (n2 - 1) * F.coalesce(f"{v}_tr", F.lit(0.0))
        return F.when(n1 + n2 > 2, F.sqrt(ss / F.greatest(n1 + n2 - 2, F.lit(1)) * (1 / n1 + 1 / n2)))

    return wide.withColumns({"df": n1 + n2 - 2, "se_d": pooled("vd") / 2, "se_m": pooled("vm")})


def be_model(data: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Coefficients on the log endpoint: formulation and period within, sequence between subjects."""
    m = _moments(data, by)
    rows = [
        ("formulation", (F.col("d_tr") - F.col("d_rt")) / 2, F.col("se_d")),
        ("period", (F.col("d_tr") + F.col("d_rt")) / 2, F.col("se_d")),
        ("sequence", F.col("m_tr") - F.col("m_rt"), F.col("se_m")),
    ]
    terms = F.array(*[F.struct(F.lit(t).alias("term"), e.alias("estimate"), s.alias("se")) for t, e, s in rows])
    return m.select(*by, "endpoint", "df", F.explode(terms).alias("r")).select(
        *by, "endpoint", F.col("r.term").alias("term"), F.col("r.estimate").alias("estimate"),
        F.col("r.se").alias("se"), "df")


def be_wald(data: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Wald F test of each term."""
    model = be_model(data, by)
    t = F.try_divide(F.col("estimate"), F.col("se"))
    return model.select(*by, "endpoint", "term", (t * t).alias("f"), F.lit(1).cast("long").alias("df1"),
                        F.col("df").alias("df2"), t_two_sided_p(t, F.col("df")).alias("p"))


def be_lsmeans(data: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Geometric least-squares mean per formulation: mean of its sequence x period cells."""
    m = _moments(data, by)
    means = {"R": (F.col("l1_rt") + F.col("l2_tr")) / 2, "T": (F.col("l2_rt") + F.col("l1_tr")) / 2}
    rows = F.array(*[F.struct(F.lit(k).alias("formulation"), F.exp(v).alias("lsmean")) for k, v in means.items()])
    return m.select(*by, "endpoint", F.explode(rows).alias("r")).select(*by, "endpoint", "r.*")


def be_result(data: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Point estimate of ln(T/R), its 90 % interval, and both on the ratio scale."""
    pe, se = F.col("pe"), F.col("se")
    half = t_quantile95(F.col("df")) * se
    return (
        _moments(data, by)
        .select(*by, "endpoint", ((F.col("d_tr") - F.col("d_rt")) / 2).alias("pe"), F.col("se_d").alias("se"), "df")
        .withColumns({"lnlb": pe - half, "lnub": pe + half})
        .withColumns({"gmr": F.exp(pe), "lb": F.exp("lnlb"), "ub": F.exp("lnub")})
    )


def be_decision(data: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Whether the interval lies inside each acceptance range."""
    rows = F.array(*[
        F.struct(F.lit(n).alias("criteria"), ((F.col("lb") >= lo) & (F.col("ub") <= hi)).alias("pass"))
        for n, (lo, hi) in LIMITS.items()
    ])
    return be_result(data, by).select(*by, "endpoint", F.explode(rows).alias("r")).select(*by, "endpoint", "r.*")


# ---- nonparametric estimate ----

def be_nonpar(data: DataFrame, by: Sequence[str] = (), log: bool = False, hot=skew.LOOK) -> DataFrame:
    """Hodges-Lehmann estimate ``pe``, the median over (i in TR, j in RT) of (d_i - d_j) / 2, and its 90 % limits ``lb`` and ``ub``.

    The limits are the differences at rank k from either end, k by the rank-sum null distribution (``plans.pairs.limit_rank``);
    ``level`` is what they reach, less than 0.9 only where a study is too small for any limits at 90 %. The n x m differences
    are never formed: their order statistics are found by counting pairs from the two sorted samples. A study within
    the row limit is one small task; larger ones are cut into ranges. A study without pairs keeps its row, with NULLs.
    """
    sides = subject_contrasts(data, by).select(
        *by, "endpoint", "sequence", F.col("d" if log else "dy").alias("d")).filter(
        F.col("d").isNotNull() & F.col("sequence").isin("TR", "RT"))
    keys = [*by, "endpoint"]
    if hot is skew.LOOK:
        hot = skew.find_hot(sides, keys)
    if hot is None:
        return _within_task(sides, keys)
    cold = _within_task(skew.same(sides, F.broadcast(hot), keys, "left_anti"), keys)
    return cold.unionByName(_across_tasks(cut_lineage(skew.same(sides, F.broadcast(hot), keys, "left_semi")), keys))


ESTIMATES = StructType([StructField(n, DoubleType()) for n in ("pe", "lb", "ub", "level")])


def _within_task(sides: DataFrame, keys: Sequence[str]) -> DataFrame:
    def estimate(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.loc[pdf["sequence"] == "TR", "d"].to_numpy(dtype=float)
        y = np.sort(pdf.loc[pdf["sequence"] == "RT", "d"].to_numpy(dtype=float))
        out = pdf.iloc[:1][list(keys)].copy()
        out[["pe", "lb", "ub", "level"]] = None
        if len(x) and len(y):
            m1, m2, low, high = (pairs.kth_difference(x, y, k) for k in pairs.wanted_ranks(len(x), len(y)))
            out[["pe", "lb", "ub", "level"]] = [[(m1 + m2) / 4, low / 2, high / 2, pairs.limit_rank(len(x), len(y))[1]]]
        return out

    return sides.groupBy(*keys).applyInPandas(estimate, StructType([sides.schema[k] for k in keys] + ESTIMATES.fields))


def _across_tasks(sides: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same order statistics of studies too large for a task; one row per study from four differences."""
    is_x = F.col("sequence") == "TR"
    found = pairs.ranked_differences(sides.withColumn("_x", is_x), keys, "_x", "d")
    at = {n: F.max(F.when(F.col("id") == i, F.col("value"))) for i, n in enumerate(("_m1", "_m2", "_low", "_high"))}
    ranked = found.groupBy(*keys).agg(*[c.alias(n) for n, c in at.items()])
    sizes = sides.groupBy(*keys).agg(F.count_if(is_x).alias("_m"), F.count_if(~is_x).alias("_n"))

    def levels(batches):
        for pdf in batches:
            pdf["level"] = [pairs.limit_rank(m, n)[1] if m and n else None for m, n in zip(pdf["_m"], pdf["_n"])]
            yield pdf[[*keys, "level"]]

    level = sizes.mapInPandas(levels, StructType([sides.schema[k] for k in keys] + ESTIMATES.fields[-1:]))
    joined = skew.same(level, ranked, keys, "left")  # a study without pairs keeps its row
    return joined.select(*keys, ((F.col("_m1") + F.col("_m2")) / 4).alias("pe"), (F.col("_low") / 2).alias("lb"), (F.col("_high") / 2).alias("ub"), "level")


def be_endpoints(data: DataFrame, by: Sequence[str] = (), hot=skew.LOOK, methods: Mapping[str, str] | None = None) -> DataFrame:
    """Every endpoint by its method, ``lm`` or ``nonpar``: as ``methods`` says by endpoint, else names containing
    "tmax" nonparametric, others linear. Estimate and 90 % limits of ``nonpar`` are differences on the endpoint's own scale.
    """
    if bad := {m for m in (methods or {}).values() if m not in ("lm", "nonpar")}:
        raise ValueError(f"methods are lm and nonpar, not {sorted(bad)}")
    ranked = F.lower("endpoint").contains("tmax")
    for name, method in (methods or {}).items():
        ranked = F.when(F.col("endpoint") == name, F.lit(method == "nonpar")).otherwise(ranked)
    lm = be_result(data.filter(~ranked), by).select(*by, "endpoint", F.lit("lm").alias("method"), "pe", "lnlb", "lnub")
    nonpar = be_nonpar(data.filter(ranked), by, hot=hot).select(
        *by, "endpoint", F.lit("nonpar").alias("method"), "pe", F.col("lb").alias("lnlb"), F.col("ub").alias("lnub"))
    return lm.unionByName(nonpar)
