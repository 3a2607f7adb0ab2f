"""Event tables: binding, dose expansion, subject parameters, several observation kinds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def event_table(df: DataFrame, id: str, time: str, amt: str, evid: str, observations: Sequence[str],
                cmt: str | None = None, rate: str | None = None, route: str | None = None,
                covariates: Sequence[str] = (), ss: str | None = None, ii: str | None = None) -> DataFrame:
    """Tidy event records with a ``violation`` text (NULL when the record is sound).

    With ``ss`` the records keep it and ``ii``, for scoring doses at steady state.
    """
    def opt(name, default, kind):
        return (F.col(name) if name else F.lit(default)).cast(kind)

    rows = df.select(
        F.col(id).alias("id"), F.col(time).cast("double").alias("time"), F.col(evid).cast("int").alias("evid"),
        opt(cmt, 1, "int").alias("cmt"), F.col(amt).cast("double").alias("amt"),
        opt(rate, 0.0, "double").alias("rate"), opt(route, None, "string").alias("route"),
        *[F.col(o).cast("double").alias(o) for o in observations], *covariates,
        *([opt(ss, 0, "int").alias("ss"), opt(ii, 0.0, "double").alias("ii")] if ss else []))
    dose = F.col("evid") == 1
    steady = dose & (F.col("ss") == 1) if ss else F.lit(False)
    every = F.coalesce(F.col("ii") > 0, F.lit(False)) if ss else F.lit(True)
    seen = F.coalesce(*[F.col(o) for o in observations])
    return rows.withColumn("violation", F.when(F.col("id").isNull(), "no id")
                           .when(F.col("time").isNull() | (F.col("time") < 0), "bad time")
                           .when(~F.col("evid").isin(0, 1) | F.col("evid").isNull(), "bad evid")
                           .when(dose & ~F.coalesce(F.col("amt") > 0, F.lit(False)), "dose without amount")
                           .when(dose & seen.isNotNull(), "dose with observation")
                           .when(~dose & F.coalesce(F.col("amt") > 0, F.lit(False)), "observation with amount")
                           .when(dose & (F.col("rate") < 0), "bad rate")
                           .when(steady & ~every, "steady state without interval")
                           .when(steady & (F.col("rate") > 0) & (F.col("amt") > F.col("rate") * (F.col("ii") if ss else 0)), "infusion outlasts interval"))


def violations(events: DataFrame) -> DataFrame:
    """Number of records per violation; the sound ones as "none"."""
    return events.groupBy(F.coalesce("violation", F.lit("none")).alias("violation")).agg(F.count(F.lit(1)).alias("n"))


def expand_doses(doses: DataFrame, time: str = "time", ii: str = "ii", addl: str = "addl", ss: str | None = None) -> DataFrame:
    """One row per administered dose: the dose itself and ``addl`` repeats every ``ii`` hours.

    Of a dose at steady state (``ss``) only the first row is one; its repeats follow from there.
    """
    more = F.coalesce(F.col(addl).cast("int"), F.lit(0))
    out = doses.withColumn("dose_no", F.explode(F.sequence(F.lit(0), more))).withColumn(
        time, F.col(time) + F.col("dose_no") * F.coalesce(F.col(ii).cast("double"), F.lit(0.0)))
    return out.withColumn(ss, F.when(F.col("dose_no") > 0, F.lit(0)).otherwise(F.col(ss))) if ss else out


def attach_subject_params(records: DataFrame, params: DataFrame, id: str, names: Mapping[str, str]) -> DataFrame:
    """Left join individual parameters as covariates, renamed (CL -> iCL)."""
    one = params.select(id, *[F.col(a).alias(b) for a, b in names.items()]).na.drop().distinct()
    return records.join(one, id, "left")


def dv_long(df: DataFrame, observations: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """Several observation columns as (dvid, dv) rows; missing observations are left out."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(k) for k, c in observations.items()])
    return wide.unpivot(list(keep), list(observations), "dvid", "dv").filter(F.col("dv").isNotNull())


def metabolite_ratio(areas: DataFrame, keys: Sequence[str], parent: str = "parent", metabolite: str = "metabolite",
                     area: str = "auclast") -> DataFrame:
    """Metabolite : parent ratio of areas from one row per (keys, dvid)."""
    wide = areas.groupBy(*keys).agg(*[
        F.max(F.when(F.col("dvid") == k, F.col(area))).alias(f"auc_{k}") for k in (parent, metabolite)])
    return wide.withColumn("ratio", F.try_divide(f"auc_{metabolite}", f"auc_{parent}"))
