"""Running operators along a subject's records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from kinetable.plans import skew


def dosing(
    df: DataFrame, id: str, time: str, evid: str, tie: Sequence[str] = (), hot=skew.LOOK,
    start: str | None = None,
) -> DataFrame:
    """Add ``occ`` (doses so far) and ``dose_time`` (time of the latest dose) to every record.

    Order: time, doses before observations at the same time, then ``tie``. With ``start`` the
    subject's first time is added under that name, from the same pass.
    """
    order = [(time, False), (evid, True), *[(c, False) for c in tie]]
    is_dose = F.col(evid) == 1
    running = {
        "occ": ("sum", F.col(evid).cast("long")),
        "dose_time": ("max", F.when(is_dose, F.col(time))),
    }
    if start:
        running[start] = ("min", F.col(time))
    return skew.by_heat(df, [id], lambda d, s: s.scan(d, [id], order, running=running), hot)


def occasion(df: DataFrame, id: str, time: str, evid: str, tie: Sequence[str] = (), hot=skew.LOOK) -> DataFrame:
    """Occasion number: cumulative dose count per subject."""
    return dosing(df, id, time, evid, tie, hot).drop("dose_time")


def time_after_dose(
    df: DataFrame, id: str, time: str, evid: str, tie: Sequence[str] = (), hot=skew.LOOK
) -> DataFrame:
    """``tad``: time since the latest dose, NULL before the first one."""
    out = dosing(df, id, time, evid, tie, hot)
    return out.withColumn("tad", F.col(time) - F.col("dose_time")).drop("occ", "dose_time")
