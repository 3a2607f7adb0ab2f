"""Areas of near-flat segments and t probabilities against high-precision values."""

from __future__ import annotations

from decimal import Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from kinetable.functions import areas
from kinetable.functions.dist import t_quantile95, t_two_sided_p

getcontext().prec = 60


def exact(t1, c1, t2, c2, a, b):
    """Area and first moment of c1 exp(-k (t - t1)) over [a, b]."""
    t1, c1, t2, c2, a, b = map(Decimal, (t1, c1, t2, c2, a, b))
    k = (c1 / c2).ln() / (t2 - t1)
    ca, cb = c1 * (-k * (a - t1)).exp(), c1 * (-k * (b - t1)).exp()
    return (ca - cb) / k, (a * ca - b * cb) / k + (ca - cb) / (k * k)


@pytest.mark.parametrize("drop", [4e-15, 1e-12, 1e-9, 1e-6, 1e-3, 0.5, 5.0, 9.999])
@pytest.mark.parametrize("t1", [0.0, 100.0])
def test_segments(spark, drop, t1):
    t2, c1, c2 = t1 + 10.0, 10.0, 10.0 - drop
    seg = ("t1", "c1", "t2", "c2")
    row = spark.createDataFrame([(t1, c1, t2, c2)], "t1 double, c1 double, t2 double, c2 double").selectExpr(
        f"{areas.auc('true', *seg)} AS auc", f"{areas.aumc('true', *seg)} AS aumc",
        f"{areas.clipped_auc('true', *seg, f'{t1 + 1}D', f'{t1 + 2.5}D')} AS part").first()
    area, moment = exact(t1, c1, t2, c2, t1, t2)
    part, _ = exact(t1, c1, t2, c2, t1 + 1, t1 + 2.5)
    for got, want in ((row.auc, area), (row.aumc, moment), (row.part, part)):
        assert abs(got / float(want) - 1) < 1e-12


# 0.95 quantiles as tabled, and two-sided tails of 3.0 by closed forms for small degrees of freedom
QUANTILES = {1: 6.313751514675043, 2: 2.919985580353726, 3: 2.3533634348018264, 4: 2.13184678632665, 5: 2.015048373333023,
             30: 1.6972608865939574, 5000: 1.6451584375}
TAILS = {1: 0.20483276469913348, 2: 0.09546596626670913, 4: 0.03994196807171882}


def test_t(spark):
    df = spark.createDataFrame([(n,) for n in QUANTILES], "nu int")
    for r in df.select("nu", t_quantile95(F.col("nu")).alias("q")).collect():
        assert abs(r.q - QUANTILES[r.nu]) < 1e-9
    tails = df.select("nu", t_two_sided_p(F.lit(3.0), F.col("nu")).alias("p"), t_two_sided_p(F.lit(0.0), F.col("nu")).alias("one")).collect()
    assert all(abs(r.p - TAILS[r.nu]) < 1e-12 for r in tails if r.nu in TAILS) and all(r.one == 1.0 for r in tails)
    none = spark.createDataFrame([(0,)], "nu int").select(t_quantile95(F.col("nu")).alias("q"), t_two_sided_p(F.lit(1.0), F.col("nu")).alias("p")).first()
    assert none.q is None and none.p is None
