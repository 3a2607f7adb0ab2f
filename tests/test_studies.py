"""Crossover studies and distribution functions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetable.functions.dist import chi2_tail, t_quantile95, t_two_sided_p
from kinetable.operators import be

# fixed values: id, sequence, AUC in periods 1 and 2, Cmax in periods 1 and 2
STUDY = """1 RT 2849 2230 499 436
2 TR 2025 2000 438 361
3 TR 2090 1826 535 558
4 RT 2790 2864 733 416
5 RT 2112 1744 344 48
6 TR 2006 1881 443 681
7 TR 2202 1935 446 481
8 RT 1736 1882 342 437
9 RT 1356 1175 357 240
10 TR 1838 1602 310 340
11 RT 1775 1585 442 286
12 TR 1898 2504 323 331
15 TR 1129 1036 308 243
16 RT 2997 2237 425 332
17 RT 1973 1778 423 407
18 TR 2014 1938 552 427
19 RT 1454 1297 256 348
20 TR 1900 1730 355 401
21 RT 2469 2023 392 480
22 TR 1763 1472 213 177
23 TR 1678 1336 487 412
24 RT 1584 1855 316 373
25 RT 4004 2449 465 625
26 TR 2271 2389 422 731
27 TR 1986 1857 560 461
28 RT 1944 1593 502 326
29 RT 1175 1147 248 221
30 TR 2519 1941 537 400
31 RT 1696 1801 390 350
34 RT 1737 1655 425 319
35 TR 1560 1629 463 372
36 RT 2040 2199 464 384"""


@pytest.fixture(scope="module")
def study(spark):
    rows = []
    for line in STUDY.split("\n"):
        id, seq, a1, a2, c1, c2 = line.split()
        rows += [(int(id), seq, 1, float(a1), float(c1)), (int(id), seq, 2, float(a2), float(c2))]
    df = spark.createDataFrame(rows, "id long, sequence string, period int, AUC double, Cmax double")
    return be.be_input(df, ["AUC", "Cmax"]).cache()


def test_formulation(study):
    got = {(r.sequence, r.period): r.formulation for r in study.collect()}
    assert got == {("RT", 1): "R", ("RT", 2): "T", ("TR", 1): "T", ("TR", 2): "R"}


def test_result(study):
    r = {x.endpoint: x for x in be.be_result(study).collect()}
    c, a = r["Cmax"], r["AUC"]
    assert c.df == 30
    assert [c.pe, c.se, c.gmr, c.lb, c.ub] == pytest.approx([-0.0952144, 0.0748778, 0.909178, 0.800674, 1.032386], abs=1e-6)
    assert [a.pe, a.se, a.gmr, a.lb, a.ub] == pytest.approx([-0.0165546, 0.0262729, 0.983582, 0.940685, 1.028434], abs=1e-6)


def test_decision(study):
    got = {(r.endpoint, r.criteria): r["pass"] for r in be.be_decision(study).collect()}
    assert got == {("AUC", "80-125"): True, ("Cmax", "80-125"): True, ("AUC", "90-110"): True, ("Cmax", "90-110"): False}


def test_design(study):
    got = {(r.endpoint, r.sequence): (r.periods, r.subjects) for r in be.be_design(study).collect()}
    assert got["AUC", "RT"] == (2, 17) and got["AUC", "TR"] == (2, 15)


def test_lsmeans_ratio_is_the_estimate(study):
    ls = {(r.endpoint, r.formulation): r.lsmean for r in be.be_lsmeans(study).collect()}
    for r in be.be_result(study).collect():
        assert ls[r.endpoint, "T"] / ls[r.endpoint, "R"] == pytest.approx(r.gmr)


def test_method_by_endpoint(study):
    default = {r.endpoint: r.method for r in be.be_endpoints(study).collect()}
    name = sorted(default)[0]
    other = "nonpar" if default[name] == "lm" else "lm"
    assert {r.endpoint: r.method for r in be.be_endpoints(study, methods={name: other}).collect()} == {**default, name: other}
    with pytest.raises(ValueError):
        be.be_endpoints(study, methods={name: "anova"})


def test_one_sequence_gives_no_estimate(spark):
    df = spark.createDataFrame([(1, "RT", 1, 5.0), (1, "RT", 2, 6.0)], "id long, sequence string, period int, y double")
    r = be.be_result(be.be_input(df, ["y"])).collect()[0]
    assert r.pe is None and r.lb is None
    assert be.be_nonpar(be.be_input(df, ["y"])).collect()[0].pe is None


@pytest.mark.parametrize("limit", ["1000000", "3"])
def test_one_sequence_study_keeps_its_row(spark, limit):
    rows = [(s, i, "RT" if s == 1 or i % 2 else "TR", t, float(i * t)) for s in (1, 2) for i in range(8) for t in (1, 2)]
    df = spark.createDataFrame(rows, "study int, id int, sequence string, period int, tmax double")
    spark.conf.set("kinetable.hotRows", limit)
    try:
        got = {r.study: r.pe for r in be.be_nonpar(be.be_input(df, ["tmax"], by=["study"]), ["study"]).collect()}
    finally:
        spark.conf.unset("kinetable.hotRows")
    assert set(got) == {1, 2} and got[1] is None and got[2] is not None


@pytest.mark.parametrize("limit", ["1000000", "10"])
@pytest.mark.parametrize("ties", [False, True])
def test_nonparametric_against_all_pairs(spark, limit, ties):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for s, (n, m) in enumerate([(9, 7), (6, 6), (1, 5)]):
        d = {}
        for i in range(n + m):
            y = rng.integers(0, 6, 2).astype(float) if ties else rng.normal(0, 100, 2)
            seq = "TR" if i < n else "RT"
            d.setdefault(seq, []).append(y[0] - y[1])
            rows += [(s, i, seq, 1, float(y[0])), (s, i, seq, 2, float(y[1]))]
        want[s] = float(np.median(np.subtract.outer(d["TR"], d["RT"])) / 2)
    df = spark.createDataFrame(rows, "study int, id int, sequence string, period int, tmax double")
    spark.conf.set("kinetable.hotRows", limit)
    try:
        got = {r.study: r.pe for r in be.be_nonpar(be.be_input(df, ["tmax"], by=["study"]), ["study"]).collect()}
    finally:
        spark.conf.unset("kinetable.hotRows")
    assert got == pytest.approx(want, abs=1e-9)


def test_distributions(spark):
    one = spark.range(1).select(
        t_two_sided_p(F.lit(1.697260887), F.lit(30)).alias("a"), t_two_sided_p(F.lit(2.0), F.lit(7)).alias("b"),
        t_two_sided_p(F.lit(0.5), F.lit(2)).alias("c"), t_two_sided_p(F.lit(1.0), F.lit(1)).alias("d"),
        t_two_sided_p(F.lit(1.96), F.lit(1999)).alias("e"), t_two_sided_p(F.lit(1.96), F.lit(2001)).alias("f"),
        t_quantile95(F.lit(30)).alias("q"), t_quantile95(F.lit(2)).alias("q2"),
        chi2_tail(F.lit(3.841458820694124), 1).alias("x1"), chi2_tail(F.lit(5.991464547107979), 2).alias("x2"),
        chi2_tail(F.lit(7.814727903251179), 3).alias("x3"), chi2_tail(F.lit(9.487729036781154), 4).alias("x4")).collect()[0]
    assert 1 - one.a / 2 == pytest.approx(0.95, abs=1e-7)
    assert 1 - one.b / 2 == pytest.approx(0.957190, abs=1e-6)
    assert 1 - one.c / 2 == pytest.approx(0.666667, abs=1e-6)
    assert one.d == pytest.approx(0.5)
    assert one.e == pytest.approx(one.f, abs=1e-6)  # neighbours in degrees of freedom
    assert one.q == pytest.approx(1.697260886593957, abs=1e-12) and one.q2 == pytest.approx(2.919985580353726, abs=1e-12)
    assert [one.x1, one.x2, one.x3, one.x4] == pytest.approx([0.05] * 4, abs=1e-6)
