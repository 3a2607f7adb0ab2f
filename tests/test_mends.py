"""Tails, skipped lines, densities, far times and clashing names."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from kinetable.functions.dist import chi2_tail
from kinetable.operators import eda, nca
from kinetable.plans import skew
from kinetable.sources import tables


def exact_tail(x, df):
    """Two-step recurrence from erfc or exp, both correctly rounded."""
    half = x / 2
    total = math.erfc(math.sqrt(half)) if df % 2 else math.exp(-half)
    for k in range(1 if df % 2 else 2, df, 2):
        total += math.exp(k / 2 * math.log(half) - half - math.lgamma(k / 2 + 1))
    return total


def test_chi2_tail(spark):
    xs = [1e-8, 0.01, 0.5, 1.0, 2.9, 3.1, 10.0, 40.0, 52.0, 90.0, 300.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.select("x", *[chi2_tail(F.col("x"), k).alias(f"p{k}") for k in (1, 2, 3, 4, 7, 25, 50)]).collect()
    for r in got:
        for k in (1, 2, 3, 4, 7, 25, 50):
            assert r[f"p{k}"] == pytest.approx(exact_tail(r.x, k), rel=1e-9), (r.x, k)
    assert spark.range(1).select(chi2_tail(F.lit(0.0), 3)).first()[0] == 1.0
    with pytest.raises(ValueError):
        chi2_tail(F.lit(1.0), 0)


@pytest.mark.parametrize("split", ["128m", "200"])
def test_skipped_lines(spark, tmp_path, split):
    """Text keys, files of several splits, a file of fewer lines than are skipped, and one of a header alone."""
    sizes = [0, 1, 2, 3, 200]
    for i, n in enumerate(sizes):
        body = "".join(f"S-{i}-{j},{j}\n" for j in range(n))
        (tmp_path / f"f{i}.csv").write_text("subject,v\n" + "".join(["number,mg\n", "S-9,1\n"][: min(2, n + 1)]) + (body if n > 1 else ""))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0" if split == "200" else "4194304")
    try:
        got = tables.read_csv(spark, str(tmp_path), schema="subject string, v int", skipto=4)
        assert (got.rdd.getNumPartitions() > 5) == (split == "200")
        assert sorted((r.subject, r.v) for r in got.collect()) == sorted((f"S-{i}-{j}", j) for i, n in enumerate(sizes) if n > 1 for j in range(n))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_density_keeps_every_group(spark):
    rows = [("flat quartiles", v) for v in (1.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 9.0)] + [("constant", 3.0)] * 3 + [("one", 2.0)] + [("null", None)]
    got = eda.density(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", 5).collect()
    at = {g: sorted((r.point, r.x, r.density) for r in got if r.g == g) for g in ("flat quartiles", "constant", "one", "null")}
    assert [x for _, x, _ in at["flat quartiles"]] == [1, 3, 5, 7, 9] and all(d > 0 for *_, d in at["flat quartiles"])
    assert at["constant"] == [(p, 3.0, None) for p in range(5)] and at["one"] == [(p, 2.0, None) for p in range(5)] and at["null"] == []


@pytest.mark.parametrize("start", [0.0, 1e8])
@pytest.mark.parametrize("limit", [None, 4])
def test_slopes_far_from_zero(spark, start, limit):
    rows = [("a", start + 6.0 * i, 100.0 * math.exp(-0.05 * 6 * i), None, "ev", None, None) for i in range(8)]
    if limit:
        spark.conf.set("kinetable.hotRows", str(limit))
    try:
        got = nca.nca_report(spark.createDataFrame(rows, "id string, t double, c double, amt double, route string, tau double, dur double"), ["id"]).first()
    finally:
        spark.conf.unset("kinetable.hotRows")
    assert got.lambdaz == pytest.approx(0.05, rel=1e-6) and got.n_lambdaz == 7
    assert got.lambdaz_intercept == pytest.approx(math.log(100) + 0.05 * start, rel=1e-6)


def test_ranges_replace_like_named_columns(spark):
    df = spark.createDataFrame([("a", i, 1, 7, 8) for i in range(50)], "id string, t int, evid int, occ int, before int")
    run, prev = {"occ": ("sum", F.col("evid"))}, {"before": "t"}
    each = [s.scan(df, ["id"], [("t", False)], run, prev) for s in (skew.Plain(), skew.Chunked(6))]
    rows = [sorted((r.t, r.occ, r.before) for r in d.collect()) for d in each]
    assert rows[0] == rows[1] == [(i, i + 1, i - 1 if i else None) for i in range(50)]
    assert sorted(each[0].columns) == sorted(each[1].columns)
    whole = [s.group(df, ["id"], {"occ": F.sum("evid"), "before": F.max("t")}) for s in (skew.Plain(), skew.Chunked(6))]
    assert [sorted((r.t, r.occ, r.before) for r in d.collect()) for d in whole] == [[(i, 50, 49) for i in range(50)]] * 2


def test_normal_log_density(spark):
    import numpy as np

    from kinetable.operators import resample

    rng = np.random.default_rng(2)
    rows = rng.normal(size=(40, 3)) @ np.array([[2.0, 0, 0], [1, 0.5, 0], [-3, 0.2, 1e-3]]).T + [5, -1, 100]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], "i int, a double, b double, c double")
    names = ["a", "b", "c"]
    got = resample.normal_log_density(df, names, resample.bootstrap_vcov(df, names), "q").orderBy("i").collect()
    cov, off = np.cov(rows.T), rows - rows.mean(axis=0)
    want = -1.5 * math.log(2 * math.pi) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off)
    assert [r.q for r in got] == pytest.approx(want.tolist(), rel=1e-6)
    same = df.withColumn("b", F.col("a") * 2)  # no density
    assert resample.normal_log_density(same, ["a", "b"], resample.bootstrap_vcov(same, ["a", "b"]), "q").where("q IS NOT NULL").count() == 0


def test_importance_ratio(spark):
    from kinetable.operators import resample

    df = spark.createDataFrame([(i, -float(i), -2.0 * i) for i in range(5)], "i int, ll double, q double")
    weights = [math.exp(i) for i in range(5)]
    got = {r.i: (r.weight, r.drawn) for r in resample.sir(df, "i", "ll", 1000, proposal="q").collect()}
    assert {i: w for i, (w, _) in got.items()} == pytest.approx({i: w / sum(weights) for i, w in enumerate(weights)})
    assert sum(n for _, n in got.values()) == 1000
