"""Sources, columns, rows, joins, events, scoring and resampling on small tables."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from kinetable.operators import agg, cols, events, metrics, rel, resample, rows, score
from kinetable.session import fresh_path, shared_dir
from kinetable.sources import tables


def test_csv_tokens_and_units(spark):
    path = fresh_path(spark, "csv")
    import os

    os.makedirs(path)
    with open(f"{path}/a.csv", "w", newline="") as f:
        f.write("ID,Age,route\r\n,year,\r\n1,44,inf\r\n2,NA,.\r\n3,,ev\r\n")
    got = tables.read_csv_skip_units(spark, path, "ID long, Age double, route string", "ID").orderBy("ID").collect()
    assert [tuple(r) for r in got] == [(1, 44.0, "inf"), (2, None, None), (3, None, "ev")]


def test_rejected_values(spark):
    path = fresh_path(spark, "csv")
    spark.createDataFrame([("1", "4x"), ("2", "NA"), ("b", "5")], "id string, age string").write.option("header", True).csv(path)
    got = {r.column: r.rejected for r in tables.rejected_values(spark, path, "id long, age double").collect()}
    assert got == {"id": 1, "age": 1}


def test_zero_variance_is_counted(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 0.0), (None, 0.0), (5.0, None)], "dv double, pred double")
    r = metrics.pooled_loglik(df, "dv", "pred", "proportional", 0.0, 0.1).first()
    assert (r.n_obs, r.n_excluded) == (1, 1)


def test_shared_dir_is_the_session_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_duplicate_columns_need_makeunique(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError):
        rel.join(a, a, "k")
    out = rel.inner_join_many([a, a, a], "k", makeunique=True)
    assert out.columns == ["k", "v", "v_1", "v_2"]


def test_rename_by_position_and_absent(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    assert cols.rename(a, {2: "w"}).columns == ["k", "w"]
    with pytest.raises(ValueError):
        cols.rename(a, {"zz": "w"})


def test_cast_strict_and_not(spark):
    a = spark.createDataFrame([("7",), ("x",)], "s string")
    assert [r.s for r in cols.cast_types(a, {"s": "int"}, strict=False).collect()] == [7, None]
    with pytest.raises(Exception):
        cols.cast_types(a, {"s": "int"}).collect()


def test_round_sig(spark):
    a = spark.createDataFrame([(123456.0,), (0.00123456,), (0.0,), (None,), (-98.76,)], "x double")
    assert [r[0] for r in a.select(cols.round_sig(F.col("x"), 3)).collect()] == [123000.0, 0.00123, 0.0, None, -98.8]


def test_unit_metadata(spark):
    out = cols.unit_convert(spark.createDataFrame([(2.0,)], "amt double"), "amt", 1000.0, "mcg", "amt_mcg")
    assert out.schema["amt_mcg"].metadata == {"unit": "mcg"} and out.collect()[0].amt_mcg == 2000.0


def test_codes_follow_text_order(spark):
    a = spark.createDataFrame([("b",), ("",), ("ba",), (None,), ("aé",), ("a",)], "s string")
    got = {r.s: r.s_code for r in cols.categorical_codes(a, ["s"]).collect()}
    assert got == {"": 1, "a": 2, "aé": 3, "b": 4, "ba": 5, None: None}


def test_missing_sorts_last(spark):
    a = spark.createDataFrame([(3,), (None,), (1,)], "x int")
    assert [r.x for r in rows.order_by(a, ("x", False)).collect()] == [1, 3, None]
    assert [r.x for r in rows.order_by(a, ("x", True)).collect()] == [3, 1, None]
    assert [r.x for r in rows.last_n(a, 1, ("x", False)).collect()] == [None]


def test_multi_agg_extrema(spark):
    a = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "g string, v double")
    assert agg.group_multi_agg(a, ["g"], ["v"], ["extrema", "median"]).collect()[0].asDict() == {
        "g": "a", "v_min": 1.0, "v_max": 3.0, "v_median": 2.0}


def test_event_violations(spark):
    a = spark.createDataFrame(
        [(1, 0.0, 1, 5.0, None), (1, 1.0, 0, None, 2.0), (1, 2.0, 1, None, None), (1, -1.0, 0, None, 2.0), (1, 3.0, 1, 5.0, 2.0)],
        "id int, time double, evid int, amt double, dv double")
    got = {r.violation: r.n for r in events.violations(events.event_table(a, "id", "time", "amt", "evid", ["dv"])).collect()}
    assert got == {"none": 2, "dose without amount": 1, "bad time": 1, "dose with observation": 1}


def test_expand_doses(spark):
    a = spark.createDataFrame([(1, 0.0, 24.0, 2), (2, 5.0, None, None)], "id int, time double, ii double, addl int")
    got = sorted((r.id, r.time) for r in events.expand_doses(a).collect())
    assert got == [(1, 0.0), (1, 24.0), (1, 48.0), (2, 5.0)]


@pytest.mark.parametrize("limit", ["1000000", "5"])
def test_superposition_across_long_gaps(spark, limit):
    """Doses hours to years apart: decay blocks, the block before, and forgotten doses."""
    doses = [0.0, 1.0, 250.0, 299.0, 301.0, 640.0, 5000.0, 5000.5]
    seen = [0.5, 1.0, 300.0, 302.0, 650.0, 4999.0, 5001.0, 9000.0]
    recs = [(1, t, 1, 10.0) for t in doses] + [(1, t, 0, None) for t in seen]
    df = spark.createDataFrame(recs, "id int, time double, evid int, amt double")
    p = {"CL": 5.0, "Vc": 20.0, "Ka": 1.7, "F": 0.9}
    spark.conf.set("kinetable.hotRows", limit)
    try:
        got = {r.time: r.pred for r in score.score_1cmt_oral(df, p).collect()}
    finally:
        spark.conf.unset("kinetable.hotRows")
    k, ka = 0.25, 1.7
    for t in seen:
        want = sum(0.9 * 10 * ka / (20 * (ka - k)) * (math.exp(-k * (t - d)) - math.exp(-ka * (t - d))) for d in doses if d <= t)
        assert got[t] == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_equal_rates_do_not_divide_by_zero(spark):
    df = spark.createDataFrame([(1, 0.0, 1, 10.0), (1, 2.0, 0, None)], "id int, time double, evid int, amt double")
    got = score.score_1cmt_oral(df, {"CL": 1.0, "Vc": 2.0, "Ka": 0.5}).collect()[0].pred
    assert got == pytest.approx(10 * 0.5 / 2 * 2.0 * math.exp(-1.0), rel=1e-4)


def test_likelihood_and_ranking(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, 1.0, 1.0)], "id int, dv double, pred double")
    ll = metrics.pooled_loglik(df, "dv", "pred", "additive", 1.0, 0.0).collect()[0].loglik
    assert ll == pytest.approx(-0.5 * (2 * math.log(2 * math.pi) + 1))
    assert metrics.influential(df, "id", "dv", "pred", "additive", 1.0, 0.0, 1).collect()[0].id == 1


def test_lower_candidate_wins_a_tie(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0, 0), (1, 2.0, 1.0, 1)], "id int, dv double, pred double, cand long")
    assert metrics.grid_fit_each(df, "id", "dv", "additive", 1.0, 0.0).collect()[0].cand == 0


def test_draws_keep_stratum_sizes_and_repeat(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(30)], "id int, s string")
    got = resample.draws(df, "id", "s", 5)
    totals = {(r.s, r.replicate): r.n for r in got.groupBy("s", "replicate").agg(F.sum("times").alias("n")).collect()}
    assert set(totals.values()) == {20, 10} and len(totals) == 10
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, resample.draws(df, "id", "s", 5).collect()))


def test_draws_are_dealt_over_tasks(spark):
    df = spark.createDataFrame([(i, "a") for i in range(3000)], "id int, s string")
    picked = resample._picks(df, "id", "s", 400, None, ())[1]
    sizes = [r["count"] for r in picked.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1_200_000 and max(sizes) < 600_000


def test_sir_draws_all_points(spark):
    df = spark.createDataFrame([(i, -0.5 * i) for i in range(50)], "id int, ll double")
    got = resample.sir(df, "id", "ll", 20).collect()
    assert sum(r.drawn for r in got) == 20 and max(got, key=lambda r: r.drawn).id == 0
