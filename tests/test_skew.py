"""Passes over hot keys against plain windows, on data where one key holds a third of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kinetable.plans.quantile import grouped
from kinetable.plans.skew import Chunked, Plain, add_chunks, attach, by_heat, find_hot, row_number
from kinetable.operators.rel import join


@pytest.fixture(scope="module")
def skewed(spark):
    """600 rows; key 0 holds a third; bursts of equal times, outliers and missing values."""
    n = F.col("id")
    return spark.range(600).select(
        n.alias("row"),
        F.when(n % 3 == 0, 0).otherwise(n % 17 + 1).alias("k"),
        F.when(n % 5 == 0, 7.0).when(n % 101 == 0, 1e9).otherwise((n * 37 % 211).cast("double")).alias("t"),
        F.when(n % 13 != 0, (n * 29 % 97).cast("double")).alias("v"),
    ).cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_hot_keys(spark, skewed, tiny_limit):
    assert [r.k for r in find_hot(skewed, ["k"]).orderBy("k").collect()][0] == 0


@pytest.mark.parametrize("desc", [False, True])
def test_scan(spark, skewed, tiny_limit, desc):
    order = [("t", desc), ("row", False)]
    running = {"s": ("sum", F.col("v")), "n": ("count", F.lit(1)), "hi": ("max", F.col("v")), "lo": ("min", F.col("v"))}

    def scan(d, s):
        return s.scan(d, ["k"], order, running, {"before": "v", "at": "t"})

    want = scan(skewed, Plain())
    assert rows(by_heat(skewed, ["k"], scan)) == rows(want)
    assert rows(scan(skewed, Chunked(10))) == rows(want)


def test_row_number(spark, skewed, tiny_limit):
    got = row_number(skewed, [("t", True), ("row", False)], "rn").orderBy("rn").select("row", "rn").collect()
    want = skewed.orderBy(F.desc("t"), "row").select("row").collect()
    assert [r.row for r in got] == [r.row for r in want]
    assert [r.rn for r in got] == list(range(1, 601))


def test_attach_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (1, 5.0)], "k int, v double")
    assert rows(attach(df, ["k"], {"s": F.sum("v")})) == rows(
        spark.createDataFrame([(None, 1.0, 3.0), (None, 2.0, 3.0), (1, 5.0, 5.0)], "k int, v double, s double"))


@pytest.mark.parametrize("by", [[], ["k"]])
def test_quantiles(spark, skewed, tiny_limit, by):
    probs = {"lo": 0.0, "q": 0.25, "m": 0.5, "x": 0.9, "hi": 1.0}
    aggs = {"n": F.count("v")}
    rounded = [F.round(c, 9).alias(c) for c in probs]
    got = grouped(skewed, by, "v", aggs, probs).select(*by, "n", *rounded)
    want = grouped(skewed, by, "v", aggs, probs, hot=None).select(*by, "n", *rounded)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("how", ["left", "inner", "right", "outer"])
def test_salted_join(spark, skewed, how):
    left = spark.createDataFrame([(0, "a"), (1, "b"), (99, "c")], "k long, name string")
    right = skewed.filter("k < 5").select(F.col("k").cast("long").alias("k"), "row")
    assert rows(join(left, right, "k", how, salt=4)) == rows(join(left, right, "k", how))


def test_no_key_is_collected_whole(spark, skewed, tiny_limit):
    """The plan for hot keys never partitions a row-level window by the key alone."""
    cut = Chunked(10).scan(skewed, ["k"], [("t", False), ("row", False)], {"s": ("sum", F.col("v"))}, {"b": "t"})
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line and "row_number" in line]
    assert windows and all("_c#" in w for w in windows)


ORDERS = {
    "text": "concat('Customer#', lpad(cast(row * 37 % 1000 AS string), 9, '0'))",
    "timestamp": "cast(timestamp_seconds(row * 37 % 1000) AS timestamp_ntz)",
    "decades": "pow(10D, row % 40)",
    "burst": "5D",
    "null": "cast(NULL AS double)",
    "mostly_null": "CASE WHEN row % 50 = 0 THEN row END",
}


@pytest.mark.parametrize("kind", list(ORDERS))
@pytest.mark.parametrize("desc", [False, True])
def test_any_order(spark, tiny_limit, kind, desc):
    df = spark.range(1500).withColumnRenamed("id", "row").withColumns({"k": F.col("row") % 3 % 2, "t": F.expr(ORDERS[kind])}).repartition(5)
    order = [("t", desc), ("row", False)]
    sizes = add_chunks(df, ["k"], order, 20).groupBy("k", "_c").count()
    assert sizes.agg(F.max("count")).first()[0] <= 20
    got = Chunked(20, ("k",)).scan(df, ["k"], order, {"n": ("count", F.lit(1))}, {"p": "row"})
    assert rows(got) == rows(Plain().scan(df, ["k"], order, {"n": ("count", F.lit(1))}, {"p": "row"}))
    numbered = row_number(df, order, "rn").orderBy("rn").select("row", "rn").collect()
    want = df.orderBy(F.col("t").desc_nulls_last() if desc else F.col("t").asc_nulls_last(), "row").collect()
    assert [(r.row, r.rn) for r in numbered] == [(w.row, i + 1) for i, w in enumerate(want)]


def test_quantiles_over_many_decades(spark, tiny_limit):
    df = spark.range(900).select((F.col("id") % 2).alias("k"), F.pow(F.lit(10.0), F.col("id") % 41 - 20).alias("v"))
    probs = {"q1": 0.1, "q5": 0.5, "q9": 0.95}
    assert rows(grouped(df, ["k"], "v", {}, probs)) == rows(grouped(df, ["k"], "v", {}, probs, hot=None))
