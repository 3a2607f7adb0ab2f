"""The registry of queries, and the given tables shaped like study data.

Each query is a function of (session, folder); its SQL twin states the same result for the check.
Doubles are rounded on both sides so that summation order does not show.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DoubleType

from kinetable.operators.sequence import dosing
from kinetable.plans import skew
from kinetable.sources.tables import dataset

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated function, and its SQL twin when there is one."""
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = settle(sql)
        return fn

    return keep


def settle(sql: str) -> str:
    """Expand ``sig(x)``: single precision, then six decimals, so that neither the order of a sum
    nor a decimal tie shows in a comparison."""
    while (at := sql.find("sig(")) >= 0:
        end, depth = at + 4, 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = f"{sql[:at]}round(CAST(CAST({sql[at + 4:end - 1]} AS REAL) AS DOUBLE), 6) + 0.0{sql[end:]}"
    return sql


def rounded(df: DataFrame, raw: Sequence[str] = ()) -> DataFrame:
    """The same rounding on every double column not named in ``raw``."""
    return df.select(*[
        F.round(F.col(f.name).cast("float").cast("double"), 6).alias(f.name)
        if f.dataType == DoubleType() and f.name not in raw else F.col(f.name)
        for f in df.schema.fields
    ])


def rsel(plain: str, doubles: str, frm: str) -> str:
    """SELECT text: columns as they are, then rounded ones."""
    cols = [c.strip() for c in plain.split(",") if c.strip()]
    cols += [f"sig({c.strip()}) AS {c.strip()}" for c in doubles.split(",") if c.strip()]
    return f"SELECT {', '.join(cols)} FROM {frm}"


# ---- covariates: one row per customer ----

def covs(spark: SparkSession, d: str) -> DataFrame:
    """id, name, continuous acctbal and wt, categorical segment and region, yes/no isPM and isfed."""
    c, n, r = (dataset(spark, d, t) for t in ("customer", "nation", "region"))
    place = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", F.col("r_name").alias("region"))
    return c.join(place, c.c_nationkey == place.n_nationkey).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"), "region", *flags("c_custkey"))


def flags(key: str):
    k = F.col(key)
    return [
        F.when(k % 3 == 0, "yes").otherwise("no").alias("isPM"),
        F.when(k % 2 == 0, "yes").otherwise("no").alias("isfed"),
        (50 + k % 50).cast("double").alias("wt"),
    ]


def flags_sql(key: str) -> str:
    return (f"""CASE WHEN {key} % 3 = 0 THEN 'yes' ELSE 'no' END AS "isPM",
        CASE WHEN {key} % 2 = 0 THEN 'yes' ELSE 'no' END AS isfed, CAST(50 + {key} % 50 AS DOUBLE) AS wt""")


COVS = f"""covs AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment,
    r_name AS region, {flags_sql('c_custkey')}
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


# ---- dosing and concentration records: the event stream ----

def hot_users(spark: SparkSession, d: str):
    """Users above the row limit, found once per query on the key column alone."""
    return skew.find_hot(dataset(spark, d, "events").select("user_id"), ["user_id"])


def raw_events(spark: SparkSession, d: str) -> DataFrame:
    """A signup is a dose of ``value``; every other event observes ``value``."""
    us = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    dose = F.col("event_type") == "signup"
    return dataset(spark, d, "events").select(
        "event_id", "event_type", "user_id", us.alias("us"), F.when(dose, 1).otherwise(0).alias("evid"),
        F.when(dose, F.col("value")).alias("amt"), F.when(~dose, F.col("value")).alias("dv"))


def pk_events(spark: SparkSession, d: str, hot, extra: Sequence[str] = ()) -> DataFrame:
    """Records with hours since the user's first event ``h``, occasion ``occ``, hours after dose ``t``."""
    ev = dosing(raw_events(spark, d), "user_id", "us", "evid", ["event_id"], hot, start="first_us")
    return ev.select(
        "event_id", "user_id", "evid", "amt", "dv", "occ", *extra,
        ((F.col("us") - F.col("first_us")) / F.lit(3.6e9)).alias("h"),
        ((F.col("us") - F.col("dose_time")) / F.lit(3.6e9)).alias("t"),
        ((F.col("dose_time") - F.col("first_us")) / F.lit(3.6e9)).alias("dose_time"))


PK = """ev0 AS (SELECT event_id, user_id, epoch_us(ts) AS us, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS evid,
    value FROM events),
ev AS (SELECT event_id, user_id, evid, (us - min(us) OVER (PARTITION BY user_id)) / 3.6e9 AS h,
    CASE WHEN evid = 1 THEN value END AS amt, CASE WHEN evid = 0 THEN value END AS dv,
    CAST(sum(evid) OVER w AS BIGINT) AS occ, (us - max(CASE WHEN evid = 1 THEN us END) OVER w) / 3.6e9 AS t
  FROM ev0 WINDOW w AS (PARTITION BY user_id ORDER BY us, evid DESC, event_id ROWS UNBOUNDED PRECEDING)),
dose AS (SELECT user_id, occ, amt AS dose FROM ev WHERE evid = 1),
prof AS (SELECT user_id, occ, t, dv AS c FROM ev WHERE occ > 0 AND evid = 0 AND dv > 0.001)"""

PROFILE = ["user_id", "occ"]


def records(spark: SparkSession, d: str, hot, route: str = "ev", tau: float | None = None,
            dur: float | None = None) -> DataFrame:
    """Profile records of the event stream: observations and the dose row of each occasion."""
    ev = pk_events(spark, d, hot).filter((F.col("occ") > 0) & ((F.col("evid") == 1) | (F.col("dv") > 0.001)))
    is_dose = F.col("evid") == 1
    return ev.select(
        "user_id", "occ", "t", F.col("dv").alias("c"), "amt",
        F.when(is_dose, F.lit(route)).alias("route"),
        F.when(is_dose, F.lit(tau)).cast("double").alias("tau"),
        F.when(is_dose, F.lit(dur)).cast("double").alias("dur"))


# ---- crossover studies: consecutive orders of a customer, two and two, are subjects ----

def be_data(spark: SparkSession, d: str) -> DataFrame:
    """study, id, sequence, period and three endpoints; an odd last order has no second period and is left out."""
    o = dataset(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    hot = None if o.count() <= skew.hot_rows(spark) else skew.LOOK
    n = F.col("rn") - 1
    one = skew.row_number(o, [("o_orderdate", False), ("o_orderkey", False)], "rn", ["o_custkey"], hot).withColumns(
        {"pair": F.floor(n / 2), "period": (n % 2 + 1).cast("int")})
    subject = Window.partitionBy("o_custkey", "pair")  # one or two rows
    both = one.withColumn("n", F.count(F.lit(1)).over(subject)).filter("n = 2")
    k = F.col("o_custkey")
    return both.select(
        (k % 25).alias("study"), (k * 1_000_000 + F.col("pair")).alias("id"),
        F.when((k + F.col("pair")) % 2 == 0, "RT").otherwise("TR").alias("sequence"),
        F.col("period"), F.col("o_totalprice").alias("AUC"),
        (F.col("o_totalprice") / (1 + F.col("o_orderkey") % 7)).alias("Cmax"),
        (F.col("o_orderkey") % 24).cast("double").alias("tmax"))


BE = """o1 AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS rn FROM orders),
o2 AS (SELECT *, rn // 2 AS pair, rn % 2 + 1 AS period FROM o1),
o3 AS (SELECT *, count(*) OVER (PARTITION BY o_custkey, pair) AS n FROM o2),
bed AS (SELECT o_custkey % 25 AS study, o_custkey * 1000000 + pair AS id, CASE WHEN (o_custkey + pair) % 2 = 0 THEN 'RT' ELSE 'TR' END AS sequence,
    CAST(period AS INTEGER) AS period, o_totalprice AS "AUC", o_totalprice / (1 + o_orderkey % 7) AS "Cmax",
    CAST(o_orderkey % 24 AS DOUBLE) AS tmax FROM o3 WHERE n = 2),
be AS (SELECT study, id, sequence, period, substring(sequence, period, 1) AS formulation, e.endpoint, e.y
  FROM bed, LATERAL (VALUES ('AUC', "AUC"), ('Cmax', "Cmax"), ('tmax', tmax)) AS e(endpoint, y))"""
