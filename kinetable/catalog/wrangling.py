"""Sources, columns, rows, joins and summaries on the given business tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinetable.catalog.base import COVS, covs, dataset, query, rounded, rsel
from kinetable.operators import agg, cols, rel, rows
from kinetable.session import fresh_path
from kinetable.sources import tables

# ---- sources and sinks ----

ORDERS_DDL = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
HOLED = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS o_totalprice FROM orders"""


def _holed(spark, d):
    """Orders as text with the three missing tokens punched in."""
    o, k = dataset(spark, d, "orders"), F.col("o_orderkey")
    return o.select(
        k.cast("string").alias("o_orderkey"),
        F.when(k % 7 == 0, "NA").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(k % 5 == 0, ".").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 11 == 0, "").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"))


@query("read_csv", HOLED)
def _(spark, d):
    path = fresh_path(spark, "orders-csv")
    tables.write_csv(_holed(spark, d), path)
    return tables.read_csv(spark, path, schema=ORDERS_DDL)


@query("read_csv_skip_units", HOLED)
def _(spark, d):
    path = fresh_path(spark, "orders-units")
    units = spark.range(1).select(*[F.lit(u).alias(c) for c, u in zip(
        ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), ("number", "number", "", "USD"))])
    tables.write_csv(units.unionByName(_holed(spark, d)), path)
    return tables.read_csv_skip_units(spark, path, ORDERS_DDL, "o_orderkey")


_SITES = 4


@query("read_csv_skipto", """SELECT 'S-' || o_orderkey AS subject, o_orderkey % 4 AS site, o_orderstatus, o_totalprice FROM orders""")
def _(spark, d):
    """One file a site with text keys, a units line and a comment below each header."""
    path = fresh_path(spark, "sites-csv")
    site = F.col("o_orderkey") % _SITES
    data = dataset(spark, d, "orders").select(
        F.concat(F.lit("S-"), F.col("o_orderkey")).alias("subject"), "o_orderstatus", F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.lit(2).alias("line"), site.alias("site"))
    heads = [("number", "code", "USD"), ("S-0", "as typed", "0")]
    lines = spark.range(_SITES).select(F.col("id").alias("site"), F.explode(F.array(*[
        F.struct(*[F.lit(v).alias(c) for c, v in zip(data.columns, h)], F.lit(i).alias("line")) for i, h in enumerate(heads)])).alias("h"))
    whole = data.unionByName(lines.select("h.*", "site")).repartition(_SITES, "site").sortWithinPartitions("site", "line")
    whole.drop("line").write.partitionBy("site").option("header", True).csv(path)
    return tables.read_csv_skip_units(spark, path, "subject string, site bigint, o_orderstatus string, o_totalprice double", skipto=4)


@query("write_csv", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def _(spark, d):
    path = fresh_path(spark, "part-csv")
    tables.write_csv(dataset(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"), path)
    return tables.read_csv(
        spark, path, schema="p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double")


@query("dataset", "SELECT * FROM lineitem")
def _(spark, d):
    return tables.dataset(spark, d, "lineitem")


@query("save_result", """SELECT l_returnflag AS parameter, sig(avg(l_extendedprice)) AS estimate FROM lineitem GROUP BY l_returnflag""")
def _(spark, d):
    est = dataset(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("parameter")).agg(
        F.avg("l_extendedprice").alias("estimate"))
    path = fresh_path(spark, "fit")
    tables.save_result({"estimates": rounded(est)}, path)
    return tables.load_result(spark, path, ["estimates"])["estimates"]


@query("report_table", """WITH s AS (SELECT l_returnflag AS stratum, avg(l_quantity) AS mean, min(l_quantity) AS min, max(l_quantity) AS max
  FROM lineitem GROUP BY l_returnflag)
SELECT stratum, 'l_quantity' AS parameter, e.stat, sig(e.value) AS value, 'STUDY-001' AS studyid, 'v0.1' AS version
FROM s, LATERAL (VALUES ('mean', mean), ('min', min), ('max', max)) AS e(stat, value)""")
def _(spark, d):
    li = dataset(spark, d, "lineitem").withColumnRenamed("l_returnflag", "stratum")
    s = agg.summarize(li, ["l_quantity"], ["mean", "extrema"], ["stratum"])
    return rounded(tables.report_table(s, ["stratum", "parameter"], ["mean", "min", "max"],
                                       {"studyid": "STUDY-001", "version": "v0.1"}))


# ---- columns ----

@query("select_cols", "SELECT l_orderkey, l_quantity FROM lineitem")
def _(spark, d):
    return cols.select_cols(dataset(spark, d, "lineitem"), "l_orderkey", "l_quantity")


@query("select_not", "SELECT * EXCLUDE (l_tax, l_shipdate) FROM lineitem")
def _(spark, d):
    return cols.select_not(dataset(spark, d, "lineitem"), "l_tax", "l_shipdate")


@query("select_regex", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def _(spark, d):
    return cols.select_regex(dataset(spark, d, "lineitem"), "key$")


@query("rename", "SELECT p_partkey AS id, p_name, p_brand AS brand, p_type, p_size, p_retailprice AS price FROM part")
def _(spark, d):
    return cols.rename(dataset(spark, d, "part"), {1: "id", "p_brand": "brand", 6: "price"})


@query("add_const", "SELECT c_custkey, 'SAD' AS cohort FROM customer")
def _(spark, d):
    return cols.add_const(dataset(spark, d, "customer").select("c_custkey"), "cohort", "SAD")


@query("case_when", """SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS class FROM part""")
def _(spark, d):
    size = F.col("p_size")
    return cols.case_when(dataset(spark, d, "part"), "class", [(size < 10, "small"), (size < 30, "medium")], "large").select(
        "p_partkey", "class")


@query("arith_cols", """SELECT l_orderkey, l_linenumber, l_orderkey + 1 AS next_key, sig(l_quantity * 1000) AS qty_milli,
  sig(l_extendedprice * (1 - l_discount)) AS net FROM lineitem""")
def _(spark, d):
    li = cols.arith_cols(dataset(spark, d, "lineitem"), {
        "next_key": F.col("l_orderkey") + 1, "qty_milli": F.col("l_quantity") * 1000,
        "net": F.col("l_extendedprice") * (1 - F.col("l_discount"))})
    return rounded(li.select("l_orderkey", "l_linenumber", "next_key", "qty_milli", "net"))


@query("cast_types", """SELECT CAST(o_orderkey AS VARCHAR) AS key_text, CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) AS key_back,
  CAST(o_orderkey AS DOUBLE) AS key_float, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS level,
  TRY_CAST(o_orderstatus AS INTEGER) AS not_a_number FROM orders""")
def _(spark, d):
    o = dataset(spark, d, "orders").select(
        F.col("o_orderkey").alias("key_text"), F.col("o_orderkey").alias("key_float"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("level"), F.col("o_orderstatus").alias("not_a_number"))
    o = cols.cast_types(o, {"key_text": "string", "key_float": "double"})
    o = cols.cast_types(o.withColumn("key_back", F.col("key_text")), {"key_back": "bigint"})
    return cols.cast_types(o, {"level": "int", "not_a_number": "int"}, strict=False)


@query("categorical_codes", """SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
  CAST(dense_rank() OVER (ORDER BY l_returnflag) AS BIGINT) AS l_returnflag_code,
  CAST(dense_rank() OVER (ORDER BY l_linestatus) AS BIGINT) AS l_linestatus_code FROM lineitem""")
def _(spark, d):
    li = dataset(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return cols.categorical_codes(li, ["l_returnflag", "l_linestatus"])


@query("missing_flag", f"SELECT o_orderkey, o_totalprice IS NULL AS absent FROM ({HOLED})")
def _(spark, d):
    o = dataset(spark, d, "orders").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")))
    return cols.missing_flag(o, "o_totalprice", "absent").select("o_orderkey", "absent")


@query("unit_convert", "SELECT l_orderkey, l_linenumber, sig(l_quantity * 1000.0) AS mcg FROM lineitem")
def _(spark, d):
    li = cols.unit_convert(dataset(spark, d, "lineitem"), "l_quantity", 1000.0, "mcg", "mcg")
    return rounded(li.select("l_orderkey", "l_linenumber", "mcg"))


@query("round_sig", """WITH k AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS x,
  floor(log10(nullif(abs(l_extendedprice), 0))) - 2 AS k FROM lineitem)
SELECT l_orderkey, l_linenumber, sig(CASE WHEN x = 0 THEN x WHEN k < 0 THEN round(x * pow(10.0, -k)) / pow(10.0, -k)
  ELSE round(x / pow(10.0, k)) * pow(10.0, k) END) AS rounded FROM k""")
def _(spark, d):
    li = dataset(spark, d, "lineitem")
    return rounded(li.select("l_orderkey", "l_linenumber", cols.round_sig(F.col("l_extendedprice"), 3).alias("rounded")))


@query("row_index", """SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS "COUNT" FROM orders""")
def _(spark, d):
    o = dataset(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return cols.row_index(o, [("o_totalprice", False), ("o_orderkey", False)]).drop("o_totalprice")


@query("axis_scale", """SELECT event_id, sig(CASE WHEN value > 0 THEN ln(value) END) AS ln_value,
  sig(CASE WHEN value > 0 THEN log10(value) END) AS log10_value, sig(asinh(value / 2) / ln(10.0)) AS pseudolog10_value FROM events""")
def _(spark, d):
    return rounded(cols.axis_scale(dataset(spark, d, "events"), "value").select(
        "event_id", "ln_value", "log10_value", "pseudolog10_value"))


# ---- rows ----

@query("row_filter", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 25 AND l_returnflag <> 'N'")
def _(spark, d):
    return rows.row_filter(dataset(spark, d, "lineitem"), F.col("l_quantity") > 25, F.col("l_returnflag") != "N").select(
        "l_orderkey", "l_linenumber")


@query("drop_missing", f"SELECT * FROM ({HOLED}) WHERE o_custkey IS NOT NULL AND o_totalprice IS NOT NULL")
def _(spark, d):
    holed = cols.cast_types(_holed(spark, d), {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}, False)
    holed = holed.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != ".", F.col("o_orderstatus")))
    return rows.drop_missing(holed, ["o_custkey", "o_totalprice"])


@query("unique_rows", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def _(spark, d):
    return rows.unique_rows(dataset(spark, d, "lineitem"), ["l_suppkey", "l_returnflag"])


@query("order_by", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC NULLS LAST")
def _(spark, d):
    return rows.order_by(dataset(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                         ("o_custkey", False), ("o_totalprice", True))


@query("first_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10")
def _(spark, d):
    return rows.first_n(dataset(spark, d, "orders").select("o_orderkey", "o_totalprice"), 10,
                        ("o_totalprice", False), ("o_orderkey", False))


@query("last_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10")
def _(spark, d):
    return rows.last_n(dataset(spark, d, "orders").select("o_orderkey", "o_totalprice"), 10,
                       ("o_totalprice", False), ("o_orderkey", False))


@query("row_slice", """SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS rn FROM orders)
WHERE rn BETWEEN 101 AND 200""")
def _(spark, d):
    return rows.row_slice(dataset(spark, d, "orders").select("o_orderkey", "o_totalprice"),
                          [("o_totalprice", False), ("o_orderkey", False)], 101, 200)


@query("page_groups", """WITH s AS (SELECT o_custkey, CAST(ceil(row_number() OVER (ORDER BY o_custkey) / 9.0) AS BIGINT) AS page
  FROM (SELECT DISTINCT o_custkey FROM orders)) SELECT o_orderkey, o_custkey, page FROM orders JOIN s USING (o_custkey)""")
def _(spark, d):
    return rows.page_groups(dataset(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 9)


@query("pick_subject", """WITH s AS (SELECT user_id, row_number() OVER (ORDER BY user_id) AS n FROM (SELECT DISTINCT user_id FROM events))
SELECT event_id, e.user_id, value FROM events e JOIN s ON e.user_id = s.user_id WHERE n BETWEEN 4 AND 12""")
def _(spark, d):
    return rows.pick_subject(dataset(spark, d, "events").select("event_id", "user_id", "value"), "user_id", 4, 12)


# ---- joins and concatenation ----

# every third customer goes by another key, so that rows of either side find no partner
_MOVED = "(SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey) FROM customer) c"


def _sides(spark, d):
    o = dataset(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), "o_totalprice")
    key = F.col("c_custkey")
    c = dataset(spark, d, "customer").select(F.when(key % 3 == 0, -key).otherwise(key).alias("k"), "c_name", "c_acctbal")
    return o, c


def _join_sql(kind: str) -> str:
    return (f"SELECT o_orderkey, coalesce(o_custkey, c_custkey) AS k, o_totalprice, c_name, c_acctbal "
            f"FROM orders {kind} JOIN {_MOVED} ON o_custkey = c_custkey")


def _joined(name: str, how: str, sql: str, salt=None) -> None:
    @query(name, sql)
    def run(spark, d):
        o, c = _sides(spark, d)
        return rel.join(o, c, "k", how, salt=salt)


_joined("left_join", "left", _join_sql("LEFT"))
_joined("inner_join", "inner", _join_sql("INNER"))
_joined("right_join", "right", _join_sql("RIGHT"))
_joined("outer_join", "outer", _join_sql("FULL"))
_joined("outer_join_salted", "outer", _join_sql("FULL"), salt=8)
_joined("anti_join", "anti", f"SELECT o_orderkey, o_custkey AS k, o_totalprice FROM orders ANTI JOIN {_MOVED} ON o_custkey = c_custkey")
_joined("semi_join", "semi", f"SELECT o_orderkey, o_custkey AS k, o_totalprice FROM orders SEMI JOIN {_MOVED} ON o_custkey = c_custkey")


@query("left_join_multi", """WITH g AS (SELECT l_suppkey * 2 AS l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, n FROM lineitem LEFT JOIN g USING (l_suppkey, l_returnflag)""")
def _(spark, d):
    li = dataset(spark, d, "lineitem")
    g = agg.group_count(li.withColumn("l_suppkey", F.col("l_suppkey") * 2), ["l_suppkey", "l_returnflag"], "n")
    return rel.join(li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag"), g, ["l_suppkey", "l_returnflag"], "left")


@query("inner_join_many", """WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1),
b AS (SELECT l_suppkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
c AS (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1)
SELECT a.k, a.n, b.n AS n_1, c.n AS n_2 FROM a JOIN b ON a.k = b.k JOIN c ON a.k = c.k""")
def _(spark, d):
    keys = {"orders": "o_custkey", "lineitem": "l_suppkey", "events": "user_id"}
    parts = [agg.group_count(dataset(spark, d, t).withColumnRenamed(k, "k"), ["k"], "n") for t, k in keys.items()]
    return rel.inner_join_many(parts, "k", makeunique=True)


@query("cross_join", "SELECT s_suppkey, n_nationkey FROM supplier CROSS JOIN nation")
def _(spark, d):
    return rel.cross_join(dataset(spark, d, "supplier").select("s_suppkey"), dataset(spark, d, "nation").select("n_nationkey"))


@query("vcat", """SELECT c_custkey AS key, c_acctbal AS bal, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier""")
def _(spark, d):
    c = dataset(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("bal"))
    s = dataset(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("bal"), F.lit("supplier").alias("kind"))
    return rel.vcat(c, s)


@query("hcat", """WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders),
b AS (SELECT o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, o_totalprice FROM a JOIN b USING (rn)""")
def _(spark, d):
    o = dataset(spark, d, "orders")
    out = rel.hcat(o.select("o_orderkey"), o.select("o_totalprice", F.col("o_orderkey").alias("tie")),
                   [("o_orderkey", False)], [("o_totalprice", False), ("tie", False)])
    return out.drop("tie")


# ---- summaries ----

@query("scalar_stats", "SELECT " + ", ".join(f"sig({f}) AS {n}" for n, f in {
    "mean": "avg(l_extendedprice)", "median": "quantile_cont(l_extendedprice, 0.5)", "max": "max(l_extendedprice)",
    "min": "min(l_extendedprice)", "std": "stddev_samp(l_extendedprice)"}.items()) + " FROM lineitem")
def _(spark, d):
    return rounded(agg.scalar_stats(dataset(spark, d, "lineitem"), "l_extendedprice"))


@query("geomean", "SELECT sig(exp(avg(ln(o_totalprice)) FILTER (WHERE o_totalprice > 0))) AS geomean FROM orders")
def _(spark, d):
    return rounded(dataset(spark, d, "orders").agg(agg.geomean("o_totalprice").alias("geomean")))


_LI_LONG = """long AS (SELECT l_returnflag, l_linestatus, e.variable, e.value FROM lineitem,
  LATERAL (VALUES ('l_quantity', l_quantity), ('l_extendedprice', l_extendedprice), ('l_discount', l_discount)) AS e(variable, value))"""
_LI = ["l_quantity", "l_extendedprice", "l_discount"]


@query("describe", f"""WITH {_LI_LONG} SELECT variable, sig(avg(value)) AS mean, sig(min(value)) AS min,
  sig(quantile_cont(value, 0.5)) AS median, sig(max(value)) AS max, count(*) - count(value) AS nmissing FROM long GROUP BY variable""")
def _(spark, d):
    return rounded(agg.describe(dataset(spark, d, "lineitem"), _LI))


@query("summary_stats", """SELECT count(o_totalprice) AS n, count(*) - count(o_totalprice) AS nmissing, sig(avg(o_totalprice)) AS mean,
  sig(min(o_totalprice)) AS min, sig(quantile_cont(o_totalprice, 0.25)) AS q25, sig(quantile_cont(o_totalprice, 0.5)) AS median,
  sig(quantile_cont(o_totalprice, 0.75)) AS q75, sig(max(o_totalprice)) AS max FROM orders""")
def _(spark, d):
    return rounded(agg.summary_stats(dataset(spark, d, "orders"), "o_totalprice"))


_BASIC = "sig(min(value)) AS min, sig(max(value)) AS max, sig(avg(value)) AS mean, sig(stddev_samp(value)) AS std"


@query("summarize", f"WITH {_LI_LONG} SELECT variable AS parameter, {_BASIC} FROM long GROUP BY variable")
def _(spark, d):
    return rounded(agg.summarize(dataset(spark, d, "lineitem"), _LI))


@query("summarize_by", f"WITH {_LI_LONG} SELECT l_returnflag, variable AS parameter, {_BASIC} FROM long GROUP BY l_returnflag, variable")
def _(spark, d):
    return rounded(agg.summarize(dataset(spark, d, "lineitem"), _LI, stratify_by=["l_returnflag"]))


@query("group_multi_agg", "SELECT l_suppkey, l_returnflag, " + ", ".join(
    f"sig({f}({c}{x})) AS {c}_{n}" for c in ("l_quantity", "l_tax")
    for n, f, x in (("mean", "avg", ""), ("std", "stddev_samp", ""), ("median", "quantile_cont", ", 0.5")))
    + " FROM lineitem GROUP BY l_suppkey, l_returnflag")
def _(spark, d):
    return rounded(agg.group_multi_agg(dataset(spark, d, "lineitem"), ["l_suppkey", "l_returnflag"],
                                       ["l_quantity", "l_tax"], ["mean", "std", "median"]))


@query("group_count", "SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders GROUP BY ALL")
def _(spark, d):
    return agg.group_count(dataset(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("stack", """SELECT l_orderkey, l_linenumber, e.variable, e.value FROM lineitem,
  LATERAL (VALUES ('l_quantity', l_quantity), ('l_discount', l_discount), ('l_tax', l_tax)) AS e(variable, value)""")
def _(spark, d):
    return agg.stack(dataset(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"], ["l_orderkey", "l_linenumber"])


_CATS = """cats AS (SELECT region, e.variable, e.value FROM covs,
  LATERAL (VALUES ('segment', segment), ('isPM', "isPM"), ('isfed', isfed)) AS e(variable, value))"""


@query("cat_summary", f"""WITH {COVS}, {_CATS} SELECT variable, value, count(*) AS count,
  sig(count(*) / sum(count(*)) OVER (PARTITION BY variable)) AS prop FROM cats GROUP BY variable, value""")
def _(spark, d):
    return rounded(agg.cat_summary(covs(spark, d), ["segment", "isPM", "isfed"]))


@query("cat_summary_by", f"""WITH {COVS}, {_CATS} SELECT region, variable, value, count(*) AS count,
  sig(count(*) / sum(count(*)) OVER (PARTITION BY region, variable)) AS prop FROM cats GROUP BY region, variable, value""")
def _(spark, d):
    return rounded(agg.cat_summary(covs(spark, d), ["segment", "isPM", "isfed"], ["region"]))


@query("extrema", "SELECT l_suppkey AS supplier, min(l_extendedprice) AS min, max(l_extendedprice) AS max FROM lineitem GROUP BY 1")
def _(spark, d):
    return agg.extrema(dataset(spark, d, "lineitem").withColumnRenamed("l_suppkey", "supplier"), "l_extendedprice", ["supplier"])


@query("group_share", """SELECT o_orderkey, o_custkey, sig(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey)) AS share FROM orders""")
def _(spark, d):
    o = dataset(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rounded(agg.group_share(o, ["o_custkey"], "o_totalprice", "share").drop("o_totalprice"))
