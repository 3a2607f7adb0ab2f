"""Crossover bioequivalence over many studies, and exploratory tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinetable.catalog.base import BE, COVS, PK, be_data, covs, dataset, hot_users, pk_events, query, rounded, rsel
from kinetable.catalog.profiles import box_rounded, box_sql
from kinetable.operators import be, eda
from kinetable.plans import skew

ENDPOINTS = ["AUC", "Cmax", "tmax"]
BY = ["study"]


def bound(spark, d, endpoints=ENDPOINTS):
    return be.be_input(be_data(spark, d), endpoints, by=BY)


def study_hot(spark, d):
    """None when even all orders together stay within the limit, else let the operator look."""
    return None if dataset(spark, d, "orders").count() <= skew.hot_rows(spark) else skew.LOOK


MOMENTS = f"""{BE},
one AS (SELECT study, endpoint, sequence, id, max(CASE WHEN period = 1 AND y > 0 THEN ln(y) END) AS l1,
  max(CASE WHEN period = 2 AND y > 0 THEN ln(y) END) AS l2 FROM be GROUP BY ALL),
con AS (SELECT *, l1 - l2 AS d, (l1 + l2) / 2 AS m FROM one WHERE l1 IS NOT NULL AND l2 IS NOT NULL),
rt AS (SELECT study, endpoint, count(*) AS n, avg(d) AS d, var_samp(d) AS vd, avg(m) AS m, var_samp(m) AS vm, avg(l1) AS l1, avg(l2) AS l2
  FROM con WHERE sequence = 'RT' GROUP BY ALL),
tr AS (SELECT study, endpoint, count(*) AS n, avg(d) AS d, var_samp(d) AS vd, avg(m) AS m, var_samp(m) AS vm, avg(l1) AS l1, avg(l2) AS l2
  FROM con WHERE sequence = 'TR' GROUP BY ALL),
mom AS (SELECT coalesce(rt.study, tr.study) AS study, coalesce(rt.endpoint, tr.endpoint) AS endpoint, rt.n + tr.n - 2 AS df,
  (tr.d - rt.d) / 2 AS pe, (tr.d + rt.d) / 2 AS period, tr.m - rt.m AS sequence, rt.l1 AS rt1, rt.l2 AS rt2, tr.l1 AS tr1, tr.l2 AS tr2,
  CASE WHEN rt.n + tr.n > 2 THEN sqrt(((rt.n-1)*coalesce(rt.vd,0) + (tr.n-1)*coalesce(tr.vd,0)) / greatest(rt.n+tr.n-2, 1) * (1.0/rt.n + 1.0/tr.n)) / 2 END AS se,
  CASE WHEN rt.n + tr.n > 2 THEN sqrt(((rt.n-1)*coalesce(rt.vm,0) + (tr.n-1)*coalesce(tr.vm,0)) / greatest(rt.n+tr.n-2, 1) * (1.0/rt.n + 1.0/tr.n)) END AS sem
  FROM rt FULL JOIN tr ON rt.study = tr.study AND rt.endpoint = tr.endpoint),
coef AS (SELECT study, endpoint, e.term, e.estimate, e.se, df FROM mom,
  LATERAL (VALUES ('formulation', pe, se), ('period', period, se), ('sequence', sequence, sem)) AS e(term, estimate, se))"""

# the series coefficients by gamma functions: independent of the product form used on the other side
P_SQL = """CASE WHEN df % 2 = 0 THEN 1 - sin_ * list_sum([exp(lgamma(j + 0.5) - lgamma(j + 1) - 0.5 * ln(pi())) * pow(cos2, j)
    FOR j IN range(0, CAST(df / 2 AS BIGINT))])
  ELSE 1 - 2 / pi() * (theta + CASE WHEN df > 1 THEN sin_ * list_sum([exp(lgamma(j + 1) + 0.5 * ln(pi()) - lgamma(j + 1.5)) / 2 * pow(cos2, j + 0.5)
    FOR j IN range(0, CAST((df - 1) / 2 AS BIGINT))]) ELSE 0 END) END"""


# the quantile by halving: independent of the Newton steps on the other side
RESULT = f"""{MOMENTS},
half AS (SELECT df, 0.0::DOUBLE AS lo, 8.0::DOUBLE AS hi, 0 AS k FROM (SELECT DISTINCT df FROM mom WHERE df > 0)
  UNION ALL SELECT df, CASE WHEN p > 0.1 THEN tv ELSE lo END, CASE WHEN p > 0.1 THEN hi ELSE tv END, k + 1
  FROM (SELECT *, {P_SQL} AS p FROM (SELECT *, atan(tv / sqrt(df)) AS theta, df / (df + tv * tv) AS cos2, tv / sqrt(df + tv * tv) AS sin_
    FROM (SELECT *, (lo + hi) / 2 AS tv FROM half WHERE k < 55)))),
tq AS (SELECT mom.*, hi AS q FROM mom LEFT JOIN (SELECT df, hi FROM half WHERE k = 55) USING (df)),
res AS (SELECT study, endpoint, pe, se, df, pe - q * se AS lnlb, pe + q * se AS lnub, exp(pe) AS gmr, exp(pe - q * se) AS lb,
  exp(pe + q * se) AS ub FROM tq)"""

@query("be_input", f"WITH {BE} SELECT study, id, sequence, period, formulation, endpoint, sig(y) AS y FROM be")
def _(spark, d):
    return rounded(bound(spark, d))


@query("be_design", f"""WITH {BE} SELECT study, endpoint, sequence, CAST(max(period) AS BIGINT) AS periods, count(DISTINCT id) AS subjects
FROM be GROUP BY study, endpoint, sequence""")
def _(spark, d):
    return be.be_design(bound(spark, d), BY)


def _stats(name: str, factor: str) -> None:
    @query(name, f"""WITH {BE} SELECT study, endpoint, {factor}, count(y) AS n, sig(avg(y)) AS mean, sig(stddev_samp(y)) AS std,
  sig(min(y)) AS min, sig(quantile_cont(y, 0.5)) AS median, sig(max(y)) AS max, sig(exp(avg(ln(y)) FILTER (WHERE y > 0))) AS geomean
  FROM be GROUP BY study, endpoint, {factor}""")
    def run(spark, d):
        return rounded(be.be_stats(bound(spark, d), factor, BY, study_hot(spark, d)))


_stats("be_stats_formulation", "formulation")
_stats("be_stats_sequence", "sequence")
_stats("be_stats_period", "period")


@query("be_model", f"WITH {MOMENTS} SELECT study, endpoint, term, sig(estimate) AS estimate, sig(se) AS se, df FROM coef")
def _(spark, d):
    return rounded(be.be_model(bound(spark, d), BY))


@query("be_wald", f"""WITH {MOMENTS}, w AS (SELECT *, abs(estimate / nullif(se, 0)) AS tv FROM coef),
g AS (SELECT *, atan(tv / sqrt(df)) AS theta, df / (df + tv * tv) AS cos2, tv / sqrt(df + tv * tv) AS sin_ FROM w)
SELECT study, endpoint, term, sig(tv * tv) AS f, CAST(1 AS BIGINT) AS df1, df AS df2, sig({P_SQL}) AS p FROM g""")
def _(spark, d):
    return rounded(be.be_wald(bound(spark, d), BY))


@query("be_lsmeans", f"""WITH {MOMENTS} SELECT study, endpoint, e.formulation, sig(e.lsmean) AS lsmean FROM mom,
  LATERAL (VALUES ('R', exp((rt1 + tr2) / 2)), ('T', exp((rt2 + tr1) / 2))) AS e(formulation, lsmean)""")
def _(spark, d):
    return rounded(be.be_lsmeans(bound(spark, d), BY))


@query("be_result", f"WITH RECURSIVE {RESULT} " + rsel("study, endpoint, df", "pe, se, lnlb, lnub, gmr, lb, ub", "res"))
def _(spark, d):
    return rounded(be.be_result(bound(spark, d), BY))


@query("be_decision", f"""WITH RECURSIVE {RESULT} SELECT study, endpoint, e.criteria, (lb >= e.lo AND ub <= e.hi) AS pass FROM res,
  LATERAL (VALUES ('80-125', 0.80::DOUBLE, 1.25::DOUBLE), ('90-110', 0.90::DOUBLE, 1.10::DOUBLE)) AS e(criteria, lo, hi)""")
def _(spark, d):
    return be.be_decision(bound(spark, d), BY)


# Differences by rank. The rank k of the limits: for up to 60 subjects by counting how many sets of m ranks have each sum, rank by
# rank; beyond that from the quantile of the normal distribution with its kurtosis term.
NONPAR = """raw AS (SELECT study, endpoint, sequence, id, max(CASE WHEN period = 1 THEN y END) - max(CASE WHEN period = 2 THEN y END) AS dy
  FROM be GROUP BY ALL),
cnt AS (SELECT study, endpoint, count(dy) FILTER (sequence = 'TR') AS m, count(dy) FILTER (sequence = 'RT') AS n FROM raw GROUP BY ALL),
size AS (SELECT DISTINCT least(m, n) AS m, greatest(m, n) AS n FROM cnt WHERE m > 0 AND n > 0),
ways AS (SELECT m, n, 0 AS r, 0 AS j, 0 AS s, 1.0::DOUBLE AS w FROM size WHERE m + n <= 60
  UNION ALL SELECT m, n, r + 1, j2, s2, sum(w) FROM (SELECT m, n, r, j + t AS j2, s + t * (r + 1) AS s2, w FROM ways, (VALUES (0), (1)) AS v(t) WHERE r < m + n AND j + t <= m)
  GROUP BY m, n, r, j2, s2),
cum AS (SELECT m, n, s, sum(w) OVER (PARTITION BY m, n ORDER BY s) AS upto, sum(w) OVER (PARTITION BY m, n) AS total FROM ways WHERE r = m + n AND j = m),
ranks AS (SELECT m, n, greatest(1, count(*) FILTER (upto / total <= 0.05)) AS k FROM cum GROUP BY m, n
  UNION ALL SELECT m, n, CAST(floor(m * n / 2 + sqrt(m * n * (m + n + 1) / 12) * (z + g * (pow(z, 3) - 3 * z) / 24) - 0.5) AS BIGINT) + 1
  FROM (SELECT *, -1.6448536269514722 AS z, -1.2 * (m * m + n * n + m * n + m + n) / (m * n * (m + n + 1)) AS g FROM size WHERE m + n > 60)),
pairs AS (SELECT a.study, a.endpoint, (a.dy - b.dy) / 2 AS x FROM raw a JOIN raw b ON a.study = b.study AND a.endpoint = b.endpoint
  WHERE a.sequence = 'TR' AND b.sequence = 'RT' AND a.dy IS NOT NULL AND b.dy IS NOT NULL),
sorted AS (SELECT study, endpoint, median(x) AS pe, list_sort(list(x)) AS xs FROM pairs GROUP BY ALL),
hl AS (SELECT study, endpoint, pe, xs[k] AS lb, xs[c.m * c.n + 1 - k] AS ub FROM sorted JOIN cnt c USING (study, endpoint)
  JOIN ranks r ON r.m = least(c.m, c.n) AND r.n = greatest(c.m, c.n))"""


@query("be_nonpar", f"""WITH RECURSIVE {BE}, {NONPAR}, k AS (SELECT DISTINCT study, endpoint FROM raw)
SELECT study, endpoint, sig(pe) AS pe, sig(lb) AS lb, sig(ub) AS ub FROM k LEFT JOIN hl USING (study, endpoint)""")
def _(spark, d):
    return rounded(be.be_nonpar(bound(spark, d), BY, hot=study_hot(spark, d)).drop("level"))


@query("be_endpoints", f"""WITH RECURSIVE {RESULT}, {NONPAR}, k AS (SELECT DISTINCT study, endpoint FROM raw WHERE endpoint = 'tmax')
SELECT study, endpoint, 'lm' AS method, sig(pe) AS pe, sig(lnlb) AS lnlb, sig(lnub) AS lnub FROM res WHERE endpoint <> 'tmax'
UNION ALL SELECT study, endpoint, 'nonpar', sig(pe), sig(lb), sig(ub) FROM k LEFT JOIN hl USING (study, endpoint)""")
def _(spark, d):
    return rounded(be.be_endpoints(bound(spark, d), BY, study_hot(spark, d)))


# ---- exploratory tables ----

@query("box_stats", box_rounded(box_sql("l_returnflag, l_linestatus", "l_extendedprice", "lineitem"), "l_returnflag, l_linestatus"))
def _(spark, d):
    return rounded(eda.box_stats(dataset(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice"))


def _hist_sql(facet: str, frm: str, value: str, bins: int) -> str:
    f = f"{facet}, " if facet else ""
    return f"""WITH r AS (SELECT min({value}) AS lo, (max({value}) - min({value})) / {bins} AS w FROM {frm}),
b AS (SELECT {f}CAST(least(floor(({value} - lo) / w), {bins - 1}) AS BIGINT) AS bin, lo, w FROM {frm}, r)
SELECT {f}bin, sig(min(lo + bin * w)) AS bin_start, count(*) AS count FROM b GROUP BY {f}bin"""


@query("histogram", _hist_sql("l_returnflag", "lineitem", "l_extendedprice", 9))
def _(spark, d):
    return rounded(eda.histogram(dataset(spark, d, "lineitem"), "l_extendedprice", 9, ["l_returnflag"]))


@query("density", """WITH s AS (SELECT o_orderstatus, count(o_totalprice) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi,
  0.9 * least(stddev_samp(o_totalprice), (quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25)) / 1.34)
    * pow(count(o_totalprice), -0.2) AS h FROM orders GROUP BY 1),
g AS (SELECT s.*, CAST(p AS INTEGER) AS point, lo + (hi - lo) * p / 31 AS x FROM s, range(0, 32) r(p))
SELECT g.o_orderstatus, point, sig(min(x)) AS x, sig(1e6 * sum(exp(-pow((o_totalprice - x) / h, 2) / 2)) / (min(h) * min(n) * sqrt(2 * pi()))) AS density
FROM g JOIN orders o ON o.o_orderstatus = g.o_orderstatus GROUP BY g.o_orderstatus, point""")
def _(spark, d):
    out = eda.density(dataset(spark, d, "orders"), ["o_orderstatus"], "o_totalprice", 32)
    return rounded(out.withColumn("density", F.col("density") * 1e6))  # per million, against the rounding


@query("covariates_check", """WITH f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders),
long AS (SELECT e.variable, e.value FROM f, LATERAL (VALUES ('o_totalprice', o_totalprice), ('o_orderkey', CAST(o_orderkey AS DOUBLE))) AS e(variable, value) WHERE rn = 1)
SELECT variable, count(value) AS n, sig(avg(value)) AS mean, sig(min(value)) AS min, sig(quantile_cont(value, 0.5)) AS median,
  sig(max(value)) AS max FROM long GROUP BY variable""")
def _(spark, d):
    o = dataset(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return rounded(eda.covariates_check(o, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_totalprice", "o_orderkey"]))


@query("pair_corr", """SELECT e.x, e.y, sig(e.r) AS r FROM (SELECT corr(l_quantity, l_extendedprice) AS a, corr(l_quantity, l_discount) AS b,
  corr(l_extendedprice, l_discount) AS c FROM lineitem),
  LATERAL (VALUES ('l_quantity', 'l_extendedprice', a), ('l_quantity', 'l_discount', b), ('l_extendedprice', 'l_discount', c)) AS e(x, y, r)""")
def _(spark, d):
    return rounded(eda.pair_corr(dataset(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]))


@query("collinearity", f"""WITH {COVS}, long AS (SELECT e.covariate, e.level, wt FROM covs,
  LATERAL (VALUES ('isPM', CASE WHEN "isPM" = 'yes' THEN 1 ELSE 0 END), ('isfed', CASE WHEN isfed = 'yes' THEN 1 ELSE 0 END)) AS e(covariate, level)) """
       + box_rounded(box_sql("covariate, level", "wt", "long"), "covariate, level"))
def _(spark, d):
    return rounded(eda.collinearity(covs(spark, d), ["isPM", "isfed"], "wt"))
