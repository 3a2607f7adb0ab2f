"""Sequence and profile-analysis queries on the event stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinetable.catalog.base import (
    PK, PROFILE, covs, dataset, hot_users, pk_events, query, raw_events, records, rounded, rsel,
)
from kinetable.operators import agg, eda, nca, rel, rows, sequence
from kinetable.plans import skew
from kinetable.session import cut_lineage


def nca_sql(method: str = "linuplogdown", llq: float | None = None, max_points: int | None = None,
            intervals=(), route: str = "ev", tau: float | None = None, dur: float | None = None,
            base: str = "prof") -> str:
    """WITH items ending in ``rep``: one row of parameters per profile."""
    logs = {"linear": "false", "linuplogdown": "c2 > 0 AND c2 < c1 AND t2 > t1",
            "linlog": "c2 > 0 AND c2 < c1 AND t2 > t1 AND t1 >= tmax"}[method]
    if llq is None:
        p0 = f"p0 AS (SELECT * FROM {base})"
    else:
        p0 = f"""pq AS (SELECT *, min(CASE WHEN c >= {llq} THEN t END) OVER (PARTITION BY user_id, occ) AS fq FROM {base}),
p0 AS (SELECT user_id, occ, t, CASE WHEN c >= {llq} THEN c ELSE 0.0 END AS c FROM pq WHERE c >= {llq} OR t < fq)"""
    frm = "0.0" if route == "iv" and not dur else "tmax"
    cap = f"AND n <= {max_points}" if max_points else ""
    shift = f"{(dur or 0.0) / 2}" if route == "inf" else "0.0"
    spans = [(nca.interval_name(a, b), a, b) for a, b in intervals] + ([("auctau", 0.0, tau)] if tau else [])
    clips = "".join(f""",
    sum(CASE WHEN greatest(t1, {a}) < least(t2, {b}) THEN CASE WHEN lg
      THEN (least(t2,{b}) - greatest(t1,{a})) * (c1*exp(ln(c2/c1)*(greatest(t1,{a})-t1)/(t2-t1)) - c1*exp(ln(c2/c1)*(least(t2,{b})-t1)/(t2-t1)))
           / (ln(c1/c2)*(least(t2,{b}) - greatest(t1,{a}))/(t2-t1))
      ELSE (least(t2,{b}) - greatest(t1,{a})) * (2*c1 + (c2-c1)*((greatest(t1,{a})-t1) + (least(t2,{b})-t1))/(t2-t1)) / 2 END END) AS {n}_in"""
                    for n, a, b in spans)
    ext = "".join(f""",
    CASE WHEN lambdaz IS NOT NULL AND {b} > greatest({a}, tlast)
      THEN coalesce({n}_in, 0) + clast * (exp(-lambdaz*(greatest({a}, tlast) - tlast)) - exp(-lambdaz*({b} - tlast))) / lambdaz
      ELSE {n}_in END AS {n}""" for n, a, b in spans)
    return f"""{p0},
land AS (SELECT user_id, occ, count(*) AS n_obs, max(c) AS cmax, max(CASE WHEN c > 0 THEN t END) AS tlast, min(t) AS tfirst
  FROM p0 GROUP BY user_id, occ),
mark AS (SELECT l.*, (SELECT min(t) FROM p0 p WHERE p.user_id = l.user_id AND p.occ = l.occ AND p.c = l.cmax) AS tmax,
  (SELECT max(c) FROM p0 p WHERE p.user_id = l.user_id AND p.occ = l.occ AND p.t = l.tlast) AS clast FROM land l),
seg0 AS (SELECT p.user_id, p.occ, t AS t1, c AS c1, lead(t) OVER w AS t2, lead(c) OVER w AS c2, tmax, tlast, tfirst
  FROM p0 p JOIN mark m ON p.user_id = m.user_id AND p.occ = m.occ
  WINDOW w AS (PARTITION BY p.user_id, p.occ ORDER BY t)),
seg AS (SELECT *, ({logs}) AS lg, t2 - t1 AS hh, ln(c1 / nullif(c2, 0)) AS lr FROM seg0 WHERE t2 <= tlast),
area AS (SELECT user_id, occ, sum(CASE WHEN lg THEN hh*(c1-c2)/lr ELSE hh*(c1+c2)/2 END) AS auclast,
    sum(CASE WHEN lg THEN (t1*c1-t2*c2)*hh/lr + (c1-c2)*hh*hh/(lr*lr) ELSE hh*(t1*c1+t2*c2)/2 END) AS aumclast{clips}
  FROM seg GROUP BY user_id, occ),
start AS (SELECT user_id, occ, CASE WHEN c2 > 0 AND c2 < c1 AND t2 > t1 THEN exp(ln(c1) - t1*(ln(c2)-ln(c1))/(t2-t1)) ELSE c1 END AS c0
  FROM seg0 WHERE t1 = tfirst),
tail AS (SELECT p.user_id, p.occ, p.t, count(*) OVER w AS n, regr_slope(ln(c), t) OVER w AS b, regr_r2(ln(c), t) OVER w AS r2,
    regr_intercept(ln(c), t) OVER w AS a
  FROM p0 p JOIN mark m ON p.user_id = m.user_id AND p.occ = m.occ WHERE c > 0 AND t > {frm}
  WINDOW w AS (PARTITION BY p.user_id, p.occ ORDER BY t DESC ROWS UNBOUNDED PRECEDING)),
adj AS (SELECT *, 1 - (1 - r2) * (n - 1) / (n - 2) AS ar FROM tail WHERE n >= 3 AND b < 0 {cap}),
best AS (SELECT *, max(ar) OVER (PARTITION BY user_id, occ) AS top FROM adj),
lz AS (SELECT user_id, occ, -b AS lambdaz, n AS n_lambdaz, ar AS adj_r2, t AS lambdaz_from, a AS lambdaz_intercept
  FROM best WHERE ar >= top - 1e-4 QUALIFY row_number() OVER (PARTITION BY user_id, occ ORDER BY n DESC) = 1),
wide AS (SELECT d.user_id, d.occ, coalesce(n_obs, 0) AS n_obs, d.dose, cmax, tmax, tlast, clast, c0, area.* EXCLUDE (user_id, occ),
    lz.* EXCLUDE (user_id, occ) FROM dose d
  LEFT JOIN mark m ON d.user_id = m.user_id AND d.occ = m.occ LEFT JOIN area ON d.user_id = area.user_id AND d.occ = area.occ
  LEFT JOIN lz ON d.user_id = lz.user_id AND d.occ = lz.occ LEFT JOIN start s ON d.user_id = s.user_id AND d.occ = s.occ),
inf AS (SELECT *, ln(2.0) / lambdaz AS half_life, auclast + clast / lambdaz AS aucinf_obs,
    aumclast + clast * tlast / lambdaz + clast / (lambdaz * lambdaz) AS aumcinf_obs{ext} FROM wide),
rep AS (SELECT *, aumclast / nullif(auclast, 0) - {shift} AS mrtlast, aumcinf_obs / nullif(aucinf_obs, 0) - {shift} AS mrtinf_obs,
    dose / nullif(aucinf_obs, 0) AS cl, dose / nullif(lambdaz * aucinf_obs, 0) AS vz, cmax / nullif(dose, 0) AS cmax_dose,
    auclast / nullif(dose, 0) AS auc_dose FROM inf)"""


def report(spark, d, **kw):
    """The report of every profile of the event stream."""
    hot = hot_users(spark, d)
    shape = {k: kw.pop(k) for k in ("route", "tau", "dur") if k in kw}
    return nca.nca_report(records(spark, d, hot, **shape), PROFILE, hot=hot, **kw)


def _register(name: str, ints: str, doubles: str, sql_extra: str | None = None, **kw) -> None:
    """A query that is a projection of the report."""
    cols = [c.strip() for c in f"{ints},{doubles}".split(",") if c.strip()]
    frm = f"({sql_extra})" if sql_extra else "rep"

    @query(name, f"WITH {PK}, {nca_sql(**kw)} " + rsel("user_id, occ, " + ints, doubles, frm))
    def run(spark, d):
        return rounded(report(spark, d, **kw).select(*PROFILE, *cols))


# ---- along the subject's records ----

@query("occasion", f"WITH {PK} SELECT event_id, user_id, evid, occ FROM ev")
def _(spark, d):
    ev = sequence.occasion(raw_events(spark, d), "user_id", "us", "evid", ["event_id"], hot_users(spark, d))
    return ev.select("event_id", "user_id", "evid", "occ")


@query("time_after_dose", f"WITH {PK} SELECT event_id, user_id, sig(t) AS tad FROM ev")
def _(spark, d):
    ev = sequence.time_after_dose(raw_events(spark, d), "user_id", "us", "evid", ["event_id"], hot_users(spark, d))
    return rounded(ev.select("event_id", "user_id", (F.col("tad") / F.lit(3.6e9)).alias("tad")))


# ---- profile parameters ----

@query("nca_profiles", f"""WITH {PK} SELECT user_id, occ, sig(t) AS t, dv AS c, amt,
  CASE WHEN evid = 1 THEN 'ev' END AS route FROM ev WHERE occ > 0""")
def _(spark, d):
    hot = hot_users(spark, d)
    ev = pk_events(spark, d, hot).filter("occ > 0").withColumn("route", F.lit("ev"))
    roles = nca.Roles(id="user_id", time="h", observations="dv", amt="amt", route="route", group=("occ",))
    return rounded(nca.nca_profiles(ev, roles, hot).drop("tau", "dur"), raw=["c", "amt"])


@query("nca_llq", f"""WITH {PK}, pq AS (SELECT *, min(CASE WHEN c >= 20 THEN t END) OVER (PARTITION BY user_id, occ) AS fq FROM prof)
SELECT user_id, occ, sig(t) AS t, CASE WHEN c >= 20 THEN c WHEN t < fq THEN 0.0 END AS c FROM pq""")
def _(spark, d):
    hot = hot_users(spark, d)
    obs = records(spark, d, hot).filter("amt is null").select(*PROFILE, "t", "c")
    return rounded(nca.blq(obs, PROFILE, 20.0, hot), raw=["c"])


_register("nca_report_llq", "n_obs", "cmax, tmax, auclast, lambdaz", llq=20.0)
_register("nca_cmax", "", "cmax")
_register("nca_tmax", "", "tmax")
_register("nca_last", "", "tlast, clast")
_register("nca_dose_norm", "", "cmax_dose, auc_dose")
_register("nca_lambdaz", "n_lambdaz", "lambdaz, adj_r2")
_register("nca_lambdaz_k", "n_lambdaz", "lambdaz", max_points=3)
_register("nca_half_life", "", "half_life")
_register("nca_auclast_linear", "", "auclast", method="linear")
_register("nca_auclast_linuplogdown", "", "auclast")
_register("nca_auclast_linlog", "", "auclast", method="linlog")
_register("nca_aucinf", "", "aucinf_obs")
_register("nca_aumc", "", "aumclast, aumcinf_obs")
_register("nca_mrt", "", "mrtlast, mrtinf_obs")
_register("nca_partial_auc", "", "auc_0_12", intervals=[(0, 12)])
_register("nca_partial_auc_multi", "", "auc_0_12, auc_12_24, auc_24_96", intervals=[(0, 12), (12, 24), (24, 96)])
# four intervals for everybody and two that differ by user
_OWN = "(CAST(user_id % 7 AS DOUBLE), CAST(user_id % 7 + 5 + user_id % 11 AS DOUBLE)), (CAST(user_id % 50 AS DOUBLE), 1000.0::DOUBLE)"
_CUT = "(least(t2, iv.b) - greatest(t1, iv.a))"


@query("nca_intervals", f"""WITH {PK}, {nca_sql()},
iv AS (SELECT DISTINCT user_id, v.a, v.b FROM events, LATERAL (VALUES (0.0::DOUBLE, 12.0::DOUBLE), (12.0, 24.0), (24.0, 96.0), (3.0, 3.5), {_OWN}) AS v(a, b)),
part AS (SELECT iv.*, s.occ, sum(CASE WHEN lg THEN {_CUT} * (c1*exp(ln(c2/c1)*(greatest(t1,iv.a)-t1)/hh) - c1*exp(ln(c2/c1)*(least(t2,iv.b)-t1)/hh)) / (lr*{_CUT}/hh)
    ELSE {_CUT} * (2*c1 + (c2-c1)*((greatest(t1,iv.a)-t1) + (least(t2,iv.b)-t1))/hh) / 2 END) AS x
  FROM iv JOIN seg s ON s.user_id = iv.user_id AND greatest(t1, iv.a) < least(t2, iv.b) GROUP BY ALL),
every AS (SELECT r.user_id, r.occ, iv.a, iv.b, x, CASE WHEN lambdaz IS NOT NULL AND iv.b > greatest(iv.a, tlast)
    THEN clast * (exp(-lambdaz*(greatest(iv.a, tlast) - tlast)) - exp(-lambdaz*(iv.b - tlast))) / lambdaz END AS tail
  FROM rep r JOIN iv ON iv.user_id = r.user_id LEFT JOIN part p ON p.user_id = r.user_id AND p.occ = r.occ AND p.a = iv.a AND p.b = iv.b)
SELECT user_id, occ, a, b, sig(coalesce(x + tail, x, tail)) AS auc FROM every""")
def _(spark, d):
    """Partial areas over a table of intervals by user."""
    u = F.col("user_id")
    spans = [(F.lit(0.0), F.lit(12.0)), (F.lit(12.0), F.lit(24.0)), (F.lit(24.0), F.lit(96.0)), (F.lit(3.0), F.lit(3.5)),
             (u % 7, u % 7 + 5 + u % 11), (u % 50, F.lit(1000.0))]
    table = dataset(spark, d, "events").select("user_id").distinct().select(
        "user_id", F.explode(F.array(*[F.struct(a.cast("double").alias("a"), b.cast("double").alias("b")) for a, b in spans])).alias("s")).select("user_id", "s.*")
    # interval ends count as rows of a user
    hot = None if dataset(spark, d, "events").count() <= skew.hot_rows(spark) // 13 else skew.LOOK
    return rounded(nca.nca_partial_areas(records(spark, d, hot_users(spark, d)), table, PROFILE, hot=hot), raw=["a", "b"])


_register("nca_cl", "", "cl_obs", "SELECT *, cl AS cl_obs FROM rep", route="iv")
_register("nca_vz", "", "vz_obs", "SELECT *, vz AS vz_obs FROM rep", route="iv")
_register("nca_cl_vz_f", "route", "cl_f_obs, vz_f_obs, cl_obs, vz_obs",
          "SELECT *, 'ev' AS route, cl AS cl_f_obs, vz AS vz_f_obs, CAST(NULL AS DOUBLE) AS cl_obs, CAST(NULL AS DOUBLE) AS vz_obs FROM rep")
_register("nca_kel", "", "kel", "SELECT *, cl / nullif(vz, 0) AS kel FROM rep")
_register("nca_steady_state", "", "tau, auctau, cl_ss",
          "SELECT *, 24.0::DOUBLE AS tau, dose / nullif(auctau, 0) AS cl_ss FROM rep", tau=24.0)


@query("nca_multi_dose", f"""WITH {PK}, {nca_sql(tau=24.0, llq=0.001)}
SELECT user_id, occ AS dose_no, CASE WHEN occ >= 2 THEN 1 ELSE 0 END AS ss, sig(cmax) AS cmax, sig(auclast) AS auclast, sig(auctau) AS auctau,
  sig(dose / nullif(CASE WHEN occ >= 2 THEN auctau ELSE aucinf_obs END, 0)) AS cl FROM rep""")
def _(spark, d):
    """Every dose of a subject is a profile; from the second on they count as given at steady state."""
    hot = hot_users(spark, d)
    ev = pk_events(spark, d, hot).withColumns({"ss": F.when(F.col("occ") >= 2, 1), "ii": F.lit(24.0), "route": F.lit("ev")}).drop("occ")
    roles = nca.Roles(id="user_id", time="h", observations="dv", amt="amt", route="route", ii="ii", ss="ss")
    out = nca.nca_report(nca.nca_doses(ev, roles, 0.001, hot), ["user_id", "dose_no", "ss"], hot=hot)
    return rounded(nca.dose_clearance(out).select("user_id", "dose_no", "ss", "cmax", "auclast", "auctau", "cl"))


_register("nca_infusion_mrt", "", "dur, mrtlast, mrtinf_obs", "SELECT *, 2.0::DOUBLE AS dur FROM rep", route="inf", dur=2.0)


@query("nca_c0", f"WITH {PK}, {nca_sql(route='iv')} SELECT user_id, occ, sig(ln(c0)) AS ln_c0 FROM rep")
def _(spark, d):  # on the log scale: back-extrapolating noise spans forty decades
    return rounded(report(spark, d, route="iv").select(*PROFILE, F.ln("c0").alias("ln_c0")))


REPORT_INTS = "n_obs, n_lambdaz"
REPORT_DOUBLES = ("dose, cmax, tmax, tlast, clast, auclast, aumclast, lambdaz, adj_r2, half_life, aucinf_obs, "
                  "aumcinf_obs, mrtlast, mrtinf_obs, cmax_dose, auc_dose, cl_f_obs, vz_f_obs, kel")
_register("nca_report", REPORT_INTS, REPORT_DOUBLES,
          "SELECT *, cl AS cl_f_obs, vz AS vz_f_obs, cl / nullif(vz, 0) AS kel FROM rep")

PARAMS = ["tmax", "cmax", "auclast", "mrtlast"]  # summarized parameters, all bounded in size


def summary_hot(spark, d):
    """None when even all dose records together stay within the limit, else let the operator look."""
    doses = dataset(spark, d, "events").filter("event_type = 'signup'").count()
    return None if doses <= skew.hot_rows(spark) else skew.LOOK


def _long(params) -> str:
    return ("long AS (SELECT user_id, occ, e.parameter, e.value FROM rep, LATERAL (VALUES "
            + ", ".join(f"('{p}', {p})" for p in params) + ") AS e(parameter, value))")


STATS_SQL = """sig(min(value)) AS min, sig(max(value)) AS max, sig(avg(value)) AS mean,
  sig(stddev_samp(value)) AS std, sig(quantile_cont(value, 0.5)) AS median"""
SUMMARY = ["extrema", "mean", "std", "median"]


@query("nca_summary", f"WITH {PK}, {nca_sql()}, {_long(PARAMS)} SELECT parameter, {STATS_SQL} FROM long GROUP BY parameter")
def _(spark, d):
    return rounded(agg.summarize(report(spark, d), PARAMS, SUMMARY, hot=summary_hot(spark, d)))


@query("nca_summary_by", f"""WITH {PK}, {nca_sql()}, {_long(PARAMS)}
SELECT occ, parameter, {STATS_SQL} FROM long GROUP BY occ, parameter""")
def _(spark, d):
    return rounded(agg.summarize(report(spark, d), PARAMS, SUMMARY, ["occ"], hot=summary_hot(spark, d)))


@query("nca_by_occasion", f"WITH {PK}, {nca_sql()} " + rsel("user_id, occ, n_obs", "cmax, tmax, auclast", "rep ORDER BY user_id, occ"))
def _(spark, d):
    hot = hot_users(spark, d)
    ev = sequence.occasion(raw_events(spark, d), "user_id", "us", "evid", ["event_id"], hot).filter(
        (F.col("occ") > 0) & ((F.col("evid") == 1) | (F.col("dv") > 0.001)))
    ev = ev.withColumns({"hours": F.col("us") / F.lit(3.6e9), "route": F.lit("ev")})
    bound = nca.nca_profiles(ev, nca.Roles("user_id", "hours", "dv", group=("occ",)), hot)
    out = nca.nca_report(bound, PROFILE, hot=hot).select(*PROFILE, "n_obs", "cmax", "tmax", "auclast")
    return rows.order_by(rounded(out), ("user_id", False), ("occ", False))


@query("nca_param_join", f"WITH {PK}, {nca_sql()} " + rsel(
    "user_id, occ", "vz, cl, lambdaz, half_life, cmax_dose", "rep WHERE lambdaz IS NOT NULL"))
def _(spark, d):
    r = report(spark, d).filter("lambdaz is not null").withColumnsRenamed({"vz_f_obs": "vz", "cl_f_obs": "cl"})
    r = cut_lineage(r.select(*PROFILE, "vz", "cl", "lambdaz", "half_life", "cmax_dose"))  # five tables read it
    singles = [r.select(*PROFILE, c) for c in ("vz", "cl", "lambdaz", "half_life", "cmax_dose")]
    return rounded(rel.inner_join_many(singles, PROFILE, makeunique=True))


@query("mean_profile", f"""WITH {PK} SELECT occ, nominal, count(c) AS n, sig(avg(c)) AS mean,
  sig(stddev_samp(c)) AS sd FROM (SELECT occ, floor(t / 12) * 12 AS nominal, c FROM prof) GROUP BY occ, nominal""")
def _(spark, d):
    obs = records(spark, d, hot_users(spark, d)).filter("amt is null").withColumn(
        "nominal", (F.floor(F.col("t") / 12) * 12).cast("double"))
    return rounded(nca.mean_profile(obs, ["occ"], "nominal", "c"))


@query("profile_series", f"""WITH {PK}, s AS (SELECT user_id, CAST(ceil(row_number() OVER (ORDER BY user_id) / 9.0) AS BIGINT) AS page
  FROM (SELECT DISTINCT user_id FROM events))
SELECT page, user_id, occ, sig(t) AS t, c, sig(ln(c)) AS ln_c FROM prof JOIN s USING (user_id)""")
def _(spark, d):
    users = dataset(spark, d, "events").select("user_id").distinct()
    pages = rows.page_groups(users, "user_id", 9)
    obs = records(spark, d, hot_users(spark, d)).filter("amt is null")
    return rounded(obs.join(pages, "user_id").select("page", *PROFILE, "t", "c", F.ln("c").alias("ln_c")), raw=["c"])


@query("terminal_fit_series", f"""WITH {PK}, {nca_sql()} SELECT p.user_id, p.occ, sig(p.t) AS t, p.c,
  sig(exp(lambdaz_intercept - lambdaz * p.t)) AS fitted
  FROM prof p JOIN rep r ON p.user_id = r.user_id AND p.occ = r.occ WHERE p.t BETWEEN lambdaz_from AND tlast""")
def _(spark, d):
    hot = hot_users(spark, d)
    recs = records(spark, d, hot)
    return rounded(nca.terminal_fit(recs, nca.nca_report(recs, PROFILE, hot=hot), PROFILE), raw=["c"])


@query("dose_proportionality", f"""WITH {PK}, {nca_sql()}, {_long(["cmax", "auclast"])}
SELECT parameter, sig(regr_slope(value, dose)) AS slope, sig(regr_intercept(value, dose)) AS intercept,
  sig(regr_r2(value, dose)) AS r2, CAST(regr_count(value, dose) AS BIGINT) AS n
  FROM long JOIN rep USING (user_id, occ) GROUP BY parameter""")
def _(spark, d):
    long = report(spark, d).unpivot(["dose"], ["cmax", "auclast"], "parameter", "value")
    return rounded(long.groupBy("parameter").agg(
        F.regr_slope("value", "dose").alias("slope"), F.regr_intercept("value", "dose").alias("intercept"),
        F.regr_r2("value", "dose").alias("r2"), F.regr_count("value", "dose").alias("n")))


def box_sql(groups: str, value: str, frm: str) -> str:
    """Box statistics of ``value`` by ``groups`` over the relation ``frm``."""
    keys = [g.strip() for g in groups.split(",")]
    on = " AND ".join(f"x.{k} IS NOT DISTINCT FROM q.{k}" for k in keys)
    picked = ", ".join(f"q.{k}" for k in keys)
    return f"""SELECT {picked}, count(v) AS n, max(q25) AS q25, max(median) AS median, max(q75) AS q75,
  sig(min(CASE WHEN v BETWEEN q25 - 1.5*(q75-q25) AND q75 + 1.5*(q75-q25) THEN v END)) AS whisker_low,
  sig(max(CASE WHEN v BETWEEN q25 - 1.5*(q75-q25) AND q75 + 1.5*(q75-q25) THEN v END)) AS whisker_high,
  count(*) FILTER (WHERE v < q25 - 1.5*(q75-q25) OR v > q75 + 1.5*(q75-q25)) AS outliers
FROM (SELECT {groups}, {value} AS v FROM {frm}) x
JOIN (SELECT {groups}, quantile_cont({value}, 0.25) AS q25, quantile_cont({value}, 0.5) AS median,
  quantile_cont({value}, 0.75) AS q75 FROM {frm} GROUP BY {groups}) q ON {on} GROUP BY {picked}"""


def box_rounded(inner: str, groups: str) -> str:
    return rsel(f"{groups}, n, outliers", "q25, median, q75, whisker_low, whisker_high", f"({inner})")


@query("params_vs_group", f"WITH {PK}, {nca_sql()} " + box_rounded(box_sql("occ", "auclast", "rep"), "occ"))
def _(spark, d):
    return rounded(eda.box_stats(report(spark, d), ["occ"], "auclast", summary_hot(spark, d)))


@query("initial_estimates", f"""WITH {PK}, {nca_sql()},
g AS (SELECT exp(avg(ln(cl)) FILTER (WHERE cl > 0)) AS cl, exp(avg(ln(lambdaz)) FILTER (WHERE lambdaz > 0)) AS kel,
  exp(avg(ln(tmax)) FILTER (WHERE tmax > 0)) AS tmax FROM rep)
SELECT sig(cl) AS cl, sig(kel) AS kel, sig(cl / kel) AS v, sig(tmax) AS tmax,
  sig(tmax / 3) AS thalf_a, sig(ln(2.0) / (tmax / 3)) AS ka FROM g""")
def _(spark, d):
    g = report(spark, d).withColumnRenamed("cl_f_obs", "cl").agg(
        *[agg.geomean(c).alias(c) for c in ("cl", "kel", "tmax")])
    thalf = F.col("tmax") / 3
    return rounded(g.select("cl", "kel", F.try_divide("cl", "kel").alias("v"), "tmax", thalf.alias("thalf_a"),
                            F.try_divide(F.lit(0.6931471805599453), thalf).alias("ka")))
