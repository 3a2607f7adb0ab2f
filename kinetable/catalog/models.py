"""Event tables, scoring with given parameters, model tables and resampling on the event stream."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from kinetable.catalog.base import (
    PK, PROFILE, dataset, flags, flags_sql, hot_users, pk_events, query, raw_events, records, rounded, rsel,
)
from kinetable.catalog.profiles import nca_sql, report, summary_hot
from kinetable.operators import agg, events, metrics, nca, resample, score
from kinetable.plans import skew
from kinetable.session import cut_lineage

# ---- event tables ----

_EV_SQL = """SELECT user_id AS id, sig(h) AS time, evid, CAST(1 AS INTEGER) AS cmt, amt, 0.0::DOUBLE AS rate, 'ev' AS route, dv,
  CASE WHEN user_id IS NULL THEN 'no id' WHEN h IS NULL OR h < 0 THEN 'bad time' WHEN evid = 1 AND NOT coalesce(amt > 0, false) THEN 'dose without amount'
    WHEN evid = 1 AND dv IS NOT NULL THEN 'dose with observation' WHEN evid = 0 AND coalesce(amt > 0, false) THEN 'observation with amount' END AS violation"""


def _bound(spark, d):
    ev = pk_events(spark, d, hot_users(spark, d), ["event_type"]).withColumn("route", F.lit("ev"))
    # a purchase also carries an amount here, so that the validation has something to find
    ev = ev.withColumn("amt", F.when(F.col("event_type") == "purchase", F.col("dv")).otherwise(F.col("amt")))
    return events.event_table(ev, "user_id", "h", "amt", "evid", ["dv"], route="route")


_BOUND = "bound AS (SELECT ev.* REPLACE (CASE WHEN event_type = 'purchase' THEN dv ELSE amt END AS amt) FROM ev JOIN events USING (event_id))"


@query("event_table", f"WITH {PK}, {_BOUND} {_EV_SQL} FROM bound")
def _(spark, d):
    return rounded(_bound(spark, d), raw=["amt", "rate", "dv"])


@query("event_violations", f"""WITH {PK}, {_BOUND}, t AS ({_EV_SQL} FROM bound)
SELECT coalesce(violation, 'none') AS violation, count(*) AS n FROM t GROUP BY 1""")
def _(spark, d):
    return events.violations(_bound(spark, d))


@query("expand_doses", f"""WITH {PK} SELECT event_id, user_id, CAST(k AS INTEGER) AS dose_no, sig(h + 24.0 * k) AS time, amt
  FROM ev, range(0, 3) r(k) WHERE evid = 1 AND k <= user_id % 3""")
def _(spark, d):
    doses = pk_events(spark, d, hot_users(spark, d)).filter("evid = 1").select(
        "event_id", "user_id", F.col("h").alias("time"), "amt", F.lit(24.0).alias("ii"), (F.col("user_id") % 3).alias("addl"))
    return rounded(events.expand_doses(doses).drop("ii", "addl"), raw=["amt"])


@query("attach_subject_params", f"""WITH {PK}, {nca_sql()}, p AS (SELECT user_id, cl AS "iCL", vz AS "iVz" FROM rep WHERE occ = 1 AND cl IS NOT NULL)
SELECT event_id, ev.user_id, sig("iCL") AS "iCL", sig("iVz") AS "iVz" FROM ev LEFT JOIN p ON ev.user_id = p.user_id""")
def _(spark, d):
    first = report(spark, d).filter("occ = 1")
    recs = raw_events(spark, d).select("event_id", "user_id")
    return rounded(events.attach_subject_params(recs, first, "user_id", {"cl_f_obs": "iCL", "vz_f_obs": "iVz"}))


_KINDS = """kinds AS (SELECT user_id, occ, t, e.dvid, e.c FROM (SELECT user_id, occ, t, CASE WHEN event_id % 2 = 0 THEN dv END AS p,
    CASE WHEN event_id % 2 = 1 THEN dv END AS m FROM ev WHERE occ > 0 AND evid = 0),
  LATERAL (VALUES ('parent', p), ('metabolite', m)) AS e(dvid, c) WHERE e.c IS NOT NULL)"""


@query("dv_long", f"""WITH {PK}, {_KINDS}, s AS (SELECT user_id, occ, dvid, t AS t1, c AS c1, lead(t) OVER w AS t2, lead(c) OVER w AS c2 FROM kinds
  WINDOW w AS (PARTITION BY user_id, occ, dvid ORDER BY t)),
a AS (SELECT user_id, occ, dvid, sum(CASE WHEN c2 < c1 THEN (t2-t1)*(c1-c2)/ln(c1/c2) ELSE (t2-t1)*(c1+c2)/2 END) AS auc FROM s GROUP BY ALL),
w AS (SELECT user_id, occ, max(auc) FILTER (WHERE dvid = 'parent') AS auc_parent, max(auc) FILTER (WHERE dvid = 'metabolite') AS auc_metabolite
  FROM a GROUP BY ALL) SELECT user_id, occ, sig(auc_parent) AS auc_parent, sig(auc_metabolite) AS auc_metabolite,
  sig(auc_metabolite / nullif(auc_parent, 0)) AS ratio FROM w""")
def _(spark, d):
    hot = hot_users(spark, d)
    odd = F.col("event_id") % 2 == 1
    ev = pk_events(spark, d, hot).filter("occ > 0 and evid = 0").withColumns(
        {"dv_p": F.when(~odd, F.col("dv")), "dv_m": F.when(odd, F.col("dv"))})
    long = events.dv_long(ev, {"parent": "dv_p", "metabolite": "dv_m"}, [*PROFILE, "t"]).withColumnRenamed("dv", "c")
    out = nca.nca_report(long, [*PROFILE, "dvid"], hot=hot)
    return rounded(events.metabolite_ratio(out, PROFILE))


# ---- scoring with given parameters ----

# fixed values: the final model's parameter set
THETA = {
    "tvcl": 3.3282948681980944,
    "tvvc": 63.33119898524297,
    "tvvp": 43.99991526592511,
    "tvq": 3.9550160877722695,
    "tvbio": 0.9051695049102518,
    "ispmoncl": -0.6124674772717063,
    "tvkafed": 0.40949597534030757,
    "tvkafasted": 1.500796375560725,
}
SCALE = 20.0  # dose units to observation units
ADD, PROP = 100.0, 0.1

PRM = f"""usr AS (SELECT user_id, {flags_sql('user_id')} FROM (SELECT DISTINCT user_id FROM events)),
prm AS (SELECT *, {THETA['tvcl']} * pow(wt / 70, 0.75) * CASE WHEN "isPM" = 'yes' THEN {1.0 + THETA['ispmoncl']} ELSE 1.0 END AS cl,
  {THETA['tvvc']} * (wt / 70) AS vc, CASE WHEN isfed = 'yes' THEN {THETA['tvkafed']} ELSE {THETA['tvkafasted']} END AS ka,
  {THETA['tvvp']} * (wt / 70) AS vp, {THETA['tvq']} * pow(wt / 70, 0.75) AS q, {THETA['tvbio']} AS bio FROM usr)"""

ONE = "bio * {a} * ka / (vc * (ka - cl / vc)) * (exp(-cl / vc * {x}) - exp(-ka * {x}))"
SC = f"""{PK}, {PRM}, sc AS (SELECT o.event_id, o.user_id, o.occ, o.t, o.dv,
  coalesce(sum({ONE.format(a=f'd.amt * {SCALE}', x='(o.h - d.h)')}), 0.0) AS pred
  FROM ev o JOIN prm ON prm.user_id = o.user_id LEFT JOIN ev d ON d.user_id = o.user_id AND d.evid = 1 AND d.h <= o.h
  WHERE o.evid = 0 AND o.occ > 0 GROUP BY ALL)"""


def dosed(spark, d, hot):
    """Records with covariates, individual parameters and the dose in observation units."""
    ev = pk_events(spark, d, hot).select("*", *flags("user_id")).withColumn("amt", F.col("amt") * SCALE)
    return score.subject_params(ev, THETA).filter("occ > 0")


MINE = {"CL": F.col, "Vc": F.col, "Ka": F.col, "Vp": F.col, "Q": F.col}


def individual():
    return {**{n: f(n) for n, f in MINE.items()}, "F": THETA["tvbio"]}


def scored(spark, d):
    hot = hot_users(spark, d)
    return score.score_1cmt_oral(dosed(spark, d, hot), individual(), "user_id", "h", hot=hot)


@query("subject_params", f"""WITH {PRM} SELECT user_id, sig(cl) AS "CL", sig(vc) AS "Vc", sig(ka) AS "Ka", sig(vp) AS "Vp", sig(q) AS "Q" FROM prm""")
def _(spark, d):
    users = dataset(spark, d, "events").select("user_id").distinct().select("user_id", *flags("user_id"))
    return rounded(score.subject_params(users, THETA).drop("isPM", "isfed", "wt"))


@query("score_1cmt_oral", f"WITH {SC} SELECT event_id, user_id, sig(pred) AS pred FROM sc")
def _(spark, d):
    return rounded(scored(spark, d).select("event_id", "user_id", "pred"))


_ROOTS = """rts AS (SELECT *, cl/vc + q/vc + q/vp AS tot, (cl/vc)*(q/vp) AS prod, q/vp AS k21 FROM prm),
ab AS (SELECT *, (tot + sqrt(tot*tot - 4*prod)) / 2 AS al, (tot - sqrt(tot*tot - 4*prod)) / 2 AS be FROM rts)"""
TWO_CMT = f"""bio * d.amt * {SCALE} * ka / vc * (
    (k21-al)*exp(-al*{{x}})/((be-al)*(ka-al)) + (k21-be)*exp(-be*{{x}})/((al-be)*(ka-be))
    + (k21-ka)*exp(-ka*{{x}})/((al-ka)*(be-ka)))"""


@query("score_2cmt_oral", f"""WITH {PK}, {PRM}, {_ROOTS}
SELECT o.event_id, o.user_id, sig(coalesce(sum({TWO_CMT.format(x='(o.h-d.h)')}), 0.0)) AS pred
FROM ev o JOIN ab ON ab.user_id = o.user_id LEFT JOIN ev d ON d.user_id = o.user_id AND d.evid = 1 AND d.h <= o.h
WHERE o.evid = 0 AND o.occ > 0 GROUP BY o.event_id, o.user_id""")
def _(spark, d):
    hot = hot_users(spark, d)
    return rounded(score.score_2cmt_oral(dosed(spark, d, hot), individual(), "user_id", "h", hot=hot).select(
        "event_id", "user_id", "pred"))


@query("score_parent_met", f"""WITH {PK}, {PRM} SELECT o.event_id, o.user_id,
  sig(coalesce(sum(d.amt * {SCALE} / vc * exp(-cl/vc * (o.h-d.h))), 0.0)) AS pred_p,
  sig(coalesce(sum(d.amt * {SCALE} * (cl/vc) / (vp * (q/vp - cl/vc)) * (exp(-cl/vc*(o.h-d.h)) - exp(-q/vp*(o.h-d.h)))), 0.0)) AS pred_m
FROM ev o JOIN prm ON prm.user_id = o.user_id LEFT JOIN ev d ON d.user_id = o.user_id AND d.evid = 1 AND d.h <= o.h
WHERE o.evid = 0 AND o.occ > 0 GROUP BY o.event_id, o.user_id""")
def _(spark, d):
    hot = hot_users(spark, d)
    p = {"CL": F.col("CL"), "Vc": F.col("Vc"), "CLme": F.col("Q"), "Vme": F.col("Vp")}
    return rounded(score.score_parent_met(dosed(spark, d, hot), p, "user_id", "h", hot=hot).select(
        "event_id", "user_id", "pred_p", "pred_m"))


# Every third dose runs in over one to five hours, every fourth is at steady state of itself every 24 h. The twin lists the earlier
# doses of a steady state one by one, far beyond a double's precision, and adds up what each dose gives alone.
PAST = 120
_REGIMEN = f"""rg AS (SELECT *, evid = 1 AND event_id % 3 = 0 AS runs, CASE WHEN evid = 1 AND event_id % 4 = 1 THEN 1 ELSE 0 END AS ss, 1 + event_id % 5 AS len FROM ev),
ep AS (SELECT *, sum(ss) OVER (PARTITION BY user_id ORDER BY h, evid DESC, event_id ROWS UNBOUNDED PRECEDING) AS epoch FROM rg),
given AS (SELECT user_id, epoch, runs, len, amt * {SCALE} AS amt, h - 24 * j AS h FROM ep, range(0, {PAST}) r(j) WHERE evid = 1 AND (ss = 1 OR j = 0))"""
# what one dose gives to an exponential at a time after its start
_ALONE = """CASE WHEN NOT d.runs THEN d.amt * exp(-{k} * (o.h - d.h)) WHEN o.h - d.h < d.len THEN d.amt / d.len / {k} * (1 - exp(-{k} * (o.h - d.h)))
    ELSE d.amt / d.len / {k} * (exp(-{k} * (o.h - d.h - d.len)) - exp(-{k} * (o.h - d.h))) END"""


def _regimen_sql(prm: str, select: str) -> str:
    return f"""WITH {PK}, {PRM}, {_ROOTS}, {_REGIMEN} SELECT o.event_id, o.user_id, {select}
FROM ep o JOIN {prm} p ON p.user_id = o.user_id LEFT JOIN given d ON d.user_id = o.user_id AND d.epoch = o.epoch AND d.h <= o.h
WHERE o.evid = 0 AND o.occ > 0 GROUP BY o.event_id, o.user_id"""


def _regimen(spark, d, hot):
    rows = dosed(spark, d, hot)
    return rows.withColumns({
        "rate": F.when((F.col("evid") == 1) & (F.col("event_id") % 3 == 0), F.col("amt") / (1 + F.col("event_id") % 5)),
        "ss": F.when((F.col("evid") == 1) & (F.col("event_id") % 4 == 1), 1).otherwise(0), "ii": F.lit(24.0)})


HOW = {"rate": "rate", "ss": "ss", "ii": "ii"}


def _mode(k: str) -> str:
    return f"sum({_ALONE.format(k=f'({k})')})"


@query("score_regimen", _regimen_sql("prm", f"""sig(coalesce(min(bio * ka / (vc * (ka - cl / vc))) * ({_mode('cl / vc')} - {_mode('ka')}), 0.0)) AS pred"""))
def _(spark, d):
    hot = hot_users(spark, d)
    out = score.score_1cmt_oral(_regimen(spark, d, hot), individual(), "user_id", "h", tie=["event_id"], hot=hot, **HOW)
    return rounded(out.select("event_id", "user_id", "pred"))


@query("score_regimen_2cmt", _regimen_sql("ab", f"""sig(coalesce(min(bio * ka / vc) * (min((k21-al)/((be-al)*(ka-al))) * {_mode('al')}
  + min((k21-be)/((al-be)*(ka-be))) * {_mode('be')} + min((k21-ka)/((al-ka)*(be-ka))) * {_mode('ka')}), 0.0)) AS pred"""))
def _(spark, d):
    hot = hot_users(spark, d)
    out = score.score_2cmt_oral(_regimen(spark, d, hot), individual(), "user_id", "h", tie=["event_id"], hot=hot, **HOW)
    return rounded(out.select("event_id", "user_id", "pred"))


@query("score_regimen_met", _regimen_sql("prm", f"""sig(coalesce(min(1 / vc) * {_mode('cl / vc')}, 0.0)) AS pred_p,
  sig(coalesce(min((cl/vc) / (vp * (q/vp - cl/vc))) * ({_mode('cl / vc')} - {_mode('q / vp')}), 0.0)) AS pred_m"""))
def _(spark, d):
    hot = hot_users(spark, d)
    p = {"CL": F.col("CL"), "Vc": F.col("Vc"), "CLme": F.col("Q"), "Vme": F.col("Vp")}
    out = score.score_parent_met(_regimen(spark, d, hot), p, "user_id", "h", tie=["event_id"], hot=hot, **HOW)
    return rounded(out.select("event_id", "user_id", "pred_p", "pred_m"))


GRID = 721  # fixed value: points of the grid 0, 0.1 ... 72
_GRID = f"g AS (SELECT user_id, i * CAST(0.1 AS DOUBLE) AS time FROM (SELECT DISTINCT user_id FROM ev WHERE evid = 1), range(0, {GRID}) r(i))"


def _grid(spark, d, hot):
    ev = pk_events(spark, d, hot).select("user_id", "h", "evid", (F.col("amt") * SCALE).alias("amt"))
    grid = score.prediction_grid(ev, "user_id", "h", "evid", "amt", 0.0, 0.1, GRID)
    return score.subject_params(grid.select("*", *flags("user_id")), THETA)


@query("predict_grid", f"""WITH {PK}, {PRM}, {_GRID}
SELECT g.user_id, time, sig(coalesce(sum({ONE.format(a=f'd.amt * {SCALE}', x='(g.time - d.h)')}), 0.0)) AS pred
FROM g JOIN prm ON prm.user_id = g.user_id LEFT JOIN ev d ON d.user_id = g.user_id AND d.evid = 1 AND d.h <= g.time GROUP BY g.user_id, time""")
def _(spark, d):
    hot = hot_users(spark, d)
    out = score.score_1cmt_oral(_grid(spark, d, hot), individual(), "user_id", "h", hot=hot)
    return rounded(out.select("user_id", F.col("h").alias("time"), "pred"), raw=["time"])


@query("predict_grid_2cmt", f"""WITH {PK}, {PRM}, {_ROOTS}, {_GRID}
SELECT g.user_id, time, sig(coalesce(sum({TWO_CMT.format(x='(g.time - d.h)')}), 0.0)) AS pred
FROM g JOIN ab ON ab.user_id = g.user_id LEFT JOIN ev d ON d.user_id = g.user_id AND d.evid = 1 AND d.h <= g.time GROUP BY g.user_id, time""")
def _(spark, d):
    hot = hot_users(spark, d)
    out = score.score_2cmt_oral(_grid(spark, d, hot), individual(), "user_id", "h", hot=hot)
    return rounded(out.select("user_id", F.col("h").alias("time"), "pred"), raw=["time"])


# ---- residuals and likelihoods ----

VAR = {"additive": f"{ADD}", "proportional": f"(pred * pred * {PROP})", "combined": f"(pred * pred * {PROP} + {ADD})"}


def _ll(kind: str) -> str:
    v = VAR[kind]
    return f"CASE WHEN {v} > 0 THEN -0.5 * (ln(2 * pi()) + ln({v}) + (dv - pred) * (dv - pred) / {v}) END"


RES = f"""{SC}, res AS (SELECT *, dv - pred AS residual, (dv - pred) / sqrt({VAR['combined']}) AS iwres FROM sc)"""


def residuals(spark, d):
    return metrics.residual_table(scored(spark, d), "dv", "pred", "combined", ADD, PROP)


@query("residual_table", f"WITH {RES} " + rsel("event_id, user_id", "pred, residual, iwres", "res"))
def _(spark, d):
    return rounded(residuals(spark, d).select("event_id", "user_id", "pred", "residual", "iwres"))


def _series(name: str, axis: str, width: float) -> None:
    @query(name, f"""WITH {RES} SELECT floor({axis} / {width}) * {width} AS bin, """ + ", ".join(
        f"count({c}) AS {c}_n, sig(avg({c})) AS {c}_mean, sig(stddev_samp({c})) AS {c}_std" for c in ("residual", "iwres")) + " FROM res GROUP BY 1")
    def run(spark, d):
        return rounded(metrics.residual_series(residuals(spark, d), axis, width))


_series("residual_series", "t", 24.0)
_series("residual_series_pred", "pred", 4.0)


@query("error_models", f"""WITH {SC} SELECT event_id, sig(sqrt({VAR['additive']})) AS sd_additive, sig(sqrt({VAR['proportional']})) AS sd_proportional,
  sig(sqrt({VAR['combined']})) AS sd_combined FROM sc""")
def _(spark, d):
    return rounded(metrics.error_models(scored(spark, d), "pred", ADD, PROP).select(
        "event_id", "sd_additive", "sd_proportional", "sd_combined"))


@query("pooled_loglik", f"WITH {SC} SELECT sig(sum({_ll('combined')})) AS loglik, count({_ll('combined')}) AS n_obs, count(*) FILTER (WHERE dv IS NOT NULL AND pred IS NOT NULL AND {_ll('combined')} IS NULL) AS n_excluded FROM sc")
def _(spark, d):
    return rounded(metrics.pooled_loglik(scored(spark, d), "dv", "pred", "combined", ADD, PROP))


def _metrics_sql(name: str, kind: str, k: int) -> str:
    return f"""{name}_ll AS (SELECT sum({_ll(kind)}) AS ll, count({_ll(kind)}) AS n, count(*) FILTER (WHERE dv IS NOT NULL AND pred IS NOT NULL AND {_ll(kind)} IS NULL) AS x, count(DISTINCT user_id) AS s FROM sc),
{name} AS (SELECT e.metric AS "Metric", e.value AS "Value" FROM {name}_ll, LATERAL (VALUES ('LogLikelihood', ll), ('-2LL', -2 * ll),
  ('AIC', -2 * ll + {2.0 * k}), ('BIC', -2 * ll + {k} * ln(n)), ('Observations', n::DOUBLE), ('Excluded', x::DOUBLE), ('Subjects', s::DOUBLE), ('Parameters', {float(k)})) AS e(metric, value))"""


def stored(spark, d):
    """Predictions written once, for several models' tables to read."""
    return cut_lineage(scored(spark, d).select("user_id", "dv", "pred"))


def _metrics(preds, kind: str, k: int):
    return metrics.fit_metrics(preds, "user_id", "dv", "pred", kind, ADD, PROP, k)


@query("fit_metrics", f"""WITH {SC}, {_metrics_sql('m', 'combined', 6)} SELECT "Metric", sig("Value") AS "Value" FROM m""")
def _(spark, d):
    return rounded(_metrics(scored(spark, d), "combined", 6))


@query("compare_metrics", f"""WITH {SC}, {_metrics_sql('a', 'additive', 5)}, {_metrics_sql('c', 'combined', 6)}
SELECT a."Metric", sig(a."Value") AS "ADD", sig(c."Value") AS "COMB" FROM a JOIN c ON a."Metric" = c."Metric" """)
def _(spark, d):
    preds = stored(spark, d)
    return rounded(metrics.compare_metrics({"ADD": _metrics(preds, "additive", 5), "COMB": _metrics(preds, "combined", 6)}))


@query("lr_test", f"""WITH {SC}, l AS (SELECT sum({_ll('additive')}) AS ll0, sum({_ll('combined')}) AS ll1 FROM sc),
s AS (SELECT *, greatest(2 * (ll1 - ll0), 0.0) AS x FROM l)
SELECT sig(ll0) AS ll0, sig(ll1) AS ll1, sig(x) AS statistic, CAST(2 AS BIGINT) AS df, sig(exp(-x / 2)) AS p FROM s""")
def _(spark, d):
    preds = stored(spark, d)
    return rounded(metrics.lr_test(_metrics(preds, "additive", 4), _metrics(preds, "combined", 6), 2))


# erfc(z): power series up to 2.2, continued fraction from its 300th term beyond
_Z = "sqrt(x / 2)"
_ERFC = f"""CASE WHEN {_Z} < 2.2 THEN 1 - 2 / sqrt(pi()) * exp(-x / 2) * list_sum([exp(n * ln(2.0) + (2 * n + 1) * ln({_Z} + 1e-300)
    - (lgamma(2 * n + 2) - n * ln(2.0) - lgamma(n + 1))) FOR n IN range(0, 80)])
  ELSE exp(-x / 2) / sqrt(pi()) / list_reduce(list_prepend({_Z}, [CAST(i AS DOUBLE) FOR i IN range(300, 0, -1)]), lambda v, i: {_Z} + i / 2 / v) END"""


def _lr(name: str, df: int, p: str) -> None:
    """The rise of the likelihood from additive to combined error over five average observations, for another number of parameters."""
    @query(name, f"""WITH {SC}, l AS (SELECT sum({_ll('additive')}) AS a, sum({_ll('combined')}) AS b, count(*) AS n FROM sc),
s AS (SELECT 0.0::DOUBLE AS ll0, (b - a) / n * 5 AS ll1 FROM l), x AS (SELECT *, greatest(2 * (ll1 - ll0), 0.0) AS x FROM s)
SELECT ll0, sig(ll1) AS ll1, sig(x) AS statistic, CAST({df} AS BIGINT) AS df, sig({p}) AS p FROM x""")
    def run(spark, d):
        preds = stored(spark, d)
        n = preds.select(F.count(F.lit(1)).alias("_obs")).withColumn("Metric", F.lit("LogLikelihood"))
        both = [_metrics(preds, kind, 4).filter("Metric = 'LogLikelihood'").withColumnRenamed("Value", kind) for kind in ("additive", "combined")]
        rise = both[0].join(both[1], "Metric").join(n, "Metric").withColumn("Value", (F.col("combined") - F.col("additive")) / F.col("_obs") * 5)
        none = rise.select("Metric", F.lit(0.0).alias("Value"))
        return rounded(metrics.lr_test(none, rise.select("Metric", "Value"), df), raw=["ll0"])


_lr("lr_test_df1", 1, _ERFC)
_lr("lr_test_df3", 3, f"{_ERFC} + sqrt(2 * x / pi()) * exp(-x / 2)")


@query("influential", f"""WITH {SC} SELECT user_id, sig(-2 * sum({_ll('combined')})) AS m2ll FROM sc GROUP BY user_id
ORDER BY -2 * sum({_ll('combined')}) DESC, user_id LIMIT 10""")
def _(spark, d):
    return rounded(metrics.influential(scored(spark, d), "user_id", "dv", "pred", "combined", ADD, PROP, 10))


@query("model_registry", f"""WITH {SC}, {_metrics_sql('a', 'additive', 5)}, {_metrics_sql('p', 'proportional', 5)}
SELECT 'one_cmt_add' AS model, "Metric", sig("Value") AS "Value" FROM a UNION ALL SELECT 'one_cmt_prop', "Metric", sig("Value") FROM p""")
def _(spark, d):
    fits = {"one_cmt_add": ("additive", 5), "one_cmt_prop": ("proportional", 5), "one_cmt_comb": ("combined", 6)}
    preds = stored(spark, d)
    tables = {n: _metrics(preds, *k) for n, k in fits.items()}
    return rounded(metrics.model_registry(tables, ["one_cmt_add", "one_cmt_prop"]))


# ---- candidate parameter sets ----

CANDIDATES = [{"CL": cl, "Vc": v, "Ka": 1.5, "F": 0.9} for cl in (1.5, 3.0, 6.0) for v in (15.0, 60.0)]
CAND = "cnd AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}::BIGINT, {p['CL']}::DOUBLE, {p['Vc']}::DOUBLE, {p['Ka']}::DOUBLE, {p['F']}::DOUBLE)" for i, p in enumerate(CANDIDATES)
) + ") AS v(cand, cl, vc, ka, bio))"
CSC = f"""{PK}, {CAND}, sc AS (SELECT o.event_id, o.user_id, o.dv, cand, coalesce(sum({ONE.format(a=f'd.amt * {SCALE}', x='(o.h - d.h)')}), 0.0) AS pred
  FROM ev o CROSS JOIN cnd LEFT JOIN ev d ON d.user_id = o.user_id AND d.evid = 1 AND d.h <= o.h WHERE o.evid = 0 AND o.occ > 0 GROUP BY ALL)"""


def _candidates(spark, d):
    hot = hot_users(spark, d)
    ev = dosed(spark, d, hot)
    return score.score_candidates(ev, CANDIDATES, ["user_id", "dv"], "user_id", "h", hot=hot)


@query("grid_fit_pooled", f"""WITH {CSC}, l AS (SELECT cand, sum({_ll('combined')}) AS loglik FROM sc GROUP BY cand)
SELECT cand, sig(loglik) AS loglik, loglik = max(loglik) OVER () AS best FROM l""")
def _(spark, d):
    return rounded(metrics.grid_fit_pooled(_candidates(spark, d), "dv", "combined", ADD, PROP))


BEST = f"""{CSC}, l AS (SELECT user_id, cand, sum({_ll('combined')}) AS loglik FROM sc GROUP BY ALL),
b AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY loglik DESC, cand) = 1)"""
TWO = f"""{BEST}, two AS (SELECT e.parameter, e.value FROM b JOIN cnd USING (cand), LATERAL (VALUES ('CL', cl), ('Vc', vc), ('Ka', ka), ('F', bio)) AS e(parameter, value))"""


@query("grid_fit_each", f"WITH {BEST} SELECT user_id, cand, sig(loglik) AS loglik FROM b")
def _(spark, d):
    return rounded(metrics.grid_fit_each(_candidates(spark, d), "user_id", "dv", "combined", ADD, PROP))


def _two_stage(spark, d):
    best = metrics.grid_fit_each(_candidates(spark, d), "user_id", "dv", "combined", ADD, PROP)
    return metrics.grid_fit_two_stage(best, CANDIDATES)


@query("grid_fit_two_stage", f"WITH {TWO} SELECT parameter, count(value) AS n, sig(avg(value)) AS mean, sig(stddev_samp(value)) AS std FROM two GROUP BY parameter")
def _(spark, d):
    return rounded(_two_stage(spark, d))


@query("compare_estimates", f"""WITH {TWO}, {nca_sql().replace('best AS', 'bst AS').replace('FROM best', 'FROM bst')},
a AS (SELECT parameter, avg(value) AS two_stage FROM two GROUP BY parameter),
n AS (SELECT e.parameter, e.nca FROM (SELECT avg(cl) AS cl, avg(vz) AS vz FROM rep), LATERAL (VALUES ('CL', cl), ('Vz', vz)) AS e(parameter, nca))
SELECT coalesce(a.parameter, n.parameter) AS parameter, sig(two_stage) AS two_stage, sig(nca) AS nca FROM a FULL JOIN n ON a.parameter = n.parameter""")
def _(spark, d):
    two = _two_stage(spark, d).select("parameter", F.col("mean").alias("estimate"))
    one = report(spark, d).agg(F.avg("cl_f_obs").alias("CL"), F.avg("vz_f_obs").alias("Vz"))
    return rounded(metrics.compare_estimates({"two_stage": two, "nca": one.unpivot([], ["CL", "Vz"], "parameter", "estimate")}))


# ---- subject deviations and covariates ----

PAIR = ["auclast", "cmax"]
DEV = f"""{PK}, {nca_sql()}, dev AS (SELECT user_id, occ, auclast, cmax, {flags_sql('user_id')},
  ln(CASE WHEN auclast > 0 THEN auclast END) - avg(ln(CASE WHEN auclast > 0 THEN auclast END)) OVER () AS eta_auclast,
  ln(CASE WHEN cmax > 0 THEN cmax END) - avg(ln(CASE WHEN cmax > 0 THEN cmax END)) OVER () AS eta_cmax FROM rep)"""


def deviations(spark, d):
    r = cut_lineage(report(spark, d).select(*PROFILE, *PAIR, *flags("user_id")))  # the mean and the rows read it
    return metrics.subject_deviation(r, PAIR)


@query("subject_deviation", f"WITH {DEV} " + rsel("user_id, occ", "eta_auclast, eta_cmax", "dev"))
def _(spark, d):
    return rounded(deviations(spark, d).select(*PROFILE, "eta_auclast", "eta_cmax"))


@query("deviation_dist", f"""WITH {DEV}, r AS (SELECT min(eta_cmax) AS lo, (max(eta_cmax) - min(eta_cmax)) / 12 AS w FROM dev),
b AS (SELECT CAST(least(floor((eta_cmax - lo) / w), 11) AS BIGINT) AS bin, lo, w FROM dev, r WHERE eta_cmax IS NOT NULL)
SELECT bin, sig(min(lo + bin * w)) AS bin_start, count(*) AS count FROM b GROUP BY bin""")
def _(spark, d):
    return rounded(metrics.deviation_dist(deviations(spark, d), "eta_cmax", 12)[0])


@query("deviation_moments", f"""WITH {DEV}, c AS (SELECT eta_cmax AS x, avg(eta_cmax) OVER () AS m FROM dev WHERE eta_cmax IS NOT NULL)
SELECT count(x) AS n, sig(avg(x)) AS mean, sig(stddev_samp(x)) AS std,
  sig(avg(pow(x - m, 3)) / pow(avg(pow(x - m, 2)), 1.5)) AS skewness FROM c""")
def _(spark, d):
    return rounded(metrics.deviation_dist(deviations(spark, d), "eta_cmax", 12)[1])


@query("deviation_vs_cov", f"""WITH {DEV} SELECT "isPM", """ + ", ".join(
    f"count({c}) AS {c}_n, sig(avg({c})) AS {c}_mean, sig(stddev_samp({c})) AS {c}_std" for c in ("eta_auclast", "eta_cmax")) + """ FROM dev GROUP BY "isPM" """)
def _(spark, d):
    return rounded(metrics.deviation_vs_group(deviations(spark, d), ["eta_auclast", "eta_cmax"], ["isPM"]))


@query("deviation_vs_weight", f"""WITH {DEV}, l AS (SELECT wt, e.parameter, e.eta FROM dev, LATERAL (VALUES ('eta_auclast', eta_auclast), ('eta_cmax', eta_cmax)) AS e(parameter, eta))
SELECT parameter, sig(regr_slope(eta, wt)) AS slope, sig(corr(eta, wt)) AS r FROM l GROUP BY parameter""")
def _(spark, d):
    return rounded(metrics.deviation_vs_value(deviations(spark, d), ["eta_auclast", "eta_cmax"], "wt"))


@query("shrinkage", f"""WITH {DEV}, s AS (SELECT stddev_samp(eta_auclast) AS a, stddev_samp(eta_cmax) AS c FROM dev)
SELECT e.parameter, sig(e.shrinkage) AS shrinkage FROM s, LATERAL (VALUES ('auclast', 1 - a / 2.0), ('cmax', 1 - c / 1.5)) AS e(parameter, shrinkage)""")
def _(spark, d):
    return rounded(metrics.shrinkage(deviations(spark, d), {"auclast": 2.0, "cmax": 1.5}))


@query("cov_effect_size", f"""WITH {DEV}, s AS (SELECT "isPM", avg(auclast) AS mean, quantile_cont(auclast, 0.5) AS median, min(auclast) AS min, max(auclast) AS max,
  stddev_samp(auclast) AS std FROM dev GROUP BY 1), b AS (SELECT mean AS base FROM s WHERE "isPM" = 'no')
SELECT "isPM", sig(mean) AS mean, sig(median) AS median, sig(min) AS min, sig(max) AS max, sig(std) AS std,
  sig(100 * (mean - base) / base) AS percent_change FROM s, b""")
def _(spark, d):
    r = report(spark, d).select("auclast", *flags("user_id"))
    return rounded(metrics.cov_effect_size(r, "isPM", "auclast", "no", summary_hot(spark, d)))


@query("bsv_percent", f"""WITH {DEV}, g AS (SELECT "isPM", count(eta_cmax) AS n, var_samp(eta_cmax) AS v FROM dev GROUP BY 1),
o AS (SELECT (SELECT var_samp(eta_cmax) FROM dev) AS before, (SELECT sum((n - 1) * v) / (sum(n) - 1) FROM g) AS after)
SELECT 'cmax' AS parameter, sig(100 * sqrt(before)) AS bsv_before, sig(100 * sqrt(after)) AS bsv_after,
  sig(100 * sqrt(after) - 100 * sqrt(before)) AS bsv_change FROM o""")
def _(spark, d):
    # before: variance over all; after: within the covariate's levels, both from per-level moments
    g = deviations(spark, d).groupBy("isPM").agg(
        F.count("eta_cmax").alias("n"), F.avg("eta_cmax").alias("m"), F.var_samp("eta_cmax").alias("v"))
    n, m, v = F.col("n"), F.col("m"), F.col("v")
    one = g.agg(F.sum((n - 1) * v).alias("within"), F.sum(n).alias("n"), F.sum(n * m).alias("s"), F.sum(n * m * m).alias("q"))
    between = F.col("q") - F.col("s") * F.col("s") / F.col("n")
    omegas = one.select(F.lit("cmax").alias("parameter"), ((F.col("within") + between) / (F.col("n") - 1)).alias("before"),
                        (F.col("within") / (F.col("n") - 1)).alias("after"))
    return rounded(metrics.bsv_percent(omegas, "before", "after").drop("before", "after"))


@query("coef_table", f"""WITH {PK}, {nca_sql()}, l AS (SELECT e.parameter, e.value FROM rep, LATERAL (VALUES ('auclast', auclast), ('cmax', cmax), ('tmax', tmax)) AS e(parameter, value)),
s AS (SELECT parameter, avg(value) AS m, stddev_samp(value) / sqrt(count(value)) AS se FROM l GROUP BY 1)
SELECT parameter, sig(m) AS estimate, sig(se) AS se, sig(100 * se / m) AS rse, sig(m - 1.959963984540054 * se) AS ci_low,
  sig(m + 1.959963984540054 * se) AS ci_high FROM s""")
def _(spark, d):
    return rounded(metrics.coef_table(report(spark, d), ["auclast", "cmax", "tmax"]))


@query("emax_response", """SELECT event_id, sig(1 + 2.0 * value / (50.0 + value)) AS stimulation,
  sig(10.0 / (0.5 * (1 + 2.0 * value / (50.0 + value)))) AS response_loss, sig(10.0 * (1 + 2.0 * value / (50.0 + value)) / 0.5) AS response_production FROM events""")
def _(spark, d):
    ev = dataset(spark, d, "events").select("event_id", "value")
    return rounded(score.emax_response(ev, "value", 2.0, 50.0, 10.0, 0.5).drop("value"))


# ---- resampling ----

REPLICATES = 200  # fixed value: bootstrap samples
SUBJ = f"""{PK}, {nca_sql()}, subj AS (SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'yes' ELSE 'no' END AS "isPM", avg(cmax) AS cmax, avg(auclast) AS auclast
  FROM rep GROUP BY 1, 2)"""


def draws_sql(base: str, replicates: int) -> str:
    return f"""rk AS (SELECT *, row_number() OVER (PARTITION BY "isPM" ORDER BY user_id) AS rank, count(*) OVER (PARTITION BY "isPM") AS ns FROM {base}),
pk AS (SELECT "isPM", CAST(r AS INTEGER) AS replicate,
  ('0x' || substr(md5("isPM" || '|' || r || '|' || rank), 1, 8))::BIGINT % ns + 1 AS rank FROM rk, range(1, {replicates + 1}) g(r)),
drawn AS (SELECT pk.replicate, pk."isPM", rk.* EXCLUDE ("isPM", rank, ns) FROM pk JOIN rk ON pk."isPM" = rk."isPM" AND pk.rank = rk.rank)"""


BOOT = f"""{SUBJ}, {draws_sql('subj', REPLICATES)}, boot AS (SELECT replicate, avg(cmax) AS cmax, avg(auclast) AS auclast FROM drawn GROUP BY 1)"""


def subjects(spark, d):
    r = report(spark, d).groupBy("user_id").agg(F.avg("cmax").alias("cmax"), F.avg("auclast").alias("auclast"))
    return cut_lineage(r.withColumn("isPM", F.when(F.col("user_id") % 3 == 0, "yes").otherwise("no")))


def strata_hot(spark, d):
    """None when even all records together stay within the limit, else let the operator look."""
    return None if dataset(spark, d, "events").count() <= skew.hot_rows(spark) else skew.LOOK


def replicated(spark, d, base=None):
    return resample.bootstrap(base or subjects(spark, d), "user_id", "isPM", ["cmax", "auclast"], REPLICATES, strata_hot(spark, d))


@query("bootstrap", f"WITH {BOOT} " + rsel("replicate", "cmax, auclast", "boot"))
def _(spark, d):
    return rounded(replicated(spark, d))


@query("bootstrap_ci", f"""WITH {BOOT}, l AS (SELECT e.parameter, e.value FROM boot, LATERAL (VALUES ('cmax', cmax), ('auclast', auclast)) AS e(parameter, value))
SELECT parameter, sig(avg(value)) AS estimate, sig(stddev_samp(value)) AS se, sig(quantile_cont(value, 0.025)) AS ci_low,
  sig(quantile_cont(value, 0.975)) AS ci_high FROM l GROUP BY parameter""")
def _(spark, d):
    return rounded(resample.bootstrap_ci(replicated(spark, d), ["cmax", "auclast"]))


@query("bootstrap_vcov", f"""WITH {BOOT} SELECT e.x, e.y, sig(e.covariance) AS covariance FROM (SELECT covar_samp(cmax, cmax) AS a, covar_samp(cmax, auclast) AS b,
  covar_samp(auclast, auclast) AS c FROM boot), LATERAL (VALUES ('cmax', 'cmax', a), ('cmax', 'auclast', b), ('auclast', 'auclast', c)) AS e(x, y, covariance)""")
def _(spark, d):
    return rounded(resample.bootstrap_vcov(replicated(spark, d), ["cmax", "auclast"]))


@query("sir", f"""WITH {BOOT}, st AS (SELECT count(cmax) AS n, avg(cmax) AS m, var_samp(cmax) AS v FROM subj),
ll AS (SELECT replicate, -0.5 * (n * ln(2 * pi() * v) + ((n - 1) * v + n * pow(m - cmax, 2)) / v) AS loglik FROM boot, st),
w AS (SELECT *, exp(loglik - max(loglik) OVER ()) AS w FROM ll),
c AS (SELECT *, sum(w) OVER (ORDER BY replicate ROWS UNBOUNDED PRECEDING) / sum(w) OVER () AS hi, w / sum(w) OVER () AS weight FROM w),
x AS (SELECT replicate, loglik, weight, count(*) AS drawn FROM c JOIN range(0, 20) p(i) ON (i + 0.5) / 20 <= hi AND (i + 0.5) / 20 > hi - weight GROUP BY ALL)
SELECT replicate, sig(loglik) AS loglik, sig(weight) AS weight, drawn FROM x""")
def _(spark, d):
    base = subjects(spark, d)
    st = base.agg(F.struct(F.count("cmax").alias("n"), F.avg("cmax").alias("m"), F.var_samp("cmax").alias("v")).alias("s")).scalar()
    n, m, v = F.col("s.n"), F.col("s.m"), F.col("s.v")
    ll = -0.5 * (n * F.ln(2 * math.pi * v) + ((n - 1) * v + n * F.pow(m - F.col("cmax"), F.lit(2.0))) / v)
    cands = replicated(spark, d, base).withColumn("s", st).select("replicate", ll.alias("loglik"))
    return rounded(resample.sir(cands, "replicate", "loglik", 20, None))


# the density of two means by the closed inverse of their covariance, independent of the factor on the other side
@query("sir_ratio", f"""WITH {BOOT}, st AS (SELECT count(cmax) AS n, avg(cmax) AS m, var_samp(cmax) AS v, count(auclast) AS an, avg(auclast) AS am, var_samp(auclast) AS av FROM subj),
pr AS (SELECT avg(cmax) AS mx, avg(auclast) AS my, covar_samp(cmax, cmax) AS vx, covar_samp(auclast, auclast) AS vy, covar_samp(cmax, auclast) AS vxy FROM boot),
ll AS (SELECT replicate, -0.5 * (n * ln(2 * pi() * v) + ((n - 1) * v + n * pow(m - cmax, 2)) / v)
    - 0.5 * (an * ln(2 * pi() * av) + ((an - 1) * av + an * pow(am - auclast, 2)) / av) AS loglik,
  -ln(2 * pi()) - 0.5 * ln(vx * vy - vxy * vxy) - 0.5 * (vy * pow(cmax - mx, 2) - 2 * vxy * (cmax - mx) * (auclast - my) + vx * pow(auclast - my, 2)) / (vx * vy - vxy * vxy) AS logq
  FROM boot, st, pr),
w AS (SELECT *, exp(loglik - logq - max(loglik - logq) OVER ()) AS w FROM ll),
c AS (SELECT *, sum(w) OVER (ORDER BY replicate ROWS UNBOUNDED PRECEDING) / sum(w) OVER () AS hi, w / sum(w) OVER () AS weight FROM w),
x AS (SELECT replicate, loglik, weight, count(*) AS drawn FROM c JOIN range(0, 20) p(i) ON (i + 0.5) / 20 <= hi AND (i + 0.5) / 20 > hi - weight GROUP BY ALL)
SELECT replicate, sig(loglik) AS loglik, sig(weight) AS weight, drawn FROM x""")
def _(spark, d):
    """Replicate means of two parameters, weighed by their likelihood over the normal density fitted to them."""
    base = subjects(spark, d)
    names = ["cmax", "auclast"]
    st = base.agg(F.struct(*[f(c).alias(f"{k}_{c}") for c in names for k, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))]).alias("s")).scalar()
    cands = cut_lineage(replicated(spark, d, base))
    own = lambda k, c: F.col(f"s.{k}_{c}")
    ll = sum(-0.5 * (own("n", c) * F.ln(2 * math.pi * own("v", c)) + ((own("n", c) - 1) * own("v", c) + own("n", c) * F.pow(own("m", c) - F.col(c), F.lit(2.0))) / own("v", c))
             for c in names)
    drawn = resample.normal_log_density(cands, names, resample.bootstrap_vcov(cands, names), "logq").withColumn("s", st)
    return rounded(resample.sir(drawn.select("replicate", ll.alias("loglik"), "logq"), "replicate", "loglik", 20, None, proposal="logq"))


@query("vpc_bands", f"""WITH {PK}, obs AS (SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'yes' ELSE 'no' END AS "isPM", floor(t / 24) * 24 AS bin, c FROM prof),
ids AS (SELECT DISTINCT user_id, "isPM" FROM obs), {draws_sql('ids', REPLICATES)},
seen AS (SELECT "isPM", bin, count(c) AS n, quantile_cont(c, [0.05, 0.5, 0.95]) AS q FROM obs GROUP BY 1, 2),
rep AS (SELECT replicate, o."isPM", bin, quantile_cont(c, [0.05, 0.5, 0.95]) AS q FROM drawn d JOIN obs o ON o.user_id = d.user_id GROUP BY 1, 2, 3),
band AS (SELECT "isPM", bin, i, quantile_cont(q[i], 0.025) AS low, quantile_cont(q[i], 0.975) AS high FROM rep, range(1, 4) g(i) GROUP BY ALL)
SELECT s."isPM", s.bin, n, CASE g.i WHEN 1 THEN 'p05' WHEN 2 THEN 'p50' ELSE 'p95' END AS mark, sig(s.q[g.i]) AS observed, sig(low) AS low, sig(high) AS high
FROM seen s, range(1, 4) g(i) LEFT JOIN band b ON b."isPM" = s."isPM" AND b.bin = s.bin AND b.i = g.i""")
def _(spark, d):
    hot = hot_users(spark, d)
    obs = records(spark, d, hot).filter("amt is null").select(
        "user_id", F.when(F.col("user_id") % 3 == 0, "yes").otherwise("no").alias("isPM"),
        (F.floor(F.col("t") / 24) * 24).cast("double").alias("bin"), "c")
    return rounded(resample.vpc_bands(obs, "user_id", "isPM", "bin", "c", REPLICATES, strata_hot(spark, d)))
