"""Predicted concentrations for given parameters, by linear-time superposition of doses.

Linear kinetics make every prediction a sum of decaying exponentials over the doses given so far.
Pairing each observation with each earlier dose would be quadratic in a subject's records. Instead
the decayed dose total S(t) = sum of amt * exp(-rate * (t - t_dose)) is kept per exponential: a running
sum over doses inside time blocks of 300 / rate, plus the total of the block before. Doses two blocks
back have decayed by more than exp(-300) and no longer reach a double's precision. Each observation
then needs only the state at its latest dose, found by equality on (subject, occasion).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from kinetable.operators.sequence import dosing
from kinetable.plans import skew

REACH = 300.0  # time constants per block; exp(REACH) is far from overflow


def as_column(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def subject_params(df: DataFrame, theta: Mapping[str, float], wt: str = "wt", is_pm: str = "isPM",
                   is_fed: str = "isfed") -> DataFrame:
    """Individual parameters from covariates.

    Clearances scale with (wt/70)^0.75 and volumes with wt/70; poor metabolizers change clearance
    by the fraction ``ispmoncl``; the absorption rate depends on the fed state.
    """
    size = F.col(wt) / 70
    flow = F.pow(size, F.lit(0.75))
    pm = F.when(F.col(is_pm) == "yes", 1.0 + theta["ispmoncl"]).otherwise(1.0)
    return df.withColumns({
        "CL": theta["tvcl"] * flow * pm,
        "Vc": theta["tvvc"] * size,
        "Ka": F.when(F.col(is_fed) == "yes", theta["tvkafed"]).otherwise(theta["tvkafasted"]),
        "Vp": theta["tvvp"] * size,
        "Q": theta["tvq"] * flow,
    })


def decayed_doses(records: DataFrame, id: str, time: str, evid: str, amt: str, rates: Mapping[str, Column],
                  tie: Sequence[str] = (), hot=skew.LOOK, rate: str | None = None, ss: str | None = None, ii: str | None = None) -> DataFrame:
    """Observation records with ``S_<name>`` for every rate; zero before the first dose.

    ``rates`` are expressions over the record's own columns (constant within a subject). Records
    that already carry ``occ`` and ``dose_time`` are taken as they are. With ``rate`` or ``ss`` doses may be
    given over time or at steady state, see ``_regimen``.
    """
    names = list(rates)
    if hot is skew.LOOK:
        hot = skew.find_hot(records, [id])
    given = bool(rate or ss)
    if given:
        rows = _regimen(records, id, time, evid, amt, tie, hot, rate, ss, ii)
        group, occ, last = [id, "_epoch"], "_occ", "_dose_time"
    else:
        done = {"occ", "dose_time"} <= set(records.columns)
        rows = records if done else dosing(records, id, time, evid, tie, hot)
        group, occ, last = [id], "occ", "dose_time"
    lanes = F.explode(F.array(*[
        F.struct(F.lit(i).alias("lane"), rates[n].cast("double").alias("rate")) for i, n in enumerate(names)
    ]))
    inputs = [F.col(amt).cast("double").alias("_amt"), *(["_r", "_len", "_ii"] if given else [])]
    doses = (
        rows.filter(F.col(evid) == 1)
        .select(*group, F.col(occ).alias("_no"), F.col(time).alias("_td"), *inputs, lanes.alias("_l"))
        .withColumns({"lane": F.col("_l.lane"), "rate": F.col("_l.rate")})
        .withColumn("_block", F.floor(F.col("_td") * F.col("rate") / REACH))
        .withColumn("_in", (_pulse(F.col("rate")) if given else F.col("_amt")) * F.exp(F.col("rate") * F.col("_td") - F.col("_block") * REACH))
        .select(*group, "_no", "_td", "lane", "rate", "_block", "_in")
    )
    lane = [*group, "lane", "_block"]
    # occasions number the doses of a subject in time order, so they order a block without ties
    run = {"_run": ("sum", F.col("_in"))}
    summed = skew.by_heat(doses, [id], lambda d, s: s.scan(d, lane, [("_no", False)], running=run), hot)
    whole = doses.groupBy(*lane).agg(F.sum("_in").alias("_past")).withColumn("_block", F.col("_block") + 1)
    within = F.exp(F.col("_block") * REACH - F.col("rate") * F.col("_td"))
    state = F.col("_run") * within + F.coalesce(F.col("_past"), F.lit(0.0)) * within * math.exp(-REACH)
    at_dose = summed.join(whole, lane, "left").groupBy(*group, F.col("_no").alias(occ)).agg(
        *[F.max(F.when(F.col("lane") == i, state)).alias(f"_a{i}") for i in range(len(names))])
    seen = rows.filter(F.col(evid) == 0).join(at_dose, [*group, occ], "left")
    gap = F.col(time) - F.col(last)
    decayed = [F.coalesce(F.col(f"_a{i}") * F.exp(-rates[n] * gap), F.lit(0.0)) for i, n in enumerate(names)]
    if given:
        decayed = [F.when(F.col("_occ") > 0, s + F.col("_on") / rates[n]).otherwise(s) for s, n in zip(decayed, names)]
    out = seen.withColumns({f"S_{n}": s for n, s in zip(names, decayed)})
    return out.drop(*[f"_a{i}" for i in range(len(names))], *(["_epoch", "_occ", "_dose_time", "_on", "_r", "_len", "_ii", "_stop"] if given else []))


def _regimen(records: DataFrame, id: str, time: str, evid: str, amt: str, tie: Sequence[str], hot,
             rate: str | None, ss: str | None, ii: str | None) -> DataFrame:
    """Records with a stop event after every infusion, the running number and time of events, and the rate running in ``_on``.

    A dose with ``rate`` above zero runs in for amt / rate; without one it is given at once. A dose with ``ss`` = 1 finds the steady
    state of the same dose every ``ii`` (which an infusion must not outlast) and ends the effect of all earlier
    doses: it opens an epoch of its subject, and sums do not cross epochs.
    """
    if ss and not ii:
        raise ValueError("steady-state doses need their interval")
    none = F.lit(None).cast("double")
    is_dose = F.col(evid) == 1
    runs = is_dose & (F.coalesce(F.col(rate).cast("double"), F.lit(0.0)) > 0) if rate else F.lit(False)
    steady = is_dose & F.coalesce(F.col(ss) == 1, F.lit(False)) if ss else F.lit(False)
    rows = records.withColumn(time, F.col(time).cast("double")).withColumns({
        "_r": F.when(runs, F.col(rate).cast("double")) if rate else none,
        "_len": F.when(runs, F.col(amt).cast("double") / F.col(rate).cast("double")) if rate else none,
        "_ii": F.when(steady, F.col(ii).cast("double")) if ss else none, "_stop": F.lit(False)})
    order = [(time, False), (evid, True), ("_stop", True), *[(c, False) for c in tie]]
    opened = {"_epoch": ("sum", steady.cast("long"))}
    rows = skew.by_heat(rows, [id], lambda d, s: s.scan(d, [id], order, running=opened), hot)
    # an infusion that a steady-state dose cuts off stops in its own epoch, where nothing is observed any more
    stops = rows.filter(F.col("_r") > 0).withColumns({time: F.col(time) + F.col("_len"), "_r": -F.col("_r"), "_ii": none, "_stop": F.lit(True)})
    counted = {"_occ": ("sum", F.col(evid).cast("long")), "_dose_time": ("max", F.when(F.col(evid) == 1, F.col(time))),
               "_on": ("sum", F.coalesce("_r", F.lit(0.0)))}
    every = rows.unionByName(stops) if rate else rows
    return skew.by_heat(every, [id], lambda d, s: s.scan(d, [id, "_epoch"], order, running=counted), hot)


def _pulse(rate: Column) -> Column:
    """What an event adds to an exponential of this rate, beside the level rate-in / rate while it runs in.

    Before a steady-state dose the same doses have been given forever: geometric series in exp(-rate * ii).
    """
    r, length, ii = F.col("_r"), F.col("_len"), F.col("_ii")
    earlier = F.exp(-rate * (ii - length)) * F.expm1(-rate * length) / F.expm1(-rate * ii)
    run_in = r / rate * (F.when(ii.isNotNull(), earlier).otherwise(0.0) - 1)
    at_once = F.col("_amt") * F.when(ii.isNotNull(), -1 / F.expm1(-rate * ii)).otherwise(1.0)
    return F.when(r > 0, run_in).when(r < 0, -r / rate).otherwise(at_once)


def _apart(a: Column, *others: Column) -> Column:
    """Nudge a rate that coincides with another one, where the closed form has a removable pole; in any unit of time."""
    for b in others:
        a = F.when(F.abs(a - b) < 1e-6 * F.abs(b), b * (1 + 1e-6)).otherwise(a)
    return a


def one_cmt(p: Mapping[str, Any]) -> tuple[dict[str, Column], Any]:
    """Rates and prediction of the one-compartment oral model: CL, Vc, Ka, F."""
    cl, v, bio = as_column(p["CL"]), as_column(p["Vc"]), as_column(p.get("F", 1.0))
    k = cl / v
    ka = _apart(as_column(p["Ka"]), k)
    return {"k": k, "ka": ka}, lambda s: bio * ka / (v * (ka - k)) * (s("k") - s("ka"))


def two_cmt(p: Mapping[str, Any]) -> tuple[dict[str, Column], Any]:
    """Two-compartment oral model: CL, Vc, Ka, Q, Vp, F."""
    cl, vc, q, vp = (as_column(p[n]) for n in ("CL", "Vc", "Q", "Vp"))
    bio = as_column(p.get("F", 1.0))
    k10, k12, k21 = cl / vc, q / vc, q / vp
    total, prod = k10 + k12 + k21, k10 * k21
    root = F.sqrt(total * total - 4 * prod)
    alpha = (total + root) / 2
    beta = prod / alpha  # the small root from the product, which does not cancel
    ka = _apart(as_column(p["Ka"]), alpha, beta)

    def predict(s):
        def part(lam, one, two):
            return (k21 - lam) / ((one - lam) * (two - lam))

        shape = part(alpha, beta, ka) * s("alpha") + part(beta, alpha, ka) * s("beta") + part(ka, alpha, beta) * s("ka")
        return bio * ka / vc * shape

    return {"alpha": alpha, "beta": beta, "ka": ka}, predict


def _predict(records, id, time, evid, amt, model, tie, hot, name, regimen) -> DataFrame:
    rates, predict = model
    out = decayed_doses(records, id, time, evid, amt, rates, tie, hot, **regimen)
    return out.withColumn(name, predict(lambda n: F.col(f"S_{n}"))).drop(*[f"S_{n}" for n in rates])


def score_1cmt_oral(records: DataFrame, params: Mapping[str, Any], id: str = "id", time: str = "time",
                    evid: str = "evid", amt: str = "amt", tie: Sequence[str] = (), hot=skew.LOOK,
                    name: str = "pred", **regimen: str) -> DataFrame:
    """Observation records with the one-compartment prediction; parameters are numbers or columns.

    ``regimen`` may name the columns ``rate`` (doses given over time) and ``ss`` with ``ii`` (doses at steady state).
    """
    return _predict(records, id, time, evid, amt, one_cmt(params), tie, hot, name, regimen)


def score_2cmt_oral(records: DataFrame, params: Mapping[str, Any], id: str = "id", time: str = "time",
                    evid: str = "evid", amt: str = "amt", tie: Sequence[str] = (), hot=skew.LOOK,
                    name: str = "pred", **regimen: str) -> DataFrame:
    """The same with two compartments."""
    return _predict(records, id, time, evid, amt, two_cmt(params), tie, hot, name, regimen)


def score_parent_met(records: DataFrame, params: Mapping[str, Any], id: str = "id", time: str = "time",
                     evid: str = "evid", amt: str = "amt", tie: Sequence[str] = (), hot=skew.LOOK, **regimen: str) -> DataFrame:
    """Intravenous parent and its metabolite, one compartment each: CL, Vc, CLme, Vme; ``regimen`` as for the others."""
    v, vme = as_column(params["Vc"]), as_column(params["Vme"])
    k = as_column(params["CL"]) / v
    kme = _apart(as_column(params["CLme"]) / vme, k)
    out = decayed_doses(records, id, time, evid, amt, {"k": k, "kme": kme}, tie, hot, **regimen)
    return out.withColumns({
        "pred_p": F.col("S_k") / v,
        "pred_m": k / (vme * (kme - k)) * (F.col("S_k") - F.col("S_kme")),
    }).drop("S_k", "S_kme")


def score_candidates(records: DataFrame, candidates: Sequence[Mapping[str, float]], keep: Sequence[str],
                     id: str = "id", time: str = "time", evid: str = "evid", amt: str = "amt",
                     tie: Sequence[str] = (), hot=skew.LOOK) -> DataFrame:
    """(keep..., cand, pred): every observation under every candidate parameter set.

    Candidates are the caller's short list of numbers. All share one pass over the records; rows
    multiply only after the last join, in front of the partial aggregation that follows.
    """
    models = [one_cmt(p) for p in candidates]
    rates = {f"{i}_{n}": r for i, (rs, _) in enumerate(models) for n, r in rs.items()}
    out = decayed_doses(records, id, time, evid, amt, rates, tie, hot)
    preds = F.array(*[
        F.struct(F.lit(i).cast("long").alias("cand"), predict(lambda n, i=i: F.col(f"S_{i}_{n}")).alias("pred"))
        for i, (_, predict) in enumerate(models)
    ])
    return out.select(*keep, F.explode(preds).alias("_p")).select(*keep, "_p.cand", "_p.pred")


def prediction_grid(records: DataFrame, id: str, time: str, evid: str, amt: str, start: float, step: float,
                    points: int) -> DataFrame:
    """Dose records plus an even time grid of observation records for every dosed subject."""
    doses = records.filter(F.col(evid) == 1).select(id, time, F.col(evid).cast("int").alias(evid), amt)
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    marks = doses.select(id).distinct().withColumn("_i", grid).select(
        id, (F.lit(float(start)) + F.col("_i") * F.lit(float(step))).alias(time),
        F.lit(0).alias(evid), F.lit(None).cast("double").alias(amt))
    return doses.unionByName(marks)


def emax_response(df: DataFrame, conc: str, smax: float, sc50: float, kprod: float, kuptake: float) -> DataFrame:
    """Stimulation factor and the steady-state response when loss or production is stimulated."""
    c = F.col(conc)
    s = 1 + smax * c / (sc50 + c)
    return df.withColumns({
        "stimulation": s,
        "response_loss": kprod / (kuptake * s),
        "response_production": kprod * s / kuptake,
    })
