"""Doses given over time and at steady state against superposed single doses."""

from __future__ import annotations

import math

import pytest

from kinetable.operators import events, score

P = {"CL": 2.0, "Vc": 20.0, "Ka": 0.7, "Q": 1.5, "Vp": 30.0, "F": 0.9}
SCHEMA = "id string, time double, evid int, amt double, rate double, ss int, ii double"
HOW = {"rate": "rate", "ss": "ss", "ii": "ii"}


def one(tau, amt, rate):
    """Response to a single dose, infusions by numbers of small doses in the limit: the closed form per exponential."""
    if tau < 0:
        return 0.0
    k, ka = P["CL"] / P["Vc"], P["Ka"]

    def mode(lam):
        if not rate:
            return amt * math.exp(-lam * tau)
        length = amt / rate
        ends = math.exp(-lam * max(0.0, tau - length)) - math.exp(-lam * tau) if tau > length else 1 - math.exp(-lam * tau)
        return rate / lam * ends

    return P["F"] * ka / (P["Vc"] * (ka - k)) * (mode(k) - mode(ka))


def wanted(rows):
    out = {}
    for who, t, evid, *_ in rows:
        if evid:
            continue
        doses = sorted((r for r in rows if r[0] == who and r[2] == 1 and r[1] <= t), key=lambda r: r[1])
        last = max((i for i, r in enumerate(doses) if r[5] == 1), default=0)
        total = 0.0
        for r in doses[last:]:
            total += sum(one(t - r[1] + j * (r[6] or 0.0), r[3], r[4]) for j in range(800 if r[5] == 1 else 1))
        out[who, t] = total
    return out


DOSES = [
    ("bolus", 0.0, 1, 100.0, 0.0, 0, 0.0), ("bolus", 5.0, 1, 50.0, None, None, None),
    ("over time", 1.0, 1, 100.0, 20.0, 0, None), ("over time", 2.0, 1, 60.0, 10.0, 0, None), ("over time", 4.0, 1, 10.0, 0.0, 0, None),
    ("steady", 0.0, 1, 500.0, 0.0, 0, 0.0), ("steady", 3.0, 1, 80.0, 0.0, 1, 12.0), ("steady", 6.0, 1, 10.0, 0.0, 0, 0.0),
    ("steady over time", 0.0, 1, 999.0, 30.0, 0, 0.0), ("steady over time", 2.0, 1, 80.0, 20.0, 1, 8.0), ("steady over time", 20.0, 1, 40.0, 40.0, 1, 24.0),
    ("full interval", 0.0, 1, 96.0, 8.0, 1, 12.0),
]
TIMES = [0.0, 0.5, 1.0, 2.0, 3.0, 5.0, 5.9, 6.0, 8.0, 13.0, 20.0, 20.5, 21.0, 40.0, 400.0, 9000.0]


@pytest.mark.parametrize("limit", [None, 5])
def test_regimens(spark, limit):
    rows = DOSES + [(who, t, 0, None, None, None, None) for who in {d[0] for d in DOSES} for t in TIMES]
    if limit:
        spark.conf.set("kinetable.hotRows", str(limit))
    try:
        got = score.score_1cmt_oral(spark.createDataFrame(rows, SCHEMA), P, **HOW).collect()
    finally:
        spark.conf.unset("kinetable.hotRows")
    want = wanted(rows)
    assert {(r.id, r.time): r.pred for r in got} == pytest.approx(want, rel=1e-9, abs=1e-10)


def test_input_balances_clearance(spark):
    """At the end of a long infusion input equals output: concentration rate / CL, whatever the model."""
    rows = [("a", 0.0, 1, 5e4, 10.0, 0, 0.0), ("a", 4999.0, 0, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for out in (score.score_1cmt_oral(df, P, **HOW), score.score_2cmt_oral(df, P, **HOW)):
        assert out.first().pred == pytest.approx(P["F"] * 10 / P["CL"], rel=1e-9)
    met = score.score_parent_met(df, {"CL": 2.0, "Vc": 20.0, "CLme": 4.0, "Vme": 8.0}, **HOW).first()
    assert (met.pred_p, met.pred_m) == pytest.approx((5.0, 2.5), rel=1e-9)


@pytest.mark.parametrize("unit", [1.0, 1e-10, 1e10])
def test_unit_of_time(spark, unit):
    """Rates per another unit of time predict the same, also beside coinciding rates."""
    for ka in (P["Ka"], P["CL"] / P["Vc"], P["CL"] / P["Vc"] * (1 + 1e-9)):
        p = {**P, "CL": P["CL"] * unit, "Q": P["Q"] * unit, "Ka": ka * unit}
        rows = [("a", 0.0, 1, 100.0, 0.0, 0, 0.0), ("a", 6.0 / unit, 0, None, None, None, None)]
        got = score.score_1cmt_oral(spark.createDataFrame(rows, SCHEMA), p).first().pred
        k = P["CL"] / P["Vc"]
        shape = (math.exp(-6 * k) - math.exp(-6 * ka)) / (ka - k) if ka == P["Ka"] else 6 * math.exp(-6 * k)
        assert got == pytest.approx(P["F"] * ka / P["Vc"] * 100 * shape, rel=1e-5)


def test_expanded_steady_state(spark):
    doses = spark.createDataFrame([("a", 0.0, 10.0, 12.0, 2, 1)], "id string, time double, amt double, ii double, addl int, ss int")
    got = events.expand_doses(doses, ss="ss").orderBy("time").collect()
    assert [(r.time, r.ss) for r in got] == [(0.0, 1), (12.0, 0), (24.0, 0)]


def test_violations(spark):
    rows = [("a", 0.0, 1, 10.0, -1.0, 0, 0.0), ("a", 0.0, 1, 10.0, 0.0, 1, 0.0), ("a", 0.0, 1, 10.0, 0.5, 1, 12.0), ("a", 0.0, 1, 10.0, 1.0, 1, 12.0), ("a", 1.0, 0, None, None, None, None)]
    df = spark.createDataFrame([(*r, None) for r in rows], SCHEMA + ", dv double")
    got = events.event_table(df, "id", "time", "amt", "evid", ["dv"], rate="rate", ss="ss", ii="ii")
    assert [r.violation for r in got.collect()] == ["bad rate", "steady state without interval", "infusion outlasts interval", None, None]
