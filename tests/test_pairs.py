"""Order statistics of differences and quantiles of many lanes against brute force, on both plans."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from kinetable.operators import be
from kinetable.plans import pairs, sweep


def samples():
    rng = np.random.default_rng(3)
    yield "smooth", rng.normal(size=83), rng.normal(size=61)
    yield "ties", rng.integers(0, 5, 70).astype(float), rng.integers(0, 5, 90).astype(float)
    yield "one value", np.full(50, 3.0), np.full(30, 1.0)
    yield "scales", rng.normal(size=45) * 10.0 ** rng.integers(-12, 12, 45), rng.normal(size=50) * 10.0 ** rng.integers(-12, 12, 50)
    yield "far", 1e8 + rng.integers(0, 3, 40) * 1e-8, rng.integers(0, 3, 44) * 0.1
    yield "single", np.array([2.5]), rng.normal(size=64)


@pytest.mark.parametrize("name, x, y", list(samples()), ids=lambda v: v if isinstance(v, str) else "")
def test_kth_difference(name, x, y):
    ordered = np.sort((x[:, None] - y[None, :]).ravel())
    for k in [1, 2, len(ordered) // 3 + 1, len(ordered) // 2 + 1, len(ordered)]:
        assert pairs.kth_difference(x, np.sort(y), k) == ordered[k - 1]


def test_ranked_differences(spark, tiny_limit):
    rows, want = [], {}
    for name, x, y in samples():
        rows += [(name, True, float(v)) for v in x] + [(name, False, float(v)) for v in y]
        ordered = np.sort((x[:, None] - y[None, :]).ravel())
        want |= {(name, i): float(ordered[k - 1]) for i, k in enumerate(pairs.wanted_ranks(len(x), len(y)))}
    rows += [("no pairs", True, float(v)) for v in range(50)]
    random.Random(1).shuffle(rows)
    got = pairs.ranked_differences(spark.createDataFrame(rows, "study string, x boolean, d double"), ["study"], "x", "d")
    assert {(r.study, r.id): r.value for r in got.collect()} == want  # to the last bit


@pytest.mark.parametrize("m, n", [(1, 2), (2, 2), (3, 3), (4, 5), (1, 19), (1, 20), (6, 4), (7, 7)])
def test_limit_rank_is_exact(m, n):
    sums = [sum(c) - m * (m + 1) // 2 for c in combinations(range(1, m + n + 1), m)]
    at_most = lambda u: sum(s <= u for s in sums) / len(sums)
    k = 1
    while at_most(k) <= 0.05:
        k += 1
    assert pairs.limit_rank(m, n) == pytest.approx((k, 1 - 2 * at_most(k - 1)))


def test_limit_rank_of_large_samples(monkeypatch):
    exact = {s: pairs.limit_rank(*s) for s in [(40, 40), (90, 110), (150, 150)]}
    pairs.limit_rank.cache_clear()
    monkeypatch.setattr(pairs, "EXACT", 0)
    assert {s: pairs.limit_rank(*s)[0] for s in exact} == {s: k for s, (k, _) in exact.items()}
    assert all(abs(pairs.limit_rank(*s)[1] - level) < 1e-5 for s, (_, level) in exact.items())
    pairs.limit_rank.cache_clear()
    assert pairs.limit_rank(5_000, 5_000)[1] == pytest.approx(0.9, abs=1e-6)


@pytest.mark.parametrize("limit", [None, 20])
def test_limits_hold_the_estimate(spark, limit):
    rng = random.Random(4)
    rows = [(i, "RT" if i % 2 else "TR", p, rng.choice([1.0, 2.0, 2.5, 4.0])) for i in range(60) for p in (1, 2)]
    rows += [(1000 + i, "RT", p, 1.0) for i in range(60) for p in (1, 2)]
    data = spark.createDataFrame([("a" if i < 1000 else "b", "tmax", s, i, p, y) for i, s, p, y in rows],
                                 "study string, endpoint string, sequence string, id int, period int, y double")
    if limit:
        spark.conf.set("kinetable.hotRows", str(limit))
    try:
        got = {r.study: r for r in be.be_nonpar(data, ["study"]).collect()}
    finally:
        spark.conf.unset("kinetable.hotRows")
    assert got["a"].lb <= got["a"].pe <= got["a"].ub and got["a"].level >= 0.9
    assert tuple(got["b"])[2:] == (None,) * 4
    test_limits_hold_the_estimate.seen = seen = getattr(test_limits_hold_the_estimate, "seen", got)
    assert {k: tuple(v) for k, v in got.items()} == {k: tuple(v) for k, v in seen.items()}


@pytest.mark.parametrize("rows", [50_000, 16])
def test_lane_quantiles_meet_their_lists_late(spark, monkeypatch, rows):
    monkeypatch.setattr(sweep, "SWEEP_ROWS", rows)
    monkeypatch.setattr(sweep, "HELD_SUMS", 2)
    rng = random.Random(7)
    lists = [(i, None if i == 3 else [rng.randrange(1, 6) for _ in range(rng.randrange(5))]) for i in range(9)] + [(9, [2] * 300), (None, [4] * 70_000)]
    data = [(rng.choice(["a", "a", "b", None]), rng.choice([*range(12), None]), rng.choice([None, 2.0, rng.random()])) for _ in range(200)]
    probs = {"low": 0.05, "mid": 0.5}
    got = sweep.lane_quantiles(spark.createDataFrame(data, "g string, i int, v double"), ["g"], "v", "held", 7, probs,
                               spark.createDataFrame(lists, "i int, held array<int>"), ["i"])
    held, want = dict(lists), {}
    for g in ("a", "b", None):
        for lane in range(7):
            own = [v for k, i, v in data if k == g and v is not None for _ in range(1 if lane == 0 else (held.get(i) or []).count(lane))]
            want[g, lane] = tuple(np.quantile(own, list(probs.values())).round(12)) if own else (None,) * 2
    assert {(r.g, r.lane): tuple(x if x is None else round(x, 12) for x in r[2:]) for r in got.collect()} == want


@pytest.mark.parametrize("rows", [50_000, 16])
def test_lane_quantiles(spark, monkeypatch, rows):
    monkeypatch.setattr(sweep, "SWEEP_ROWS", rows)
    rng = random.Random(6)
    data = [(rng.choice(["a", "a", "b", None]), rng.choice([None, 1.0, 2.0, rng.random(), -rng.random()]),
             None if rng.random() < 0.1 else [rng.randrange(1, 6) for _ in range(rng.randrange(5))]) for _ in range(300)]
    data += [("c", 1.0, []), ("d", None, [1])]
    probs = {"low": 0.05, "mid": 0.5, "high": 1.0}
    got = sweep.lane_quantiles(spark.createDataFrame(data, "g string, v double, held array<int>"), ["g"], "v", "held", 7, probs)
    want = {}
    for g in ("a", "b", None, "c"):
        for lane in range(7):
            own = [v for k, v, held in data if k == g and v is not None for _ in range(1 if lane == 0 else (held or []).count(lane))]
            want[g, lane] = tuple(np.quantile(own, list(probs.values())).round(12)) if own else (None,) * 3
    seen = {(r.g, r.lane): tuple(x if x is None else round(x, 12) for x in r[2:]) for r in got.collect()}
    assert seen == want
