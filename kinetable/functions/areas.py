"""Area of one concentration segment (t1, c1) -> (t2, c2), as SQL expressions.

Arguments and results are expression texts; ``lg`` is the text of the segment's log-scale test.
"""

from __future__ import annotations

import math

METHODS = ("linear", "linuplogdown", "linlog")


def log_rule(method: str, t1: str, c1: str, t2: str, c2: str, tmax: str) -> str:
    """Whether the segment declines in a way the method integrates on the log scale."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    if method == "linear":
        return "false"
    falls = f"{c2} > 0 AND {c2} < {c1} AND {t2} > {t1}"
    return f"({falls})" if method == "linuplogdown" else f"({falls} AND {t1} >= {tmax})"


def _drop(c1: str, c2: str) -> str:
    """ln(c1 / c2) from the difference, which keeps its digits however flat the decline is."""
    return f"log1p(({c1} - {c2}) / {c2})"


def _mean_decay(x: str) -> str:
    """Mean of exp(-u) for u in [0, x]."""
    return f"(CASE WHEN {x} > 0 THEN -expm1(-{x}) / {x} ELSE 1.0D END)"


def _first_moment(x: str) -> str:
    """Integral of u exp(-u x) for u in [0, 1]: a power series where the closed form would cancel."""
    series = _weight(14)  # below 0.5 the next term is under 1e-18
    for n in range(13, -1, -1):
        series = f"({_weight(n)} - {x} * {series})"
    return f"(CASE WHEN {x} < 0.5D THEN {series} ELSE (1 - exp(-{x}) * (1 + {x})) / ({x} * {x}) END)"


def _weight(n: int) -> str:
    return f"{1 / (math.factorial(n) * (n + 2))!r}D"


def auc(lg: str, t1: str, c1: str, t2: str, c2: str) -> str:
    h = f"({t2} - {t1})"
    return f"CASE WHEN {lg} THEN {h} * ({c1} - {c2}) / {_drop(c1, c2)} ELSE {h} * ({c1} + {c2}) / 2 END"


def aumc(lg: str, t1: str, c1: str, t2: str, c2: str) -> str:
    h = f"({t2} - {t1})"
    x = _drop(c1, c2)
    flat = f"{t1} * {h} * ({c1} - {c2}) / {x} + {c1} * {h} * {h} * {_first_moment(x)}"
    return f"CASE WHEN {lg} THEN {flat} ELSE {h} * ({t1} * {c1} + {t2} * {c2}) / 2 END"


def clipped_auc(lg: str, t1: str, c1: str, t2: str, c2: str, a: str, b: str) -> str:
    """The part of the segment inside [a, b]: on the log scale with the whole segment's rate."""
    lo, hi = f"greatest({t1}, {a})", f"least({t2}, {b})"
    from_, width = f"(({lo} - {t1}) / ({t2} - {t1}))", f"(({hi} - {lo}) / ({t2} - {t1}))"
    x = _drop(c1, c2)
    curved = f"({hi} - {lo}) * {c1} * exp(-{x} * {from_}) * {_mean_decay(f'({x} * {width})')}"
    straight = f"({hi} - {lo}) * ({c1} + ({c2} - {c1}) * ({from_} + {width} / 2))"
    return f"CASE WHEN {lo} < {hi} THEN CASE WHEN {lg} THEN {curved} ELSE {straight} END END"
