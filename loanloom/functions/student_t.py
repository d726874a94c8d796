"""Student-t quantiles for a confidence interval."""

from __future__ import annotations

import math
from functools import lru_cache


def _cdf(t: float, dof: int) -> float:
    # P(T <= t) from the finite trigonometric sums for integer degrees of freedom.
    theta = math.atan(t / math.sqrt(dof))
    c2 = math.cos(theta) ** 2
    term, total = 1.0, 0.0
    if dof % 2:
        for k in range(1, (dof - 1) // 2 + 1):
            term = term * (1.0 if k == 1 else c2 * (2 * k - 2) / (2 * k - 1))
            total += term
        inner = theta + math.sin(theta) * math.cos(theta) * total if dof > 1 else theta
        return 0.5 + inner / math.pi
    for k in range(dof // 2):
        term = term * (1.0 if k == 0 else c2 * (2 * k - 1) / (2 * k))
        total += term
    return 0.5 + math.sin(theta) * total / 2


@lru_cache(maxsize=None)
def t_quantile(p: float, dof: int) -> float:
    """Value t with P(T <= t) = p, for p above one half."""
    lo, hi = 0.0, 1.0
    while _cdf(hi, dof) < p:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _cdf(mid, dof) < p else (lo, mid)
    return (lo + hi) / 2
