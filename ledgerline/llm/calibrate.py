"""Logistic calibration of margins (Platt's smoothed targets), safe under perfect separation."""

from __future__ import annotations

import numpy as np


def _loss(a: float, b: float, x: np.ndarray, t: np.ndarray, ridge: float) -> float:
    z = a * x + b
    return float((np.logaddexp(0, z) - t * z).sum() + ridge * a * a / 2)


def logistic(margin: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """(slope, shift) of P(1 | margin), by damped Newton steps on standardised margins."""
    mean, std = float(margin.mean()), float(margin.std()) or 1.0
    x = (margin - mean) / std
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 0.0, float(np.log((n1 + 1) / (n0 + 1)))
    now = _loss(a, b, x, t, ridge)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - t) * x).sum() + ridge * a, (p - t).sum()])
        s = p * (1 - p) + 1e-9
        h = np.array([[(s * x * x).sum() + ridge, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-6]])
        step, size = np.linalg.solve(h, g), 1.0
        while size > 1e-6 and _loss(a - size * step[0], b - size * step[1], x, t, ridge) > now:
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
        before, now = now, _loss(a, b, x, t, ridge)
        if before - now < 1e-9:
            break
    a = max(a, 0.0)  # a higher margin never means a lower score
    return a / std, b - a * mean / std


def prior_shift(y: np.ndarray, share: float | None) -> float:
    """What to add to the logit when label 1 has ``share`` of all rows and not that of the sample ``y``."""
    if share is None or not 0 < share < 1 or y.min() == y.max():
        return 0.0
    own = y.mean()
    return float(np.log(share / (1 - share)) - np.log(own / (1 - own)))
