"""Probability laws on arrays, without tables that grow with their arguments."""

from __future__ import annotations

import math

import numpy as np

#: Numbers below this have their logarithmic factorials from a table, others from Stirling's series.
_FEW = 64
_LOG_FACTORIAL = np.array([math.lgamma(k + 1) for k in range(_FEW)])


def _stirling_rest(n: np.ndarray) -> np.ndarray:
    """log n! less the leading terms of Stirling's formula, for n > 0."""
    small = np.minimum(n, _FEW - 1).astype(np.int64)
    exact = _LOG_FACTORIAL[small] - (small + 0.5) * np.log(np.maximum(small, 1)) + small - 0.5 * math.log(2 * math.pi)
    x = np.maximum(n, 1.0)
    return np.where(n < _FEW, exact, 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5))


def poisson_point(n: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """P(X = n) of Poisson laws, by the deviance: no large terms that cancel."""
    n, rate = np.asarray(n, float), np.asarray(rate, float)
    at = np.maximum(n, 1.0)
    x = (rate - at) / at
    # x - log(1 + x), by its series where the two nearly cancel
    near = np.abs(x) < 1e-2
    series = x * x * (0.5 - x * (1 / 3 - x * (0.25 - x * (0.2 - x * (1 / 6 - x * (1 / 7 - x / 8))))))
    with np.errstate(divide="ignore", over="ignore"):
        deviance = at * np.where(near, series, x - np.log1p(x))
        return np.where(n > 0, np.exp(-deviance - _stirling_rest(at)) / np.sqrt(2 * math.pi * at), np.exp(-rate))


def poisson_tail(n: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """P(X >= n) of Poisson laws, at any rate.

    Above the rate the tail itself is summed from its largest term on, below it the lower part, so nothing cancels and
    nothing underflows that is not negligible. Each sum goes on until its terms are; terms fall by a ratio below 1.
    """
    n, rate = np.asarray(n, np.int64), np.asarray(rate, float)
    out = np.ones(len(n))
    out[(rate <= 0) & (n > 0)] = 0.0
    for upper in (True, False):
        at = np.flatnonzero((n > 0) & (rate > 0) & ((n > rate) if upper else (n <= rate)))
        k = n[at].astype(float) if upper else n[at] - 1.0
        term = poisson_point(k, rate[at])
        total, lam, live = term.copy(), rate[at], np.arange(len(at))
        while len(live):
            if upper:
                k[live] += 1
                term[live] *= lam[live] / k[live]
            else:
                term[live] *= k[live] / lam[live]
                k[live] -= 1
            total[live] += term[live]
            live = live[(term[live] > total[live] * 1e-17) & (upper | (k[live] > 0))]
        out[at] = total if upper else 1 - total
    return np.clip(out, 0.0, 1.0)


def digamma(x: float) -> float:
    out = 0.0
    while x < 10:
        out -= 1 / x
        x += 1
    y = 1 / (x * x)
    return out + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y / 240)))


def trigamma(x: float) -> float:
    out = 0.0
    while x < 10:
        out += 1 / (x * x)
        x += 1
    y = 1 / (x * x)
    return out + 1 / x + y / 2 + y / x * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y / 30)))


def gamma_fit(mean: float, mean_log: float) -> tuple[float, float]:
    """Shape and scale of the likeliest gamma law of numbers with these means of value and logarithm."""
    s = max(math.log(mean) - mean_log, 1e-9)
    shape = (3 - s + math.sqrt((s - 3) ** 2 + 24 * s)) / (12 * s)
    for _ in range(50):
        step = (math.log(shape) - digamma(shape) - s) / (1 / shape - trigamma(shape))
        step = min(max(step, -shape), shape / 2)  # keeps the shape above 0
        shape -= step
        if abs(step) < 1e-12 * shape:
            break
    return shape, mean / shape
