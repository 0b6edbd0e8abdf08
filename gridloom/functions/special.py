"""Special functions on whole arrays: incomplete gamma and beta, and inversion of distributions; and a root solver.

Arguments outside a function's domain give NaN.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from statistics import NormalDist

import numpy as np

_TINY = 1e-300


_ERF, _ERFC, _LGAMMA, _GAMMA, _NORMAL = (np.frompyfunc(f, 1, 1) for f in (math.erf, math.erfc, math.lgamma, math.gamma, NormalDist().inv_cdf))


def _each(over: np.ufunc, x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """A function of the C library over an array; NaN where ``good`` does not hold."""
    out = np.full(x.shape, np.nan)
    out[good] = over(x[good])
    return out


def erf(x: np.ndarray) -> np.ndarray:
    return _each(_ERF, x, ~np.isnan(x))


def erfc(x: np.ndarray) -> np.ndarray:
    return _each(_ERFC, x, ~np.isnan(x))


def lgamma(x: np.ndarray) -> np.ndarray:
    return _each(_LGAMMA, x, (x > 0) & (x < 1e305))


def gamma(x: np.ndarray) -> np.ndarray:
    return _each(_GAMMA, x, (x < 171.6) & (x > -170) & ((x > 0) | (x != np.floor(x))))


def normal_inverse(p: np.ndarray) -> np.ndarray:
    return _each(_NORMAL, p, (p > 0) & (p < 1))


def _fraction(num: Callable[[int], np.ndarray], den: Callable[[int], np.ndarray]) -> np.ndarray:
    """1 / (den(0) + num(1) / (den(1) + num(2) / (den(2) + ...))), until every element has settled."""
    full = lambda v: np.where(v == 0, _TINY, v)
    d = 1 / full(den(0))
    c, value = np.full(d.shape, 1 / _TINY), d.copy()
    for n in range(1, 10_000):
        d = 1 / full(den(n) + num(n) * d)
        c = full(den(n) + num(n) / c)
        step = c * d
        value = value * step
        if not np.any(np.abs(step - 1) > 4e-16):
            break
    return value


def gamma_p(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma: a series below a + 1, a continued fraction above."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    out = np.where(np.isnan(a) | np.isnan(x) | (a <= 0), np.nan, 0.0)
    some = (x > 0) & (a > 0)
    low, high = some & (x < a + 1), some & (x >= a + 1)
    if low.any():
        k, y = a[low], x[low]
        term = 1 / k
        total, n = term.copy(), k.copy()
        while np.any(term > total * 1e-17):
            n = n + 1
            term = term * y / n
            total = total + term
        out[low] = total * np.exp(k * np.log(y) - y - lgamma(k))
    if high.any():
        k, y = a[high], x[high]
        out[high] = 1 - np.exp(k * np.log(y) - y - lgamma(k)) * _fraction(lambda n: -n * (n - k), lambda n: y + 2 * n + 1 - k)
    return out


def beta_i(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta; the fraction is used on the side where it converges fast."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, x)))
    out = np.where(np.isnan(a + b + x) | (a <= 0) | (b <= 0), np.nan, (x >= 1).astype(float))
    some = (x > 0) & (x < 1) & (a > 0) & (b > 0)
    far = some & (x > (a + 1) / (a + b + 2))
    for side, p, q, y in ((some & ~far, a, b, x), (far, b, a, 1 - x)):
        if side.any():
            p, q, y = p[side], q[side], y[side]
            lead = np.exp(p * np.log(y) + q * np.log1p(-y) + lgamma(p + q) - lgamma(p) - lgamma(q)) / p

            def num(n: int, p=p, q=q, y=y) -> np.ndarray:
                m = n // 2
                if n % 2 == 0:
                    return m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m))
                return -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))

            value = lead * _fraction(num, lambda n, y=y: np.ones(y.shape))
            out[side] = 1 - value if side is far else value
    return out


def invert(cdf: Callable[[np.ndarray], np.ndarray], p: np.ndarray, low: float, high: float) -> np.ndarray:
    """The x of a rising ``cdf`` at ``p``; open ends are found by doubling, then all are halved to the last bits."""
    p = np.asarray(p, float)
    lo, hi = np.full(p.shape, low), np.full(p.shape, high)
    if math.isinf(high):
        hi = np.full(p.shape, max(1.0, low + 1) if math.isfinite(low) else 1.0)
        while np.any(short := (cdf(hi) < p) & (hi < 1e300)):
            hi = np.where(short, hi * 2, hi)
    if math.isinf(low):
        lo = np.full(p.shape, -1.0)
        while np.any(short := (cdf(lo) > p) & (lo > -1e300)):
            lo = np.where(short, lo * 2, lo)
    for _ in range(400):
        middle = (lo + hi) / 2
        if np.all((middle == lo) | (middle == hi) | np.isnan(middle)):
            break
        less = cdf(middle) < p
        lo, hi = np.where(less, middle, lo), np.where(less, hi, middle)
    return (lo + hi) / 2


def student_cdf(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    tail = beta_i(df / 2, 0.5, df / (df + x * x)) / 2
    return np.where(x > 0, 1 - tail, tail)


def f_cdf(x: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    return np.where(x > 0, beta_i(d1 / 2, d2 / 2, d1 * x / (d1 * x + d2)), np.where(np.isnan(x), np.nan, 0.0))


def log_choose(n: np.ndarray, k: np.ndarray) -> np.ndarray:
    return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)


def binomial_pmf(k: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    inner = np.exp(log_choose(n, k) + k * np.log(p) + (n - k) * np.log1p(-p))
    return np.where((k < 0) | (k > n), 0.0, np.where((p == 0) | (p == 1), (k == n * p).astype(float), inner))


def solve(f: Callable[[np.ndarray], np.ndarray], guess: np.ndarray, low: float, high: float) -> np.ndarray:
    """A root of each element of ``f``: secant steps from the guess; where they fail, bisection of the first
    bracket found by widening; NaN where there is none."""
    a, b = guess + 0.0, guess + 1e-4
    out, going = np.full(b.shape, np.nan), np.isfinite(guess)
    for _ in range(60):
        fa, fb = f(a), f(b)
        going = going & ~((np.abs(fb) < 1e-12) | (fa == fb))
        if not going.any():
            break
        step = b - fb * (b - a) / (fb - fa)
        a, b = np.where(going, b, a), np.where(going, step, b)
        going = going & np.isfinite(step) & (step > low) & (step < high)
    good = np.isfinite(b) & (b > low) & (b < high) & (np.abs(f(b)) < 1e-9)
    out[good] = b[good]
    if good.all():
        return out
    points = [low + (guess - low) * t for t in (1e-9, 0.01, 0.1, 0.5, 0.9, 1.0)] + [np.minimum(guess + 2.0**k / 100, high) for k in range(40)]
    a, b, held = np.full(b.shape, np.nan), np.full(b.shape, np.nan), good | ~np.isfinite(guess)
    for left, right in zip(points, points[1:]):
        here = ~held & (f(left) * f(right) <= 0)
        a, b, held = np.where(here, left, a), np.where(here, right, b), held | here
    for _ in range(200):
        middle = (a + b) / 2
        first = f(a) * f(middle) <= 0
        a, b = np.where(first, a, middle), np.where(first, middle, b)
    return np.where(good, out, (a + b) / 2)
