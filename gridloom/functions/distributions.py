"""Probability distributions as Arrow functions, and tests that combine aggregates with a tail probability.

Spark has no special functions, so a batch of rows goes to Python as Arrow columns, and is computed as whole
arrays. Wrong arguments give NULL.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from gridloom.functions import special as S
from gridloom.functions.base import c, fn, num, ok


def vector(f: Callable[..., np.ndarray]) -> Callable[..., Column]:
    """``f`` on arrays of floats as a function of Columns; NaN and infinities give NULL."""

    def batch(*columns: pd.Series) -> pd.Series:
        with np.errstate(all="ignore"):
            values = [np.asarray(x, float) for x in columns]
            out = np.array(f(*values), float)
            out[~np.isfinite(out) | np.isnan(sum(values))] = np.nan
        return pd.Series(out).astype("float64")

    udf = pandas_udf(batch, DoubleType())
    return lambda *args: udf(*[c(int(a)).cast("double") if isinstance(a, bool) else num(a) for a in args])


def _sound(test: np.ndarray, value: np.ndarray) -> np.ndarray:
    return np.where(test, value, np.nan)


def _either(pdf, cdf):
    """A function with a last ``cumulative`` argument."""
    return lambda *a: np.where(a[-1] != 0, cdf(*a[:-1]), pdf(*a[:-1]))


def _norm(x, m, s, cumulative):
    z = (x - m) / s
    return _sound(s > 0, np.where(cumulative != 0, S.erfc(-z / np.sqrt(2)) / 2, np.exp(-z * z / 2) / (s * np.sqrt(2 * np.pi))))


_n_dist, _n_inv = vector(_norm), vector(lambda p, m, s: _sound(s > 0, m + s * S.normal_inverse(p)))
fn("NORM.DIST", "NORMDIST")(lambda x, m, s, cumulative=True: _n_dist(x, m, s, cumulative))
fn("NORM.S.DIST")(lambda z, cumulative=True: _n_dist(z, 0.0, 1.0, cumulative))
fn("NORMSDIST")(lambda z: _n_dist(z, 0.0, 1.0, True))
fn("NORM.INV", "NORMINV")(_n_inv)
fn("NORM.S.INV", "NORMSINV")(lambda p: _n_inv(p, 0.0, 1.0))
fn("GAUSS")(lambda z: _n_dist(z, 0.0, 1.0, True) - 0.5)
fn("PHI")(lambda x: F.exp(-num(x) * num(x) / 2) / F.sqrt(2 * F.pi()))
fn("CONFIDENCE", "CONFIDENCE.NORM")(lambda alpha, s, n: -_n_inv(num(alpha) / 2, 0.0, 1.0) * num(s) / F.sqrt(num(n)))
_erf, _erfc = vector(S.erf), vector(S.erfc)
fn("ERF")(lambda lo, hi=None: _erf(lo) if hi is None else _erf(hi) - _erf(lo))
fn("ERF.PRECISE")(_erf)
fn("ERFC", "ERFC.PRECISE")(_erfc)
fn("GAMMALN", "GAMMALN.PRECISE")(vector(S.lgamma))
fn("GAMMA")(vector(S.gamma))


def _gamma_pdf(x, a, b):
    inner = np.exp((a - 1) * np.log(x) - x / b - a * np.log(b) - S.lgamma(a))
    return _sound((x >= 0) & (a > 0) & (b > 0), np.where(x > 0, inner, np.where(a == 1, 1 / b, 0.0)))


def _gamma_cdf(x, a, b):
    return _sound((x >= 0) & (a > 0) & (b > 0), S.gamma_p(a, x / b))


def _gamma_inv(p, a, b):
    good = (p >= 0) & (p < 1) & (a > 0) & (b > 0)
    return _sound(good, S.invert(lambda x: S.gamma_p(a, x / b), np.where(good, p, np.nan), 0.0, np.inf))


fn("GAMMA.DIST", "GAMMADIST")(vector(_either(_gamma_pdf, _gamma_cdf)))
fn("GAMMA.INV", "GAMMAINV")(vector(_gamma_inv))
_two = lambda k: np.full(k.shape, 2.0)
_chi = vector(_either(lambda x, k: _gamma_pdf(x, k / 2, _two(k)), lambda x, k: _gamma_cdf(x, k / 2, _two(k))))
_chi_right = vector(lambda x, k: 1 - _gamma_cdf(x, k / 2, _two(k)))
fn("CHISQ.DIST")(_chi)
fn("CHISQ.DIST.RT", "CHIDIST")(_chi_right)
fn("CHISQ.INV")(vector(lambda p, k: _gamma_inv(p, k / 2, _two(k))))
fn("CHISQ.INV.RT", "CHIINV")(vector(lambda p, k: _gamma_inv(1 - p, k / 2, _two(k))))


def _poisson(k, m, cumulative):
    k, some = np.floor(k), m > 0
    exact = np.where(some, np.exp(k * np.log(m) - m - S.lgamma(k + 1)), (k == 0).astype(float))
    return _sound((k >= 0) & (m >= 0), np.where(cumulative != 0, 1 - S.gamma_p(k + 1, m), exact))


fn("POISSON.DIST", "POISSON")(vector(_poisson))


@fn("EXPON.DIST", "EXPONDIST")
def expon(x, rate, cumulative=True) -> Column:
    x, rate = num(x), num(rate)
    return ok((x >= 0) & (rate > 0), F.when(c(cumulative), -F.expm1(-rate * x)).otherwise(rate * F.exp(-rate * x)))


@fn("WEIBULL.DIST", "WEIBULL")
def weibull(x, a, b, cumulative=True) -> Column:
    x, a, b = num(x), num(a), num(b)
    p = F.pow(x / b, a)
    return ok((x >= 0) & (a > 0) & (b > 0), F.when(c(cumulative), -F.expm1(-p)).otherwise(a / b * F.pow(x / b, a - 1) * F.exp(-p)))


def _beta(x, a, b, cumulative, lo, hi):
    u = (x - lo) / (hi - lo)
    density = np.exp((a - 1) * np.log(u) + (b - 1) * np.log1p(-u) + S.lgamma(a + b) - S.lgamma(a) - S.lgamma(b)) / (hi - lo)
    return _sound((a > 0) & (b > 0) & (lo <= x) & (x <= hi) & (lo < hi), np.where(cumulative != 0, S.beta_i(a, b, u), density))


def _beta_inv(p, a, b, lo, hi):
    good = (p > 0) & (p < 1) & (a > 0) & (b > 0)
    return _sound(good, lo + (hi - lo) * S.invert(lambda x: S.beta_i(a, b, x), np.where(good, p, np.nan), 0.0, 1.0))


_beta_dist, _beta_q = vector(_beta), vector(_beta_inv)
fn("BETA.DIST")(lambda x, a, b, cumulative=True, lo=0.0, hi=1.0: _beta_dist(x, a, b, cumulative, lo, hi))
fn("BETADIST")(lambda x, a, b, lo=0.0, hi=1.0: _beta_dist(x, a, b, True, lo, hi))
fn("BETA.INV", "BETAINV")(lambda p, a, b, lo=0.0, hi=1.0: _beta_q(p, a, b, lo, hi))


def _t_pdf(x, k):
    return _sound(k >= 1, np.exp(S.lgamma((k + 1) / 2) - S.lgamma(k / 2)) / np.sqrt(k * np.pi) * (1 + x * x / k) ** (-(k + 1) / 2))


def _t_cdf(x, k):
    return _sound(k >= 1, S.student_cdf(x, k))


def _t_inv(p, k):
    good = (p > 0) & (p < 1) & (k >= 1)
    return _sound(good, S.invert(lambda x: S.student_cdf(x, k), np.where(good, p, np.nan), -np.inf, np.inf))


_t_two = vector(lambda x, k: 2 * (1 - _t_cdf(np.abs(x), k)))
fn("T.DIST")(vector(_either(_t_pdf, _t_cdf)))
fn("T.DIST.2T")(_t_two)
fn("T.DIST.RT")(vector(lambda x, k: 1 - _t_cdf(x, k)))
fn("TDIST")(lambda x, k, tails: ok(num(x) >= 0, _t_two(x, k) * num(tails) / 2))
fn("T.INV")(vector(_t_inv))
fn("T.INV.2T", "TINV")(vector(lambda p, k: _t_inv(1 - p / 2, k)))


def _f_pdf(x, a, b):
    lead = S.lgamma((a + b) / 2) - S.lgamma(a / 2) - S.lgamma(b / 2) + a / 2 * np.log(a / b)
    return _sound(x >= 0, np.exp(lead + (a / 2 - 1) * np.log(x) - (a + b) / 2 * np.log1p(a * x / b)))


def _f_inv(p, a, b):
    good = (p >= 0) & (p <= 1) & (a > 0) & (b > 0)
    return _sound(good, S.invert(lambda x: S.f_cdf(x, a, b), np.where(good, p, np.nan), 0.0, np.inf))


_f_right = vector(lambda x, a, b: 1 - S.f_cdf(x, a, b))
fn("F.DIST")(vector(_either(_f_pdf, S.f_cdf)))
fn("F.DIST.RT", "FDIST")(_f_right)
fn("F.INV")(vector(_f_inv))
fn("F.INV.RT", "FINV")(vector(lambda p, a, b: _f_inv(1 - p, a, b)))


def _binom(k, n, p, cumulative):
    k, n = np.floor(k), np.floor(n)
    upto = np.where(k == n, 1.0, S.beta_i(n - k, k + 1, 1 - p))
    return _sound((0 <= k) & (k <= n) & (0 <= p) & (p <= 1), np.where(cumulative != 0, upto, S.binomial_pmf(k, n, p)))


def _binom_inv(n, p, alpha):
    """The least k whose cumulative probability reaches alpha, halving all rows' ranges at once."""
    n = np.floor(n)
    good = (0 <= p) & (p <= 1) & (0 < alpha) & (alpha < 1) & (n >= 0)
    low, high = np.full(n.shape, -1.0), np.where(good, n, 0.0)
    while np.any(high - low > 1):
        k = np.floor((low + high) / 2)
        enough = np.where(k >= n, 1.0, S.beta_i(n - k, k + 1, 1 - p)) >= alpha - 1e-15
        open_ = high - low > 1
        low, high = np.where(open_ & ~enough, k, low), np.where(open_ & enough, k, high)
    return _sound(good, high)


fn("BINOM.DIST", "BINOMDIST")(vector(_binom))
fn("BINOM.INV", "CRITBINOM")(vector(_binom_inv))


def _negbinom(f, s, p, cumulative):
    f, s = np.floor(f), np.floor(s)
    exact = np.exp(S.log_choose(f + s - 1, s - 1) + s * np.log(p) + np.where(f > 0, f * np.log1p(-p), 0.0))
    return _sound((f >= 0) & (s >= 1) & (0 < p) & (p <= 1), np.where(cumulative != 0, S.beta_i(s, f + 1, p), exact))


_nb = vector(_negbinom)
fn("NEGBINOM.DIST")(lambda f, s, p, cumulative=False: _nb(f, s, p, cumulative))
fn("NEGBINOMDIST")(lambda f, s, p: _nb(f, s, p, False))


_ln = vector(lambda x, m, s, cumulative: _sound(x > 0, _norm(np.log(x), m, s, cumulative) / np.where(cumulative != 0, 1, x)))
fn("LOGNORM.DIST")(lambda x, m, s, cumulative=True: _ln(x, m, s, cumulative))
fn("LOGNORMDIST")(lambda x, m, s: _ln(x, m, s, True))
fn("LOGNORM.INV", "LOGINV")(lambda p, m, s: F.exp(_n_inv(p, m, s)))


def _hypergeom(k, n, good, total, cumulative):
    k, n, good, total = (np.floor(v) for v in (k, n, good, total))
    sound = (0 <= k) & (k <= np.minimum(n, good)) & (n <= total)
    whole = S.log_choose(total, n)
    one = lambda i: np.where((n - i <= total - good) & (i <= k), np.nan_to_num(np.exp(S.log_choose(good, i) + S.log_choose(total - good, n - i) - whole)), 0.0)
    upto = np.zeros(k.shape)
    most = np.where(sound & (cumulative != 0), k, -1.0)
    for i in range(int(np.nanmax(most, initial=-1)) + 1):
        upto = upto + one(np.full(k.shape, float(i)))
    return _sound(sound, np.where(cumulative != 0, upto, one(k)))


_hg = vector(_hypergeom)
fn("HYPGEOM.DIST")(lambda k, n, good, total, cumulative=False: _hg(k, n, good, total, cumulative))
fn("HYPGEOMDIST")(lambda k, n, good, total: _hg(k, n, good, total, False))


def chisq_test(actual: Column, expected: Column, degrees: int) -> tuple[Column, Callable[[Column], Column]]:
    """(aggregate, p-value of the aggregate): Spark keeps Arrow functions apart from aggregates."""
    statistic = F.sum(F.try_divide((num(actual) - num(expected)) * (num(actual) - num(expected)), num(expected)))
    return statistic, lambda s: _chi_right(s, float(degrees))


fn("CHISQ.TEST", "CHITEST")(chisq_test)


@fn("T.TEST", "TTEST")
def t_test(x, y, tails: int, kind: int) -> tuple[Column, Callable[[Column], Column]]:
    """Kinds 1 paired, 2 equal variances, 3 Welch: (aggregate struct<t, df>, p-value of it)."""
    x, y = num(x), num(y)
    if kind == 1:
        d = x - y
        t, df = F.try_divide(F.avg(d), F.stddev_samp(d) / F.sqrt(F.count(d))), F.count(d) - 1
    else:
        nx, ny, vx, vy = F.count(x), F.count(y), F.var_samp(x), F.var_samp(y)
        if kind == 2:
            df = nx + ny - 2
            pooled = ((nx - 1) * vx + (ny - 1) * vy) / df
            t = F.try_divide(F.avg(x) - F.avg(y), F.sqrt(pooled * (1 / nx + 1 / ny)))
        else:
            a, b = vx / nx, vy / ny
            t = F.try_divide(F.avg(x) - F.avg(y), F.sqrt(a + b))
            df = F.try_divide((a + b) * (a + b), a * a / (nx - 1) + b * b / (ny - 1))
    return F.struct(t.alias("t"), df.cast("double").alias("df")), lambda s: _t_two(F.abs(s["t"]), s["df"]) * tails / 2


@fn("F.TEST", "FTEST")
def f_test(x, y) -> tuple[Column, Callable[[Column], Column]]:
    stat = F.struct(F.try_divide(F.var_samp(num(x)), F.var_samp(num(y))).alias("f"), (F.count(num(x)) - 1).alias("a"), (F.count(num(y)) - 1).alias("b"))
    return stat, lambda s: 2 * F.least(_f_right(s["f"], s["a"], s["b"]), 1 - _f_right(s["f"], s["a"], s["b"]))


@fn("Z.TEST", "ZTEST")
def z_test(x, mean, sigma=None) -> tuple[Column, Callable[[Column], Column]]:
    spread = F.stddev_samp(num(x)) if sigma is None else num(sigma)
    return F.try_divide(F.avg(num(x)) - num(mean), spread / F.sqrt(F.count(num(x)))), lambda z: 1 - _n_dist(z, 0.0, 1.0, True)
