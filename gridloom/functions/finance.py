"""Annuities, depreciation, cash flows and coupon bonds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import special
from gridloom.functions.base import c, count_up, fn, fold, num, ok
from gridloom.functions.dates import year_frac
from gridloom.functions.distributions import vector


def _growth(rate, nper) -> Column:
    return F.pow(1 + num(rate), num(nper))


def _due(rate, kind) -> Column:
    return 1 + num(rate) * num(kind)


@fn("PMT")
def pmt(rate, nper, pv, fv=0, kind=0) -> Column:
    g = _growth(rate, nper)
    level = -(num(pv) + num(fv)) / num(nper)
    return F.when(num(rate) == 0, level).otherwise(F.try_divide(-num(rate) * (num(pv) * g + num(fv)), _due(rate, kind) * (g - 1)))


@fn("FV")
def fv(rate, nper, payment, pv=0, kind=0) -> Column:
    g = _growth(rate, nper)
    return F.when(num(rate) == 0, -(num(pv) + num(payment) * num(nper))).otherwise(-(num(pv) * g + num(payment) * _due(rate, kind) * F.try_divide(g - 1, num(rate))))


@fn("PV")
def pv(rate, nper, payment, fv=0, kind=0) -> Column:
    g = _growth(rate, nper)
    return F.when(num(rate) == 0, -(num(fv) + num(payment) * num(nper))).otherwise(-(num(fv) + num(payment) * _due(rate, kind) * F.try_divide(g - 1, num(rate))) / g)


@fn("NPER")
def nper(rate, payment, pv, fv=0, kind=0) -> Column:
    flow = F.try_divide(num(payment) * _due(rate, kind), num(rate))
    grown = F.ln(F.try_divide(flow - num(fv), flow + num(pv))) / F.ln(1 + num(rate))
    return F.when(num(rate) == 0, F.try_divide(-(num(pv) + num(fv)), num(payment))).otherwise(grown)


@fn("IPMT")
def ipmt(rate, per, n, value) -> Column:
    """Interest on what is left after per - 1 payments at each period's end."""
    left = -fv(rate, num(per) - 1, pmt(rate, n, value), value)
    return ok((num(per) >= 1) & (num(per) <= num(n)), -left * num(rate))


fn("PPMT")(lambda rate, per, n, value, fv=0, kind=0: pmt(rate, n, value, fv, kind) - ipmt(rate, per, n, value))


def _cumulative(part):
    def total(rate, n, value, start, end, kind=0) -> Column:
        return fold(count_up(start, end), 0.0, lambda a, p: a + part(rate, p, n, value))

    return total


fn("CUMIPMT")(_cumulative(ipmt))
fn("CUMPRINC")(_cumulative(lambda rate, p, n, value: pmt(rate, n, value) - ipmt(rate, p, n, value)))
fn("ISPMT")(lambda rate, per, n, value: num(value) * num(rate) * (num(per) / num(n) - 1))
fn("SLN")(lambda cost, salvage, life: F.try_divide(num(cost) - num(salvage), num(life)))
fn("SYD")(lambda cost, salvage, life, per: (num(cost) - num(salvage)) * (num(life) - num(per) + 1) * 2 / (num(life) * (num(life) + 1)))
fn("PDURATION")(lambda rate, pv, fv: ok((num(rate) > 0) & (num(pv) > 0) & (num(fv) > 0), F.ln(num(fv) / num(pv)) / F.ln(1 + num(rate))))
fn("RRI")(lambda n, pv, fv: ok((num(n) > 0) & (num(pv) != 0), F.pow(F.try_divide(num(fv), num(pv)), 1 / num(n)) - 1))
fn("EFFECT")(lambda rate, n: ok((num(rate) > 0) & (num(n) >= 1), F.pow(1 + num(rate) / F.floor(num(n)), F.floor(num(n))) - 1))
fn("NOMINAL")(lambda rate, n: ok((num(rate) > 0) & (num(n) >= 1), (F.pow(num(rate) + 1, 1 / F.floor(num(n))) - 1) * F.floor(num(n))))


def _dollar(x, fraction, to_decimal: bool) -> Column:
    f = F.floor(num(fraction))
    whole = F.signum(num(x)) * F.floor(F.abs(num(x)))
    scale = F.pow(F.lit(10.0), F.ceil(F.log10(f)))
    part = num(x) - whole
    return ok(f >= 1, whole + (part * scale / f if to_decimal else part * f / scale))


fn("DOLLARDE")(lambda x, fraction: _dollar(x, fraction, True))
fn("DOLLARFR")(lambda x, fraction: _dollar(x, fraction, False))


@fn("DB")
def db(cost, salvage, life, per, month=12) -> Column:
    """Declining balance with the rate rounded to three decimals; the first year has ``month`` months."""
    rate = F.bround(1 - F.pow(F.try_divide(num(salvage), num(cost)), 1 / num(life)), 3)
    first = num(cost) * rate * num(month) / 12
    before = fold(count_up(2, num(per) - 1), first, lambda a, _: a + (num(cost) - a) * rate)
    last = num(per) > num(life)
    middle = (num(cost) - before) * rate
    return F.when(num(per) == 1, first).when(last, middle * (12 - num(month)) / 12).otherwise(middle)


def _ddb_total(cost, salvage, life, upto, factor) -> Column:
    rate = F.least(num(factor) / num(life), F.lit(1.0))
    return fold(count_up(1, upto), 0.0, lambda a, _: a + F.greatest(F.least((num(cost) - a) * rate, num(cost) - num(salvage) - a), F.lit(0.0)))


fn("DDB")(lambda cost, salvage, life, per, factor=2: _ddb_total(cost, salvage, life, per, factor) - _ddb_total(cost, salvage, life, num(per) - 1, factor))


@fn("VDB")
def vdb(cost, salvage, life, start, end, factor=2, no_switch=False) -> Column:
    """Period by period, switching to straight line where that writes off more, with parts of periods."""
    cost, salvage, life, start, end = map(num, (cost, salvage, life, start, end))

    def period(state: Column, k: Column) -> Column:
        left = state["left"]
        rest = left - salvage
        falling = F.least(left * F.least(num(factor) / life, F.lit(1.0)), rest)
        level = F.when(life > k, rest / (life - k)).otherwise(rest)
        amount = F.greatest(falling if no_switch else F.greatest(falling, level), F.lit(0.0))
        share = F.greatest(F.least(end, k + 1.0) - F.greatest(start, k.cast("double")), F.lit(0.0))
        return F.struct((left - amount).alias("left"), (state["total"] + amount * share).alias("total"))

    return fold(count_up(0, F.ceil(end) - 1), F.struct(cost.alias("left"), F.lit(0.0).alias("total")), period)["total"]


def _rate(n, payment, pv, fv, kind, guess):
    def f(r):
        some = np.abs(r) >= 1e-12
        s = np.where(some, r, 1.0)
        g = (1 + s) ** n
        return np.where(some, pv * g + payment * (1 + s * kind) * (g - 1) / s + fv, pv + payment * n + fv)

    return special.solve(f, guess, -0.999999, 1e6)


_rate_udf = vector(_rate)
fn("RATE")(lambda n, payment, pv, fv=0, kind=0, guess=0.1: _rate_udf(n, payment, pv, fv, kind, guess))

# Cash flows in rows: the order is a column, so that they are aggregated, not gathered.
fn("NPV")(lambda rate, value, order: F.sum(num(value) / F.pow(1 + num(rate), num(order))))
fn("XNPV")(lambda rate, value, days: F.sum(num(value) / F.pow(1 + num(rate), num(days) / 365)))
fn("FVSCHEDULE")(lambda principal, rate: num(principal) * F.product(1 + num(rate)))


@fn("MIRR")
def mirr(value, order, finance_rate, reinvest_rate, n) -> Column:
    """``order`` counts flows from 0 to n - 1."""
    gain = F.sum(F.when(num(value) > 0, num(value) * F.pow(1 + num(reinvest_rate), num(n) - 1 - num(order))))
    cost = F.sum(F.when(num(value) < 0, num(value) / F.pow(1 + num(finance_rate), num(order))))
    return F.pow(F.try_divide(gain, -cost), 1 / (num(n) - 1)) - 1


def _worth(at: np.ndarray, amount: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Present values of flows at rates; beyond doubles, next to -100 %, the last flow gives the sign."""
    with np.errstate(all="ignore"):
        out = (amount / (1 + rate)[:, None] ** at).sum(1)
    return np.where(np.isfinite(out), out, np.copysign(1e300, amount[at.argmax()]))


def irr(df: DataFrame, keys: list[str], value: str, at: str, guess: float = 0.1, name: str = "irr") -> DataFrame:
    """IRR (``at``: order) or, with ``at`` in years, XIRR of each group: the root of the sum of v / (1 + r)^at.

    A group's flows of equal ``at`` are summed first, so the list handed to the solver holds one flow a date.
    """
    flows = df.groupBy(*keys, at).agg(F.sum(value).alias("v")).groupBy(*keys).agg(F.collect_list(F.struct(F.col(at).cast("double").alias("t"), F.col("v").cast("double").alias("v"))).alias("flows"))

    def root(batches):
        for b in batches:
            out = []
            for flows in b["flows"]:
                t, v = (np.array([x[k] for x in flows], float) for k in "tv")
                mixed = len(v) and v.min() < 0 < v.max()
                out.append(float(special.solve(lambda r: _worth(t, v, r), np.array([guess]), -0.999999, 1e6)[0]) if mixed else None)
            b = b.drop(columns=["flows"])
            b[name] = out
            yield b

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in flows.drop("flows").schema]
    return flows.mapInPandas(root, ", ".join([*fields, f"`{name}` double"]))


# Discount securities by day-count fractions.
_yf = lambda a, b, basis: year_frac(a, b, basis)
fn("ACCRINT")(lambda issue, first, settle, rate, par, freq, basis=0: num(par) * num(rate) * _yf(issue, settle, basis))
fn("ACCRINTM")(lambda issue, settle, rate, par=1000, basis=0: num(par) * num(rate) * _yf(issue, settle, basis))
fn("DISC")(lambda s, m, price, redemption, basis=0: F.try_divide(num(redemption) - num(price), num(redemption) * _yf(s, m, basis)))
fn("INTRATE")(lambda s, m, investment, redemption, basis=0: F.try_divide(num(redemption) - num(investment), num(investment) * _yf(s, m, basis)))
fn("RECEIVED")(lambda s, m, investment, discount, basis=0: F.try_divide(num(investment), 1 - num(discount) * _yf(s, m, basis)))
fn("PRICEDISC")(lambda s, m, discount, redemption, basis=0: num(redemption) * (1 - num(discount) * _yf(s, m, basis)))
fn("YIELDDISC")(lambda s, m, price, redemption, basis=0: F.try_divide(num(redemption) - num(price), num(price) * _yf(s, m, basis)))


@fn("PRICEMAT")
def price_mat(s, m, issue, rate, yld, basis=0) -> Column:
    whole, gone, left = _yf(issue, m, basis), _yf(issue, s, basis), _yf(s, m, basis)
    return F.try_divide(100 * (1 + whole * num(rate)), 1 + left * num(yld)) - 100 * gone * num(rate)


@fn("YIELDMAT")
def yield_mat(s, m, issue, rate, price, basis=0) -> Column:
    whole, gone, left = _yf(issue, m, basis), _yf(issue, s, basis), _yf(s, m, basis)
    return F.try_divide(F.try_divide(1 + whole * num(rate), num(price) / 100 + gone * num(rate)) - 1, left)


_days = lambda s, m: F.floor(num(m)) - F.floor(num(s))
fn("TBILLPRICE")(lambda s, m, discount: ok(_days(s, m).between(1, 366), 100 * (1 - num(discount) * _days(s, m) / 360)))
fn("TBILLYIELD")(lambda s, m, price: ok(_days(s, m).between(1, 366), (100 - num(price)) / num(price) * 360 / _days(s, m)))


@fn("TBILLEQ")
def tbill_eq(s, m, discount) -> Column:
    """Bond-equivalent yield; beyond half a year the one of a bill that pays interest once."""
    d, r = _days(s, m), num(discount)
    price, t = 1 - r * d / 360, d / 365
    long = (-2 * t + 2 * F.sqrt(t * t - (2 * t - 1) * (1 - 1 / price))) / (2 * t - 1)
    return ok(d.between(1, 366), F.when(d <= 182, 365 * r / (360 - r * d)).otherwise(long))


# Coupon schedules, on whole arrays. Days are whole numbers from 1970 on.
_EPOCH = 25569


def _month_of(days: np.ndarray) -> np.ndarray:
    return days.astype("M8[D]").astype("M8[M]").astype(np.int64)


def _first_of(months: np.ndarray) -> np.ndarray:
    return months.astype("M8[M]").astype("M8[D]").astype(np.int64)


def _split(days: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Month (from 1970 on), day of the month, and whether it is the last one of a February."""
    m = _month_of(days)
    return m, days - _first_of(m) + 1, (m % 12 == 1) & (days + 1 == _first_of(m + 1))


class Coupons:
    """The coupon before and after settlement and the number left; a month's last day stays a last day."""

    def __init__(self, settle, maturity, freq, basis):
        self.settle, self.maturity = (np.floor(np.nan_to_num(x)).astype(np.int64) - _EPOCH for x in (settle, maturity))
        self.sound = (self.settle < self.maturity) & np.isin(freq, (1, 2, 4))
        self.freq, self.basis = np.where(self.sound, freq, 1.0), basis
        self.step = (12 // self.freq).astype(np.int64)
        months = _month_of(self.maturity) - _month_of(self.settle)
        least = np.maximum(-(-months // self.step), 1)
        self.left = np.where(self._back(least) > self.settle, least + 1, least)
        self.before, self.after = self._back(self.left), self._back(self.left - 1)

    def _back(self, coupons: np.ndarray) -> np.ndarray:
        own = _month_of(self.maturity)
        m = own - coupons * self.step
        size = lambda k: _first_of(k + 1) - _first_of(k)
        at = self.maturity - _first_of(own) + 1
        return _first_of(m) + np.where(at == size(own), size(m), np.minimum(at, size(m))) - 1

    def days(self) -> np.ndarray:
        """Of the period that settlement falls in."""
        return np.where(self.basis == 1, self.after - self.before, np.where(self.basis == 3, 365, 360) / self.freq)

    def gone(self) -> np.ndarray:
        """Days from the coupon before to settlement."""
        (m1, d1, feb1), (m2, d2, feb2) = _split(self.before), _split(self.settle)
        us2 = np.where(feb1 & feb2, 30, d2)
        us1 = np.where(feb1, 30, d1)
        us2 = np.where((us2 == 31) & (us1 >= 30), 30, us2)
        european = np.minimum(d2, 30) - np.minimum(d1, 30)
        by_month = (m2 - m1) * 30 + np.where(self.basis == 4, european, us2 - np.minimum(us1, 30))
        return np.where(np.isin(self.basis, (0, 4)), by_month, self.settle - self.before).astype(float)

    def share(self) -> np.ndarray:
        return self.gone() / self.days()

    def price(self, rate, yld, redemption) -> np.ndarray:
        """Discounted coupons and redemption without the accrued interest; coupons by the sum of their geometric series."""
        n, gone, coupon, r = self.left, self.share(), 100 * rate / self.freq, yld / self.freq
        some = np.abs(r) > 1e-12
        s = np.where(some, r, 1.0)
        series = np.where(some, -np.expm1(-n * np.log1p(s)) * (1 + s) / s, n)
        many = coupon * (1 + r) ** (gone - 1) * series + redemption * (1 + r) ** (gone - n)
        return np.where(n == 1, (coupon + redemption) / (1 + (1 - gone) * r), many) - coupon * gone


def _coup(what: str):
    def f(settle, maturity, freq, basis):
        k = Coupons(settle, maturity, freq, basis)
        ahead = lambda: np.where(np.isin(basis, (0, 4)), k.days() - k.gone(), k.after - k.settle)
        values = {"ncd": lambda: k.after + _EPOCH, "pcd": lambda: k.before + _EPOCH, "num": lambda: k.left, "days": k.days, "daybs": k.gone, "daysnc": ahead}
        return np.where(k.sound, values[what](), np.nan)

    udf = vector(f)
    return lambda settle, maturity, freq, basis=0: udf(settle, maturity, freq, basis)


for _name, _what in {"COUPDAYS": "days", "COUPDAYBS": "daybs", "COUPDAYSNC": "daysnc", "COUPNCD": "ncd", "COUPPCD": "pcd", "COUPNUM": "num"}.items():
    fn(_name)(_coup(_what))


def _price(settle, maturity, rate, yld, redemption, freq, basis):
    k = Coupons(settle, maturity, freq, basis)
    return np.where(k.sound, k.price(rate, yld, redemption), np.nan)


def _yield(settle, maturity, rate, price, redemption, freq, basis):
    k = Coupons(settle, maturity, freq, basis)
    guess = np.where(k.sound & np.isfinite(price + rate + redemption), np.maximum(rate, 0.01), np.nan)
    return special.solve(lambda y: k.price(rate, y, redemption) - price, guess, -0.9, 100.0)


def _duration(settle, maturity, coupon, yld, freq, basis):
    """The mean time of the discounted flows."""
    k = Coupons(settle, maturity, freq, basis)
    gone, r, amount = k.share(), yld / k.freq, 100 * coupon / k.freq
    worth, timed = np.zeros(r.shape), np.zeros(r.shape)
    for i in range(int(np.where(k.sound, k.left, 0).max(initial=0))):
        t = i + 1 - gone
        own = np.where(i < k.left, (amount + np.where(i == k.left - 1, 100.0, 0.0)) / (1 + r) ** t, 0.0)
        worth, timed = worth + own, timed + t * own
    return np.where(k.sound, timed / worth / k.freq, np.nan)


_price_udf, _yield_udf, _duration_udf = vector(_price), vector(_yield), vector(_duration)
fn("PRICE")(lambda s, m, rate, yld, redemption, freq, basis=0: _price_udf(s, m, rate, yld, redemption, freq, basis))
fn("YIELD")(lambda s, m, rate, price, redemption, freq, basis=0: _yield_udf(s, m, rate, price, redemption, freq, basis))
fn("DURATION")(lambda s, m, coupon, yld, freq, basis=0: _duration_udf(s, m, coupon, yld, freq, basis))
fn("MDURATION")(lambda s, m, coupon, yld, freq, basis=0: _duration_udf(s, m, coupon, yld, freq, basis) / (1 + num(yld) / num(freq)))
fn("OFFSET")(lambda x, rows, order: F.lead(c(x), rows).over(order) if rows >= 0 else F.lag(c(x), -rows).over(order))
fn("IRR", "XIRR")(irr)
