"""Math, trigonometry and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.base import CATALOGUE, c, count_up, fn, fold, num, ok

for _name, _f in {
    "ABS": F.abs, "SIGN": F.signum, "LOG10": F.log10, "LN": F.ln, "EXP": F.exp, "SIN": F.sin, "COS": F.cos, "TAN": F.tan,
    "ASIN": F.asin, "ACOS": F.acos, "ATAN": F.atan, "SINH": F.sinh, "COSH": F.cosh, "TANH": F.tanh, "ASINH": F.asinh,
    "ACOSH": F.acosh, "ATANH": F.atanh, "DEGREES": F.degrees, "RADIANS": F.radians, "SEC": F.sec, "CSC": F.csc, "COT": F.cot,
    "FISHER": F.atanh, "FISHERINV": F.tanh,
}.items():
    CATALOGUE[_name] = lambda x, f=_f: F.when(~F.isnan(y := f(num(x))), y)

fn("PI")(lambda: F.pi())
fn("ATAN2")(lambda x, y: F.atan2(num(y), num(x)))
fn("SECH")(lambda x: 1 / F.cosh(num(x)))
fn("CSCH")(lambda x: F.try_divide(F.lit(1.0), F.sinh(num(x))))
fn("COTH")(lambda x: F.try_divide(F.lit(1.0), F.tanh(num(x))))
fn("ACOT")(lambda x: F.pi() / 2 - F.atan(num(x)))
fn("ACOTH")(lambda x: ok(F.abs(num(x)) > 1, F.ln((num(x) + 1) / (num(x) - 1)) / 2))
fn("INT")(lambda x: F.floor(num(x)).cast("double"))
fn("SQRT")(lambda x: ok(num(x) >= 0, F.sqrt(num(x))))
fn("SQRTPI")(lambda x: ok(num(x) >= 0, F.sqrt(num(x) * F.pi())))
fn("LOG")(lambda x, base=10: ok(num(x) > 0, F.ln(num(x)) / F.ln(num(base))))
fn("RAND")(lambda: F.rand())
fn("RANDBETWEEN")(lambda lo, hi: F.floor(F.rand() * (num(hi) - num(lo) + 1)) + num(lo))
fn("RANDARRAY")(lambda n: F.transform(count_up(1, n), lambda _: F.rand()))


def _scale(digits) -> Column:
    return F.pow(F.lit(10.0), num(digits))


@fn("TRUNC", "ROUNDDOWN")
def trunc(x, digits=0) -> Column:
    return F.signum(num(x)) * F.floor(F.abs(num(x)) * _scale(digits)) / _scale(digits)


@fn("ROUND")
def round_half_away(x, digits=0) -> Column:
    """Half away from zero; the decimal form of the double decides what is a half."""
    if isinstance(digits, int):
        return F.round(num(x), digits)
    return F.signum(num(x)) * F.floor(F.abs(num(x)) * _scale(digits) + 0.5) / _scale(digits)


@fn("ROUNDUP")
def round_up(x, digits=0) -> Column:
    return F.signum(num(x)) * F.ceil(F.abs(num(x)) * _scale(digits)) / _scale(digits)


@fn("CEILING")
def ceiling(x, step=1) -> Column:
    return F.when(num(step) == 0, F.lit(0.0)).when(~((num(x) > 0) & (num(step) < 0)), F.ceil(F.try_divide(num(x), num(step))) * num(step))


@fn("FLOOR")
def floor(x, step=1) -> Column:
    return ok((num(step) != 0) & ~((num(x) > 0) & (num(step) < 0)), F.floor(F.try_divide(num(x), num(step))) * num(step))


@fn("CEILING.MATH")
def ceiling_math(x, step=1, mode=0) -> Column:
    s = F.abs(num(step))
    away = (num(x) < 0) & (num(mode) != 0)
    q = F.try_divide(num(x), s)
    return F.when(s == 0, F.lit(0.0)).otherwise(F.when(away, F.floor(q)).otherwise(F.ceil(q)) * s)


@fn("FLOOR.MATH")
def floor_math(x, step=1, mode=0) -> Column:
    s = F.abs(num(step))
    toward = (num(x) < 0) & (num(mode) != 0)
    q = F.try_divide(num(x), s)
    return F.when(s == 0, F.lit(0.0)).otherwise(F.when(toward, F.ceil(q)).otherwise(F.floor(q)) * s)


fn("CEILING.PRECISE", "ISO.CEILING")(lambda x, step=1: ceiling_math(x, step))
fn("FLOOR.PRECISE")(lambda x, step=1: floor_math(x, step))
fn("MOD")(lambda x, n: ok(num(n) != 0, num(x) - num(n) * F.floor(F.try_divide(num(x), num(n)))))
fn("QUOTIENT")(lambda x, n: trunc(F.try_divide(num(x), num(n))))
fn("EVEN")(lambda x: F.signum(num(x)) * 2 * F.ceil(F.abs(num(x)) / 2))


@fn("ODD")
def odd(x) -> Column:
    up = F.ceil((F.abs(num(x)) - 1) / 2) * 2 + 1
    return F.when(num(x) == 0, F.lit(1.0)).otherwise(F.signum(num(x)) * F.greatest(up, F.lit(1)))


@fn("MROUND")
def mround(x, step) -> Column:
    q = F.try_divide(num(x), num(step))
    return F.when(num(step) == 0, F.lit(0.0)).when(num(x) * num(step) >= 0, F.floor(q + 0.5) * num(step))


@fn("POWER")
def power(x, y) -> Column:
    """0^0 is an error; an odd root of a negative number is taken."""
    x, y = num(x), num(y)
    root = F.round(F.try_divide(F.lit(1.0), y))
    odd_root = (x < 0) & (y != F.floor(y)) & (F.abs(root * y - 1) < 1e-12) & (root % 2 != 0)
    plain = F.pow(x, y)
    return F.when((x == 0) & (y <= 0), F.lit(None)).when(odd_root, -F.pow(-x, y)).when(~F.isnan(plain), plain)


def _product(values: Column) -> Column:
    return fold(F.transform(values, lambda v: v.cast("double")), 1.0, lambda a, v: a * v)


@fn("FACT")
def fact(x) -> Column:
    n = F.floor(num(x))
    return F.when(n > 170, F.lit(float("inf"))).when(n >= 0, _product(count_up(1, n)))


@fn("FACTDOUBLE")
def fact_double(x) -> Column:
    n = F.floor(num(x))
    return ok(n >= -1, _product(F.filter(count_up(1, n), lambda v: (n - v) % 2 == 0)))


@fn("COMBIN")
def combin(n, k) -> Column:
    n, k = F.floor(num(n)), F.floor(num(k))
    k = F.least(k, n - k)
    steps = count_up(1, k)
    return ok((n >= 0) & (k >= 0), F.round(fold(steps, 1.0, lambda a, i: a * (n - k + i) / i)))


fn("COMBINA")(lambda n, k: combin(num(n) + num(k) - 1, k))
fn("PERMUTATIONA")(lambda n, k: F.pow(num(n), num(k)))


@fn("PERMUT")
def permut(n, k) -> Column:
    n, k = F.floor(num(n)), F.floor(num(k))
    return ok((k >= 0) & (k <= n), _product(count_up(n - k + 1, n)))


@fn("MULTINOMIAL")
def multinomial(*values) -> Column:
    total, out = F.lit(0.0), F.lit(1.0)
    for v in values:
        total = total + num(v)
        out = out * combin(total, v)
    return out


@fn("SERIESSUM")
def series_sum(x, n, m, coefficients) -> Column:
    """``coefficients`` is an array column."""
    terms = F.transform(coefficients, lambda a, i: a.cast("double") * F.pow(num(x), num(n) + i * num(m)))
    return fold(terms, 0.0, lambda a, t: a + t)


def _gcd(a: Column, b: Column) -> Column:
    """Euclid in at most 80 steps, which is enough below 2^53."""
    pair = F.struct(F.abs(a).cast("bigint").alias("a"), F.abs(b).cast("bigint").alias("b"))
    step = lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), (s["a"] % F.when(s["b"] == 0, F.lit(1)).otherwise(s["b"])).alias("b")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(80)), pair, step, lambda s: s["a"])


@fn("GCD")
def gcd(*values) -> Column:
    """Of scalars; ``gcd_of(array)`` folds an array, such as a collected group."""
    return gcd_of(F.array(*[F.floor(num(v)).cast("bigint") for v in values])).cast("double")


def gcd_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, v: _gcd(a, v.cast("bigint")))


@fn("LCM")
def lcm(*values) -> Column:
    return lcm_of(F.array(*[F.floor(num(v)).cast("bigint") for v in values])).cast("double")


def lcm_of(values: Column) -> Column:
    def join(a: Column, v: Column) -> Column:
        v = F.abs(v.cast("bigint"))
        return F.when((a == 0) | (v == 0), F.lit(0).cast("bigint")).otherwise((F.try_divide(a, _gcd(a, v)) * v).cast("bigint"))

    return F.aggregate(values, F.lit(1).cast("bigint"), join)


#: Values of Roman digits and pairs, fixed values.
_ROMAN = ((1000, "M"), (900, "CM"), (500, "D"), (400, "CD"), (100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I"))


@fn("ROMAN")
def roman(x) -> Column:
    rest, out = F.floor(num(x)).cast("bigint"), F.lit("")
    parts = []
    for value, digits in _ROMAN:
        parts.append(F.repeat(F.lit(digits), F.floor(rest / value).cast("int")))
        rest = rest % value
    return ok((num(x) >= 0) & (num(x) < 4000), F.concat(out, *parts))


@fn("ARABIC")
def arabic(text) -> Column:
    """Digits add, or subtract before a greater one; a leading minus is allowed."""
    s = F.upper(F.trim(c(text)))
    body = F.regexp_replace(s, "^-", "")
    value = F.create_map(*[F.lit(x) for v, d in _ROMAN if len(d) == 1 for x in (d, v)])
    digits = F.transform(F.split(body, ""), lambda d: F.try_element_at(value, d))
    signed = F.transform(digits, lambda v, i: F.when(F.get(digits, i + 1) > v, -v).otherwise(v))
    total = F.aggregate(signed, F.lit(0), lambda a, v: a + v)
    return F.when(body == "", F.lit(0)).otherwise(F.when(s.startswith("-"), -total).otherwise(total)).cast("double")


@fn("BASE")
def base(x, radix, least=0) -> Column:
    text = F.conv(F.floor(num(x)).cast("bigint").cast("string"), 10, int(radix))
    return F.when(F.char_length(text) >= c(least), text).otherwise(F.lpad(text, int(least), "0"))


fn("DECIMAL")(lambda text, radix: F.conv(F.trim(c(text)), int(radix), 10).cast("double"))

# Aggregates over columns.
fn("SUM")(lambda *x: F.coalesce(F.sum(_total(x)), F.lit(0.0)))
fn("SUMSQ")(lambda *x: F.coalesce(F.sum(_total([num(v) * num(v) for v in x])), F.lit(0.0)))
fn("SUMX2MY2")(lambda x, y: F.sum(num(x) * num(x) - num(y) * num(y)))
fn("SUMX2PY2")(lambda x, y: F.sum(num(x) * num(x) + num(y) * num(y)))
fn("SUMXMY2")(lambda x, y: F.sum((num(x) - num(y)) * (num(x) - num(y))))
fn("PRODUCT")(lambda x: F.coalesce(F.product(num(x)), F.lit(1.0)))
fn("AVERAGE")(lambda x: F.avg(num(x)))
fn("COUNT")(lambda x: F.count(c(x).try_cast("double")))
fn("COUNTA")(lambda x: F.count(c(x)))
fn("COUNTBLANK")(lambda x: F.count_if(c(x).isNull() | (c(x).cast("string") == "")))
fn("MIN")(lambda x: F.coalesce(F.min(num(x)), F.lit(0.0)))
fn("MAX")(lambda x: F.coalesce(F.max(num(x)), F.lit(0.0)))


def _total(columns) -> Column:
    out = None
    for x in columns:
        out = num(x) if out is None else F.coalesce(out, F.lit(0.0)) + F.coalesce(num(x), F.lit(0.0))
    return out


@fn("SUMPRODUCT")
def sum_product(*columns) -> Column:
    out = F.coalesce(num(columns[0]), F.lit(0.0))
    for x in columns[1:]:
        out = out * F.coalesce(num(x), F.lit(0.0))
    return F.coalesce(F.sum(out), F.lit(0.0))


#: Codes of SUBTOTAL and AGGREGATE, fixed values.
CODES = {1: "AVERAGE", 2: "COUNT", 3: "COUNTA", 4: "MAX", 5: "MIN", 6: "PRODUCT", 7: "STDEV.S", 8: "STDEV.P", 9: "SUM", 10: "VAR.S", 11: "VAR.P", 12: "MEDIAN", 14: "LARGE", 15: "SMALL"}


@fn("SUBTOTAL")
def subtotal(code: int, x, hidden=None, is_subtotal=None) -> Column:
    """Codes 101 to 111 leave hidden rows out; rows that are subtotals never count."""
    keep = F.lit(True)
    if is_subtotal is not None:
        keep = keep & ~F.coalesce(c(is_subtotal), F.lit(False))
    if hidden is not None and code > 100:
        keep = keep & ~F.coalesce(c(hidden), F.lit(False))
    return CATALOGUE[CODES[code % 100]](F.when(keep, c(x)))


@fn("AGGREGATE")
def aggregate(code: int, options: int, x, k=None, error=None) -> Column:
    """Options 2, 3, 6 and 7 leave rows with an ``error`` out; otherwise any error makes the result one."""
    f = CATALOGUE[CODES[code]]
    extra = () if k is None else (k,)
    if error is None:
        return f(c(x), *extra)
    if options in (2, 3, 6, 7):
        return f(F.when(c(error).isNull(), c(x)), *extra)
    return F.when(F.count(c(error)) == 0, f(c(x), *extra))
