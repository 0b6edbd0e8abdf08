"""Number bases, units, bits and complex numbers written as text."""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.base import c, fn, num, ok

#: Digits of each base and the width of its two's complement numbers in digits, fixed values.
_BASES = {"BIN": (2, 10), "OCT": (8, 10), "HEX": (16, 10)}


def to_decimal(text, base: str) -> Column:
    """Ten digits at most; a set top bit of ten digits means a negative number."""
    radix, width = _BASES[base]
    t = F.upper(F.trim(c(text).cast("string")))
    digits = {2: "[01]", 8: "[0-7]", 16: "[0-9A-F]"}[radix]
    value = F.conv(t, radix, 10).cast("double")
    whole = float(radix**width)
    return ok(F.rlike(t, F.lit(f"^{digits}{{1,{width}}}$")), F.when(value >= whole / 2, value - whole).otherwise(value))


def from_decimal(x, base: str, places: int | None = None) -> Column:
    radix, width = _BASES[base]
    n, whole = F.floor(num(x)).cast("bigint"), radix**width
    text = F.conv(F.when(n < 0, n + whole).otherwise(n).cast("string"), 10, radix)
    inside = (n >= -whole // 2) & (n < whole // 2)
    if places is None:
        return ok(inside, text)
    return ok(inside & ((n < 0) | (F.char_length(text) <= places)), F.when(n < 0, text).otherwise(F.lpad(text, places, "0")))


for _a in _BASES:
    fn(f"{_a}2DEC")(lambda text, a=_a: to_decimal(text, a))
    fn(f"DEC2{_a}")(lambda x, places=None, a=_a: from_decimal(x, a, places))
    for _b in _BASES:
        if _a != _b:
            fn(f"{_a}2{_b}")(lambda text, places=None, a=_a, b=_b: from_decimal(to_decimal(text, a), b, places))

_LIMIT = 1 << 48


def _bits(f):
    def build(a, b) -> Column:
        x, y = num(a), num(b)
        good = (x >= 0) & (y >= 0) & (x < _LIMIT) & (y < _LIMIT) & (x == F.floor(x)) & (y == F.floor(y))
        return ok(good, f(x.cast("bigint"), y.cast("bigint")).cast("double"))

    return build


fn("BITAND")(_bits(lambda x, y: x.bitwiseAND(y)))
fn("BITOR")(_bits(lambda x, y: x.bitwiseOR(y)))
fn("BITXOR")(_bits(lambda x, y: x.bitwiseXOR(y)))


def _shift(x, by, left: bool) -> Column:
    by = num(by) if left else -num(by)
    moved = F.floor(num(x) * F.pow(F.lit(2.0), by))
    return ok((num(x) >= 0) & (num(x) < _LIMIT) & (F.abs(by) <= 53) & (moved < _LIMIT), moved.cast("double"))


fn("BITLSHIFT")(lambda x, by: _shift(x, by, True))
fn("BITRSHIFT")(lambda x, by: _shift(x, by, False))
fn("DELTA")(lambda a, b=0: (num(a) == num(b)).cast("int"))
fn("GESTEP")(lambda x, step=0: (num(x) >= num(step)).cast("int"))

#: Units by kind, each with its size in the kind's first unit, fixed values.
UNITS = {
    "mass": {"g": 1.0, "sg": 14593.9029372064, "lbm": 453.59237, "u": 1.66053906660e-24, "ozm": 28.349523125, "grain": 0.06479891, "stone": 6350.29318, "ton": 907184.74, "uk_ton": 1016046.9088},
    "length": {"m": 1.0, "mi": 1609.344, "Nmi": 1852.0, "in": 0.0254, "ft": 0.3048, "yd": 0.9144, "ang": 1e-10, "ell": 1.143, "ly": 9.4607304725808e15, "pc": 3.08567758149137e16, "Pica": 0.0254 / 72, "pica": 0.0254 / 6, "survey_mi": 1609.347218694},
    "time": {"sec": 1.0, "s": 1.0, "yr": 31557600.0, "day": 86400.0, "d": 86400.0, "hr": 3600.0, "mn": 60.0, "min": 60.0},
    "pressure": {"Pa": 1.0, "p": 1.0, "atm": 101325.0, "at": 101325.0, "mmHg": 133.322, "psi": 6894.757293168361, "Torr": 101325.0 / 760},
    "force": {"N": 1.0, "dyn": 1e-5, "dy": 1e-5, "lbf": 4.4482216152605, "pond": 0.00980665},
    "energy": {"J": 1.0, "e": 1e-7, "c": 4.184, "cal": 4.1868, "eV": 1.602176634e-19, "ev": 1.602176634e-19, "HPh": 2684519.537696173, "Wh": 3600.0, "wh": 3600.0, "flb": 1.3558179483314004, "BTU": 1055.05585262, "btu": 1055.05585262},
    "power": {"W": 1.0, "w": 1.0, "HP": 745.6998715822702, "h": 745.6998715822702, "PS": 735.49875},
    "magnetism": {"T": 1.0, "ga": 1e-4},
    "volume": {"l": 1.0, "L": 1.0, "lt": 1.0, "tsp": 0.00492892159375, "tbs": 0.01478676478125, "oz": 0.0295735295625, "cup": 0.2365882365, "pt": 0.473176473, "us_pt": 0.473176473, "uk_pt": 0.56826125, "qt": 0.946352946, "gal": 3.785411784, "uk_gal": 4.54609, "m3": 1000.0, "ft3": 28.316846592, "in3": 0.016387064, "yd3": 764.554857984, "barrel": 158.987294928},
    "area": {"m2": 1.0, "ar": 100.0, "ha": 10000.0, "uk_acre": 4046.8564224, "us_acre": 4046.872609874, "ft2": 0.09290304, "in2": 0.00064516, "yd2": 0.83612736, "mi2": 2589988.110336, "Nmi2": 3429904.0},
    "information": {"bit": 1.0, "byte": 8.0},
    "speed": {"m/s": 1.0, "m/sec": 1.0, "m/h": 1 / 3600, "mph": 0.44704, "kn": 1852 / 3600, "admkn": 0.514773333333333},
}
#: Prefixes, fixed values.
PREFIXES = {"Y": 1e24, "Z": 1e21, "E": 1e18, "P": 1e15, "T": 1e12, "G": 1e9, "M": 1e6, "k": 1e3, "h": 1e2, "da": 1e1, "d": 1e-1, "c": 1e-2, "m": 1e-3, "u": 1e-6, "n": 1e-9, "p": 1e-12, "f": 1e-15, "a": 1e-18}
_METRIC = {"g", "m", "sec", "s", "Pa", "p", "N", "dyn", "J", "e", "c", "cal", "eV", "Wh", "W", "T", "l", "L", "ar", "bit", "byte", "K", "m/s"}
_HEAT = {"C": (1.0, 273.15), "cel": (1.0, 273.15), "F": (5 / 9, 459.67 * 5 / 9), "fah": (5 / 9, 459.67 * 5 / 9), "K": (1.0, 0.0), "kel": (1.0, 0.0), "Rank": (5 / 9, 0.0), "Reau": (1.25, 273.15)}


def _unit(name: str) -> tuple[str, float] | None:
    for kind, units in UNITS.items():
        if name in units:
            return kind, units[name]
    for prefix in sorted(PREFIXES, key=len, reverse=True):
        rest = name[len(prefix) :]
        if name.startswith(prefix) and rest in _METRIC:
            for kind, units in UNITS.items():
                if rest in units:
                    return kind, PREFIXES[prefix] * units[rest]
    return None


@fn("CONVERT")
def convert(x, source: str, target: str) -> Column:
    if source in _HEAT and target in _HEAT:
        (a, b), (p, q) = _HEAT[source], _HEAT[target]
        return (num(x) * a + b - q) / p
    one, two = _unit(source), _unit(target)
    return F.lit(None).cast("double") if one is None or two is None or one[0] != two[0] else num(x) * (one[1] / two[1])


# Complex numbers: text at the edges, struct<re, im> inside.
_NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, so that nested calls stay small."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: A real part that the end or a sign follows; possessive, as it is matched for every cell.
_REAL = r"^([+-]?[0-9.]++(?:[eE][+-]?[0-9]++)?+)(?=[+-]|$)"


def parse_complex(z) -> Column:
    """struct<re, im> of "a+bi", "bi" or "a"; NULL for other text."""

    def read(t: Column) -> Column:
        known = F.translate(t, "0123456789.eE+-ij", "") == ""  # a cast takes more for a number than these write
        return F.struct(F.when(known, t).alias("t"), F.regexp_extract(t, _REAL, 1).alias("re"))

    def cut(p: Column) -> Column:
        return F.struct(p["re"].alias("re"), F.substr(p["t"], F.length(p["re"]) + 1).alias("im"))

    def made(p: Column) -> Column:
        real, imag = p["re"], p["im"]
        size = F.left(imag, F.length(imag) - 1)
        unit = F.when(size.isin("", "+"), F.lit(1.0)).when(size == "-", F.lit(-1.0)).otherwise(size.try_cast("double"))
        unit = F.when(imag == "", F.when(real != "", F.lit(0.0))).when(F.right(imag, F.lit(1)).isin("i", "j"), unit)
        return _pair(F.when(real == "", F.lit(0.0)).otherwise(real.try_cast("double")), unit)

    parts = _let(_let(_let(F.regexp_replace(c(z).cast("string"), r"\s", ""), read), cut), made)
    return _let(parts, lambda w: F.when(w["re"].isNotNull() & w["im"].isNotNull(), w))


def _part(x: Column) -> Column:
    """A double as a spreadsheet writes it, in up to 14 decimals."""

    def write(near: Column) -> Column:
        whole = (near == F.floor(near)) & (F.abs(near) < 1e15)
        return F.when(whole, near.cast("bigint").cast("string")).otherwise(F.regexp_replace(F.format_string("%.14f", near), r"\.?0+$", ""))

    return _let(F.when(F.abs(x - F.rint(x)) < 1e-12, F.rint(x)).otherwise(x), write)


def show_complex(z: Column, suffix: str = "i") -> Column:
    def write(w: Column) -> Column:
        re_, size = w["re"], w["size"]
        sign = F.when(w["below"], "-").otherwise(F.when(re_ == "0", "").otherwise("+"))
        tail = F.concat(sign, F.when(size == "1", "").otherwise(size), F.lit(suffix))
        return F.when(size == "0", re_).otherwise(F.concat(F.when(re_ == "0", "").otherwise(re_), tail))

    parts = _let(z, lambda v: F.struct(_part(v["re"]).alias("re"), _part(F.abs(v["im"])).alias("size"), (v["im"] < 0).alias("below")))
    return _let(parts, write)


def _pair(re_, im) -> Column:
    return F.struct(re_.alias("re"), im.alias("im"))


def _times(a: Column, b: Column) -> Column:
    return _let(F.struct(a.alias("a"), b.alias("b")), lambda p: _pair(p["a"]["re"] * p["b"]["re"] - p["a"]["im"] * p["b"]["im"], p["a"]["re"] * p["b"]["im"] + p["a"]["im"] * p["b"]["re"]))


def _over(a: Column, b: Column) -> Column:
    def divide(p: Column) -> Column:
        x, y = p["a"], p["b"]
        size = y["re"] * y["re"] + y["im"] * y["im"]
        return _pair(F.try_divide(x["re"] * y["re"] + x["im"] * y["im"], size), F.try_divide(x["im"] * y["re"] - x["re"] * y["im"], size))

    return _let(F.struct(a.alias("a"), b.alias("b")), divide)


fn("COMPLEX")(lambda re_, im, suffix="i": show_complex(_pair(num(re_), num(im)), suffix))
fn("IMREAL")(lambda z: parse_complex(z)["re"])
fn("IMAGINARY")(lambda z: parse_complex(z)["im"])
fn("IMABS")(lambda z: F.hypot(parse_complex(z)["re"], parse_complex(z)["im"]))
fn("IMARGUMENT")(lambda z: F.atan2(parse_complex(z)["im"], parse_complex(z)["re"]))
fn("IMCONJUGATE")(lambda z: show_complex(_pair(parse_complex(z)["re"], -parse_complex(z)["im"])))
fn("IMSUB")(lambda a, b: show_complex(_pair(parse_complex(a)["re"] - parse_complex(b)["re"], parse_complex(a)["im"] - parse_complex(b)["im"])))
fn("IMDIV")(lambda a, b: show_complex(_over(parse_complex(a), parse_complex(b))))


@fn("IMSUM")
def im_sum(*z) -> Column:
    parts = [parse_complex(v) for v in z]
    return show_complex(_pair(sum((p["re"] for p in parts), F.lit(0.0)), sum((p["im"] for p in parts), F.lit(0.0))))


@fn("IMPRODUCT")
def im_product(*z) -> Column:
    out = _pair(F.lit(1.0), F.lit(0.0))
    for v in z:
        out = _times(out, parse_complex(v))
    return show_complex(out)


def _complex(part: Callable[[Column, Column], Column]) -> Callable[[Column], Column]:
    """A function of a complex number's struct, from one of its two parts."""
    return lambda w: part(w["re"], w["im"])


def _polar(size: Column, angle: Column) -> Column:
    return _pair(size * F.cos(angle), size * F.sin(angle))


_log = lambda base: _complex(lambda a, b: _pair(F.ln(F.hypot(a, b)) / base, F.atan2(b, a) / base))
_sin = _complex(lambda a, b: _pair(F.sin(a) * F.cosh(b), F.cos(a) * F.sinh(b)))
_cos = _complex(lambda a, b: _pair(F.cos(a) * F.cosh(b), -F.sin(a) * F.sinh(b)))
_sinh = _complex(lambda a, b: _pair(F.sinh(a) * F.cos(b), F.cosh(a) * F.sin(b)))
_cosh = _complex(lambda a, b: _pair(F.cosh(a) * F.cos(b), F.sinh(a) * F.sin(b)))
_one = lambda: _pair(F.lit(1.0), F.lit(0.0))


def _inverse(f):
    return lambda w: _over(_one(), f(w))


def _shown(f):
    """The spreadsheet function of a function on structs; what overflows or has no value is an error."""
    known = lambda x: F.when(F.abs(x) < float("inf"), x)  # noqa: E731  NaN is not below infinity
    whole = lambda w: _let(f(w), lambda v: _pair(known(v["re"]), known(v["im"])))
    return lambda z: show_complex(_let(parse_complex(z), whole))


for _name, _f in {
    "IMSQRT": _complex(lambda a, b: _polar(F.sqrt(F.hypot(a, b)), F.atan2(b, a) / 2)), "IMEXP": _complex(lambda a, b: _polar(F.exp(a), b)),
    "IMLN": _log(1.0), "IMLOG10": _log(math.log(10)), "IMLOG2": _log(math.log(2)), "IMSIN": _sin, "IMCOS": _cos, "IMTAN": lambda w: _over(_sin(w), _cos(w)),
    "IMSINH": _sinh, "IMCOSH": _cosh, "IMSEC": _inverse(_cos), "IMCSC": _inverse(_sin), "IMCOT": lambda w: _over(_cos(w), _sin(w)), "IMSECH": _inverse(_cosh),
    "IMCSCH": _inverse(_sinh),
}.items():
    fn(_name)(_shown(_f))
fn("IMPOWER")(lambda z, n: _shown(_complex(lambda a, b: _polar(F.pow(F.hypot(a, b), num(n)), F.atan2(b, a) * num(n))))(z))
