"""Criteria strings, conditional aggregates and the database functions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.base import CATALOGUE, c, fn, num
from gridloom.functions.text import wildcard_regex

_NEAR = 1e-10


def finite(x: Column) -> Column:
    """A number, NULL for text and for what only floating point calls a number."""
    n = x.try_cast("double")
    return F.when(~F.isnan(n) & (F.abs(n) < float("inf")), n)


def criterion(x: Column, text) -> Column:
    """The test of a criteria string: an operator and a value, a plain number, or text with wildcards.

    Equality of numbers has a tolerance of 1e-10, that of text ignores case; wildcards count only without
    an operator; an empty criterion holds for all. The result is never NULL.
    """
    if text is None or text == "":
        return F.lit(True)
    n = finite(x)
    if isinstance(text, (int, float)) and not isinstance(text, bool):
        return F.coalesce(F.abs(n - text) < _NEAR, F.lit(False))
    op, value = re.match(r"\s*(>=|<=|<>|>|<|=)?(.*)\s*$", str(text), re.S).groups()
    try:
        number = float(value)
        if number != number or abs(number) == float("inf"):
            number = None
    except ValueError:
        number = None
    s = F.coalesce(x.cast("string"), F.lit(""))
    if number is not None:
        equal = F.abs(n - number) < _NEAR
        tests = {None: equal, "=": equal, "<>": ~F.coalesce(equal, F.lit(False)), ">": n > number, "<": n < number, ">=": n >= number, "<=": n <= number}
    else:
        low, word = F.lower(s), value.lower()
        plain = F.rlike(s, F.lit(wildcard_regex(value))) if re.search(r"[*?~]", value) else low == word
        text_only = n.isNull() & (s != "")
        tests = {None: plain, "=": low == word, "<>": low != word, ">": text_only & (low > word), "<": text_only & (low < word), ">=": text_only & (low >= word), "<=": text_only & (low <= word)}
    return F.coalesce(tests[op], F.lit(False))


def all_of(*pairs) -> Column:
    """AND of (column, criterion, column, criterion, ...)."""
    return reduce(lambda a, b: a & b, [criterion(c(x), t) for x, t in zip(pairs[::2], pairs[1::2])])


fn("SUMIF")(lambda x, test, value=None: F.coalesce(F.sum(F.when(criterion(x, test), num(x if value is None else value))), F.lit(0.0)))
fn("SUMIFS")(lambda value, *pairs: F.coalesce(F.sum(F.when(all_of(*pairs), num(value))), F.lit(0.0)))
fn("COUNTIF")(lambda x, test: F.count_if(criterion(x, test)))
fn("COUNTIFS")(lambda *pairs: F.count_if(all_of(*pairs)))
fn("AVERAGEIF")(lambda x, test, value=None: F.avg(F.when(criterion(x, test), num(x if value is None else value))))
fn("AVERAGEIFS")(lambda value, *pairs: F.avg(F.when(all_of(*pairs), num(value))))
fn("MAXIFS")(lambda value, *pairs: F.coalesce(F.max(F.when(all_of(*pairs), num(value))), F.lit(0.0)))
fn("MINIFS")(lambda value, *pairs: F.coalesce(F.min(F.when(all_of(*pairs), num(value))), F.lit(0.0)))


fn("DISTINCTCOUNT")(lambda value, *pairs: F.count_distinct(F.when(all_of(*pairs), c(value)) if pairs else c(value)))


def block(rows: list[dict[str, object]]) -> Column:
    """A criteria block: rows are alternatives, the cells of a row all must hold; no rows hold for all."""
    if not rows:
        return F.lit(True)
    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [criterion(F.col(k), v) for k, v in r.items()], F.lit(True)) for r in rows])


def _database(name: str):
    def build(field: str, rows: list[dict[str, object]]) -> Column:
        return CATALOGUE[name](F.when(block(rows), F.col(field)))

    return build


for _d, _plain in {"DSUM": "SUM", "DCOUNT": "COUNT", "DCOUNTA": "COUNTA", "DAVERAGE": "AVERAGE", "DMAX": "MAX", "DMIN": "MIN", "DPRODUCT": "PRODUCT", "DSTDEV": "STDEV.S", "DSTDEVP": "STDEV.P", "DVAR": "VAR.S", "DVARP": "VAR.P"}.items():
    fn(_d)(_database(_plain))


@fn("DGET")
def dget(field: str, rows: list[dict[str, object]]) -> Column:
    """The only value that meets the block; NULL when there is none or more than one."""
    hit = block(rows)
    return F.when(F.count_if(hit) == 1, F.max(F.when(hit, F.col(field))))


def database(df: DataFrame, name: str, field: str, rows: list[dict[str, object]], keys: list[str] | None = None) -> DataFrame:
    """A database function of each group; the block is also a filter, so it reaches the scan."""
    return df.where(block(rows)).groupBy(*(keys or [])).agg(CATALOGUE[name](field, rows).alias(name.lower()))
