"""The catalogue of spreadsheet functions: names, aliases and the Column builders behind them.

A builder takes Columns or plain values and returns a Column. An error of the spreadsheet (#NUM!, #N/A and
so on) is NULL here. Aggregates return aggregate Columns for ``agg``; window functions take an ordering.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CATALOGUE: dict[str, Callable] = {}


def fn(*names: str):
    """Enter a builder under its spreadsheet names."""

    def add(f: Callable) -> Callable:
        for name in names:
            CATALOGUE[name] = f
        return f

    return add


def call(name: str, /, *args, **options) -> Column:
    """The named function applied to Columns or values; dots and case of the name as in a formula."""
    key = name.upper()
    if key not in CATALOGUE:
        raise KeyError(f"no function {name}")
    return CATALOGUE[key](*args, **options)


def c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def num(x) -> Column:
    return c(x).cast("double")


def ok(test: Column, value: Column) -> Column:
    """``value`` where ``test`` holds, else NULL (an error)."""
    return F.when(test, value)


def fold(values: Column, start, step: Callable[[Column, Column], Column]) -> Column:
    return F.aggregate(values, c(start), step)


def count_up(first, last) -> Column:
    """[first, ..., last] as longs, empty when last < first."""
    a, b = c(first).cast("bigint"), c(last).cast("bigint")
    return F.when(b >= a, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))
