"""Range operations: type-aware sorting, filters, conditional formats, scales, validation and totals rows."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.arrays import sum_before
from gridloom.functions.order_stats import order_statistics, with_statistics

_S = lambda x: F.coalesce(x.cast("string"), F.lit(""))
_N = lambda x: x.try_cast("double")
_SURE = lambda p: F.coalesce(p, F.lit(False))


def parse_sort(text: str) -> list[tuple[str, bool]]:
    """``"price desc, name asc"`` (or with colons) as (column, descending)."""
    out = []
    for part in text.split(","):
        name, _, way = part.strip().replace(":", " ").rpartition(" ")
        if way.lower() not in ("asc", "desc"):
            name, way = part.strip(), "asc"
        out.append((name.strip(), way.lower() == "desc"))
    return out


def sort_rows(df: DataFrame, keys: str | list[tuple[str, bool]], order: str | None = None) -> DataFrame:
    """Numbers before text before blanks whatever the direction; text without case; ``order`` settles ties."""
    columns = []
    for name, descending in parse_sort(keys) if isinstance(keys, str) else keys:
        x = F.col(name)
        rank = F.when(_S(x) == "", 2).when(_N(x).isNotNull(), 0).otherwise(1)
        way = (lambda k: k.desc_nulls_last()) if descending else (lambda k: k.asc_nulls_last())
        columns += [rank.asc(), way(_N(x)), way(F.lower(_S(x)))]
    return df.orderBy(*columns, *([F.col(order).asc()] if order else []))


def filter_test(x: Column, op: str, value=None, other=None) -> Column:
    """One autofilter criterion as a predicate that is never NULL."""
    s, low = F.lower(_S(x)), str(value).lower()
    tests = {
        "equals": lambda: s == low,
        "notEquals": lambda: s != low,
        "contains": lambda: s.contains(low),
        "doesNotContain": lambda: ~s.contains(low),
        "beginsWith": lambda: s.startswith(low),
        "endsWith": lambda: s.endswith(low),
        "gt": lambda: _N(x) > value,
        "gte": lambda: _N(x) >= value,
        "lt": lambda: _N(x) < value,
        "lte": lambda: _N(x) <= value,
        "between": lambda: _N(x).between(value, other),
        "notBetween": lambda: ~_N(x).between(value, other),
        "values": lambda: s.isin([str(v).lower() for v in value]),
        "blanks": lambda: s == "",
        "nonBlanks": lambda: s != "",
    }
    return _SURE(tests[op]())


def autofilter(df: DataFrame, criteria: dict[str, list[tuple]]) -> DataFrame:
    """Columns are joined by AND; several criteria of one column by OR.

    ("top", n), ("bottom", n) and their percent forms keep ranked rows, ties included. The cut is found by a
    bounded sort or a percentile, so no window holds all rows.
    """
    for name, tests in criteria.items():
        plain = [filter_test(F.col(name), *t) for t in tests if t[0] not in ("top", "bottom", "topPercent", "bottomPercent")]
        if plain:
            df = df.where(reduce(lambda a, b: a | b, plain))
        for kind, n in [t for t in tests if t[0] in ("top", "bottom", "topPercent", "bottomPercent")]:
            df = df.where(_SURE(F.col(name) >= ranked_cut(df, name, kind, n) if kind.startswith("top") else F.col(name) <= ranked_cut(df, name, kind, n)))
    return df


def ranked_cut(df: DataFrame, name: str, kind: str, n: float) -> Column:
    """The value at which the first (last) n rows or percent of them end, as a scalar subquery."""
    x, top = F.col(name), kind.startswith("top")
    known = df.where(x.isNotNull()).select(x.alias("x"))
    rows = int(n)
    if kind.endswith("Percent"):
        rows = max(1, int(known.count() * n / 100))
        if known.schema["x"].dataType.simpleString() in ("double", "float", "int", "smallint", "tinyint"):
            return order_statistics(known, [], "x", {"cut": ("large" if top else "small", rows)}).select("cut").scalar()
    first = known.orderBy(F.desc("x") if top else F.asc("x")).limit(rows)
    return first.agg(F.min("x") if top else F.max("x")).scalar()


# Conditional formats as flags.
def cell_is(x: Column, op: str, a, b=None) -> Column:
    n = _N(x)
    tests = {"greaterThan": lambda: n > a, "lessThan": lambda: n < a, "greaterThanOrEqual": lambda: n >= a, "lessThanOrEqual": lambda: n <= a, "equal": lambda: n == a, "notEqual": lambda: n != a, "between": lambda: n.between(a, b), "notBetween": lambda: ~n.between(a, b)}
    return _SURE(tests[op]())


def text_rule(x: Column, op: str, value: str) -> Column:
    names = {"containsText": "contains", "notContainsText": "doesNotContain", "beginsWith": "beginsWith", "endsWith": "endsWith"}
    return filter_test(x, names[op], value)


def top_flag(x: Column, n: float, percent: bool = False, bottom: bool = False, keys: list | None = None) -> Column:
    """Rows among the first n, or percent, of their keys; ties of the last place are in. ``flag_top`` takes whole tables."""
    w = Window.partitionBy(*_needed(keys, "flag_top")).orderBy(x.asc_nulls_last() if bottom else x.desc_nulls_last())
    size = F.count(x).over(Window.partitionBy(*keys))
    limit = F.greatest(F.floor(size * n / 100), F.lit(1)) if percent else F.lit(n)
    return _SURE(x.isNotNull() & (F.rank().over(w) <= limit))


def average_flag(x: Column, above: bool = True, deviations: int = 0, equal: bool = False, keys: list | None = None) -> Column:
    """Above (below) their keys' mean, moved by so many population standard deviations. ``flag_average`` takes whole tables."""
    w = Window.partitionBy(*_needed(keys, "flag_average"))
    return _beyond(x, F.avg(x).over(w) + F.stddev_pop(x).over(w) * (deviations if above else -deviations), above, equal)


def _needed(keys: list | None, instead: str) -> list:
    if not keys:
        raise ValueError(f"a window without keys is one task; use {instead}(df, name, ...)")
    return keys


def _beyond(x: Column, line: Column, above: bool, equal: bool) -> Column:
    hit = (x > line) if above else (x < line)
    return _SURE(hit | (x == line) if equal else hit)


def flag_top(df: DataFrame, name: str, n: float, percent: bool = False, bottom: bool = False, flag: str = "flag") -> DataFrame:
    """``df`` with a flag for the first n rows, or percent, of the whole table, ties included: a comparison with one value."""
    kind = ("bottom" if bottom else "top") + ("Percent" if percent else "")
    x, cut = F.col(name), ranked_cut(df, name, kind, n)
    return df.withColumn(flag, _SURE(x <= cut if bottom else x >= cut))


def flag_average(df: DataFrame, name: str, above: bool = True, deviations: int = 0, equal: bool = False, flag: str = "flag") -> DataFrame:
    """``df`` with a flag for values beyond the whole table's mean: a comparison with one value."""
    x = F.col(name)
    line = df.agg((F.avg(x) + F.stddev_pop(x) * (deviations if above else -deviations)).alias("line")).scalar()
    return df.withColumn(flag, _beyond(x, line, above, equal))


def repeated_flag(x: Column, unique: bool = False, keys: list | None = None) -> Column:
    """Values met more than once (or once) in their keys, text without case; blanks are neither."""
    n = F.count("*").over(Window.partitionBy(*(keys or []), F.lower(_S(x))))
    return _SURE((_S(x) != "") & ((n == 1) if unique else (n > 1)))


PERIODS = ("today", "yesterday", "tomorrow", "last7Days", "thisWeek", "lastWeek", "nextWeek", "thisMonth", "lastMonth", "nextMonth")


def date_occurring(d: Column, period: str, today: dt.date | None = None) -> Column:
    """A date in a period around ``today``; weeks begin on Sunday."""
    now = F.lit(today) if today else F.current_date()
    week = F.date_sub(now, F.dayofweek(now) - 1)
    day = d.cast("date")
    month = lambda k: F.trunc(F.add_months(now, k), "month")
    tests = {
        "today": day == now,
        "yesterday": day == F.date_sub(now, 1),
        "tomorrow": day == F.date_add(now, 1),
        "last7Days": day.between(F.date_sub(now, 6), now),
        "thisWeek": day.between(week, F.date_add(week, 6)),
        "lastWeek": day.between(F.date_sub(week, 7), F.date_sub(week, 1)),
        "nextWeek": day.between(F.date_add(week, 7), F.date_add(week, 13)),
        "thisMonth": F.trunc(day, "month") == month(0),
        "lastMonth": F.trunc(day, "month") == month(-1),
        "nextMonth": F.trunc(day, "month") == month(1),
    }
    return _SURE(tests[period])


def scaled(df: DataFrame, name: str, keys: list[str], out: str = "share") -> DataFrame:
    """Data bars and colour scales: each value's place between its keys' least (0) and greatest (1)."""
    ends = df.groupBy(*keys).agg(F.min(name).alias("__lo"), F.max(name).alias("__hi"))
    joined = df.join(ends, keys) if keys else df.crossJoin(F.broadcast(ends))  # one row
    return joined.withColumn(out, F.coalesce(F.try_divide(F.col(name) - F.col("__lo"), F.col("__hi") - F.col("__lo")), F.lit(0.0))).drop("__lo", "__hi")


def icon(share: Column, icons: int = 3) -> Column:
    """The number of an icon set's icon, from 0, by equal parts of the scale."""
    return F.least(F.floor(share * icons), F.lit(icons - 1)).cast("int")


def valid(x: Column, rule: str, op: str = "between", a=None, b=None, blank_ok: bool = True) -> Column:
    """A validation rule as a flag: list, whole, decimal, date, time, textLength or custom (``a`` is the test)."""
    blank = _S(x) == ""
    if rule == "custom":
        good = a
    elif rule == "list":
        good = F.lower(_S(x)).isin([str(v).lower() for v in a])
    else:
        n = {"whole": lambda: _N(x), "decimal": lambda: _N(x), "date": lambda: x.try_cast("date"), "time": lambda: F.date_format(x, "HH:mm:ss"), "textLength": lambda: F.char_length(_S(x))}[rule]()
        names = {"between": lambda: n.between(a, b), "notBetween": lambda: ~n.between(a, b), "equal": lambda: n == a, "notEqual": lambda: n != a, "greaterThan": lambda: n > a, "lessThan": lambda: n < a, "greaterThanOrEqual": lambda: n >= a, "lessThanOrEqual": lambda: n <= a}
        good = names[op]()
        if rule == "whole":
            good = good & (_N(x) == F.floor(_N(x)))
    return (blank & F.lit(blank_ok)) | (~blank & _SURE(good)) if blank_ok else ~blank & _SURE(good)


#: Functions of a table's totals row.
TOTALS = {"sum": F.sum, "average": F.avg, "count": F.count, "countNums": lambda x: F.count(_N(x)), "max": F.max, "min": F.min, "stdDev": F.stddev_samp, "var": F.var_samp}


def totals_row(df: DataFrame, totals: dict[str, str]) -> DataFrame:
    """One row: the chosen function of each column, all in one pass."""
    return df.agg(*[TOTALS[how](F.col(name)).alias(name) for name, how in totals.items()])


def pareto(df: DataFrame, label: str, value: str) -> DataFrame:
    """Labels by falling total with their cumulative share of the sum of all."""
    sums = df.groupBy(label).agg(F.sum(value).alias("total"))
    whole = df.agg(F.sum(value)).scalar()
    out = sum_before(sums, "total", "total", ties=[label], descending=True, name="__before")
    return out.withColumn("cumulative_share", (F.col("__before") + F.col("total")) / whole).drop("__before")


def histogram(df: DataFrame, value: str, bins: int, low: float, high: float) -> DataFrame:
    """Counts of equal bins from low to high; the last bin holds its upper end, values outside are left out."""
    width = (high - low) / bins
    n = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).cast("int")
    return df.where(F.col(value).between(low, high)).groupBy(n.alias("bin")).agg(F.count("*").alias("n"))


def box(df: DataFrame, keys: list[str], value: str, exclusive: bool = False) -> DataFrame:
    """Box-plot quartiles with the mean and the ends, inclusive or exclusive of the median's ends."""
    kind = "quartile_exc" if exclusive else "quartile"
    ends = [F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"), F.avg(value).alias("mean")]
    out = with_statistics(df, keys, value, {"q1": (kind, 1), "median": ("median",), "q3": (kind, 3)}, ends)
    return out.select(*keys, "low", "q1", "median", "q3", "high", "mean")


def waterfall(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Each step's start and end level within its keys."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(value).over(w)
    return df.withColumn("end", end).withColumn("start", F.col("end") - F.col(value))


def sparkline(df: DataFrame, keys: list[str], order: str, value: str, kind: str = "line") -> DataFrame:
    """The ordered values of each key, or their signs for a win/loss line."""
    v = F.signum(value) if kind == "winloss" else F.col(value)
    points = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), v.alias("v"))))
    return df.groupBy(*keys).agg(F.transform(points, lambda e: e["v"]).alias("points"))


def moving_average(x: Column, order: str, n: int, keys: list[str] | None = None) -> Column:
    return F.avg(x).over(Window.partitionBy(*(keys or [])).orderBy(order).rowsBetween(1 - n, 0))


def slicer(df: DataFrame, name: str, chosen: list) -> DataFrame:
    return df.where(F.col(name).isin(chosen))


def find_replace(df: DataFrame, columns: list[str], find: str, new: str, regex: bool = False) -> DataFrame:
    """Text replaced in columns, with ``__replaced`` counting the matches of each row."""
    pattern = find if regex else "\\Q" + find + "\\E"
    counts = [F.size(F.regexp_extract_all(_S(F.col(c)), F.lit(f"({pattern})"), F.lit(1))) for c in columns]
    out = df.withColumn("__replaced", sum(counts, F.lit(0)))
    for c in columns:
        out = out.withColumn(c, F.regexp_replace(F.col(c), pattern, new if regex else re.sub(r"([\\$])", r"\\\1", new)))
    return out
