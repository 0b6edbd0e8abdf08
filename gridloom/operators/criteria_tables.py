"""Criteria blocks that come from a table: rows are alternatives, the filled cells of a row all must hold.

Of criteria rows that differ in nothing but the bound of a comparison, the one that holds for most is kept.
Each row left is looked up by one of its cells: an equality, a pattern resolved to the values that fit
it, or a range cut into intervals; rows without such a cell are dealt over all rows by salts. Every kind
is an equality join that asks for existence, and the other cells are tested within it, so no pairs of rows
come out and no side has to be broadcast.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.base import CATALOGUE
from gridloom.functions.ordered import cut_points
from gridloom.operators.criteria import _NEAR, finite
from gridloom.operators.patterns import _indexed, _pairs, pattern_regex
from gridloom.staging import staged

INTERVALS = 64  # of a column's order, and salts
_RANGES = (">", "<", ">=", "<=")
_NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"
_GRAIN = 1e9  # equal numbers lie within 1e-10: they share one of two neighbouring grains


def _cells(criteria: DataFrame, columns: list[str]) -> DataFrame:
    """For each column i its operator ``o{i}``, value ``w{i}``, number ``n{i}`` and pattern ``r{i}``; all NULL for an empty cell."""
    made = {}
    for i, name in enumerate(columns):
        cell = F.when(F.col(f"`{name}`").cast("string") != "", F.col(f"`{name}`").cast("string"))
        op = F.regexp_extract(cell, r"(?s)^\s*(>=|<=|<>|>|<|=)?(.*)$", 1)
        word = F.regexp_extract(cell, r"(?s)^\s*(>=|<=|<>|>|<|=)?(.*)$", 2)
        number = F.when(F.rlike(word, F.lit(_NUMBER)), F.trim(word).try_cast("double"))
        wild = (op == "") & number.isNull() & F.rlike(word, F.lit("[*?~]"))
        made |= {f"o{i}": op, f"w{i}": F.lower(word), f"n{i}": number, f"r{i}": F.when(wild, pattern_regex(word)), f"p{i}": F.when(wild, F.lower(word))}
    made |= {f"w{i}": F.when(made[f"n{i}"].isNull(), made[f"w{i}"]) for i in range(len(columns))}
    return criteria.select(*[x.alias(n) for n, x in made.items()]).distinct()


def _weakest(cells: DataFrame, fields: int) -> DataFrame:
    """Of the rows that are equal but for the bound of one comparison, the one with the weakest: what meets another meets it."""
    compares = [F.coalesce(F.col(f"o{i}").isin(*_RANGES), F.lit(False)) for i in range(fields)]
    met = cells.agg(*[F.max(x) for x in compares]).first()
    for i in range(fields):
        if met[i]:
            bounds = {x: F.col(f"{x}{i}") for x in "nw"}
            fixed = {f"__{x}": F.when(~compares[i], v) for x, v in bounds.items()} | {"__number": bounds["n"].isNotNull()}
            weakest = {x: F.when(F.first(f"o{i}").isin(">", ">="), F.min(v)).when(F.first(f"o{i}").isin("<", "<="), F.max(v)).otherwise(F.first(f"__{x}")).alias(f"{x}{i}") for x, v in bounds.items()}
            others = [c for c in cells.columns if c not in (f"n{i}", f"w{i}")]
            cells = cells.withColumns(fixed).groupBy(*others, *fixed).agg(*weakest.values()).select(*cells.columns)
    return cells


def _holds(i: int, met: list[tuple[str, bool, bool]]) -> Column:
    """The test of cell i on the number ``__n{i}`` and the lower-case text ``__s{i}`` of a row; ``met`` are the (operator,
    with a number, with a pattern) that occur, so that no others are compiled. Never NULL."""
    op, word, number, regex = (F.col(f"{c}{i}") for c in "ownr")
    n, s = F.col(f"__n{i}").outer(), F.col(f"__s{i}").outer()
    written = n.isNull() & (s != "")
    same = F.abs(n - number) < _NEAR
    numeric = {"": same, "=": same, "<>": F.coalesce(~same, F.lit(True)), ">": n > number, "<": n < number, ">=": n >= number, "<=": n <= number}
    text = {"": s == word, "=": s == word, "<>": s != word, ">": written & (s > word), "<": written & (s < word), ">=": written & (s >= word), "<=": written & (s <= word)}
    out = op.isNull()
    for o, with_number, with_pattern in met:
        test = numeric[o] if with_number else F.rlike(s, regex) if with_pattern else text[o]
        out = out | ((op == o) & (number.isNotNull() if with_number else number.isNull()) & (regex.isNotNull() if with_pattern else regex.isNull()) & F.coalesce(test, F.lit(False)))
    return out


def _interval(x: Column, cuts: list[float]) -> Column:
    """The number of the interval that a number lies in."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(x < F.lit(cuts[middle]), tree(low, middle)).otherwise(tree(middle + 1, high))

    return tree(0, len(cuts))


def where_any(df: DataFrame, criteria: DataFrame) -> DataFrame:
    """Rows of ``df`` that meet any row of ``criteria``, whose columns name ``df``'s, without case.

    A row of empty cells holds for all; no rows hold for all, too. A filled cell under a name that ``df`` has
    not makes its row fail. Columns of criteria are given once each. The criteria are parsed, thinned out and written
    to the shared folder when the plan is made; reading the table for its number of distinct values, interval
    ends and patterns takes a job each where they are needed.
    """
    names = {c.lower(): c for c in df.columns}
    known, strange = [c for c in criteria.columns if c.lower() in names], [c for c in criteria.columns if c.lower() not in names]
    for c in strange:
        criteria = criteria.where(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) == "")
    if not known or not strange and criteria.isEmpty():
        return df.where(F.lit(not criteria.isEmpty() or not strange))
    fields = [names[c.lower()] for c in known]
    distinct = df.agg(*[F.approx_count_distinct(F.col(f"`{f}`").cast("string")).alias(f"d{i}") for i, f in enumerate(fields)]).first()
    order = sorted(range(len(fields)), key=lambda i: -distinct[f"d{i}"])
    cells = _weakest(_cells(criteria, known), len(fields))
    kind = F.lit(None).cast("string")
    for i in reversed(order):  # ranges first, so that equalities of other columns take precedence
        o, n = F.col(f"o{i}"), F.col(f"n{i}")
        kind = F.when(o.isin(*_RANGES) & n.isNotNull(), f"range{i}").otherwise(kind)
    for i in reversed(order):
        kind = F.when(F.col(f"p{i}").isNotNull(), f"like{i}").otherwise(kind)
    for i in reversed(order):
        o, n = F.col(f"o{i}"), F.col(f"n{i}")
        kind = F.when(o.isin("", "=") & F.col(f"p{i}").isNull(), F.when(n.isNotNull(), f"number{i}").otherwise(f"text{i}")).otherwise(kind)
    free = reduce(lambda a, b: a & b, [F.col(f"o{i}").isNull() for i in range(len(fields))])
    cells = cells.withColumn("kind", F.when(free, "free").otherwise(F.coalesce(kind, F.lit("any"))))
    cells = staged(cells, "criteria", "kind")  # apart, so that each kind's join is planned by its own size
    met = lambda i: F.collect_set(F.when(F.col(f"o{i}").isNotNull(), F.struct(F.col(f"o{i}"), F.col(f"n{i}").isNotNull(), F.col(f"r{i}").isNotNull()))).alias(f"m{i}")
    found = {r.kind: [sorted(map(tuple, r[f"m{i}"])) for i in range(len(fields))] for r in cells.groupBy("kind").agg(*map(met, range(len(fields)))).collect()}  # a few kinds a column
    kinds = sorted(found)
    if "free" in kinds:
        return df
    if not kinds:
        return df.where(F.lit(False))
    made = {f"__n{i}": finite(F.col(f"`{f}`")) for i, f in enumerate(fields)} | {f"__s{i}": F.lower(F.coalesce(F.col(f"`{f}`").cast("string"), F.lit(""))) for i, f in enumerate(fields)}
    keys: dict[str, DataFrame] = {}
    for k, kind in enumerate(kinds):
        of, key = cells.where(F.col("kind") == kind), f"__k{k}"
        if kind == "any":
            of = of.withColumn("key", F.explode(F.sequence(F.lit(0), F.lit(INTERVALS - 1))))
            made[key] = F.pmod(F.xxhash64(*[F.col(f"`{f}`") for f in fields]), F.lit(INTERVALS)).cast("int")
        else:
            what, i = re.fullmatch(r"([a-z]+)(\d+)", kind).groups()
            x, number, word = F.col(f"`{fields[int(i)]}`"), F.col(f"n{i}"), made[f"__s{i}"]
            if what == "number":
                grain = lambda v: F.floor(v * _GRAIN).cast("double")
                of = of.withColumn("key", F.explode(F.array_distinct(F.array(grain(number - _NEAR), grain(number), grain(number + _NEAR)))))
                made[key] = grain(finite(x))
            elif what == "text":
                of, made[key] = of.withColumn("key", F.col(f"w{i}")), word
            elif what == "like":
                texts = staged(df.select(word.alias("text")).distinct(), "texts")
                indexed, ways = _indexed(of.select(F.col(f"p{i}").alias("pattern")).distinct(), texts)
                fits = _pairs(indexed, texts, ways).select(F.col("pattern").alias(f"p{i}"), F.col("text").alias("key"))
                of, made[key] = staged(of.join(fits, f"p{i}"), "fitting"), word
            else:
                cuts = sorted({r[0] for r in cut_points(df.select(finite(x).alias("x")).where("x is not null"), ["x"], INTERVALS)})
                o, at = F.col(f"o{i}"), _interval(number, cuts)
                of = of.withColumn("key", F.explode(F.when(o.isin(">", ">="), F.sequence(at, F.lit(len(cuts)))).otherwise(F.sequence(F.lit(0), at))))
                made[key] = F.when(finite(x).isNotNull(), _interval(finite(x), cuts))
        keys[key] = of
    wide = df.withColumns(made)
    tests = []
    for (key, of), kind in zip(keys.items(), kinds):
        rest = reduce(lambda a, b: a & b, [_holds(i, own) for i, own in enumerate(found[kind]) if own])
        tests.append(of.where((F.col("key") == F.col(key).outer()) & rest).exists())
    return wide.where(reduce(lambda a, b: a | b, tests)).drop(*made)


#: The database functions, and the aggregates behind them.
AGGREGATES = {"DSUM": "SUM", "DCOUNT": "COUNT", "DCOUNTA": "COUNTA", "DAVERAGE": "AVERAGE", "DMAX": "MAX", "DMIN": "MIN", "DPRODUCT": "PRODUCT", "DSTDEV": "STDEV.S", "DSTDEVP": "STDEV.P", "DVAR": "VAR.S", "DVARP": "VAR.P"}


def database_by_table(df: DataFrame, names: list[str], field: str, criteria: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Database functions of each group over the rows that meet a criteria table, a column for each function (dsum, ...)."""
    x, made = F.col(f"`{field}`"), []
    for name in names:
        if name == "DGET":
            made.append(F.when(F.count("*") == 1, F.max(x)).alias("dget"))
        else:
            made.append(CATALOGUE[AGGREGATES[name]](x).alias(name.lower()))
    return where_any(df, criteria).groupBy(*(keys or [])).agg(*made)
