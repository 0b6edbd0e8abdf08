"""Running folds over a total order of all rows, in which no task sees them all.

Cut points from a bounded sample part the order into stretches. Each stretch is folded in a task of its
own; what the stretches before it hand on is one small row each, joined back by broadcast. With ``by``
columns the fold starts anew with each key, and a key that fills many stretches is still spread over them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Sampled rows for each stretch: their number bounds what the driver holds.
SAMPLED = 20


@dataclass(frozen=True)
class Fold:
    """``kind`` (sum, count, min, max, first or last, of values that are not NULL) of the rows up to each
    one; with ``before`` without the row itself."""

    kind: str
    value: Column
    before: bool = False

    def plain(self) -> Column:
        kinds = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
        return kinds[self.kind](self.value)

    def over(self, window) -> Column:
        if self.kind in ("first", "last"):
            return (F.first if self.kind == "first" else F.last)(self.value, ignorenulls=True).over(window)
        return self.plain().over(window)

    def joined(self, carried: Column, inside: Column) -> Column:
        if self.kind in ("sum", "count"):
            return F.when(carried.isNull(), inside).when(inside.isNull(), carried).otherwise(carried + inside)
        if self.kind == "first":
            return F.coalesce(carried, inside)
        if self.kind == "last":
            return F.coalesce(inside, carried)
        return (F.least if self.kind == "min" else F.greatest)(carried, inside)


def _names(order: Sequence[str]) -> list[tuple[str, bool]]:
    """("-name" falls) as (name, descending)."""
    return [(o[1:], True) if o.startswith("-") else (o, False) for o in order]


def sort_columns(order: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`").desc() if down else F.col(f"`{name}`").asc() for name, down in _names(order)]


def _ahead(names: list[tuple[str, bool]], cut: Sequence) -> Column:
    """Whether a row stands before a cut point; NULL is the least value, NaN the greatest."""
    out = None
    for (name, down), v in list(zip(names, cut))[::-1]:
        x = F.col(f"`{name}`")
        if v is None:
            less = x.isNotNull() if down else F.lit(False)
        else:
            less = F.coalesce(x > F.lit(v), F.lit(False)) if down else F.coalesce(x < F.lit(v), F.lit(True))
        out = less if out is None else less | (x.eqNullSafe(F.lit(v)) & out)
    return out


def cut_points(df: DataFrame, order: Sequence[str], pieces: int | None = None) -> list:
    """Up to ``pieces`` - 1 rows of order columns, in order, that part ``df`` into about equal stretches. Runs a job."""
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = df.select(*[F.col(f"`{n}`") for n, _ in _names(order)]).orderBy(F.rand(17)).limit(SAMPLED * pieces)
    rows = few.orderBy(*sort_columns(order)).collect()
    cuts = [rows[len(rows) * i // pieces] for i in range(1, pieces)] if len(rows) >= pieces else rows[1:]
    return [c for i, c in enumerate(cuts) if not i or c != cuts[i - 1]]


def in_stretches(df: DataFrame, order: Sequence[str], cuts: list, name: str = "__stretch") -> DataFrame:
    """``df`` with the number of each row's stretch, found by a tree of comparisons with the cut points."""
    names = _names(order)

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(_ahead(names, cuts[middle]), tree(low, middle)).otherwise(tree(middle + 1, high))

    return df.withColumn(name, tree(0, len(cuts)))


def in_intervals(df: DataFrame, column: str, cuts: Sequence[float], name: str) -> DataFrame:
    """``df`` with the number of the interval that a number lies in, by binary search; NaN and NULL come behind the last one."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    from pyspark.ml.feature import Bucketizer

    splits = [float("-inf"), *cuts, float("inf")]
    put = Bucketizer(splits=splits, inputCol=column, outputCol=name, handleInvalid="keep").transform(df)
    return put.withColumn(name, F.col(name).cast("int"))


def scan(df: DataFrame, order: Sequence[str], folds: dict[str, Fold], by: Sequence[str] = (), pieces: int | None = None) -> DataFrame:
    """``df`` with a column for each fold, over the rows in the order of ``order`` ("-name" falls) within ``by``.

    NULL comes first, or last where the order falls. Rows that tie in all of ``by`` and ``order`` share a
    stretch and are taken in no fixed order: tell them apart by a further column. The cut points are
    found when the plan is made, by a job that reads the order columns only.
    """
    by, whole = list(by), [*by, *order]
    cuts = cut_points(df, whole, pieces)
    placed = in_stretches(df, whole, cuts)
    keys = [F.col(f"`{k}`") for k in by]
    window = Window.partitionBy("__stretch", *keys).orderBy(*sort_columns(order))
    upto = {True: window.rowsBetween(Window.unboundedPreceding, -1), False: window.rowsBetween(Window.unboundedPreceding, 0)}
    inside = placed.withColumns({name: f.over(upto[f.before]) for name, f in folds.items()})
    if not cuts:
        return inside.drop("__stretch")
    # a key reaches beyond its stretch only if the next cut point lies in it
    after = F.get(F.array(*[F.struct(F.lit(True).alias("cut"), *[F.lit(v).alias(f"k{i}") for i, v in enumerate(c[: len(by)])]) for c in cuts]), F.col("__stretch"))
    reaches = after.isNotNull()
    for i, k in enumerate(keys):
        reaches = reaches & k.eqNullSafe(after[f"k{i}"])
    ends = placed.where(reaches)
    falls = {down for _, down in _names(order)}
    place = F.struct(*[F.col(f"`{n}`") for n, _ in _names(order)])
    if len(falls) > 1:  # no struct orders as these columns do: count the rows instead
        ends, place, falls = ends.withColumn("__place", F.row_number().over(window)), F.col("__place"), {False}
    tails = []
    for name, f in folds.items():
        if f.kind in ("first", "last"):
            pick = F.max_by if (f.kind == "last") != (True in falls) else F.min_by
            tails.append(pick(f.value, F.when(f.value.isNotNull(), place)).alias(name))
        else:
            tails.append(f.plain().alias(name))
    sums = ends.groupBy("__stretch", *[k.alias(f"__k{i}") for i, k in enumerate(keys)]).agg(*tails)  # a row a stretch
    past = Window.partitionBy(*[f"__k{i}" for i in range(len(by))]).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, 0)
    handed = sums.select((F.col("__stretch") + 1).alias("__to"), *[F.col(f"__k{i}") for i in range(len(by))], *[Fold("sum" if f.kind == "count" else f.kind, F.col(name)).over(past).alias(f"__c_{name}") for name, f in folds.items()])
    match = F.col("__stretch") == F.col("__to")
    for i, k in enumerate(keys):
        match = match & k.eqNullSafe(F.col(f"__k{i}"))
    both = inside.join(F.broadcast(handed), match, "left")
    return both.select(*[F.col(f"`{c}`") for c in df.columns if c not in folds], *[f.joined(F.col(f"__c_{name}"), F.col(f"`{name}`")).alias(name) for name, f in folds.items()])

