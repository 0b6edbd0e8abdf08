"""Order statistics of many groups at once, exact, without gathering a group's values.

The order of values is cut into intervals by a sample; one aggregate counts the rows of each group in each
interval, which tells the interval that holds a rank. Only rows of such intervals are looked at again,
in finer intervals, until few are left; those are counted by value. Every round reads two or three columns
and moves a row a group and interval.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.ordered import cut_points, in_intervals
from gridloom.staging import staged

INTERVALS = 256
FEW = 1_000_000  # rows of the intervals sought that are counted by value at last

#: Kinds of statistics: the place, from 0, of k among n values; with fractions two values are mixed.
PLACES = {
    "median": lambda n, k: (n - 1) * 0.5,
    "percentile": lambda n, k: (n - 1) * k,
    "percentile_exc": lambda n, k: F.lit(k) * (n + 1) - 1,
    "quartile": lambda n, k: (n - 1) * (k / 4),
    "quartile_exc": lambda n, k: F.lit(k / 4) * (n + 1) - 1,
    "small": lambda n, k: F.lit(int(k) - 1.0),
    "large": lambda n, k: n - float(int(k)),
}


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on equal keys where NULL equals NULL; the left keys stay."""
    if not keys:
        return left.crossJoin(right) if how in ("inner", "left") else left.where(F.lit(not right.isEmpty()))  # one row of totals, or a set without keys
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    test = F.lit(True)
    for k in keys:
        test = test & F.col(f"`{k}`").eqNullSafe(F.col(f"`__r_{k}`"))
    return left.join(renamed, test, how).drop(*[f"__r_{k}" for k in keys])


def _before(n: str, keys: list[str], order: str) -> Column:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(w), F.lit(0))


def order_statistics(df: DataFrame, keys: list[str], value: str, want: dict[str, tuple], few: int = FEW) -> DataFrame:
    """Keys, ``n`` (values that are not NULL) and a column for each wanted statistic: ("median",), ("percentile", k) and
    ("percentile_exc", k) with k from 0 to 1, ("quartile", q) and ("quartile_exc", q), ("large", k), ("small", k).

    A statistic whose place a group has not is NULL; groups without a value are missing. Intervals are made
    when the plan is made, each round by a job.
    """
    rows = df.where(F.col(value).isNotNull()).select(*[F.col(f"`{k}`") for k in keys], F.col(value).cast("double").alias("__v"))
    open_, rest, done, inner = rows.withColumn("__b", F.lit(0).cast("bigint")), None, [], [*keys, "__b"]
    while True:
        points = {c[0] for c in cut_points(open_, ["__v"], INTERVALS // 2) if math.isfinite(c[0])}
        cuts = sorted(points | {math.nextafter(c, math.inf) for c in points if c < 1.7e308})  # a frequent value has an interval of its own
        cut = in_intervals(open_, "__v", cuts, "__i").withColumn("__c", F.col("__b") * (INTERVALS + 1) + F.col("__i"))
        counts = staged(cut.groupBy(*inner, "__c").agg(F.count("*").alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")), "counts")
        if rest is None:
            total = F.sum("__n").over(Window.partitionBy(*keys))
            placed = counts.select("*", total.alias("n"), _before("__n", keys, "__c").alias("__past"))
            sought = []
            for name, (kind, *k) in want.items():
                at = PLACES[kind](F.col("n"), *(k or [None]))
                inside = (at >= 0) & (at <= F.col("n") - 1)
                for side, rank in ((0, F.floor(at)), (1, F.ceil(at))):
                    sought.append(F.when(inside, F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), (rank - F.col("__past")).cast("bigint").alias("rank"), (at - F.floor(at)).alias("share"))))
            ranks = placed.withColumn("__s", F.explode(F.filter(F.array(*sought), lambda s: s.isNotNull() & (s["rank"] >= 0) & (s["rank"] < F.col("__n")))))
            chosen = ranks.select(*keys, "n", "__c", "__n", "__lo", "__hi", "__s.*")
            sizes = counts.groupBy(*keys).agg(F.sum("__n").alias("n"))
        else:
            placed = counts.select("*", _before("__n", inner, "__c").alias("__past"))
            joined = null_safe_join(rest.select(*inner, "n", "name", "side", F.col("rank").alias("__rank"), "share"), placed, inner)
            hit = (F.col("__rank") >= F.col("__past")) & (F.col("__rank") < F.col("__past") + F.col("__n"))
            chosen = joined.where(hit).select(*keys, "n", "__c", "__n", "__lo", "__hi", "name", "side", (F.col("__rank") - F.col("__past")).alias("rank"), "share")
        chosen = staged(chosen.withColumnRenamed("__c", "__b"), "chosen")
        done.append(chosen.where(F.col("__lo") == F.col("__hi")).select(*keys, "n", "name", "side", "share", F.col("__lo").alias("v")))
        rest = chosen.where(F.col("__lo") != F.col("__hi"))
        kept = rest.select(*inner, "__n").distinct()
        left = kept.agg(F.sum("__n")).first()[0] or 0
        if not left:
            break
        open_ = null_safe_join(cut.select(*keys, F.col("__c").alias("__b"), "__v"), kept.drop("__n"), inner, "left_semi")
        if left <= few:
            by_value = open_.groupBy(*inner, "__v").agg(F.count("*").alias("__n"))
            placed = by_value.select("*", _before("__n", inner, "__v").alias("__past"))
            joined = null_safe_join(rest.select(*inner, "n", "name", "side", "rank", "share"), placed, inner)
            done.append(joined.where((F.col("rank") >= F.col("__past")) & (F.col("rank") < F.col("__past") + F.col("__n"))).select(*keys, "n", "name", "side", "share", F.col("__v").alias("v")))
            break
    found = reduce(DataFrame.unionByName, done)
    side = lambda name, s: F.max(F.when((F.col("name") == name) & (F.col("side") == s), F.struct("v", "share")))
    mixed = [(lambda a, b: F.when(a["v"] == b["v"], a["v"]).otherwise(a["v"] * (1 - a["share"]) + b["v"] * a["share"]))(side(name, 0), side(name, 1)).alias(name) for name in want]
    return null_safe_join(sizes, found.groupBy(*keys).agg(*mixed), keys, "left").select(*keys, "n", *want)


def with_statistics(df: DataFrame, keys: list[str], value: str, want: dict[str, tuple], plain: list[Column]) -> DataFrame:
    """``plain`` aggregates of each group beside order statistics of ``value``; groups without values have NULL there."""
    return null_safe_join(df.groupBy(*keys).agg(*plain), order_statistics(df, keys, value, want).drop("n"), keys, "left")
