"""Lookups as left joins that keep the first (or last) match, and as-of joins for approximate ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.base import CATALOGUE
from gridloom.functions.order_stats import null_safe_join
from gridloom.functions.ordered import Fold, scan
from gridloom.functions.text import wildcard_regex


def _folded(df: DataFrame, key: str) -> Column:
    """Text keys compare without case; NULL keys never match."""
    x = F.col(key)
    return F.lower(x) if dict(df.dtypes)[key] == "string" else x


def exact(left: DataFrame, on: str, right: DataFrame, key: str, take: list[str], order: str | None = None, last: bool = False, default: dict | None = None) -> DataFrame:
    """VLOOKUP and XLOOKUP exact, MATCH 0: each left row with ``take`` of the first (last) right row of its key.

    The right side is cut to one row a key before the join, so left rows never multiply; Spark decides from
    its size whether to broadcast it.
    """
    picked = F.struct(*[F.col(c) for c in take])
    by = F.col(order) if order else F.lit(0)
    pick = (F.max_by if last else F.min_by)(picked, by).alias("__found")
    few = right.where(F.col(key).isNotNull()).groupBy(_folded(right, key).alias("__key")).agg(pick)
    out = left.join(few, _folded(left, on) == F.col("__key"), "left")
    for c in take:
        fallback = (default or {}).get(c)
        hit = F.col("__key").isNotNull()
        out = out.withColumn(c, F.when(hit, F.col(f"__found.{c}")).otherwise(F.lit(fallback)))
    return out.drop("__key", "__found")


def as_of(left: DataFrame, on: str, right: DataFrame, key: str, take: list[str], by: list[str] | None = None, direction: str = "backward", order: str | None = None, spread: bool = False) -> DataFrame:
    """The right row of greatest key <= ``on`` (backward) or least key >= it (forward), within equal ``by``.

    Left and right rows are united, sorted once within each group, and the last (next) right row is carried
    along. Of right rows of equal key the last in ``order`` counts backward, the first forward. Without
    ``by``, or with ``spread`` where some groups fill many tasks, the order is cut into stretches that hand
    their last right row on.
    """
    by = by or []
    found = F.struct(F.lit(True).alias("__hit"), *[F.col(c) for c in take])
    tie = F.col(order).cast("double") if order else F.lit(0.0)
    l = left.select(*by, F.col(on).alias("__at"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("__left"), F.lit(1).alias("__side"), F.monotonically_increasing_id().cast("double").alias("__tie"))
    r = right.where(F.col(key).isNotNull()).select(*by, F.col(key).alias("__at"), found.alias("__right"), F.lit(0 if direction == "backward" else 2).alias("__side"), tie.alias("__tie"))
    both = l.unionByName(r, allowMissingColumns=True)
    if spread or not by:
        falls = "" if direction == "backward" else "-"
        both = scan(both, [f"{falls}{c}" for c in ("__at", "__side", "__tie")], {"__pick": Fold("last", F.col("__right"))}, by)
    else:
        turn = F.asc if direction == "backward" else F.desc  # a frame that ends with the group would be read anew for every row
        w = Window.partitionBy(*by).orderBy(*map(turn, ("__at", "__side", "__tie")))
        both = both.withColumn("__pick", F.last("__right", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = both.where(F.col("__left").isNotNull())
    seen = F.col("__at").isNotNull()
    return out.select("__left.*", *[F.when(seen, F.col(f"__pick.{c}")).alias(c) for c in take])


def nearest(left: DataFrame, on: str, right: DataFrame, key: str, take: list[str], by: list[str] | None = None, larger: bool = False) -> DataFrame:
    """XLOOKUP -1 (next smaller) or 1 (next larger) on unsorted vectors: an exact match first, else the nearest.

    Each distinct value of ``by`` and ``on`` is looked up once and joined back, so that left rows are not sorted.
    """
    asked = list(dict.fromkeys([*(by or []), on]))
    found = as_of(left.select(*asked).distinct(), on, right, key, take, by, "forward" if larger else "backward")
    found = found.select(*asked, F.struct(*[F.col(c) for c in take]).alias("__near"))
    out = null_safe_join(left, found, asked, "left")
    return out.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"__near.{c}").alias(c) for c in take])


def wildcard(left: DataFrame, patterns: dict[str, str], on: str, name: str = "matched") -> DataFrame:
    """XLOOKUP 2 and MATCH 0 with wildcards over a fixed set of patterns: the value of the first that fits."""
    out = None
    for pattern, value in patterns.items():
        test = F.rlike(F.col(on), F.lit(wildcard_regex(pattern)))
        out = (F if out is None else out).when(test, F.lit(value))
    return left.withColumn(name, out)


def matching(df: DataFrame, other: DataFrame, on: list[str], anti: bool = False) -> DataFrame:
    """Rows whose key the other table has (COUNTIF > 0), or has not."""
    return df.join(other, on, "left_anti" if anti else "left_semi")


def horizontal(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """HLOOKUP's table stood upright: (ids, key, value), ready for ``exact`` or ``as_of``."""
    return df.unpivot(ids, columns, "key", "value")


def position(left: DataFrame, on: str, right: DataFrame, key: str, order: str, mode: int = 0, last: bool = False, by: list[str] | None = None, name: str = "position") -> DataFrame:
    """XMATCH: ``left`` with the place, from 1, of the right row found, NULL for none; ``order`` counts rows from 0.

    Mode 0 takes the first equal key (the last with ``last``), -1 an equal or the next smaller key, 1 an equal
    or the next larger one; keys need no order. Of equal keys the first row counts, with ``last`` the last.
    """
    if mode == 0:
        out = exact(left, on, right.withColumn(name, F.col(order) + 1), key, [name], order, last)
        return out.withColumn(name, F.col(name).cast("bigint"))
    pick = (F.max if last else F.min)(order)
    few = right.where(F.col(key).isNotNull()).groupBy(*(by or []), key).agg((pick + 1).cast("bigint").alias(name))
    return nearest(left, on, few, key, [name], by, larger=mode > 0)


def match(left: DataFrame, on: str, right: DataFrame, key: str, order: str, kind: int = 1, by: list[str] | None = None, name: str = "position") -> DataFrame:
    """MATCH: kind 1 is the place of the last key that is not larger (keys rise), -1 of the last that is not
    smaller (keys fall), 0 of the first equal one."""
    return position(left, on, right, key, order, -kind, last=kind != 0, by=by, name=name)


def across(left: DataFrame, on: str, wide: DataFrame, label: str, row, columns: list[str], name: str = "value", default=None) -> DataFrame:
    """HLOOKUP: column names are the keys; of the column named by ``left``'s cell the row with label ``row``."""
    tall = horizontal(wide.where(F.col(label) == F.lit(row)), [label], columns).withColumnRenamed("value", name)
    return exact(left, on, tall, "key", [name], default={name: default} if default is not None else None)


def xlookup(left: DataFrame, on: str, right: DataFrame, key: str, take: list[str], order: str | None = None, mode: int = 0, last: bool = False, default: dict | None = None, by: list[str] | None = None) -> DataFrame:
    """XLOOKUP with its match modes 0, -1 and 1, the search from the end (``last``) and the value if not found.

    Mode 2, wildcards, takes the patterns from ``on`` (see ``patterns``); ``order`` is needed for it.
    """
    if mode == 0:
        return exact(left, on, right, key, take, order, last, default)
    if mode == 2:
        from gridloom.operators.patterns import wildcard_lookup

        return wildcard_lookup(left, on, right, key, take, order, default)
    picked = F.struct(*[F.col(c) for c in take])
    few = right.where(F.col(key).isNotNull()).groupBy(*(by or []), key).agg((F.max_by if last else F.min_by)(picked, F.col(order) if order else F.lit(0)).alias("__few"))
    out = nearest(left, on, few, key, ["__few"], by, larger=mode > 0)
    missing = F.col("__few").isNull()
    return out.select(*left.columns, *[F.when(missing, F.lit((default or {}).get(c))).otherwise(F.col(f"__few.{c}")).alias(c) for c in take])


for _name, _f in {"VLOOKUP": exact, "HLOOKUP": across, "XLOOKUP": xlookup, "LOOKUP": as_of, "MATCH": match, "XMATCH": position, "INDIRECT": lambda spark, name: spark.table(name)}.items():
    CATALOGUE.setdefault(_name, _f)
