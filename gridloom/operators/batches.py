"""Batches of steps: table edits as plans, and rows kept as a log of steps that can be dumped and replayed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KNOWN = {"set", "add", "remove", "rename", "filter", "drop", "sort", "move", "swap", "copy"}


def _checked(df: DataFrame, steps: list[dict]) -> None:
    """Raise before anything is done if a step is unknown or names a column that is not there by then."""
    names = list(df.columns)
    for s in steps:
        op = s.get("op")
        if op not in KNOWN:
            raise ValueError(f"unknown step {s!r}")
        used = [*s.get("columns", []), *([s["column"]] if "column" in s and op not in ("set", "add") else []), *([s["before"]] if "before" in s else [])]
        missing = [c for c in used if c not in names]
        if missing:
            raise ValueError(f"no column {missing[0]!r} for step {s!r}")
        if op in ("set", "add") and s["column"] not in names or op == "copy":
            names.append(s["column"] if op != "copy" else s["to"])
        elif op == "drop":
            names.remove(s["column"])
        elif op == "rename":
            names[names.index(s["column"])] = s["to"]


def apply_steps(df: DataFrame, steps: list[dict]) -> DataFrame:
    """Replay a batch on a table: all steps, or none if one is wrong.

    set and add (column, value, where), remove (where), filter (where), drop, rename (to), sort (by), move (a
    column, before another one or to a place from 0), swap (the values of two columns), copy (to a new column).
    """
    _checked(df, steps)
    for s in steps:
        op = s["op"]
        if op in ("set", "add"):
            keep = F.coalesce(F.expr(s["where"]), F.lit(False)) if s.get("where") else F.lit(True)
            df = df.withColumn(s["column"], F.when(keep, F.expr(s["value"])).otherwise(F.col(s["column"]) if s["column"] in df.columns else F.lit(None)))
        elif op == "remove":
            df = df.where(~F.coalesce(F.expr(s["where"]), F.lit(False)))
        elif op == "filter":
            df = df.where(s["where"])
        elif op == "drop":
            df = df.drop(s["column"])
        elif op == "rename":
            df = df.withColumnRenamed(s["column"], s["to"])
        elif op == "copy":
            df = df.withColumn(s["to"], F.col(f"`{s['column']}`"))
        elif op == "swap":
            a, b = s["columns"]
            df = df.withColumns({a: F.col(f"`{b}`"), b: F.col(f"`{a}`")})
        elif op == "move":
            rest = [c for c in df.columns if c != s["column"]]
            at = rest.index(s["before"]) if "before" in s else s["to"]
            df = df.select(*[F.col(f"`{c}`") for c in [*rest[:at], s["column"], *rest[at:]]])
        else:
            df = df.orderBy(*[F.expr(k) for k in s["by"]])
    return df


def dump_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """A table as steps: (step), JSON that adds each row: {"op": "add", "key": {...}, "values": {...}}."""
    values = [c for c in df.columns if c not in keys]
    pick = lambda names: F.struct(*[F.col(f"`{c}`") for c in names])
    return df.select(F.to_json(F.struct(F.lit("add").alias("op"), pick(keys).alias("key"), pick(values).alias("values"))).alias("step"))


def parsed_steps(steps: DataFrame, schema: str, keys: list[str], order: str) -> DataFrame:
    """Steps of ``dump_rows``'s form as (order, op, keys, values), typed by the table's schema; what is no step is left out."""
    from pyspark.sql.types import StructType, _parse_datatype_string

    fields = _parse_datatype_string(schema).fields
    part = lambda own: StructType([f for f in fields if (f.name in keys) == own]).simpleString()
    read = F.from_json("step", f"op string, key {part(True)}, values {part(False)}")
    out = steps.select(order, read.alias("s")).where(F.col("s.op").isin("add", "set", "remove"))
    return out.select(order, "s.op", *[F.col(f"s.key.{f.name}" if f.name in keys else f"s.values.{f.name}").alias(f.name) for f in fields])


def replay(base: DataFrame, steps: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``base`` after the steps (``order``, op, keys and values), in their order within each key.

    add puts a row in place of what was there, remove takes it away, set changes the values that are not NULL
    of a row that is there; one that is not there stays away. One aggregate finds each key's last add or
    remove, a second one the values set since; rows of keys without steps are not touched. Rows of ``base``
    should be unique by ``keys``, steps by keys and ``order``.
    """
    values = [c for c in base.columns if c not in keys]
    reset = F.max(F.when(F.col("op").isin("add", "remove"), F.struct(F.col(order).alias("at"), F.col("op").alias("op"))))
    resets = steps.groupBy(*keys).agg(reset.alias("__reset"))
    since = steps.join(resets, keys).where(F.col("__reset").isNull() | (F.col(order) >= F.col("__reset.at")))
    last = [F.max_by(f"`{c}`", F.when(F.col("op").isin("add", "set") & F.col(f"`{c}`").isNotNull(), F.col(order))).alias(f"__{c}") for c in values]
    state = since.groupBy(*keys).agg(F.max("__reset.op").alias("__op"), F.lit(True).alias("__known"), *last)
    both = base.withColumn("__there", F.lit(True)).join(state, keys, "full")
    alive = F.when(F.col("__op") == "add", True).when(F.col("__op") == "remove", False).otherwise(F.col("__there"))
    kept = both.where(F.coalesce(alive, F.lit(False)))
    return kept.select(*keys, *[F.when(F.col("__op") == "add", F.col(f"__{c}")).otherwise(F.coalesce(f"__{c}", F.col(f"`{c}`"))).alias(c) for c in values]).select(base.columns)
