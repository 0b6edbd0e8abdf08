"""Profiles of tables and texts: statistics, outline, issues, detected tables and template merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_S = lambda name: F.col(f"`{name}`").cast("string")


def kind_of(x: Column) -> Column:
    """The kind of a cell given as text, in the order in which import infers it.

    A look at the first character spares prose the patterns.
    """
    first = F.substring(x, 1, 1)
    return (
        F.when(x.isNull() | (x == ""), "blank")
        .when(x.startswith("="), "formula")
        .when(first.isin(*" \t\n\x0b\f\r+-.0123456789") & x.rlike(r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"), "number")
        .when(first.isin(*"0123456789") & x.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(x, "yyyy-MM-dd").isNotNull(), "date")
        .when(F.upper(x).isin("TRUE", "FALSE"), "boolean")
        .when(x.startswith("#") & x.rlike(r"^#(N/A|NAME\?|NULL!|REF!|VALUE!|NUM!|DIV/0!|SPILL!|CALC!)$"), "error")
        .otherwise("string")
    )


KINDS = ("blank", "formula", "number", "date", "boolean", "error", "string")


def profile(df: DataFrame) -> DataFrame:
    """One row a column: counts of cells by kind, distinct values (approximate) and text lengths, in one pass.

    A cell's kind is found once, in a projection ahead of the counts.
    """
    kinds = [f"__kind{i}" for i in range(len(df.columns))]
    df = df.select(*[F.col(f"`{c}`") for c in df.columns], *[kind_of(_S(c)).alias(k) for c, k in zip(df.columns, kinds)])
    measures = []
    for i, name in enumerate(df.columns[: len(kinds)]):
        kind = F.col(kinds[i])
        parts = [F.count_if(kind == k).alias(k) for k in KINDS]
        parts += [F.approx_count_distinct(_S(name)).alias("distinct"), F.max(F.char_length(_S(name))).alias("longest")]
        measures.append(F.struct(F.lit(name).alias("column"), F.lit(i).alias("position"), *parts))
    return df.agg(F.array(*measures).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def outline(df: DataFrame, name: str) -> DataFrame:
    """A table's name, rows, columns and formula-like cells."""
    formulas = sum((F.count_if(F.coalesce(_S(c).startswith("="), F.lit(False))) for c in df.columns), F.lit(0))
    return df.agg(F.lit(name).alias("name"), F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns"), formulas.alias("formulas"))


def text_stats(df: DataFrame, text: str = "text", keys: list[str] | None = None) -> DataFrame:
    """Documents, characters, words, lines and empty texts of each key."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.size(F.filter(F.split(t, r"\s+"), lambda w: w != ""))
    return df.groupBy(*(keys or [])).agg(
        F.count("*").alias("texts"), F.sum(F.char_length(t)).alias("chars"), F.sum(words).alias("words"),
        F.sum(F.when(t == "", 0).otherwise(F.size(F.split(t, "\n")))).alias("lines"), F.count_if(t == "").alias("empty"),
    )


def issues(df: DataFrame, key: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """(issue, severity, key) of every row that a rule's test holds for; all rules in one pass."""
    found = F.array(*[F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(name).alias("issue"), F.lit(level).alias("severity"))) for name, (level, test) in rules.items()])
    return df.select(F.col(key), F.explode(F.filter(found, lambda x: x.isNotNull())).alias("i")).select("i.*", key)


def cell_issues(df: DataFrame, key: str) -> DataFrame:
    """Errors, spaces around text, numbers kept as text with a sign, and missing values, for text columns."""
    rules = {}
    for name, kind in df.dtypes:
        x = F.col(f"`{name}`")
        if name == key:
            continue
        rules[f"missing:{name}"] = ("info", x.isNull())
        if kind == "string":
            rules[f"error_value:{name}"] = ("error", kind_of(x) == "error")
            rules[f"padded:{name}"] = ("warning", x != F.trim(x))
            rules[f"number_as_text:{name}"] = ("warning", kind_of(x) == "number")
    return issues(df, key, rules)


def merge_template(df: DataFrame, template: str, fields: dict[str, Column], name: str = "merged") -> DataFrame:
    """``{{key}}`` replaced by each row's values; ``replaced`` counts, ``unresolved`` lists keys without one."""
    import re

    parts, known, missing = [], [], []
    at = 0
    for m in re.finditer(r"\{\{\s*([\w.\[\]]+)\s*\}\}", template):
        parts.append(F.lit(template[at : m.start()]))
        value = fields.get(m[1])
        if value is None:
            missing.append(m[1])
            parts.append(F.lit(m[0]))
        else:
            known.append(m[1])
            parts.append(F.coalesce(value.cast("string"), F.lit("")))
        at = m.end()
    parts.append(F.lit(template[at:]))
    return df.withColumn(name, F.concat(*parts)).withColumn("replaced", F.lit(len(known))).withColumn("unresolved", F.array(*map(F.lit, dict.fromkeys(missing))).cast("array<string>"))


def flatten_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A JSON column's objects and arrays as dotted keys: (…, key, value), a row each."""
    from pyspark.sql.types import ArrayType, StructType, _parse_datatype_string

    parsed = df.withColumn("__j", F.from_json(column, schema))

    def leaves(x: Column, kind, prefix: str) -> list[Column]:
        if isinstance(kind, StructType):
            return [leaf for f in kind for leaf in leaves(x[f.name], f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
        if isinstance(kind, ArrayType):
            return [F.transform(x, lambda v, i: F.struct(F.concat(F.lit(f"{prefix}["), i.cast("string"), F.lit("]")).alias("key"), v.cast("string").alias("value")))]
        return [F.array(F.struct(F.lit(prefix).alias("key"), x.cast("string").alias("value")))]

    parts = leaves(F.col("__j"), _parse_datatype_string(schema), "")
    whole = reduce(lambda a, b: F.concat(a, F.coalesce(b, F.array().cast("array<struct<key:string,value:string>>"))), parts[1:], parts[0])
    return parsed.select(*df.columns, F.explode(F.filter(whole, lambda e: e["value"].isNotNull())).alias("e")).select(*df.columns, "e.*")
