"""Delimited text with a type for each cell, as spreadsheet import infers it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.profile import kind_of

#: Forms of dates that import accepts, fixed values.
DATE_FORMS = ("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd HH:mm:ss")


def read_delimited(spark: SparkSession, path: str, delimiter: str | None = None, header: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """All columns as text; quoted fields may hold line ends. The delimiter defaults by the file's name."""
    delimiter = delimiter or ("\t" if path.lower().endswith((".tsv", ".tab")) else ",")
    reader = spark.read.option("multiLine", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
    return reader.option("sep", delimiter).option("header", header).option("encoding", encoding).option("inferSchema", False).csv(path)


def typed_cell(x: Column) -> Column:
    """struct<kind, num, date, bool, formula, str> of a cell; long digit strings keep their text beside the number."""
    kind = kind_of(x)
    date = F.coalesce(*[F.try_to_timestamp(x, F.lit(f)) for f in DATE_FORMS])
    kind = F.when(kind.isin("string", "date"), F.when(date.isNotNull(), "date").otherwise("string")).otherwise(kind)
    return F.struct(
        kind.alias("kind"),
        F.when(kind == "number", x.try_cast("double")).alias("num"),
        F.when(kind == "date", date).alias("date"),
        F.when(kind == "boolean", F.upper(x) == "TRUE").alias("bool"),
        F.when(kind == "formula", F.substring(x, F.lit(2), F.char_length(x))).alias("formula"),
        F.when(kind != "blank", x).alias("str"),
    )


def typed(df: DataFrame) -> DataFrame:
    """Every column as a typed cell."""
    return df.select(*[typed_cell(F.col(f"`{c}`")).alias(c) for c in df.columns])


def column_types(df: DataFrame) -> DataFrame:
    """(column, kind): the one kind of a column's filled cells, or string where they differ."""
    kinds = [F.struct(F.lit(c).alias("column"), F.collect_set(F.when(kind_of(F.col(f"`{c}`")) != "blank", kind_of(F.col(f"`{c}`")))).alias("kinds")) for c in df.columns]
    rows = df.agg(F.array(*kinds).alias("k")).select(F.explode("k").alias("k")).select("k.*")
    return rows.select("column", F.when(F.size("kinds") == 1, F.element_at("kinds", 1)).otherwise("string").alias("kind"))


def write_delimited(df: DataFrame, path: str, delimiter: str = ",", header: bool = True) -> None:
    df.write.mode("overwrite").option("sep", delimiter).option("header", header).option("quote", '"').option("escape", '"').csv(path)
