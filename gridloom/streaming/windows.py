"""Windowed aggregates of event streams with late data; the same functions serve batch tables.

An extension beyond spreadsheets: pivot aggregates over tumbling, sliding and session windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.pivot import AGGREGATES


def events_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream, ``ts`` as a timestamp."""
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _window(kind: str, ts: str, size: str, slide: str | None) -> Column:
    if kind == "session":
        return F.session_window(ts, size)
    return F.window(ts, size, slide or size)


def windowed(df: DataFrame, keys: list[str], values: dict[str, tuple[str, str]], size: str, *, slide: str | None = None, kind: str = "tumbling", ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """(window_start, window_end, keys, values): ``values`` names an aggregate and its column.

    On a stream, events later than ``late`` are dropped and their windows' state with them.
    """
    if df.isStreaming:
        df = df.withWatermark(ts, late)
    grouped = df.groupBy(_window(kind, ts, size, slide).alias("w"), *keys)
    out = grouped.agg(*[AGGREGATES[how](F.col(name)).alias(alias) for alias, (how, name) in values.items()])
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *values)


def deduplicated(df: DataFrame, keys: list[str], ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """Each key once within the lateness that state is kept for."""
    if df.isStreaming:
        return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)
