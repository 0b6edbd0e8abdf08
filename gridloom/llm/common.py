"""Small helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (reached as pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where intermediate tables go when a local session names no shared folder (tests).
LOCAL_FOLDER = "/tmp/checkpoints/gridloom"

#: Spark's setting by which an execution's shuffle files go when it ends.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_table(df: DataFrame, name: str, *, by: str | None = None) -> DataFrame:
    """Write ``df`` below the session's shared checkpoint folder and read it back.

    This cuts the lineage and survives lost executors, as every executor sees the folder; shuffle files of
    the write are deleted with its end, as nothing reads them any more. With ``by`` the table is bucketed by
    that column, so that joins on it read it where it lies. Tables go with the folder's session, or by
    ``discard``. Beyond one machine ``spark.checkpoint.dir`` has to be set.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = base or LOCAL_FOLDER
    table_name = f"{name}_{uuid.uuid4().hex}"
    path = f"{base.rstrip('/')}/{table_name}"
    kept = spark.conf.get(_SHUFFLES_GO, "false")
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        if by:
            df.write.bucketBy(parallelism(spark), by).format("parquet").option("path", path).saveAsTable(table_name)
        else:
            df.write.parquet(path)
    finally:
        spark.conf.set(_SHUFFLES_GO, kept)
    if base == LOCAL_FOLDER:
        atexit.register(shutil.rmtree, path, True)
    if not by:
        return spark.read.schema(df.schema).parquet(path)
    staged = spark.table(table_name)
    spark.sql(f"DROP TABLE {table_name}")  # its name only: the files lie in a folder of their own
    return staged


def stage_all(frames: Iterable[DataFrame], empty: DataFrame, name: str) -> DataFrame:
    """Write frames of one schema, each before the next one is asked for, and read them back as one table; ``empty`` if there is none."""
    paths = [staged.inputFiles() for staged in (stage_table(df, name) for df in frames)]
    files = [f for own in paths for f in own]
    return empty.sparkSession.read.schema(empty.schema).parquet(*files) if files else empty


def discard(staged: DataFrame) -> None:
    """Delete a table of ``stage_table`` that no later step reads."""
    files = staged.inputFiles()
    if files:
        path = staged.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        path.getFileSystem(staged.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``most_bytes`` in each (a longer row stands alone)."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if i > start and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start, len(lengths) - start)
