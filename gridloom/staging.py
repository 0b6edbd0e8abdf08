"""Folders that all executors share, for files between the steps of a job."""

from __future__ import annotations

import atexit
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Where files go when a local session names no shared folder.
LOCAL_FOLDER = "/tmp/checkpoints/gridloom"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a local session without it takes its own and clears it at exit."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{(base or LOCAL_FOLDER).rstrip('/')}/{name}_{uuid.uuid4().hex}"
    if not base:
        atexit.register(shutil.rmtree, path, True)
    return path


def staged(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written to a shared folder and read back: what follows starts from the files, whatever executors are lost.

    The values of ``by``, its last columns, have folders of their own."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path, partitionBy=list(by) or None)
    return df.sparkSession.read.schema(df.schema).parquet(path)
