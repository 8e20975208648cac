"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; a local session without the setting gets one of its own, a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="kairopanel-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once as Parquet below spark.checkpoint.dir and read back, for frames that several branches read; the folder
    is cleared after the job."""
    path = f"{work_folder(df.sparkSession, name)}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
