"""Paths for tables that a job writes for its own later steps."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the cluster names; a temporary one where it names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    base = base or "file://" + tempfile.mkdtemp(prefix="spark-")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """df written once as Parquet and read again."""
    path = shared(df.sparkSession, name)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
