"""Tables that a job writes for its own later steps, and small shared pieces of plans."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir.

    Where it is unset on a single machine, as in tests, a temporary folder is set; elsewhere that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not current.isDefined() and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = current.get() if current.isDefined() else f"file://{tempfile.mkdtemp(prefix='spark-')}"
        if not current.isDefined():
            spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """df written as Parquet to the shared folder and read again: later steps start from files that
    survive lost executors, not from shuffle blocks."""
    spark = df.sparkSession
    path = os.path.join(scratch(spark), f"{name}-{uuid.uuid4().hex}")
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_bytes(df: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one column-pruned scan."""
    return int(df.agg(F.sum(F.octet_length(text)).cast("long")).first()[0] or 0)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Tells apart rows that share a doc_id; rows equal in both are the same work."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def folded(df: DataFrame, keys: list[str], merge, schema: str, fan: int = 64) -> DataFrame:
    """applyInPandas of ``merge`` over the rows of each key, never more than about ``fan`` tasks' rows
    at once: levels of partial merges come first where df has more partitions than that. ``merge``
    must take its own output as input."""
    n = df.rdd.getNumPartitions()
    df = df.withColumn("_part", F.spark_partition_id())
    while n > fan:
        df = df.withColumn("_part", F.floor(F.col("_part") / fan))
        again = df.groupBy(*keys, "_part").applyInPandas(lambda pdf, m=merge: m(pdf).assign(_part=int(pdf["_part"].iloc[0])), schema + ", _part long")
        df, n = again, -(-n // fan)
    return df.drop("_part").groupBy(*keys).applyInPandas(merge, schema)
