"""Tables kept in one total order over their files, with a manifest of each file's first and last key.

Files follow each other by name, rows follow each other in their file, so that a row has an ordinal. The
manifest (in ``_manifest``, which readers of the folder skip) is a sparse index: a range of keys opens only
the files that can hold it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def in_order(df: DataFrame, keys: list[str | Column], partitions: int | None = None) -> DataFrame:
    """df dealt to range partitions, each sorted: partition by partition it is in the keys' order."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def write_lines(df: DataFrame, path: str, keys: list[str | Column], value: str = "value") -> None:
    """The lines of df as text files that follow each other by name in the keys' order."""
    in_order(df, keys).select(value).write.text(path)


def write_ordered(df: DataFrame, path: str, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Writes df as Parquet in the keys' order and returns its manifest: (file, rows, before, first, last), before
    being the rows in the files ahead. Rows with equal keys may stand in two files."""
    in_order(df, keys, partitions).write.parquet(path)
    spark = df.sparkSession
    back = spark.read.schema(df.schema).parquet(path).select(F.col("_metadata.file_name").alias("file"), F.struct(*keys).alias("key"))
    per = back.groupBy("file").agg(F.count("*").alias("rows"), F.min("key").alias("first"), F.max("key").alias("last"))
    before = F.sum("rows").over(Window.orderBy("file")) - F.col("rows")
    per.select("file", "rows", before.alias("before"), "first", "last").write.parquet(f"{path}/_manifest")
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/_manifest")


def with_ordinals(spark: SparkSession, path: str) -> DataFrame:
    """The table with ``ordinal``, from 1."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    start = manifest(spark, path).select(F.col("file").alias("_file"), F.col("before").alias("_before"))
    return rows.join(start, "_file").withColumn("ordinal", F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_before")


def read_range(spark: SparkSession, path: str, first: dict, last: dict) -> DataFrame:
    """Rows whose keys lie from ``first`` to ``last`` (values of the leading keys, both included), from the files that the
    manifest names for them."""
    low, high = F.struct(*(F.lit(v).alias(k) for k, v in first.items())), F.struct(*(F.lit(v).alias(k) for k, v in last.items()))
    part = lambda c, of: F.struct(*(F.col(f"{c}.{k}" if c else k).alias(k) for k in of))
    files = [r["file"] for r in manifest(spark, path).where((part("last", first) >= low) & (part("first", last) <= high)).select("file").collect()]
    schema = spark.read.parquet(path).schema
    rows = spark.read.schema(schema).parquet(*(f"{path}/{f}" for f in files)) if files else spark.createDataFrame([], schema)
    return rows.where((part("", first) >= low) & (part("", last) <= high))
