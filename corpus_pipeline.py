"""From documents to packed batches: quality, near duplicates, repeated passages, test items, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that the next one reads from Parquet;
all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from readloom.llm import decontaminate, near_dedup, packing, quality, substring_dedup, tables


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.apply(docs, tables.table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.apply(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.apply(docs)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.apply(docs, tables.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("near duplicates", one_of_each_group),
    ("substring dedup", without_repeats),
    ("decontamination", without_test_items),
    ("packing", packed),
]

#: SQL can't express the trained classifier; tests hold the stages to brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = tables.stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
