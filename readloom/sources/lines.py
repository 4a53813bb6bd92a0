"""Text files by line: numbers of lines, and good and bad rows told apart in one pass.

Spark reads text in byte ranges. A first pass counts the lines of each range, their prefix sums say which
line a range begins with, and the second pass adds the place within the range: many tasks number one
file, and no text is shuffled. Bad rows never end a job and none is lost: each goes, with its file, its
line and what is wrong with it, to a frame of its own.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import once
from .scratch import shared, stored

#: Ranges up to which their table (some 200 bytes each) is broadcast; it is shuffled beyond.
FEW_RANGES = 100_000


def ranged(spark: SparkSession, path) -> DataFrame:
    """(value, file, block, row): lines, the byte range that they were read in and a number that ascends
    in it."""
    meta = F.col("_metadata")
    return spark.read.text(path).select("value", meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row"))


def with_ranges(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """lines with the columns that ranges (file, block, ..; a stored table) has for their range."""
    return lines.join(F.broadcast(ranges) if ranges.count() <= FEW_RANGES else ranges, ["file", "block"])


def numbered(spark: SparkSession, path) -> DataFrame:
    """(file, line, ordinal, value) of text files: line counts from 1 in each file, ordinal from 1 over
    all files in the order of their paths. An empty file has no lines. A file that another job changes
    between the passes is an error."""
    lines = ranged(spark, path)
    counts = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = lambda *keys: F.sum("n").over(Window.partitionBy(*keys).orderBy("file", "block")) - F.col("n")
    counts = stored(counts.select("*", before("file").alias("in_file"), before().alias("in_all")), "line-counts")
    at = F.col("row") - F.col("first")
    at = F.when((at >= 0) & (at < F.col("n")), at + 1).otherwise(F.raise_error(F.lit("a text changed while its lines were counted")).cast("long"))
    return with_ranges(lines, counts).select("file", (F.col("in_file") + at).alias("line"), (F.col("in_all") + at).alias("ordinal"), "value")


class Routed(NamedTuple):
    """Frames by kind, the bad rows (file, line, error, value) and the number of rows of each kind."""

    rows: dict[str, DataFrame]
    bad: DataFrame
    counts: dict[str, int]


BAD = "bad"
CELLS = "_cells"


def routed(lines: DataFrame, kinds: dict[str, DataFrame | list[Column]], kind: Column, error: Column, name: str) -> Routed:
    """Lines (file, line, ordinal, value) dealt by ``kind`` where ``error`` is null, else to the bad rows, in one
    pass over the text. kinds: the columns that each kind keeps. The result is stored; counts come with it."""
    which = F.when(error.isNotNull(), BAD).otherwise(kind)
    keep = [F.struct(*columns).alias(k) for k, columns in kinds.items()]
    lines = once(once(lines, CELLS, F.split("value", "\t", -1)), "_error", error)
    error = F.col("_error")
    one = lines.select("file", "line", "ordinal", F.when(error.isNotNull(), F.col("value")).alias("value"), error.alias("error"), *(F.when(which == k, c).alias(k) for k, c in zip(kinds, keep)), which.alias("kind"))
    seen = Observation()
    path = shared(lines.sparkSession, name)
    one.observe(seen, F.count("*").alias("lines"), *(F.count_if(F.col("kind") == k).alias(k) for k in (*kinds, BAD))).write.partitionBy("kind").parquet(path)
    back = lines.sparkSession.read.schema(one.schema).parquet(path)
    rows = {k: back.where(F.col("kind") == k).select("file", "line", "ordinal", f"{k}.*") for k in kinds}
    bad = back.where(F.col("kind") == BAD).select("file", "line", "error", "value")
    return Routed(rows, bad, dict(seen.get))


def cells() -> Column:
    """The cells of a line, within what ``routed`` is given."""
    return F.col(CELLS)


def typed(schema: T.StructType, columns: Column) -> list[Column]:
    """A row's cells by the schema's names and types, null where a number can't be read."""
    return [F.get(columns, F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema)]


def misfit(schema: T.StructType, columns: Column, least: int, most: int | None = None, required: int | None = None) -> Column:
    """What is wrong with a row, or null: ``blank``, ``header`` (comment, track and browser lines), ``width`` (cells
    not from least to most), or the name of the first number that isn't one among the first ``required``
    columns (all)."""
    value = F.col("value")
    out = F.when(F.trim(value) == "", "blank").when(value.rlike(r"^(#|track\b|browser\b)"), "header")
    out = out.when((F.size(columns) < least) | (F.size(columns) > (most or 1 << 30)), "width")
    for i, f in enumerate(schema[:required] if required else schema):
        if f.dataType != T.StringType():
            out = out.when(F.get(columns, F.lit(i)).try_cast(f.dataType).isNull(), f.name)
    return out
