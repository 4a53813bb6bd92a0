"""Interval operators: merging, range joins, genomic order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import contig_rank
from ..sources.ordered import in_order

BIN = 1024
#: Bases of a range in merging, and of the bins that ranges of a join are made of.
SPAN = 1 << 16
#: Left rows of a range in a join.
RANGE_ROWS = 50_000


def merge(regions: DataFrame, keys: list[str], span: int = SPAN) -> DataFrame:
    """Union of overlapping or touching half-open intervals (start, stop) within keys; empty ones are left out.

    A contig is many tasks' work: starts are dealt to ranges of ``span`` bases, each is merged by itself, and an
    associative scan over the ranges (the farthest stop and the last island begun before each) joins islands
    over their borders. Equal starts meet before the shuffle, so a range has at most ``span`` rows,
    however many regions there are.
    """
    x = regions.where("start < stop").groupBy(*keys, "start").agg(F.max("stop").alias("stop")).withColumn("_range", F.floor(F.col("start") / span))
    reach = x.groupBy(*keys, "_range").agg(F.max("stop").alias("_reach"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    reach = reach.select(*keys, "_range", F.max("_reach").over(earlier).alias("_carried"))
    within = Window.partitionBy(*keys, "_range").orderBy("start")
    before = F.greatest(F.max("stop").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.col("_carried"))
    x = x.join(reach, [*keys, "_range"]).withColumn("_before", before)
    x = x.withColumn("_begun", F.when(F.col("_before").isNull() | (F.col("start") > F.col("_before")), F.col("start")))
    # The island that a start without one of its own belongs to began in this range or in an earlier one.
    begun = x.groupBy(*keys, "_range").agg(F.max("_begun").alias("_last"))
    begun = begun.select(*keys, "_range", F.max("_last").over(earlier).alias("_open"))
    island = F.coalesce(F.max("_begun").over(within.rowsBetween(Window.unboundedPreceding, 0)), F.col("_open"))
    islands = x.join(begun, [*keys, "_range"]).withColumn("_island", island)
    return islands.groupBy(*keys, F.col("_island").alias("start")).agg(F.max("stop").alias("stop"))


def bins(start: Column, last: Column, size: int = BIN) -> Column:
    """Bins that the closed interval [start, last] touches."""
    return F.sequence(F.floor(start / size), F.floor(F.greatest(start, last) / size))


def points_in(points: DataFrame, position: Column, regions: DataFrame, size: int = BIN) -> DataFrame:
    """points with ``start`` and ``stop`` of the merged region of their chr that holds position, or
    nulls. Regions are exploded to bins, points stay one row; Spark broadcasts regions if small."""
    cut = regions.select(F.col("chr").alias("_chr"), "start", "stop", F.explode(bins(F.col("start"), F.col("stop") - 1, size)).alias("_bin"))
    left = points.withColumn("_p", position).withColumn("_b", F.floor(F.col("_p") / size))
    on = (F.col("chr") == F.col("_chr")) & (F.col("_b") == F.col("_bin")) & (F.col("_p") >= F.col("start")) & (F.col("_p") < F.col("stop"))
    return left.join(cut, on, "left").drop("_chr", "_bin", "_p", "_b")


def _dealt(left: DataFrame, start: str, keys: list[str], rows: int) -> DataFrame:
    """A row for each key: ``_ranges``, the range of each bin of ``SPAN`` bases, and ``_salts``, the parts of each range.

    Bins that follow each other make one range of about ``rows`` rows of left; a bin with more is a range of
    its own with as many parts as it needs. The table has an integer for each bin of the genome."""
    n = left.groupBy(*keys, F.greatest(F.floor(F.col(start) / SPAN), F.lit(0)).alias("_bin")).agg(F.count("*").alias("_n"))
    by = Window.partitionBy(*keys).orderBy("_bin")
    hot = F.col("_n") >= rows
    # A range ends where the rows so far pass a multiple of ``rows``, and around a hot bin.
    past = F.floor((F.sum("_n").over(by) - F.col("_n")) / rows)
    mark = F.struct(past.alias("past"), hot.alias("hot"), F.when(hot, F.col("_bin")).alias("alone"))
    n = n.withColumn("_mark", mark)
    new = F.when(F.lag("_mark").over(by).isNull() | ~F.col("_mark").eqNullSafe(F.lag("_mark").over(by)), 1).otherwise(0)
    n = n.withColumn("_new", new).withColumn("_range", (F.sum("_new").over(by) - 1).cast("int"))
    per = n.groupBy(*keys, "_range").agg(F.min("_bin").alias("_bin"), F.greatest(F.ceil(F.sum("_n") / (2 * rows)), F.lit(1)).cast("int").alias("_salt"))
    listed = per.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_range", "_bin", "_salt"))).alias("r"))
    # Bins up to the next range's first one; what lies before the first range counts with it, what lies behind with the last.
    width = lambda x, i: F.coalesce(F.get("r", i + 1)["_bin"], x["_bin"] + 1) - F.when(i == 0, F.lit(0)).otherwise(x["_bin"])
    return listed.select(*keys, F.flatten(F.transform("r", lambda x, i: F.array_repeat(x["_range"], width(x, i).cast("int")))).alias("_ranges"), F.col("r._salt").alias("_salts"))


def _range_of(position: Column) -> Column:
    at = F.least(F.greatest(F.floor(position / SPAN), F.lit(0)), F.size("_ranges") - 1)
    return F.get("_ranges", at.cast("int"))


def _pairs(left_start, left_last, left_home, right_start, right_last, right_home):
    """Indexes (i, j) of intervals that overlap: the left begins inside the right where the left is at home, or the
    right begins inside the left, behind its start, where the right is at home. Both are runs of a sorted
    array, so the work is that of sorting and of the pairs themselves."""

    def runs(lo, hi):
        n = np.maximum(hi - lo, 0)
        first = np.repeat(np.cumsum(n) - n, n)
        return np.repeat(np.arange(len(n)), n), np.arange(int(n.sum())) - first + np.repeat(lo, n)

    a = np.flatnonzero(left_home)
    a = a[np.argsort(left_start[a], kind="stable")]
    j, k = runs(np.searchsorted(left_start[a], right_start, "left"), np.searchsorted(left_start[a], right_last, "right"))
    b = np.flatnonzero(right_home)
    b = b[np.argsort(right_start[b], kind="stable")]
    i, m = runs(np.searchsorted(right_start[b], left_start, "right"), np.searchsorted(right_start[b], left_last, "right"))
    return np.concatenate([a[k], i]), np.concatenate([j, b[m]])


def overlapping(left: DataFrame, right: DataFrame, l_start: str, l_last: str, r_start: str, r_last: str, keys: list[str], rows: int = RANGE_ROWS) -> DataFrame:
    """Pairs whose closed intervals overlap, each once. left and right share only the columns in keys; an interval
    whose last base lies before its first overlaps nothing.

    The genome is cut into ranges of about ``rows`` rows of left. A left interval is one row, in the range where it
    begins (and one more for each further range that it reaches); so is a right one, whatever its length. Each
    range is swept over sorted starts. A hot range is split: its left rows go to one of several parts, its
    right rows to all of them. Nulls and keys of one side only have no pairs.
    """
    cuts = _dealt(left.where(f"{l_start} <= {l_last}"), l_start, keys, rows)
    cuts = F.broadcast(cuts)
    key = [*keys, "_range", "_salt"]
    spread = lambda df, start, last: df.where(F.col(start) <= F.col(last)).join(cuts, keys).withColumn("_home", _range_of(F.col(start))).withColumn("_range", F.explode(F.sequence("_home", _range_of(F.col(last))))).withColumn("_home", F.col("_home") == F.col("_range"))
    salts = F.get("_salts", F.col("_range"))
    # By the row's own values: a task that runs again deals its rows as before.
    part = F.pmod(F.xxhash64(*(c for c, kind in left.dtypes if "map<" not in kind)), salts).cast("int")
    a = spread(left, l_start, l_last).withColumn("_salt", part).drop("_ranges", "_salts").withColumnRenamed("_home", "_l_home")
    b = spread(right, r_start, r_last).withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_ranges", "_salts").withColumnRenamed("_home", "_r_home")
    schema = T.StructType([*(f for f in left.schema), *(f for f in right.schema if f.name not in keys)])

    def swept(lefts, rights):
        at = lambda t, c: t.column(c).to_numpy(zero_copy_only=False)
        i, j = _pairs(at(lefts, l_start), at(lefts, l_last), at(lefts, "_l_home"), at(rights, r_start), at(rights, r_last), at(rights, "_r_home"))
        mine = lefts.select([f.name for f in schema if f.name in lefts.column_names]).take(i)
        other = rights.select([f.name for f in schema if f.name not in lefts.column_names]).take(j)
        return pa.Table.from_arrays([*mine.columns, *other.columns], names=[*mine.column_names, *other.column_names]).select(schema.names)

    return a.groupBy(*key).cogroup(b.groupBy(*key)).applyInArrow(swept, schema)


def in_genomic_order(df: DataFrame, position: str = "pos", partitions: int | None = None) -> DataFrame:
    """Range-partitioned and sorted by contig rank and position; ``ordered.write_ordered`` keeps such an order with a manifest."""
    return in_order(df.withColumn("_rank", contig_rank(F.col("chr"))), ["_rank", position], partitions).drop("_rank")
