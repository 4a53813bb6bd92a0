"""Length buckets of least padding, and token-budget batches inside them.

A sequence is a document's words and one end token, cut into pieces of ``MAX_LENGTH``. The global
histogram of piece lengths (at most ``MAX_LENGTH`` counts, so bounded) goes to the driver, where
dynamic programming chooses the ``BUCKETS`` boundaries with the least padding in all. A batch is the
next ``BUDGET // boundary`` pieces of a bucket, in an order that shards of the rows' hashes give:
pieces are numbered inside a shard, and shards by running sums of their counts, so no bucket is
sorted in one task.

Defined cases: a null or empty text is its end token alone; a null doc_id is packed like any other;
an empty table has no batches; repeated rows are packed each; a very long text is many pieces; columns
besides doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tables

MAX_LENGTH, BUCKETS, BUDGET = 2048, 8, 16384
SHARD_ROWS = 100_000


def boundaries(lengths: list[int], counts: list[int], buckets: int = BUCKETS) -> list[int]:
    """Upper lengths of the buckets, ascending, that pad least; the least number that does."""
    order = np.argsort(lengths)
    x, c = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    n = len(x)
    if not n:
        return []
    n_before = np.concatenate([[0], np.cumsum(c)])
    cost = np.concatenate([[0], np.full(n, np.iinfo(np.int64).max // 4)])
    cuts = []
    # Padding = Σ boundary·pieces - Σ lengths; the second sum is the same for all choices.
    for _ in range(min(buckets, n)):
        best, at = np.full(n + 1, np.iinfo(np.int64).max // 4), np.zeros(n + 1, np.int64)
        best[0] = 0
        for j in range(1, n + 1):
            total = cost[:j] + x[j - 1] * (n_before[j] - n_before[:j])
            at[j] = int(np.argmin(total))
            best[j] = total[at[j]]
        cuts.append(at)
        if (best == cost).all():
            break
        cost = best
    out, j = [], n
    for at in reversed(cuts):
        if j == 0:
            break
        out.append(int(x[j - 1]))
        j = int(at[j])
    return sorted(set(out))


def lengths(docs: DataFrame, words: Column | None = None) -> DataFrame:
    """(doc_id, n, row): words of the text and one end token, and the text's hash."""
    words = F.coalesce(F.regexp_count("text", F.lit(tables.WORD)), F.lit(0)) if words is None else words
    return docs.select("doc_id", (words + 1).cast("long").alias("n"), F.xxhash64("text").alias("row"))


def pieces(sizes: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """(doc_id, row, piece, start, length)."""
    cut = sizes.select("doc_id", "row", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {max_length}"))).alias("piece"))
    start = F.col("piece") * max_length
    return cut.select("doc_id", "row", "piece", start.alias("start"), F.least(F.lit(max_length), F.col("n") - start).alias("length"))


def pack(docs: DataFrame, max_length: int = MAX_LENGTH, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """(doc_id, piece, start, length, bucket, batch, padding): bucket is the length that the piece is
    padded to; batch numbers the bucket's batches from 0."""
    cut = tables.stored(pieces(lengths(docs), max_length), "pieces")
    histogram = cut.groupBy("length").count().collect()
    uppers = boundaries([r["length"] for r in histogram], [r["count"] for r in histogram], buckets) or [max_length]
    bucket = F.lit(uppers[-1])
    for u in reversed(uppers[:-1]):
        bucket = F.when(F.col("length") <= u, F.lit(u)).otherwise(bucket)
    shards = max(tables.parts(docs.sparkSession), sum(r["count"] for r in histogram) // SHARD_ROWS)
    cut = cut.select("*", bucket.cast("long").alias("bucket"), F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(shards)).alias("shard"))
    counts = cut.groupBy("bucket", "shard").count()
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket", "shard").orderBy("doc_id", "row", "piece", "length")
    numbered = cut.select("*", F.row_number().over(inside).alias("rn")).join(offsets, ["bucket", "shard"])
    batch = F.expr(f"(before + rn - 1) div greatest(1, {budget} div bucket)")
    return numbered.select("doc_id", "piece", "start", "length", "bucket", batch.alias("batch"), (F.col("bucket") - F.col("length")).alias("padding"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(tables.table(spark, sf_dir, "documents"))
