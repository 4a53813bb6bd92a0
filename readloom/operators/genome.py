"""Reference genome in chunks: sizes, sequence fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import count_of

CHUNK = 256


def sizes(genome: DataFrame) -> DataFrame:
    """(chr, size): A, C, G and T in either case."""
    return genome.groupBy("chr").agg(F.sum(count_of(F.col("seq"), "ACGTacgt")).cast("long").alias("size"))


def with_total(sizes: DataFrame) -> DataFrame:
    return sizes.unionByName(sizes.agg(F.lit("Total_size").alias("chr"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")))


def fetch(wanted: DataFrame, genome: DataFrame, key: list[str], chunk: int = CHUNK) -> DataFrame:
    """wanted (key.., chr, start, len) with ``seq``: bases from the 0-based start. A wanted piece that
    reaches past its contig's end is null."""
    cut = wanted.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("start") / chunk), F.floor((F.col("start") + F.greatest("len", F.lit(1)) - 1) / chunk))))
    lo = F.greatest(F.col("start") - F.col("chunk") * chunk, F.lit(0))
    hi = F.least(F.col("start") + F.col("len") - F.col("chunk") * chunk, F.lit(chunk))
    got = cut.join(genome, ["chr", "chunk"], "left").withColumn("part", F.substr(F.col("seq"), (lo + 1).cast("int"), (hi - lo).cast("int")))
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "part"))), lambda x: x["part"]), "")
    out = got.groupBy(*key, "chr", "start", "len").agg(parts.alias("seq"))
    return out.withColumn("seq", F.when(F.length("seq") == F.col("len"), F.col("seq")))
