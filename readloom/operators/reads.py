"""Read quality control: offset detection, trimming, rejection, mate pairing, statistics.

reads: sample, run, dir, ordinal, name, seq, qual.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import count_of, reject_reason, trimmed_length

HEAD = 250
LOW = "".join(chr(c) for c in range(33, 63))
HIGH = "".join(chr(c) for c in range(75, 127))


def pair_key(name):
    """Up to and with the first slash; the first word of a name without one."""
    return F.coalesce(F.nullif(F.regexp_extract(name, "^([^/]+/)", 1), F.lit("")), F.regexp_extract(name, r"^(\S*)", 1))


def offsets(reads: DataFrame, head: int = HEAD) -> DataFrame:
    """(sample, run, n33, n64, offset) from the first reads of each mate file: more than 99 % of the
    characters that only one offset has decide; offset is null where they don't."""
    first = Window.partitionBy("sample", "run", "dir").orderBy("ordinal")
    return offsets_of(reads.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= head))


def offsets_of(heads: DataFrame) -> DataFrame:
    """``offsets`` of reads that are the first ones of their files already, as ``read_fastq(.., head=HEAD)`` gives them."""
    n = heads.groupBy("sample", "run").agg(F.sum(count_of(F.col("qual"), LOW)).cast("long").alias("n33"), F.sum(count_of(F.col("qual"), HIGH)).cast("long").alias("n64"))
    total = F.col("n33") + F.col("n64")
    return n.withColumn("offset", F.when(100 * F.col("n33") / F.nullif(total, F.lit(0)) > 99, 33).when(100 * F.col("n64") / F.nullif(total, F.lit(0)) > 99, 64))


def classified(reads: DataFrame, offset: int | DataFrame | None = None, **thresholds) -> DataFrame:
    """reads trimmed, with len, reason (null: passes), qualities' offset, pair_key and valid. offset: a number, a table
    as from ``offsets_of``, or found in these reads."""
    if offset is None or isinstance(offset, DataFrame):
        found = (offsets(reads) if offset is None else offset).select("sample", "run", F.coalesce("offset", F.raise_error(F.lit("quality offset can't be told")).cast("int")).alias("offset"))
        reads = reads.join(found, ["sample", "run"])
    else:
        reads = reads.withColumn("offset", F.lit(offset))
    cut = F.length("qual") - trimmed_length(F.col("qual"), F.col("offset"))
    t = reads.withColumn("bases", F.length("seq")).withColumn("_cut", cut)
    t = t.withColumn("seq", F.substr(F.col("seq"), F.lit(1), F.greatest(F.length("seq") - F.col("_cut"), F.lit(0)))).withColumn("qual", F.substr(F.col("qual"), F.lit(1), F.length("qual") - F.col("_cut"))).drop("_cut")
    t = t.withColumn("len", F.length("seq")).withColumn("reason", reject_reason(F.col("seq"), F.col("qual"), F.col("offset"), **thresholds))
    valid = (F.length("name") > 0) & (F.length("seq") > 0) & (F.length("qual") > 0)
    return t.withColumn("pair_key", pair_key(F.col("name"))).withColumn("present", valid).withColumn("same_length", F.length("seq") == F.length("qual"))


def pooled(*runs: DataFrame) -> DataFrame:
    """The reads of several runs or read sets together, columns by name."""
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out


def paired(classified: DataFrame) -> DataFrame:
    """classified with mates and passing: how many reads its pair has and how many of them pass.

    Where a pair's name occurs again, the n-th read of one direction is the mate of the n-th of the
    other. One shuffle on the pair's key serves both windows.
    """
    key = ["sample", "run", "pair_key"]
    turn = F.row_number().over(Window.partitionBy(*key, "dir").orderBy("ordinal"))
    pair = Window.partitionBy(*key, "turn")
    met = classified.repartition(*key).withColumn("turn", turn)
    return met.withColumn("mates", F.count("*").over(pair)).withColumn("passing", F.count_if(F.col("reason").isNull()).over(pair))


def routed(classified: DataFrame) -> DataFrame:
    """Passing reads of complete pairs with out: 1 and 2 when both mates pass, S when one does. Reads
    without a mate have no output."""
    out = F.when(F.col("passing") == 2, F.col("dir").cast("string")).otherwise("S")
    return paired(classified).where(F.col("reason").isNull() & (F.col("mates") == 2)).withColumn("out", out).drop("turn", "mates", "passing")


def mates(classified: DataFrame) -> DataFrame:
    """(sample, run, pair_key, pass1, pass2) of complete pairs."""
    passes = lambda d: F.bool_or((F.col("dir") == d) & F.col("reason").isNull()).alias(f"pass{d}")
    by = paired(classified).where("mates = 2").groupBy("sample", "run", "pair_key", "turn").agg(passes(1), passes(2))
    return by.drop("turn")


def totals(classified: DataFrame) -> DataFrame:
    """(sample, reads, bases) before trimming."""
    return classified.groupBy("sample").agg(F.count("*").alias("reads"), F.sum("bases").cast("long").alias("bases"))


def rejected(classified: DataFrame) -> DataFrame:
    """(sample, reason, reads, pct of all reads)."""
    by = classified.groupBy("sample", F.coalesce("reason", F.lit("passed")).alias("reason")).agg(F.count("*").alias("reads"))
    return by.withColumn("pct", 100 * F.col("reads") / F.sum("reads").over(Window.partitionBy("sample"))).where("reason <> 'passed'")


def passed(classified: DataFrame) -> DataFrame:
    """Reads and bases of each output and in all (total last), with shares of passed and of all. One grouping of the
    reads by sample and output, none included, gives every number."""
    goes = F.col("reason").isNull() & (F.col("mates") == 2)
    out = F.when(goes, F.when(F.col("passing") == 2, F.col("dir").cast("string")).otherwise("S"))
    by = paired(classified).groupBy("sample", out.alias("out")).agg(F.count("*").alias("reads"), F.sum("len").alias("bases"), F.sum("bases").alias("before"))
    every = Window.partitionBy("sample")
    by = by.withColumn("t_reads", F.sum("reads").over(every)).withColumn("t_bases", F.sum("before").over(every)).where("out is not null")
    by = by.select("sample", F.explode(F.array(F.col("out"), F.lit("total"))).alias("out"), "reads", "bases", "t_reads", "t_bases")
    x = by.groupBy("sample", "out").agg(F.sum("reads").alias("reads"), F.sum("bases").cast("long").alias("bases"), F.max("t_reads").alias("t_reads"), F.max("t_bases").alias("t_bases"))
    x = x.withColumn("p_reads", F.max("reads").over(every)).withColumn("p_bases", F.max("bases").over(every))
    pct = lambda a, b: (100 * F.col(a) / F.col(b)).alias(f"{a}_pct_{'passed' if b[0] == 'p' else 'all'}")
    return x.select("sample", "out", "reads", pct("reads", "p_reads"), pct("reads", "t_reads"), "bases", pct("bases", "p_bases"), pct("bases", "t_bases")).orderBy("sample", F.when(F.col("out") == "total", 1).otherwise(0), "out")


def warnings(classified: DataFrame) -> DataFrame:
    """(sample, run, reads, incomplete, unequal, unpaired): reads without a name, bases or qualities, reads with other
    than as many qualities as bases, and reads without a mate."""
    return paired(classified).groupBy("sample", "run").agg(F.count("*").alias("reads"), F.count_if(~F.col("present")).alias("incomplete"), F.count_if(~F.col("same_length")).alias("unequal"), F.count_if(F.col("mates") != 2).alias("unpaired"))


def _share(by: DataFrame, classified: DataFrame) -> DataFrame:
    """pct of the reads in passing outputs."""
    n = routed(classified).groupBy("sample").agg(F.count("*").alias("passed"))
    return by.join(n, "sample", "left").withColumn("pct", 100 * F.col("reads") / F.col("passed")).drop("passed")


def length_histogram(classified: DataFrame) -> DataFrame:
    return _share(classified.where("reason is null").groupBy("sample", "len").agg(F.count("*").alias("reads")), classified)


def gc_histogram(classified: DataFrame, width: int = 4) -> DataFrame:
    """Reads by GC percent, rounded half-even to a tenth, in bins with their middle as label."""
    pct = F.bround(100 * count_of(F.col("seq"), "GCgc") / F.nullif(F.col("len"), F.lit(0)), 1)
    low = F.floor(F.least(pct, F.lit(99.99999)) / width) * width
    by = classified.where("reason is null").groupBy("sample", (low + width / 2).cast("double").alias("gc")).agg(F.count("*").alias("reads"))
    return _share(by, classified)


def _profiled(batches):
    """mapInArrow: a task's sums (sample, pos, quality, n, bases) of each place, from (sample, offset, seq,
    qual). Reads are bytes side by side: no row is made for a base."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        sample = batch.column("sample").dictionary_encode()
        seq, qual = (batch.column(c).fill_null("") for c in ("seq", "qual"))
        size = pc.binary_length(qual).to_numpy(zero_copy_only=False).astype(np.int64)
        base = np.zeros(int(size.sum()), np.uint8)
        have = np.minimum(pc.binary_length(seq).to_numpy(zero_copy_only=False), size)
        begin = np.cumsum(size) - size
        pos = np.arange(len(base)) - np.repeat(begin, size)
        text = np.frombuffer("".join(seq.to_pylist()).encode("latin-1", "replace"), np.uint8)
        full = pc.utf8_length(seq).to_numpy(zero_copy_only=False).astype(np.int64)
        inside = pos < np.repeat(have, size)
        base[inside] = text[(np.repeat(np.cumsum(full) - full, size) + pos)[inside]]
        q = np.frombuffer("".join(qual.to_pylist()).encode("latin-1", "replace"), np.uint8).astype(np.int64)
        q = q - np.repeat(batch.column("offset").to_numpy(zero_copy_only=False).astype(np.int64), size)
        longest, owner = int(size.max(initial=0)), np.repeat(sample.indices.to_numpy(zero_copy_only=False), size)
        for k, name in enumerate(sample.dictionary.to_pylist()):
            mine = owner == k
            p = pos[mine]
            got = np.stack([np.bincount(p, w, longest) for w in (q[mine], (base[mine] | 32) == ord("n"), np.ones(len(p)))]).astype(np.int64)
            old = sums.get(name)
            if old is not None and old.shape[1] > longest:
                got = np.pad(got, ((0, 0), (0, old.shape[1] - longest)))
            elif old is not None:
                old = np.pad(old, ((0, 0), (0, longest - old.shape[1])))
            sums[name] = got if old is None else old + got
    for name, x in sums.items():
        some = np.flatnonzero(x[2])
        columns = [pa.array([name] * len(some), pa.string()), pa.array(some + 1, pa.int32()), *(pa.array(c[some]) for c in x)]
        yield pa.RecordBatch.from_arrays(columns, ["sample", "pos", "quality", "n", "bases"])


def position_profile(classified: DataFrame) -> DataFrame:
    """(sample, pos, mean_quality, n, n_pct, bases) for each 1-based place in passing reads. Tasks sum
    their reads by place, so one row a place and task is shuffled."""
    p = classified.where("reason is null").select("sample", "offset", "seq", "qual").mapInArrow(_profiled, "sample string, pos int, quality long, n long, bases long")
    by = p.groupBy("sample", "pos").agg(*(F.sum(c).cast("long").alias(c) for c in ("quality", "n", "bases")))
    return by.select("sample", "pos", (F.col("quality") / F.col("bases")).alias("mean_quality"), "n", (100 * F.col("n") / F.col("bases")).alias("n_pct"), "bases")


def fastq_text(reads: DataFrame, *more: str) -> DataFrame:
    return reads.select("sample", "out", *more, F.concat_ws("\n", "name", "seq", F.lit("+"), "qual").alias("value"))
