"""Depth-of-coverage statistics over genome, chromosomes and target regions.

One grouping of all positions, by (sample, chr, in_bed, depth), feeds every report: the cube has a
row for each depth seen and no more, however many positions there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import CANONICAL
from ..functions.exprs import high_quality, is_canonical, normal_chrom
from . import intervals

MOST_DEPTH = 500


def canonical(df: DataFrame) -> DataFrame:
    """Chromosome names made normal; rows of other contigs go."""
    return df.withColumn("chr", normal_chrom(F.col("chr"))).where(is_canonical(F.col("chr")))


def chrom_dim(spark) -> DataFrame:
    return spark.createDataFrame([(c, i + 1) for i, c in enumerate(CANONICAL)], "chr string, idx int")


def targets(regions: DataFrame) -> DataFrame:
    return intervals.merge(canonical(regions), ["chr"])


def target_size(regions: DataFrame) -> DataFrame:
    return targets(regions).agg(F.coalesce(F.sum(F.col("stop") - F.col("start")), F.lit(0)).cast("long").alias("bed_positions"))


def flagged(sites: DataFrame, regions: DataFrame, pos_shift: int = 0) -> DataFrame:
    """sites with in_bed and hq. The 1-based position is held against 0-based regions as it is;
    pos_shift = 1 takes one off first."""
    found = intervals.points_in(canonical(sites), F.col("pos") - pos_shift, targets(regions))
    return found.withColumn("in_bed", F.col("start").isNotNull()).withColumn("hq", high_quality()).drop("start", "stop")


def cube(sites: DataFrame, regions: DataFrame, pos_shift: int = 0) -> DataFrame:
    """(sample, chr, in_bed, depth, positions, hq)."""
    f = flagged(sites, regions, pos_shift)
    return f.groupBy("sample", "chr", "in_bed", "depth").agg(F.count("*").alias("positions"), F.count_if("hq").alias("hq"))


def scopes(cube: DataFrame) -> DataFrame:
    """The cube's rows under each scope that they count in: all, bed, or their chromosome."""
    names = F.filter(F.array(F.lit("all"), F.when(F.col("in_bed"), F.lit("bed")), F.col("chr")), lambda x: x.isNotNull())
    return cube.select("sample", F.explode(names).alias("scope"), "depth", "positions", "hq")


def depth_histogram(cube: DataFrame) -> DataFrame:
    return scopes(cube).groupBy("sample", "scope", "depth").agg(F.sum("positions").alias("positions"))


def totals(cube: DataFrame) -> DataFrame:
    """(sample, scope, coverage, hq_positions, covered_positions)."""
    return scopes(cube).groupBy("sample", "scope").agg(F.sum(F.col("depth") * F.col("positions")).cast("long").alias("coverage"), F.sum("hq").cast("long").alias("hq_positions"), F.sum("positions").cast("long").alias("covered_positions"))


def cumulative(cube: DataFrame) -> DataFrame:
    """(sample, scope, depth, cum): positions of at least that depth, for every depth from 1 to the
    sample's largest. A scope with no positions has no rows."""
    counts = depth_histogram(cube)
    most = counts.groupBy("sample").agg(F.max("depth").alias("most"))
    frame = counts.select("sample", "scope").distinct().join(most, "sample").where("most >= 1").select("sample", "scope", F.explode(F.sequence(F.lit(1), F.col("most"))).alias("depth"))
    down = Window.partitionBy("sample", "scope").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    dense = frame.join(counts, ["sample", "scope", "depth"], "left")
    return dense.select("sample", "scope", "depth", F.sum(F.coalesce("positions", F.lit(0))).over(down).cast("long").alias("cum"))


def base80(cube: DataFrame, size: DataFrame) -> DataFrame:
    """(sample, base80): the depth that 80 % of the target reaches, between neighbours by line.
    Depth 0 counts with the positions seen at depth 0, not with the whole target."""
    zero = depth_histogram(cube).where("scope = 'bed' and depth = 0").select("sample", F.lit(0).alias("depth"), F.col("positions").alias("cum"))
    samples = cube.where("in_bed").select("sample").distinct()
    zero = samples.join(zero, "sample", "left").select("sample", F.lit(0).alias("depth"), F.coalesce("cum", F.lit(0)).alias("cum"))
    line = zero.unionByName(cumulative(cube).where("scope = 'bed'").select("sample", "depth", "cum"))
    after = F.coalesce(F.lead("cum").over(Window.partitionBy("sample").orderBy("depth")), F.lit(0))
    low = line.withColumn("after", after).crossJoin(F.broadcast(size)).where("after / bed_positions < 0.8D")
    first = low.groupBy("sample").agg(F.min_by(F.struct("depth", "cum", "after", "bed_positions"), "depth").alias("x")).select("sample", "x.*")
    value = F.col("depth") + (F.col("cum") - 0.8 * F.col("bed_positions")) / F.nullif(F.col("cum") - F.col("after"), F.lit(0))
    return first.select("sample", value.alias("base80"))


def summary(cube: DataFrame, size: DataFrame, genome_sizes: DataFrame) -> DataFrame:
    """One row a sample. genome_sizes: (chr, size); the genome is all its contigs."""
    wide = totals(cube).where("scope in ('all', 'bed')").groupBy("sample").pivot("scope", ["all", "bed"]).agg(F.first("coverage").alias("coverage"), F.first("hq_positions").alias("hq"), F.first("covered_positions").alias("n"))
    wide = wide.na.fill(0).crossJoin(F.broadcast(size)).crossJoin(F.broadcast(genome_sizes.agg(F.sum("size").alias("genome_size")))).join(base80(cube, size), "sample", "left")
    share = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0))
    mean_bed = share("bed_coverage", "bed_positions")
    return wide.select(
        "sample", "bed_positions", F.col("all_n").alias("pileup_positions"), F.col("all_coverage").alias("coverage"), "genome_size",
        share("all_coverage", "genome_size").alias("mean_genome"), share("all_coverage", "all_n").alias("mean_covered"), mean_bed.alias("mean_bed"),
        F.col("all_hq").alias("hq_positions"), share("all_hq", "genome_size").alias("hq_genome"), share("all_hq", "all_n").alias("hq_covered"),
        F.col("bed_hq").alias("hq_bed_positions"), share("bed_hq", "bed_positions").alias("hq_bed"), F.col("bed_coverage").alias("coverage_bed"),
        share("bed_coverage", "all_coverage").alias("coverage_share"), share("bed_hq", "all_hq").alias("hq_share"),
        "base80", (mean_bed / F.nullif(F.col("base80"), F.lit(0.0))).alias("base80_penalty"),
    )


def per_chromosome(cube: DataFrame, genome_sizes: DataFrame) -> DataFrame:
    """Every canonical chromosome of every sample, with or without data, in order."""
    spark = cube.sparkSession
    frame = cube.select("sample").distinct().crossJoin(F.broadcast(chrom_dim(spark)))
    got = frame.join(totals(cube).withColumnRenamed("scope", "chr"), ["sample", "chr"], "left").join(genome_sizes, "chr", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return got.select("sample", "idx", "chr", zero("size"), zero("hq_positions"), zero("coverage"), (F.coalesce("coverage", F.lit(0)) / F.nullif(F.col("size"), F.lit(0))).alias("mean")).orderBy("sample", "idx")


def histogram_report(cube: DataFrame, size: DataFrame, genome_sizes: DataFrame) -> DataFrame:
    """Cumulative counts and percents of target, covered positions and genome, depth 0 to 500."""
    cum = cumulative(cube).where((F.col("depth") <= MOST_DEPTH) & F.col("scope").isin("all", "bed"))
    wide = cum.groupBy("sample", "depth").pivot("scope", ["all", "bed"]).agg(F.first("cum")).na.fill(0)
    n = totals(cube).where("scope = 'all'").select("sample", "covered_positions")
    base = n.crossJoin(F.broadcast(size)).crossJoin(F.broadcast(genome_sizes.agg(F.sum("size").alias("genome_size"))))
    pct = lambda a, b: 100 * F.col(a) / F.nullif(F.col(b), F.lit(0))
    rows = wide.join(base, "sample").select("sample", "depth", F.col("bed").alias("n_bed"), pct("bed", "bed_positions").alias("pct_bed"), F.col("all").alias("n_covered"), pct("all", "covered_positions").alias("pct_covered"), pct("all", "genome_size").alias("pct_genome"))
    hundred = F.lit(100.0)
    zero = base.select("sample", F.lit(0).alias("depth"), F.col("bed_positions").alias("n_bed"), hundred.alias("pct_bed"), F.col("covered_positions").alias("n_covered"), hundred.alias("pct_covered"), hundred.alias("pct_genome"))
    return zero.unionByName(rows)


def histogram_by_chromosome(cube: DataFrame, genome_sizes: DataFrame) -> DataFrame:
    """A column for each canonical chromosome: 100 at depth 0, then cumulative share of its size."""
    cum = cumulative(cube).where((F.col("depth") <= MOST_DEPTH) & F.col("scope").isin(*CANONICAL)).withColumnRenamed("scope", "chr").join(genome_sizes, "chr")
    every = cumulative(cube).where(F.col("depth") <= MOST_DEPTH).select("sample", "depth").distinct()
    wide = cum.groupBy("sample", "depth").pivot("chr", CANONICAL).agg(F.first(F.col("cum") / F.nullif(F.col("size"), F.lit(0))))
    rows = every.join(wide, ["sample", "depth"], "left").na.fill(0.0)
    zero = cube.select("sample").distinct().select("sample", F.lit(0).alias("depth"), *(F.lit(100.0).alias(c) for c in CANONICAL))
    return zero.unionByName(rows)


def bedgraph(sites: DataFrame, hq_only: bool = False) -> DataFrame:
    s = canonical(sites)
    s = s.where(high_quality()) if hq_only else s
    text = F.concat_ws(":", "chr", "pos", "ref", "con_q", "map_q", "depth")
    return s.select("sample", "chr", F.col("pos").alias("start"), (F.col("pos") + 1).alias("stop"), text.alias("name"), F.lit("+").alias("strand"), F.col("depth").alias("score"))


def gene_pieces(transcripts: DataFrame, ss_len: int = 2) -> DataFrame:
    """(tx_id, chr, kind, start, stop): exons, their coding parts and the splice sites beside them."""
    e = F.arrays_zip("e_sta", "e_end")
    n = F.size("e_sta")

    def of(kind, x, i):
        lo, hi = F.greatest(x["e_sta"], F.col("c_sta")), F.least(x["e_end"], F.col("c_end"))
        row = lambda a, b: F.struct(F.lit(kind).alias("kind"), a.alias("start"), b.alias("stop"))
        if kind == "exon":
            return F.array(row(x["e_sta"], x["e_end"]))
        if kind == "cds":
            return F.when(lo < hi, F.array(row(lo, hi))).otherwise(F.array().cast("array<struct<kind:string,start:int,stop:int>>"))
        donor = F.when(i < n - 1, row(x["e_end"], x["e_end"] + ss_len))
        acceptor = F.when(i > 0, row(x["e_sta"] - ss_len, x["e_sta"]))
        return F.filter(F.array(donor, acceptor), lambda y: y.isNotNull())

    def pieces(kind):
        return F.flatten(F.transform(e, lambda x, i: of(kind, x, i)))

    every = F.concat(*(pieces(k) for k in ("exon", "cds", "splice")))
    return transcripts.select("tx_id", "chr", F.explode(every).alias("p")).select("tx_id", "chr", "p.kind", "p.start", "p.stop")


def gene_coverage(sites: DataFrame, transcripts: DataFrame) -> DataFrame:
    """(sample, tx_id, kind, bases, coverage, mean_depth, hq_fraction); uncovered pieces count 0."""
    pieces = gene_pieces(canonical(transcripts))
    merged = intervals.merge(pieces, ["tx_id", "chr", "kind"])
    bases = merged.groupBy("tx_id", "kind").agg(F.sum(F.col("stop") - F.col("start")).cast("long").alias("bases"))
    points = canonical(sites).select("sample", "chr", "depth", high_quality().alias("hq"), (F.col("pos") - 1).alias("p0"))
    cut = merged.select("tx_id", "chr", "kind", "start", (F.col("stop") - 1).alias("last"))
    hit = intervals.overlapping(points.withColumn("p1", F.col("p0")), cut, "p0", "p1", "start", "last", ["chr"])
    got = hit.groupBy("sample", "tx_id", "kind").agg(F.sum("depth").cast("long").alias("coverage"), F.count_if("hq").alias("hq"))
    frame = bases.crossJoin(sites.select("sample").distinct())
    out = frame.join(got, ["sample", "tx_id", "kind"], "left").na.fill(0, ["coverage", "hq"])
    return out.select("sample", "tx_id", "kind", "bases", "coverage", (F.col("coverage") / F.col("bases")).alias("mean_depth"), (F.col("hq") / F.col("bases")).alias("hq_fraction"))
