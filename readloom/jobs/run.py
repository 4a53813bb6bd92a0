"""The jobs from files to files, as functions and for spark-submit:

    spark-submit --py-files readloom.zip -m readloom.jobs.run filter_reads READS OUT

READS, PILEUP and CALLS are files or folders whose names begin with ``sample.run.``; all samples are done at once. Results
go to OUT: reads, calls and id lists as text under names of their own, tables as TSV with a header,
positions in genomic order as Parquet with a manifest, and bad rows with their file, line and error. What
a job reads twice it stores once, in the shared folder.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import contig_rank
from ..operators import annotate, calling, coverage, genome, reads, rollup
from ..sources import named, ordered, text
from ..sources.scratch import stored


def _tables(out: str, **tables: DataFrame) -> None:
    for name, df in tables.items():
        text.write_tsv(df, f"{out}/tables/{name}")


def _bad(out: str, name: str, bad: DataFrame) -> None:
    text.write_tsv(bad.select("file", "line", "error", F.regexp_replace("value", "\t", "\\\\t").alias("value")), f"{out}/bad/{name}")


def filter_reads(spark: SparkSession, fastq: str, out: str) -> None:
    """Read quality control: passing reads as ``sample.run.filter.{1,2,S}.fastq`` and the statistics of all reads. A read's
    direction is the 2 behind its name's slash, else 1; the quality offset comes from the heads of the files."""
    mate = F.when(F.col("name").rlike("/2$"), 2).otherwise(1)
    made = text.with_sample(text.read_fastq(spark, fastq)).withColumn("dir", mate)
    heads = text.with_sample(text.read_fastq(spark, fastq, head=reads.HEAD))
    c = stored(reads.classified(made.drop("path", "read_set"), reads.offsets_of(heads)), "classified")
    lines = reads.fastq_text(reads.routed(c), "run").select(F.concat_ws(".", "sample", "run", F.lit("filter"), "out", F.lit("fastq")).alias("file"), "value")
    named.write_named(lines, f"{out}/reads")
    _tables(out, passed=reads.passed(c), rejected=reads.rejected(c), totals=reads.totals(c), lengths=reads.length_histogram(c), gc=reads.gc_histogram(c), positions=reads.position_profile(c), warnings=reads.warnings(c))


def _pileup(spark: SparkSession, path: str, out: str) -> tuple[DataFrame, DataFrame]:
    """(sites, indels) with their sample; bad rows go to the results."""
    r = text.read_pileup(spark, path)
    _bad(out, "pileup", r.bad)
    return tuple(text.with_sample(r.rows[k], "file").drop("file", "line", "ordinal", "run", "read_set") for k in ("site", "indel"))


def coverage_statistics(spark: SparkSession, pileup: str, bed: str, fasta: str, out: str) -> None:
    """Depth of coverage over genome, chromosomes and target, and positions of high quality as bedGraph rows."""
    sites, _ = _pileup(spark, pileup, out)
    regions = text.read_bed(spark, bed)
    _bad(out, "bed", regions.bad)
    target = regions.rows["region"].select("chr", "start", "stop")
    cube, size, sizes = stored(coverage.cube(sites, target), "cube"), coverage.target_size(target), stored(genome.sizes(text.read_fasta(spark, fasta)), "sizes")
    _tables(out, summary=coverage.summary(cube, size, sizes), per_chromosome=coverage.per_chromosome(cube, sizes), histogram=coverage.histogram_report(cube, size, sizes), histogram_by_chromosome=coverage.histogram_by_chromosome(cube, sizes), genome_sizes=genome.with_total(sizes))
    bedgraph = coverage.bedgraph(sites, hq_only=True).withColumn("rank", contig_rank(F.col("chr")))
    ordered.write_ordered(bedgraph, f"{out}/bedgraph", ["rank", "start", "sample"])


def call_variants(spark: SparkSession, pileup: str, fasta: str, out: str) -> None:
    """Substitutions and indels as ``sample.vbed`` and ``sample.calls``, and tables about them."""
    sites, indel_rows = _pileup(spark, pileup, out)
    snvs, indels = calling.snvs(sites), calling.indels(indel_rows)
    bases = stored(text.read_fasta(spark, fasta), "genome")
    vbed = calling.snv_vbed(snvs).unionByName(calling.indel_vbed(indels, bases))
    lines = vbed.select(F.concat("sample", F.lit(".vbed")).alias("file"), contig_rank(F.col("chr")).alias("rank"), "sta", F.concat_ws("\t", "chr", "sta", "stop", "descr", "qual", "strand").alias("value"))
    named.write_named(ordered.in_order(lines, ["file", "rank", "sta", "value"]), f"{out}/variants")
    calls = calling.call_text(calling.snv_calls(snvs).unionByName(calling.indel_calls(indels)))
    named.write_named(calls.select(F.concat("sample", F.lit(".calls")).alias("file"), "value"), f"{out}/calls")
    _tables(out, snvs=calling.snv_summary(snvs), base_changes=calling.base_changes(snvs), code_changes=calling.code_changes(snvs), allele_ranks=calling.allele_ranks(sites), alternative_share=calling.alternative_share(sites), indels=calling.indel_summary(indels), warnings=calling.warnings(sites))


def annotate_variants(spark: SparkSession, vbed: str, known: str, models: str, canonical: str, gene_map: str, xref: str, fasta: str, out: str, layout: str = "knownGene") -> None:
    """Variants of ``sample.vbed`` files against known variants and gene models: ties, groups under inheritance models, genes,
    id lists, the nested report and lines for a damage predictor."""
    rows = text.read_vbed(spark, vbed)
    _bad(out, "vbed", rows.bad)
    sample = F.regexp_extract("file", r"([^/.]+)\.[^/]*$", 1)
    v = stored(annotate.parse_vbed(rows.rows["call"].withColumn("sample", sample).withColumnRenamed("ordinal", "idx")), "variants")
    k = text.read_numbered(spark, known, "knownVariants")
    _bad(out, "known", k.bad)
    v = stored(annotate.with_status(v, annotate.known_hits(v, k.rows["row"].drop("line").withColumnRenamed("ordinal", "line"))), "variants")
    wanted = text.id_set(text.read_layout(spark, canonical, "knownCanonical"), "id").withColumnRenamed("id", "tx_id")
    tx = annotate.eligible(text.gene_models(text.read_layout(spark, models, layout)).join(wanted, "tx_id", "left_semi"))
    pairs = stored(annotate.candidates(v, tx), "pairs")
    bases = stored(text.read_fasta(spark, fasta), "genome")
    cds = annotate.coding_sequences(tx.join(pairs.select("tx_id").distinct(), "tx_id", "left_semi"), bases)
    effects = stored(annotate.codon_effects(pairs, cds, bases), "effects")
    ties = stored(annotate.ties(pairs).unionByName(annotate.effect_ties(effects)), "ties")
    described = text.read_layout(spark, xref, "kgXref").select(F.col("id").alias("tx_id"), "description", "symbol").dropDuplicates(["tx_id"])
    to_gene = text.gene_map(text.read_numbered(spark, gene_map, "ensGtp").rows["row"], "id", "gene", "ordinal")
    genes = stored(described.join(to_gene, "tx_id", "full"), "genes")
    groups = stored(rollup.inheritance(rollup.transcript_sums(ties)), "groups")
    gene_groups = stored(rollup.with_genes(groups, genes), "gene-groups")
    _tables(out, variants=rollup.variant_report(ties), variant_types=rollup.variant_counts(v), tag_combinations=rollup.tag_combinations(v, ties), models=rollup.model_counts(groups), genes=rollup.gene_counts(gene_groups), candidates=rollup.candidate_genes(gene_groups), without_gene=rollup.without_gene(groups, genes), effects=effects)
    text.write_text(rollup.id_lines(rollup.id_lists(v, ties, gene_groups, groups), genes), f"{out}/lists", "level", "grp", "tag", "sample")
    rollup.gene_report(gene_groups, ties, v).write.json(f"{out}/report")
    named.write_named(rollup.prediction_input(v, ties).select(F.concat("sample", F.lit(".pph")).alias("file"), "value"), f"{out}/predictor")


JOBS = {f.__name__: f for f in (filter_reads, coverage_statistics, call_variants, annotate_variants)}


def main(arguments: list[str]) -> None:
    if not arguments or arguments[0] not in JOBS:
        sys.exit(f"{__doc__}\nJobs: {', '.join(JOBS)}")
    spark = SparkSession.builder.appName(f"readloom {arguments[0]}").getOrCreate()
    JOBS[arguments[0]](spark, *arguments[1:])


if __name__ == "__main__":
    main(sys.argv[1:])
