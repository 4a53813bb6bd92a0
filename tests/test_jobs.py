"""Whole jobs from files to files, held to the tables that the queries check against SQL."""

import pytest
from pyspark.sql import functions as F

from readloom.jobs import frames, run
from readloom.operators import coverage, reads, rollup
from readloom.sources import named, ordered, text

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def f(spark):
    return frames.frames(spark, SF)


@pytest.fixture(scope="module")
def folder(spark, f, tmp_path_factory):
    """Files of reads, pileup rows with some bad ones, regions, genome, known variants and gene models."""
    top = str(tmp_path_factory.mktemp("files"))
    line = lambda df, name, *cells: df.select(F.lit(name).alias("file") if isinstance(name, str) else name.alias("file"), F.concat_ws("\t", *cells).alias("value"))
    x = f.reads.select(F.concat_ws(".", "sample", "run", "dir", F.lit("fastq")).alias("file"), "ordinal", F.concat_ws("\n", "name", "seq", F.lit("+"), "qual").alias("value"))
    named.write_named(ordered.in_order(x, ["file", "ordinal"]), f"{top}/reads")
    mine = F.concat("sample", F.lit(".run.pileup"))
    sites = line(f.sites, mine, "chr", "pos", "ref", "cons", "con_q", "var_q", "map_q", "depth", "bases", F.lit("I"))
    indels = line(f.indels, mine, "chr", "pos", F.lit("*"), "genotype", "con_q", "var_q", "map_q", "depth", "allele1", "allele2", "n1", "n2", "n_other", F.lit("0"), F.lit("0"))
    bad = spark.createDataFrame([("s0.run.pileup", "chr1\tx"), ("s1.run.pileup", "")], "file string, value string")
    named.write_named(sites.unionByName(indels).unionByName(bad), f"{top}/pileup")
    text.write_text(f.regions.select(F.concat_ws("\t", "chr", "start", "stop").alias("value")), f"{top}/bed")
    heads = f.genome.select("chr").distinct().select("chr", F.lit(-1).cast("long").alias("chunk"), F.concat(F.lit(">"), "chr").alias("value"))
    heads.unionByName(f.genome.select("chr", "chunk", F.col("seq").alias("value"))).repartition(1).sortWithinPartitions("chr", "chunk").select("value").write.text(f"{top}/genome")
    ordered.write_lines(f.known.select("line", F.concat_ws("\t", F.lit("1"), "chr", "sta", "stop", F.lit("rs"), F.lit("0"), "strand", F.lit("-"), F.lit("-"), "obs", F.lit("g"), "class", F.lit("u"), F.lit("0"), F.lit("0"), F.lit("u"), F.lit("e"), F.lit("1")).alias("value")), f"{top}/snp131", ["line"])
    tsv = lambda df, name, *cells: text.write_text(df.select(F.concat_ws("\t", *cells).alias("value")), f"{top}/{name}")
    listed = lambda c: F.concat(F.array_join(c, ","), F.lit(","))
    tsv(f.transcripts, "knownGene", "tx_id", "chr", "strand", "sta", "stop", "c_sta", "c_end", F.size("e_sta"), listed("e_sta"), listed("e_end"), F.lit("p"), F.lit("a"))
    tsv(f.canonical_tx, "knownCanonical", "chr", "sta", "stop", F.lit("1"), "tx_id", F.lit("p"))
    tsv(f.genes, "ensGtp", F.coalesce("gene_id", F.lit("")), "tx_id", F.lit("p"))
    tsv(f.genes, "kgXref", "tx_id", *[F.lit("x")] * 3, "symbol", F.lit("r"), F.lit("a"), "description")
    return top


def rows(df):
    return sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect())))


def read_back(spark, path, like):
    return spark.read.csv(path, sep="\t", header=True, schema=like.schema)


def same(spark, out, **tables):
    for name, want in tables.items():
        assert rows(read_back(spark, f"{out}/tables/{name}", want)) == rows(want), name


def test_reads(spark, f, folder, tmp_path):
    out = str(tmp_path)
    run.filter_reads(spark, f"{folder}/reads", out)
    got = named.read_named(spark, f"{out}/reads").groupBy("file", "value").count()
    want = f.routed.select(F.concat_ws(".", "sample", "run", F.lit("filter"), "out", F.lit("fastq")).alias("file"), F.explode(F.array("name", "seq", F.lit("+"), "qual")).alias("value")).groupBy("file", "value").count()
    assert rows(got) == rows(want)
    c = f.classified
    same(spark, out, passed=reads.passed(c), rejected=reads.rejected(c), totals=reads.totals(c), lengths=reads.length_histogram(c), gc=reads.gc_histogram(c), positions=reads.position_profile(c), warnings=reads.warnings(c))


def test_coverage(spark, f, folder, tmp_path):
    out = str(tmp_path)
    run.coverage_statistics(spark, f"{folder}/pileup", f"{folder}/bed", f"{folder}/genome", out)
    same(spark, out, summary=coverage.summary(f.cube, f.target, f.sizes), per_chromosome=coverage.per_chromosome(f.cube, f.sizes), histogram=coverage.histogram_report(f.cube, f.target, f.sizes))
    assert spark.read.csv(f"{out}/bad/pileup", sep="\t", header=True).count() == 2
    assert rows(spark.read.parquet(f"{out}/bedgraph").drop("rank")) == rows(coverage.bedgraph(f.sites, True))


def test_calls_and_annotation(spark, f, folder, tmp_path):
    out = str(tmp_path)
    run.call_variants(spark, f"{folder}/pileup", f"{folder}/genome", out)
    got = named.read_named(spark, f"{out}/variants")
    assert rows(got) == rows(f.vbed.select(F.concat("sample", F.lit(".vbed")).alias("file"), F.concat_ws("\t", "chr", "sta", "stop", "descr", "qual", "strand").alias("value")))
    run.annotate_variants(spark, f"{out}/variants", *(f"{folder}/{x}" for x in ("snp131", "knownGene", "knownCanonical", "ensGtp", "kgXref", "genome")), f"{out}/annotated")
    same(spark, f"{out}/annotated", variants=rollup.variant_report(f.ties), variant_types=rollup.variant_counts(f.variants), tag_combinations=rollup.tag_combinations(f.variants, f.ties), models=rollup.model_counts(f.groups), genes=rollup.gene_counts(f.gene_groups), candidates=rollup.candidate_genes(f.gene_groups))
    lists = spark.read.text(f"{out}/annotated/lists")
    assert lists.count() == rollup.id_lists(f.variants, f.ties, f.gene_groups).count()
