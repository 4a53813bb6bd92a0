"""Text readers with fixed schemas, and writers. Nothing is inferred.

Pileup, BED, variant-bed and mixed folders are read by ``lines.routed``: good rows by kind, bad rows with file,
line and error, every line in one of them. Tables of one layout (``read_layout``) end the job at a wrong width.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calls
from ..functions.exprs import bound, once
from . import lines
from .lines import Routed, misfit, numbered, routed, typed

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()


def _schema(text: str) -> T.StructType:
    kinds = {"i": I, "d": D, "s": S}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split(":") for x in text.split())])


#: Layouts by type, and the pattern of file names that tells it. Fixed values.
LAYOUTS = {
    "knownGene": (r"knownGene", _schema("id:s chr:s strand:s sta:i stop:i c_sta:i c_end:i e_cnt:i e_sta:s e_end:s protein:s align:s")),
    "knownCanonical": (r"knownCanonical", _schema("chr:s sta:i stop:i cluster:s id:s protein:s")),
    "ensGene": (r"ensGene", _schema("bin:i id:s chr:s strand:s sta:i stop:i c_sta:i c_end:i e_cnt:i e_sta:s e_end:s score:s id2:s c_sta_st:s c_end_st:s frames:s")),
    "refGene": (r"refGene", _schema("bin:i id:s chr:s strand:s sta:i stop:i c_sta:i c_end:i e_cnt:i e_sta:s e_end:s score:s id2:s c_sta_st:s c_end_st:s frames:s")),
    "kgXref": (r"kgXref", _schema("id:s mrna:s sp_id:s sp_display:s symbol:s refseq:s protein:s description:s")),
    "ensGtp": (r"ensGtp", _schema("gene:s id:s protein:s")),
    "knownToRefSeq": (r"knownToRefSeq", _schema("name:s value:s")),
    "knownVariants": (r"snp\d+", _schema("bin:i chr:s sta:i stop:i name:s score:i strand:s ref_ncbi:s ref_ucsc:s obs:s mol_type:s class:s valid:s av_het:d av_het_se:d func:s loc_type:s weight:i")),
    "knownIsoforms": (r"knownIsoforms", _schema("cluster:s id:s")),
}
SITES = _schema("chr:s pos:i ref:s cons:s con_q:i var_q:i map_q:i depth:i bases:s quals:s")
BED = _schema("chr:s start:i stop:i")
VBED = _schema("chr:s sta:i stop:i descr:s qual:i strand:s")


def layout(path: str) -> str:
    """Layout by the file's name; an unknown name is an error."""
    name = path.rsplit("/", 1)[-1]
    for kind, (pattern, _) in LAYOUTS.items():
        if re.search(pattern, name):
            return kind
    raise ValueError(f"no layout is known for {name}")


def read_layout(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    return spark.read.csv(path, sep="\t", quote="", schema=LAYOUTS[kind or layout(path)][1], mode="FAILFAST")


def sample_of(path) -> tuple:
    """Columns (sample, run) from a file's path: `sample.run.…`, else the words themselves."""
    part = lambda k, other: F.coalesce(F.nullif(F.regexp_extract(path, r"/?([^./]+)\.([^./]+)\.[^/]*$", k), F.lit("")), F.lit(other))
    return part(1, "sample"), part(2, "run")


INDELS = _schema("chr:s pos:i star:s genotype:s con_q:i var_q:i map_q:i depth:i allele1:s allele2:s n1:i n2:i n_other:i")


def read_pileup(spark: SparkSession, path: str) -> Routed:
    """Kinds ``site`` (10 columns) and ``indel`` (15 columns, the reference is '*') of pileup text. A line with fewer
    than 10 columns, another width for its kind, a text for a number or a '*' within a longer
    reference is bad."""
    c = lines.cells()
    ref = F.get(c, F.lit(2))
    site, indel = misfit(SITES, c, 10, 10), misfit(INDELS, c, 15, 15)
    error = F.when(ref == "*", indel).otherwise(F.coalesce(site, F.when(ref.contains("*"), "ref")))
    indels = [x for x, f in zip(typed(INDELS, c), INDELS) if f.name != "star"]
    return routed(numbered(spark, path), {"site": typed(SITES, c), "indel": indels}, F.when(ref == "*", "indel").otherwise("site"), error, "pileup")


def read_sites(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(site rows, bad rows) of pileup text; indel rows belong to ``read_indels``."""
    r = read_pileup(spark, path)
    return r.rows["site"].drop("file", "line", "ordinal"), r.bad


def read_indels(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(indel rows, bad rows) of pileup text."""
    r = read_pileup(spark, path)
    return r.rows["indel"].drop("file", "line", "ordinal"), r.bad


def read_bed(spark: SparkSession, path: str) -> Routed:
    """Kind ``region``: the first three of three or more columns. Header lines (track, browser, #) are among
    the bad rows, as ``header``."""
    c = lines.cells()
    return routed(numbered(spark, path), {"region": typed(BED, c)}, F.lit("region"), misfit(BED, c, 3), "bed")


def read_vbed(spark: SparkSession, path: str) -> Routed:
    """Kind ``call``: rows whose description is a call (error ``descr`` otherwise). The strand may be missing."""
    c = lines.cells()
    no_call = bound(calls.call(F.get(c, F.lit(3))), lambda got: got.isNull() | calls.kind(got["var"]).isNull())
    error = F.coalesce(misfit(VBED, c, 5, 6), F.when(no_call, "descr"))
    return routed(numbered(spark, path), {"call": typed(VBED, c)}, F.lit("call"), error, "vbed")


def file_name(path: Column) -> Column:
    """The name in a row's path: of the file, or of the folder that a writer gave that name (``file=name``)."""
    folder = F.regexp_extract(path, r"/file=([^/]+)/", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(path, r"([^/]+)$", 1))


def read_mixed(spark: SparkSession, path: str) -> Routed:
    """Kind ``row`` of a folder of files of several layouts, each file's told by its name, in one scan: (layout,
    cells), cells by column name. A line of a file of unknown layout is bad as ``layout``; widths and numbers are
    checked by the layout. ``of_layout`` gives the table of one layout."""
    c = lines.cells()
    name = file_name(F.col("file"))
    kind, error, names = F.lit(None).cast("string"), F.lit("layout"), F.lit(None).cast("array<string>")
    for k, (pattern, schema) in reversed(LAYOUTS.items()):
        mine = name.rlike(pattern)
        kind = F.when(mine, k).otherwise(kind)
        error = F.when(mine, misfit(schema, c, len(schema), len(schema))).otherwise(error)
        names = F.when(mine, F.array(*(F.lit(f.name) for f in schema))).otherwise(names)
    return routed(numbered(spark, path), {"row": [kind.alias("layout"), F.map_from_arrays(names, c).alias("cells")]}, F.lit("row"), error, "mixed")


def of_layout(mixed: Routed, kind: str) -> DataFrame:
    """(file, line, ordinal and the layout's columns) of one layout's rows."""
    x = mixed.rows["row"].where(F.col("layout") == kind)
    return x.select("file", "line", "ordinal", *(F.element_at("cells", f.name).cast(f.dataType).alias(f.name) for f in LAYOUTS[kind][1]))


def read_numbered(spark: SparkSession, path: str, kind: str | None = None) -> Routed:
    """Kind ``row``: a table of one layout with ``line`` (in its file) and ``ordinal`` (over the files in order of
    their paths), for rules of first and last rows."""
    schema = LAYOUTS[kind or layout(path)][1]
    c = lines.cells()
    return routed(numbered(spark, path), {"row": typed(schema, c)}, F.lit("row"), misfit(schema, c, len(schema), len(schema)), "table")


def gene_models(df: DataFrame) -> DataFrame:
    """Exon lists as arrays of integers, without the empty last item."""
    ints = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("int"))
    return df.withColumn("e_sta", ints("e_sta")).withColumn("e_end", ints("e_end")).withColumnRenamed("id", "tx_id")


def id_set(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column) != "").distinct()


def gene_map(df: DataFrame, transcript: str, gene: str, line: str) -> DataFrame:
    """(tx_id, gene_id): rows without a gene go, the last row of a transcript wins."""
    last = Window.partitionBy(transcript).orderBy(F.desc(line))
    x = df.where(F.col(gene).isNotNull() & (F.col(gene) != "")).withColumn("_rn", F.row_number().over(last)).where("_rn = 1")
    return x.select(F.col(transcript).alias("tx_id"), F.col(gene).alias("gene_id"))


def read_fasta(spark: SparkSession, path: str, runs_on: bool = False) -> DataFrame:
    """(chr, chunk, seq) of FASTA files in pieces of 256 bases; the contig's name is the first word after '>'.
    See ``fasta``: a file is read in byte ranges by as many tasks. runs_on: the files, by path, are parts of
    one text."""
    from . import fasta

    return fasta.chunked(spark, path, runs_on)


def read_fastq(spark: SparkSession, path: str, head: int | None = None) -> DataFrame:
    """(path, ordinal, name, seq, qual) of FASTQ files read by the package's data source; ordinal is the
    record's place in its file in bytes (records, in a compressed one). head: the first records of each file
    only, without reading on. Filters on path and ordinal choose files and byte ranges."""
    from .fastq import FastqSource

    spark.dataSource.register(FastqSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("fastq_reads")
    return (reader if head is None else reader.option("head", head)).load(path)


def with_sample(df: DataFrame, path: str = "path") -> DataFrame:
    """df with sample and run by the name in each row's path, and read_set: SE or PE where a part of the name says so,
    else null."""
    folder = F.regexp_extract(path, r"/file=([^/]+)/", 1)
    name = F.when(folder != "", folder).otherwise(F.regexp_replace(path, r"\.\d{5}$", ""))
    sample, run = sample_of(name)
    parts = F.split(F.regexp_extract(name, r"([^/]+)$", 1), r"\.")
    kind = F.when(F.array_contains(parts, "SE"), "SE").when(F.array_contains(parts, "PE"), "PE")
    return df.withColumn("sample", sample).withColumn("run", run).withColumn("read_set", kind)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictor results with line (over all files): columns by the names of the first line, cells trimmed; later
    '#' lines go. The first line is read on the driver. Missing cells and parts are null."""
    text = numbered(spark, path)
    first = text.where("ordinal = 1").first()
    header = [h.strip() for h in first["value"].lstrip("#").split("\t")] if first else ["Comments", "o_snp_id"]
    x = text.where((F.col("ordinal") > 1) & ~F.col("value").startswith("#"))
    x = once(x, "c", F.transform(F.split("value", "\t", -1), lambda v: F.trim(v)))
    x = x.select(F.col("ordinal").alias("line"), *(F.get("c", F.lit(i)).alias(h) for i, h in enumerate(header)))
    note = F.split("Comments", ";")
    chrom, pos, bases, tx = calls.snp_id(F.col("o_snp_id"))
    return x.withColumns({"var_id": F.get(note, F.lit(0)), "tag": F.get(note, F.lit(1)), "status": F.get(note, F.lit(2)), "snp_chr": chrom, "snp_pos": pos, "snp_bases": bases, "tx_id": tx})


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.csv(path, sep="\t", header=header, quote="", escape="")


def write_text(df: DataFrame, path: str, *partition_by: str) -> None:
    """df: value and the columns it is partitioned by. Rows of a partition meet before they are written, so that it has few
    files; large partitions are split by Spark's rebalancing."""
    (df.hint("rebalance", *partition_by).write.partitionBy(*partition_by) if partition_by else df.write).text(path)
