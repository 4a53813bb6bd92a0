"""From ties to variants, transcripts and genes under inheritance models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GROUPS = [f"{s}{m}" for s in ("all", "known", "novel") for m in ("", "_recessive", "_homozygous")]


def variant_report(ties: DataFrame) -> DataFrame:
    """(sample, tag, variants, known, novel): distinct variants of each tag."""
    once = ties.select("sample", "var_id", "tag", "status").distinct()
    return once.groupBy("sample", "tag").agg(F.count("*").alias("variants"), F.count_if(F.col("status") == "known").alias("known"), F.count_if(F.col("status") == "novel").alias("novel"))


def variant_counts(variants: DataFrame) -> DataFrame:
    """(sample, var_type, variants, known, novel and their shares); all types together as 'all'."""
    each = variants.select("sample", "status", F.explode(F.array(F.col("var_type"), F.lit("all"))).alias("var_type"))
    by = each.groupBy("sample", "var_type").agg(F.count("*").alias("variants"), F.count_if(F.col("status") == "known").alias("known"))
    return by.select("*", (F.col("variants") - F.col("known")).alias("novel"), (F.col("known") / F.col("variants")).alias("known_share"), (1 - F.col("known") / F.col("variants")).alias("novel_share"))


def tag_combinations(variants: DataFrame, ties: DataFrame) -> DataFrame:
    """(sample, tags, variants): sorted tag sets, no_annotations where there are none."""
    sets = ties.groupBy("sample", "var_id").agg(F.array_join(F.array_sort(F.collect_set("tag")), "_").alias("tags"))
    x = variants.select("sample", "var_id").join(sets, ["sample", "var_id"], "left").withColumn("tags", F.coalesce("tags", F.lit("no_annotations")))
    return x.groupBy("sample", "tags").agg(F.count("*").alias("variants")).orderBy("sample", F.desc("variants"), "tags")


def transcript_sums(ties: DataFrame) -> DataFrame:
    """(sample, tx_id, grp, tag, any, sum, hom, het): every tie counts, repeats too. Ties of one status are summed before
    they count for all; sums are of halves, which no order of rows changes."""
    hom = F.col("hom_het") == "hom"
    x = ties.groupBy("sample", "tx_id", "status", "tag").agg(F.count("*").alias("any"), F.sum(F.when(hom, 1.0).otherwise(0.5)).alias("sum"), F.count_if(hom).alias("hom"), F.count_if(~hom).alias("het"))
    x = x.withColumn("grp", F.explode(F.array(F.lit("all"), F.col("status"))))
    return x.groupBy("sample", "tx_id", "grp", "tag").agg(*(F.sum(c).alias(c) for c in ("any", "sum", "hom", "het")))


def inheritance(sums: DataFrame) -> DataFrame:
    """(sample, tx_id, grp, tag) with grp under each model that holds."""
    models = F.filter(F.array(F.col("grp"), F.when(F.col("sum") >= 1, F.concat("grp", F.lit("_recessive"))), F.when(F.col("hom") >= 1, F.concat("grp", F.lit("_homozygous")))), lambda g: g.isNotNull())
    return sums.select("sample", "tx_id", F.explode(models).alias("grp"), "tag")


def model_counts(groups: DataFrame) -> DataFrame:
    """(sample, tag, transcripts of each group)."""
    return groups.groupBy("sample", "tag").pivot("grp", GROUPS).count().na.fill(0)


def with_genes(groups: DataFrame, genes: DataFrame) -> DataFrame:
    return groups.join(genes.where("gene_id is not null").select("tx_id", "gene_id", "description"), "tx_id")


def without_gene(groups: DataFrame, genes: DataFrame) -> DataFrame:
    """Transcripts that have no gene id."""
    return groups.select("sample", "tx_id").distinct().join(genes.where("gene_id is not null"), "tx_id", "left_anti")


def gene_counts(gene_groups: DataFrame) -> DataFrame:
    return gene_groups.groupBy("sample", "grp", "tag").agg(F.count_distinct("gene_id").alias("genes"))


def candidate_genes(gene_groups: DataFrame) -> DataFrame:
    return gene_groups.where("grp = 'novel_recessive' and tag = 'candidateGenes'").select("sample", "gene_id").distinct()


def gene_descriptions(gene_groups: DataFrame) -> DataFrame:
    return gene_groups.groupBy("sample", "gene_id").agg(F.array_join(F.array_sort(F.collect_set("description")), "\t").alias("descriptions"))


def mutation_map(effects: DataFrame, predictions: DataFrame) -> DataFrame:
    """(sample, tx_id, changes): map of amino-acid change to its prediction, zygosity and variant."""
    each = predictions.select("var_id", "tx_id", F.explode(F.array_distinct(F.array("nt1", "nt2"))).alias("allele"), "prediction")
    x = effects.where("ref_aa <> alt_aa").join(each, ["var_id", "tx_id", "allele"], "left")
    one = x.groupBy("sample", "tx_id", "aa_change").agg(F.min(F.struct(F.coalesce("prediction", F.lit("")).alias("prediction"), "hom_het", "var_id")).alias("v"))
    return one.groupBy("sample", "tx_id").agg(F.map_from_entries(F.collect_list(F.struct("aa_change", "v"))).alias("changes"))


def first_predictions(predictions: DataFrame) -> DataFrame:
    """The first row of each snp_id, by line."""
    first = Window.partitionBy("snp_id").orderBy("line")
    return predictions.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def merged_predictions(predictions: DataFrame, effects: DataFrame) -> DataFrame:
    """predictions (line, var_id, tx_id, snp_id, nt1, nt2, prediction, status) whose variant and transcript
    are known, first row of each snp_id, one row for each allele."""
    p = first_predictions(predictions)
    x = p.select("var_id", "tx_id", "snp_id", "prediction", F.explode(F.array_distinct(F.array("nt1", "nt2"))).alias("allele"))
    return effects.select("sample", "var_id", "tx_id", "allele", "hom_het", "status").distinct().join(x, ["var_id", "tx_id", "allele"])


def prediction_ties(merged: DataFrame) -> DataFrame:
    """A tie '<status>_polyphen-2' for each variant and transcript with a prediction but benign."""
    x = merged.where("prediction <> 'benign'").select("sample", "var_id", "tx_id", "snp_id", "hom_het", "status").distinct()
    return x.select("sample", "var_id", "tx_id", F.concat("status", F.lit("_polyphen-2")).alias("tag"), F.lit(None).cast("int").alias("exon_no"), "hom_het", "status")


def prediction_input(variants: DataFrame, ties: DataFrame) -> DataFrame:
    """Lines for a damage predictor: novel single-base variants tagged candidateGenes."""
    tagged = ties.where("tag = 'candidateGenes'").select("sample", "var_id").distinct()
    x = variants.where("var_type = 'snp' and status = 'novel'").join(tagged, ["sample", "var_id"])
    bases = F.concat_ws("/", F.array_sort("alleles"))
    return x.select("sample", F.concat("chr", F.lit(":"), F.col("sta") + 1, F.lit(" "), bases, F.lit(" #"), "var_id", F.lit(";candidateGenes;novel")).alias("value"))


def id_lists(variants: DataFrame, ties: DataFrame, gene_groups: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """(level, grp, tag, sample, id): variants, transcripts and genes of each group and tag. A variant has one
    status, a transcript one sum for each group and tag: only ties and genes repeat."""
    once = ties.select("sample", "var_id", "tag", "status").distinct()
    v = once.select("sample", F.explode(F.array(F.lit("all"), F.col("status"))).alias("grp"), "tag", F.col("var_id").alias("id"))
    groups = inheritance(transcript_sums(ties)) if groups is None else groups
    t = groups.select("sample", "grp", "tag", F.col("tx_id").cast("string").alias("id"))
    g = gene_groups.select("sample", "grp", "tag", F.col("gene_id").alias("id")).distinct()
    level = lambda df, name: df.select(F.lit(name).alias("level"), "grp", "tag", "sample", "id")
    return level(v, "variant").unionByName(level(t, "transcript")).unionByName(level(g, "gene"))


def id_lines(lists: DataFrame, genes: DataFrame) -> DataFrame:
    """id_lists with ``value`` for the id: a transcript's id is followed by its description, a gene's by
    all of its transcripts' descriptions, between tabs."""
    known = genes.select("tx_id", "gene_id", "description")
    tx = known.select(F.lit("transcript").alias("level"), F.col("tx_id").cast("string").alias("id"), F.col("description").alias("d"))
    gene = gene_descriptions(known.where("gene_id is not null").withColumn("sample", F.lit(""))).select(F.lit("gene").alias("level"), F.col("gene_id").alias("id"), F.col("descriptions").alias("d"))
    mine = F.col("level") == "variant"
    x = lists.where(~mine).join(tx.unionByName(gene), ["level", "id"], "left")
    x = x.select("level", "grp", "tag", "sample", F.concat_ws("\t", "id", "d").alias("value"))
    return lists.where(mine).select("level", "grp", "tag", "sample", F.col("id").alias("value")).unionByName(x)


def gene_report(gene_groups: DataFrame, ties: DataFrame, variants: DataFrame, tag: str = "candidateGenes") -> DataFrame:
    """Genes of the two strict novel groups with their transcripts, variants and alleles, nested."""
    g = gene_groups.where((F.col("tag") == tag) & F.col("grp").isin("novel_recessive", "novel_homozygous"))
    v = ties.where(F.col("tag") == tag).select("sample", "tx_id", "var_id").distinct().join(variants.select("sample", "var_id", "hom_het", "alleles"), ["sample", "var_id"])
    tx = v.groupBy("sample", "tx_id").agg(F.array_sort(F.collect_list(F.struct("var_id", "hom_het", "alleles"))).alias("variants"))
    x = g.select("sample", "grp", "gene_id", "tx_id").distinct().join(tx, ["sample", "tx_id"])
    return x.groupBy("sample", "grp", "gene_id").agg(F.array_sort(F.collect_list(F.struct("tx_id", "variants"))).alias("transcripts"))
