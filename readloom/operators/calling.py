"""Variant selection from pileup rows, and call statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import CALLS
from ..functions.exprs import bases_only, callable_site, change_class, count_of, count_text, indel_starts, iupac_bases, once, plain_counts
from . import genome as genome_ops


def parsed(sites: DataFrame) -> DataFrame:
    """Callable sites that differ from the reference, with their alleles counted."""
    s = sites.where(callable_site()).where("ref <> cons")
    s = once(s, "_plain", bases_only(F.col("bases")))
    s = once(s, "alleles", plain_counts(F.col("ref"), F.col("_plain"))).withColumn("deletions", count_of(F.col("_plain"), "*")).withColumn("indel_starts", indel_starts(F.col("bases")))
    return once(s.drop("_plain"), "parsed", F.aggregate(F.map_values("alleles"), F.lit(0), lambda a, x: a + x)).withColumn("mismatch", F.col("parsed") != F.col("depth"))


def warnings(sites: DataFrame) -> DataFrame:
    """(sample, sites, mismatched, bases_off): sites whose parsed bases aren't as many as their depth, and how far
    they are off in all."""
    off = F.abs(F.col("parsed") - F.col("depth"))
    return parsed(sites).groupBy("sample").agg(F.count("*").alias("sites"), F.count_if("mismatch").alias("mismatched"), F.sum(off).cast("long").alias("bases_off"))


def snvs(sites: DataFrame, max_del_frac: float = CALLS["max_del_frac"]) -> DataFrame:
    """Selected substitutions, with hom_het and the alternative bases."""
    s = parsed(sites).where(F.col("parsed") > 0).where(F.col("deletions") / F.col("parsed") <= max_del_frac)
    ref, code = F.upper("ref"), F.upper("cons")
    alts = F.array_sort(F.array_except(iupac_bases(code), F.array(ref)))
    return s.withColumn("ref", ref).withColumn("code", code).withColumn("alts", alts).withColumn("hom_het", F.when(code.isin(*"ACGT"), "hom").otherwise("het"))


def snv_vbed(snvs: DataFrame) -> DataFrame:
    text = F.concat("ref", F.lit("=>"), "code", F.lit("("), "depth", F.lit(";"), count_text(F.col("alleles")), F.lit(")"))
    return snvs.select("sample", "chr", (F.col("pos") - 1).alias("sta"), F.col("pos").alias("stop"), text.alias("descr"), F.col("var_q").alias("qual"), F.lit("+").alias("strand"))


def snv_calls(snvs: DataFrame) -> DataFrame:
    """One row for each alternative base."""
    x = snvs.select("*", F.explode("alts").alias("alt"))
    return x.select("sample", "chr", F.col("pos").alias("start"), F.col("pos").alias("stop"), "ref", "alt", _id("alt", F.col("pos")), F.lit("snv").alias("type"), "depth", count_text(F.col("alleles")).alias("counts"), "con_q", "var_q", "map_q", "hom_het")


def _id(alt, at):
    return F.concat("chr", F.lit(":"), F.col("pos"), F.lit("-"), at, F.lit("_"), F.col(alt)).alias("call_id")


def call_text(calls: DataFrame) -> DataFrame:
    """The annotation tool's lines. Their snpQ holds the consensus quality and conQ the variant
    quality; the table's columns are right."""
    tail = F.concat(F.lit("id:"), "call_id", F.lit(";type:"), "type", F.lit(";covr:"), "depth", F.lit(";cnts:("), "counts", F.lit(");snpQ:"), "con_q", F.lit(";conQ:"), "var_q", F.lit(";mapQ:"), "map_q", F.lit(";"), "hom_het")
    return calls.select("sample", F.concat_ws("\t", "chr", "start", "stop", "ref", "alt", tail).alias("value"))


def indels(rows: DataFrame, min_reads=CALLS["min_indel_reads"], min_count=CALLS["min_indel_count"], min_frac=CALLS["min_indel_frac"], max_other=CALLS["max_other_frac"]) -> DataFrame:
    """Selected indels with coordinates. Equal alleles keep the second count; O without reads goes."""
    entry = lambda k, n: F.struct(k.alias("key"), n.alias("value"))
    one = F.when(F.col("allele1") == F.col("allele2"), F.array().cast("array<struct<key:string,value:int>>")).otherwise(F.array(entry(F.col("allele1"), F.col("n1"))))
    every = F.concat(one, F.array(entry(F.col("allele2"), F.col("n2")), entry(F.lit("O"), F.col("n_other"))))
    x = rows.where(callable_site()).where((F.col("n_other") / F.col("depth") <= max_other) & (F.col("depth") >= min_reads))
    x = x.withColumn("alleles", F.map_from_entries(F.filter(every, lambda e: (e["key"] != "O") | (e["value"] > 0))))
    signed = F.filter(F.map_entries("alleles"), lambda e: e["key"].rlike(r"^[+-]\w"))
    x = x.where(F.exists(signed, lambda e: (e["value"] >= min_count) & (e["value"] / F.col("depth") >= min_frac)))
    length = F.coalesce(F.array_max(F.transform(signed, lambda e: F.when(e["key"].startswith("-"), F.length(e["key"]) - 1).otherwise(0))), F.lit(0))
    x = x.withColumn("del_len", length)
    ins = F.col("del_len") == 0
    x = x.withColumn("sta", F.when(ins, F.col("pos") - 1).otherwise(F.col("pos"))).withColumn("stop", F.when(ins, F.col("pos") - 1).otherwise(F.col("pos") + F.col("del_len")))
    split = F.array_distinct(F.split("genotype", "/"))
    return x.withColumn("call_stop", F.when(ins, F.col("pos")).otherwise(F.col("pos") + F.col("del_len") - 1)).withColumn("called", split).withColumn("hom_het", F.when(F.size(split) == 1, "hom").otherwise("het"))


def indel_calls(indels: DataFrame) -> DataFrame:
    """One row for each called allele but the reference: deleted or inserted bases against '-'."""
    x = indels.select("*", F.explode(F.filter("called", lambda a: a != "*")).alias("allele"))
    bases = F.substr(F.col("allele"), F.lit(2))
    plus = F.col("allele").startswith("+")
    x = x.withColumn("ref", F.when(plus, "-").otherwise(bases)).withColumn("alt", F.when(plus, bases).otherwise("-"))
    return x.select("sample", "chr", F.col("pos").alias("start"), F.col("call_stop").alias("stop"), "ref", "alt", _id("allele", F.col("call_stop")), F.when(F.col("del_len") == 0, "ins").otherwise("del").alias("type"), "depth", count_text(F.col("alleles"), True).alias("counts"), "con_q", "var_q", "map_q", "hom_het")


def indel_vbed(indels: DataFrame, genome: DataFrame) -> DataFrame:
    """Lines with the genome's base at the start (0-based start column)."""
    wanted = indels.select("chr", F.col("sta").alias("start"), F.lit(1).alias("len")).distinct()
    base = genome_ops.fetch(wanted, genome, []).select("chr", F.col("start").alias("sta"), F.upper("seq").alias("ref"))
    x = indels.join(base, ["chr", "sta"], "left")
    text = F.concat(F.coalesce("ref", F.lit("")), F.lit("=>"), F.upper("genotype"), F.lit("("), "depth", F.lit(";"), count_text(F.col("alleles"), True), F.lit(")"))
    return x.select("sample", "chr", "sta", "stop", text.alias("descr"), F.col("var_q").alias("qual"), F.lit("+").alias("strand"))


def vbed_text(vbed: DataFrame) -> DataFrame:
    return vbed.select("sample", F.concat_ws("\t", "chr", "sta", "stop", "descr", "qual", "strand").alias("value"))


def snv_summary(snvs: DataFrame) -> DataFrame:
    cls = F.transform("alts", lambda a: change_class(F.col("ref"), a))
    x = snvs.withColumn("ts", F.size(F.filter(cls, lambda c: c == "transition"))).withColumn("tv", F.size(F.filter(cls, lambda c: c == "transversion")))
    return x.groupBy("sample").agg(F.count("*").alias("snvs"), F.count_if(F.col("hom_het") == "hom").alias("hom"), F.count_if(F.col("hom_het") == "het").alias("het"), F.sum("ts").cast("long").alias("transitions"), F.sum("tv").cast("long").alias("transversions"))


def base_changes(snvs: DataFrame) -> DataFrame:
    """ref by alternative base, one column each."""
    return snvs.select("sample", "ref", F.explode("alts").alias("alt")).groupBy("sample", "ref").pivot("alt", list("ACGT")).count().na.fill(0)


def code_changes(snvs: DataFrame) -> DataFrame:
    """ref by consensus code, in rows."""
    return snvs.groupBy("sample", "ref", "code").agg(F.count("*").alias("n"))


def allele_ranks(sites: DataFrame) -> DataFrame:
    """(sample, alleles, rank, sites, mean_pct): mean share of the allele of each rank, at sites with
    that many alleles, summed in whole hundredths so that no order of rows changes it; before the
    deletion filter. Equal counts rank by allele."""
    s = parsed(sites).where(F.size("alleles") > 0)
    ranked = F.array_sort(F.transform(F.map_entries("alleles"), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("key"))))
    x = s.select("sample", "depth", F.size("alleles").alias("alleles"), F.posexplode(ranked).alias("i", "a"))
    share = F.bround(100 * (-F.col("a.n")) / (F.col("depth") + F.lit(1e-9)), 2)
    return x.groupBy("sample", "alleles", (F.col("i") + 1).alias("rank")).agg(F.count("*").alias("sites"), (F.sum(F.round(100 * share).cast("long")).cast("double") / 100 / F.count("*")).alias("mean_pct"))


def alternative_share(sites: DataFrame) -> DataFrame:
    """(sample, pct, sites): whole percents of reads that aren't the reference, dense from 0 to the
    sample's largest; before the deletion filter."""
    s = parsed(sites)
    ref_reads = F.coalesce(F.try_element_at("alleles", F.upper("ref")), F.lit(0))
    pct = F.floor(100 * ((F.col("depth") - ref_reads) / (F.col("depth") + F.lit(1e-9)))).cast("long")
    by = s.groupBy("sample", pct.alias("pct")).agg(F.count("*").alias("sites"))
    frame = by.groupBy("sample").agg(F.max("pct").alias("m")).select("sample", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m"))).alias("pct"))
    return frame.join(by, ["sample", "pct"], "left").na.fill(0, ["sites"])


def indel_summary(indels: DataFrame) -> DataFrame:
    """(sample, kind, length, n): by the first sign in the genotype."""
    ins, dels = F.regexp_extract("genotype", r"\+(\w+)", 1), F.regexp_extract("genotype", r"-(\w+)", 1)
    kind = F.when(ins != "", "insertion").when(dels != "", "deletion")
    return indels.groupBy("sample", kind.alias("kind"), F.when(ins != "", F.length(ins)).otherwise(F.length(dels)).alias("length")).agg(F.count("*").alias("n")).where("kind is not null")
