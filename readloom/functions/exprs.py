"""Column expressions of the genomics jobs; all run inside Spark, none in Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .constants import ALIASES, CALLS, CANONICAL, CODONS, CONTIGS, HIGH_QUALITY, IUPAC, LAST, READS


def literal_map(d: dict) -> Column:
    return F.create_map(*(F.lit(x) for kv in d.items() for x in kv))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is worked out once for a row, however many filters and columns use it later: Spark writes
    the text of a plain column into each of them."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def bound(value: Column, use) -> Column:
    """use(value), with value worked out once for all places where use has it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def count_of(x: Column, characters: str) -> Column:
    """Characters of x that are among the given ones. Few of them are searched for one by one: translate looks up each
    character of x."""
    if len(characters) > 2:
        return F.length(x) - F.length(F.translate(x, characters, ""))
    left = x
    for c in characters:
        left = F.replace(left, F.lit(c), F.lit(""))
    return F.length(x) - F.length(left)


def gc_fraction(seq: Column) -> Column:
    """Null for an empty sequence."""
    return count_of(seq, "GCgc") / F.nullif(F.length(seq), F.lit(0))


def normal_chrom(c: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(ALIASES), c), c)


def is_canonical(c: Column) -> Column:
    return c.isin(*CANONICAL)


def contig_rank(c: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map({x: i for i, x in enumerate(CONTIGS)}), c), F.lit(LAST))


def complement(s: Column) -> Column:
    return F.translate(s, "ACGTacgt", "TGCATGCA")


def reverse_complement(s: Column) -> Column:
    return F.reverse(complement(s))


def translated(dna: Column) -> Column:
    """Protein of a sequence: blanks go, a partial last codon and unknown codons give nothing."""
    s = F.upper(F.translate(dna, " ", ""))
    n = F.floor(F.length(s) / 3).cast("int")
    codon = lambda i: F.coalesce(F.try_element_at(literal_map(CODONS), F.substring(s, i * 3 + 1, F.lit(3))), F.lit(""))
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), codon), "")).when(n.isNotNull(), F.lit(""))


def iupac_bases(code: Column) -> Column:
    """Sorted bases of a code's first character."""
    return F.split(F.try_element_at(literal_map(IUPAC), F.upper(F.substring(code, 1, 1))), "")


def iupac_code(bases: Column) -> Column:
    """Code of a string of bases, in any order and with repeats."""
    letters = F.array_join(F.array_sort(F.array_distinct(F.split(F.upper(bases), ""))), "")
    return F.try_element_at(literal_map({v: k for k, v in IUPAC.items()}), letters)


def change_class(ref: Column, alt: Column) -> Column:
    """Transition within purines or pyrimidines, else transversion; null where not two bases."""
    pair = F.concat(ref, alt)
    return F.when(pair.isin("AG", "GA", "CT", "TC"), "transition").when((ref != alt) & ref.isin(*"ACGT") & alt.isin(*"ACGT"), "transversion")


def overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Length of the overlap of closed intervals; one given end first is turned round."""
    return F.greatest(F.lit(0), F.least(F.greatest(a, b), F.greatest(c, d)) - F.greatest(F.least(a, b), F.least(c, d)) + 1)


def duration(seconds: Column) -> Column:
    """Days-hours:minutes:seconds, each of two digits at least; days may have more."""
    s = seconds.cast("long")
    return F.when(s.isNotNull(), F.format_string("%02d-%02d:%02d:%02d", F.floor(s / 86400), F.floor(s / 3600) % 24, F.floor(s / 60) % 60, s % 60))


def trimmed_length(qual: Column, offset: Column) -> Column:
    """Qualities left without the tail of lowest quality: B at offset 64, # at 33."""
    return F.length(F.when(offset == 64, F.regexp_replace(qual, "B+$", "")).otherwise(F.regexp_replace(qual, "#+$", "")))


def _below(qual: Column, offset: Column, q: int) -> Column:
    """Qualities under q; the quality characters of offset 33 start at 0 as well."""
    chars = lambda o: "".join(chr(c) for c in range(o, o + q))
    return F.when(offset == 64, count_of(qual, chars(64))).otherwise(count_of(qual, chars(33)))


def reject_reason(seq: Column, qual: Column, offset: Column, min_len=READS["min_len"], max_n=READS["max_n"], max_q10=READS["max_q10"], max_q20=READS["max_q20"]) -> Column:
    """First reason to reject a trimmed read, or null."""
    return (
        F.when(F.length(seq) < min_len, "too_short")
        .when(count_of(seq, "Nn") > max_n, "too_many_N")
        .when(_below(qual, offset, 10) > max_q10, "under10")
        .when(_below(qual, offset, 20) > max_q20, "under20")
    )


def high_quality(min_coverage=HIGH_QUALITY["min_coverage"], min_con_q=HIGH_QUALITY["min_con_q"], min_map_q=HIGH_QUALITY["min_map_q"]) -> Column:
    return (F.col("depth") >= min_coverage) & (F.col("con_q") >= min_con_q) & (F.col("map_q") >= min_map_q)


def callable_site(min_coverage=CALLS["min_coverage"], min_con_q=CALLS["min_con_q"], min_var_q=CALLS["min_var_q"], min_map_q=CALLS["min_map_q"]) -> Column:
    return (F.col("con_q") >= min_con_q) & (F.col("var_q") >= min_var_q) & (F.col("map_q") >= min_map_q) & (F.col("depth") >= min_coverage)


def bases_only(bases: Column) -> Column:
    """A pileup's bases without read marks and without indels: `^q` and `$` go, and after each
    `+n` or `-n` the next n characters."""
    plain = F.regexp_replace(F.regexp_replace(bases, r"\^.", ""), r"\$", "")
    pieces = lambda p: F.split(p, r"[+-](?=\d)")
    digits = lambda p: F.regexp_extract(p, r"^(\d+)", 1)
    cut = lambda p, i: F.when(i == 0, p).otherwise(F.substr(p, F.length(digits(p)) + F.coalesce(digits(p).try_cast("int"), F.lit(0)) + 1))
    return bound(plain, lambda p: F.when(p.rlike(r"[+-]\d"), F.array_join(F.transform(pieces(p), cut), "")).otherwise(p))


def indel_starts(bases: Column) -> Column:
    return F.size(F.split(F.regexp_replace(bases, r"\^.", ""), r"[+-](?=\d)")) - 1


def allele_counts(ref: Column, bases: Column) -> Column:
    """Map of upper-case allele to reads, D for deletions, without zeros."""
    return bound(bases_only(bases), lambda plain: plain_counts(ref, plain))


def plain_counts(ref: Column, plain: Column) -> Column:
    """``allele_counts`` of bases that ``bases_only`` has left."""
    base = F.upper(ref)
    ref_reads = count_of(plain, ".,")
    entry = lambda b: F.struct(F.lit(b).alias("key"), (count_of(plain, b + b.lower()) + F.when(base == b, ref_reads).otherwise(0)).alias("value"))
    other = F.struct(base.alias("key"), F.when(base.isin(*"ACGTN"), F.lit(0)).otherwise(ref_reads).alias("value"))
    every = F.array(*(entry(b) for b in "ACGNT"), F.struct(F.lit("D").alias("key"), count_of(plain, "*").alias("value")), other)
    return F.map_from_entries(F.filter(every, lambda e: e["value"] > 0))


def count_text(m: Column, by_count: bool = False) -> Column:
    """`A:37,C:14`: by allele, or by count downwards and then allele."""
    entries = F.map_entries(m)
    if by_count:
        ordered = F.transform(F.sort_array(F.transform(entries, lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("key")))), lambda e: F.concat(e["key"], F.lit(":"), (-e["n"]).cast("string")))
    else:
        ordered = F.transform(F.sort_array(entries), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return F.array_join(ordered, ",")
