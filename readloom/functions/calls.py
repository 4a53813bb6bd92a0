"""The description of a call, ``REF=>VAR(depth;allele:reads,...)``, taken apart, and ids made of parts.

Each part is cut off at its mark; a text without all marks, or with an empty part, is no call.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import bound, iupac_bases

#: Letters, digits, signs and the star: what an allele may be written with.
_ALLELE = r"^[\w*+-]+$"


def _part(text: Column, mark: str, i: int) -> Column:
    """Part i of a text cut at the first of a mark (a pattern), null where the mark is missing."""
    return F.get(F.split(text, mark, 2), F.lit(i))


def call(descr: Column) -> Column:
    """(ref, var, depth, counts) of a description, blanks left out; null where it is none."""
    d = F.replace(descr, F.lit(" "), F.lit(""))
    item = lambda x, i: F.get(x, F.lit(i))

    def made(ref, var, inside):
        depth, counts = item(inside, 0), item(inside, 1)
        whole = (ref != "") & ~ref.contains("=") & (var != "") & depth.rlike(r"^\d+$") & depth.try_cast("int").isNotNull() & (counts != "")
        return F.when(whole, F.struct(ref.alias("ref"), var.alias("var"), depth.try_cast("int").alias("depth"), counts.alias("counts")))

    within = lambda inner: F.split(F.when(inner.contains(")"), _part(inner, r"\)", 0)), ";", 2)
    after = lambda ref, x: bound(within(item(x, 1)), lambda inside: made(ref, item(x, 0), inside))
    return bound(F.split(d, "=>", 2), lambda x: bound(F.split(item(x, 1), r"\(", 2), lambda y: after(item(x, 0), y)))


def _two(var: Column) -> tuple[Column, Column, Column]:
    """First and second allele of a genotype ``a/b``, and whether it is one."""
    one, other = F.get(F.split(var, "/"), F.lit(0)), F.get(F.split(var, "/"), F.lit(1))
    return one, other, F.coalesce(one.rlike(_ALLELE) & other.rlike(_ALLELE), F.lit(False))


def kind(var: Column) -> Column:
    """'indel' for two alleles between a slash, 'snp' for one letter, else null."""
    return F.when(_two(var)[2], "indel").when(F.length(var) == 1, F.when(var.rlike(_ALLELE) & ~var.isin("*", "+", "-"), "snp"))


def alleles(var: Column) -> Column:
    one, other, two = _two(var)
    return F.when(two, F.array_distinct(F.array(one, other))).otherwise(iupac_bases(var))


def zygosity(var: Column) -> Column:
    """'hom' for two equal alleles or one of A, C, G, T."""
    one, other, two = _two(var)
    return F.when(F.when(two, one == other).otherwise(var.isin(*"ACGT")), "hom").otherwise("het")


def observed(counts: Column) -> Column:
    """Map of upper-case allele to reads of ``allele:reads,..``; items of another form are left out and the
    last of an allele counts."""
    name, n = (lambda x: F.upper(_part(x, ":", 0))), (lambda x: _part(x, ":", 1).try_cast("int"))
    every = F.transform(F.split(counts, ","), lambda x: F.struct(name(x).alias("key"), n(x).alias("value")))
    pairs = F.filter(every, lambda x: x["key"].rlike(_ALLELE) & x["value"].isNotNull())
    keys = lambda p: F.transform(p, lambda x: x["key"])
    last = lambda p: F.when(F.size(F.array_distinct(keys(p))) == F.size(p), p).otherwise(F.filter(p, lambda x, i: ~F.array_contains(F.slice(keys(p), i + 2, F.size(p)), x["key"])))
    return bound(pairs, lambda p: F.map_from_entries(last(p)))


def snp_id(text: Column) -> tuple[Column, Column, Column, Column]:
    """(chr, position, bases, transcript) of ``chr:position.bases.transcript``; the transcript's own dots stay.
    All null where the text isn't of this form."""
    chrom, rest = _part(text, ":", 0), _part(text, ":", 1)
    pos, rest = _part(rest, r"\.", 0), _part(rest, r"\.", 1)
    bases, tx = _part(rest, r"\.", 0), _part(rest, r"\.", 1)
    fits = chrom.startswith("chr") & pos.try_cast("long").isNotNull() & (bases != "") & (tx != "")
    return tuple(F.when(fits, x) for x in (chrom, pos.try_cast("long"), bases, tx))
