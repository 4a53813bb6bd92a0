"""Canonical digest lookup of whole texts among known licences.

Normal form: lower case; lines that begin with a copyright mark and lines that are only "all rights
reserved" gone; every run of characters other than letters and digits one space; equivalent spellings
one. Its SHA-256 is joined to the digests of the known texts. Expressions of Spark only.

Returns a row for each document: doc_id, digest, license_id (null where no known text is equal). A
null text has a null digest and matches nothing; an empty or blank text has the digest of "" and
matches nothing. Known texts that share a digest give the smallest id. Repeated rows stay repeated,
each with its own result. A very long text is normalised whole by Spark's own functions, within a
few times its size of the executor's heap. An empty table, of documents or of known texts, is no error: no
rows, or no matches. Other columns aren't read. ``digests`` takes a table of texts (an id column and
text) where the list of ``licences`` isn't enough.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables
from .licences import KNOWN, SPELLINGS

_COPYRIGHT = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright\b|©|\(c\)|all rights reserved[^\p{L}\p{N}\n]*$)[^\n]*$"
_MARK = r"copyright|©|\(c\)|all rights reserved"
_NOT_WORD = r"[^\p{L}\p{N}]+"
_VARIANT = "|".join(b for _, b in SPELLINGS)


def normal(text: Column) -> Column:
    t = F.lower(text)
    t = F.when(t.rlike(_MARK), F.regexp_replace(t, _COPYRIGHT, " ")).otherwise(t)
    t = F.trim(F.regexp_replace(t, _NOT_WORD, " "))
    # Most texts have no variant spelling: one look spares them the replacements.
    spelt = reduce(lambda x, p: F.regexp_replace(x, rf"\b{p[1]}\b", p[0]), SPELLINGS, t)
    return F.when(t.rlike(_VARIANT), spelt).otherwise(t)


def known(spark: SparkSession, texts: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """(digest, license_id) of licence texts given as literals."""
    rows = F.inline(F.array(*(F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in texts)))
    return digests(spark.range(1).select(rows), "license_id")


def digests(texts: DataFrame, id_column: str) -> DataFrame:
    """(digest, license_id) of a table of licence texts (id_column, text)."""
    n = normal(F.col("text"))
    return texts.where(F.length(n) > 0).groupBy(F.sha2(n, 256).alias("known_digest")).agg(F.min(id_column).alias("license_id"))


def scan(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """licences: (known_digest, license_id). Spark broadcasts it where its size allows."""
    mine = docs.select("doc_id", F.sha2(normal(F.col("text")), 256).alias("digest"))
    return mine.join(licences, mine["digest"] == licences["known_digest"], "left").select("doc_id", "digest", "license_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(tables.table(spark, sf_dir, "documents"), known(spark))


def _sql(text: str) -> str:
    t = f"lower({text})"
    t = f"regexp_replace({t}, '{_COPYRIGHT}', ' ', 'g')"
    t = f"trim(regexp_replace({t}, '{_NOT_WORD}', ' ', 'g'))"
    for good, bad in SPELLINGS:
        t = rf"regexp_replace({t}, '\b{bad}\b', '{good}', 'g')"
    return t


_VALUES = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)
ORACLE_SQL = f"""
WITH known AS (SELECT sha256({_sql("t")}) AS digest, min(i) AS license_id FROM (VALUES {_VALUES}) v(i, t) GROUP BY 1),
mine AS (SELECT doc_id, sha256({_sql("text")}) AS digest FROM documents)
SELECT doc_id, digest, license_id FROM mine LEFT JOIN known USING (digest)
"""
