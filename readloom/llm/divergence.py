"""Which sources of a language use other words, and which words those are.

Terms are maximal runs of ASCII letters and of any characters beyond ASCII, only A-Z lower-cased. A
language keeps the V terms that at least ``MIN_DOCS`` of its documents have. A source of a language gives
term t the share p = 1 + floor(10^9 (count + 1) / (N + V)), N its occurrences of kept terms; so does the
language as a whole. The divergence of a term is f(p, q) = floor((p - q)^2 / q), in whole numbers.

Tasks count the terms of their documents; each kept term becomes one row with the counts in all sources,
spread to an array with a place for each source of the language. Higher-order functions give the
contributions of the sources that have the term, two by two, as the difference to what they would be
if one or both hadn't it; what a source's terms give against sources without them depends on the
term's count alone, so it is summed over the counts that occur. Sums go through map-side aggregation.

Null text, lang and source are ''. Every row is a document, repeated or not. A (lang, source) without terms
has only terms of count 0; a language without kept terms gives pairs of value 0. Ties rank by item's UTF-8
bytes. Long texts are cut at ends of words before they are split. An empty table gives no rows; other
columns aren't read. N + V must stay under 9 * 10^15 and counts of one term under 2^63.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tables

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Distinct (lang, source, term) that a task counts before it sends them, and bytes of text split at once.
HELD, PIECE = 500_000, 1_000_000
#: Rows of the table of languages and bytes of it up to which it is broadcast; salted joins beyond.
META_BYTES = 32 << 20

_TABLE = bytes(x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 128 else 32 for x in range(256))


def pieces(raw: bytes, most: int):
    """Lower-cased words of a text's bytes in lists of about ``most`` bytes, no word cut."""
    raw = raw.translate(_TABLE)
    a = 0
    while a < len(raw):
        b = raw.find(b" ", a + most) if len(raw) - a > most else -1
        b = len(raw) if b < 0 else b
        yield raw[a:b].split()
        a = b


def counted(batches, held: int = HELD, piece: int = PIECE):
    """(lang, source, term, n, df) of a task's documents: occurrences and documents."""
    from collections import Counter

    import pyarrow as pa

    def send(counts):
        rows = [(lang, source, t.decode("utf-8"), n, docs[t]) for (lang, source), (words, docs) in counts.items() for t, n in words.items()]
        cols = list(zip(*rows)) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["lang", "source", "term", "n", "df"])

    counts, size = {}, 0
    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"].cast(pa.binary())):
            words, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            size -= len(words)
            seen = set()
            for part in pieces(text.as_py() or b"", piece):
                words.update(part)
                seen.update(part)
            docs.update(seen)
            size += len(words)
            if size > held:
                yield send(counts)
                counts, size = {}, 0
    yield send(counts)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 (count + 1) / total), by long division in three steps of a thousand each: no
    intermediate reaches 1000 * total. floor() of exact whole division."""
    out, rest = F.lit(0).cast("long"), count + 1
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + _div(rest, total)
        rest = rest % total
    return out + 1


def diverging(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def _with_meta(df: DataFrame, meta: DataFrame, small: bool) -> DataFrame:
    """df with its language's columns of meta; languages are few and hot, so a join by language alone would
    make them one task each."""
    if small:
        return df.join(F.broadcast(meta), "lang")
    salts = tables.parts(df.sparkSession)
    salted = meta.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("_salt", F.floor(F.rand(5) * salts).cast("int")).join(salted, ["lang", "_salt"]).drop("_salt")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, meta_bytes: int = META_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank) of docs (lang, source, text): the other sources of the language
    by divergence, part 'pair', and the terms that a source has more than its language, part 'term'."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(empty("lang"), empty("source"), empty("text"))
    schema = "lang string, source string, term string, n long, df long"
    # One shuffle serves both groupings: its keys are keys of each. No hot key: a task sends a term once for each source.
    dealt = rows.mapInArrow(counted, schema).repartition("lang", "term")
    by_source = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    kept = by_source.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("counts")).where(F.col("df") >= min_docs)
    kept = tables.stored(kept.select("lang", "term", "counts"), "divergence-terms")

    groups = rows.select("lang", "source").distinct()
    sums = kept.select("lang", F.explode("counts").alias("source", "n")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("v"))
    each = groups.join(sums, ["lang", "source"], "left").join(vocabulary, "lang", "left").na.fill(0, ["n", "v"])
    each = each.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("s"), F.max("v").alias("v"))
    names, ns, v = F.col("s.source"), F.col("s.n"), F.col("v")
    total = F.transform(ns, lambda n: n + v)
    # Where V and N are 0 no share is ever used.
    whole = F.aggregate(ns, F.lit(0).cast("long"), lambda a, n: a + n) + v
    none = F.transform(total, lambda t: F.when(t > 0, share(F.lit(0).cast("long"), t)).otherwise(1))
    meta = tables.stored(each.select("lang", names.alias("names"), total.alias("total"), none.alias("p0"), v.alias("v"), whole.alias("whole")), "divergence-languages")
    n_bytes = meta.agg(F.sum(F.octet_length(F.array_join("names", "")) + 24 * F.size("names") + 64)).first()[0] or 0
    small = n_bytes <= meta_bytes

    # Each term's counts at the places of its language's sources, 0 where it doesn't occur.
    spread = lambda: F.transform("names", lambda s: F.coalesce(F.try_element_at("counts", s), F.lit(0).cast("long")))
    wide = _with_meta(kept, meta, small).withColumn("wide", spread())
    have = F.filter(F.transform("wide", lambda n, i: F.struct(i.alias("i"), n.alias("n"), F.when(n > 0, share(n, F.get("total", i))).alias("p"))), lambda x: x["n"] > 0)
    wide = tables.stored(wide.select("lang", "term", have.alias("have")), "divergence-wide")
    zero = lambda i: F.get("p0", i)

    # Two sources that both have the term, against what each alone would give (below). The sources of a term
    # are emitted two by two with their shares; the sums see compiled arithmetic.
    x = _with_meta(wide.select("lang", "have", F.explode("have").alias("x")), meta.select("lang", "p0"), small)
    x = x.select("lang", "have", "p0", F.col("x.i").alias("a"), F.col("x.p").alias("p"), zero(F.col("x.i")).alias("pz"))
    x = x.select("lang", "a", "p", "pz", F.inline(F.transform("have", lambda y: F.struct(y["i"].alias("b"), y["p"].alias("q"), zero(y["i"]).alias("qz")))))
    p, pz, q, qz = (F.col(c) for c in ("p", "pz", "q", "qz"))
    together = x.select("lang", "a", "b", (diverging(p, q) - diverging(p, qz) - diverging(pz, q) + diverging(pz, qz)).alias("value"))
    # A source that has the term and any other as if it hadn't, by count.
    by_count = wide.select("lang", F.explode("have").alias("x")).groupBy("lang", "x.i", "x.p").agg(F.count("*").alias("m"))
    by_count = _with_meta(by_count, meta.select("lang", "p0"), small)
    ip, m = F.col("p"), F.col("m")
    apart = F.transform("p0", lambda q, j: F.array(F.struct(F.col("i").alias("a"), j.alias("b"), (m * (diverging(ip, q) - diverging(zero(F.col("i")), q))).alias("value")), F.struct(j.alias("a"), F.col("i").alias("b"), (m * (diverging(q, ip) - diverging(q, zero(F.col("i"))))).alias("value"))))
    alone = by_count.select("lang", F.inline(F.flatten(apart)))
    part = together.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).unionByName(alone.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    found = part.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    # Terms that neither has, and every pair's names.
    frame = meta.select("lang", "names", "p0", "v", F.posexplode("names").alias("a", "source")).select("lang", "source", "a", "p0", "v", F.posexplode("names").alias("b", "item")).where("a <> b")
    base = F.col("v") * diverging(zero(F.col("a")), zero(F.col("b")))
    pairs = frame.join(found, ["lang", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", (base + F.coalesce("value", F.lit(0).cast("long"))).alias("value"))

    # A term of a source against the language.
    q = share(F.aggregate("have", F.lit(0).cast("long"), lambda a, y: a + y["n"]), F.col("whole"))
    term = _with_meta(wide, meta.select("lang", "names", "whole"), small).withColumn("q", q).select("lang", "names", "term", "q", F.inline("have"))
    term = term.where("p > q").select("lang", F.get("names", F.col("i")).alias("source"), F.lit("term").alias("part"), F.col("term").alias("item"), diverging(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(term.withColumn("rank", rank).where(F.col("rank") <= top))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(tables.table(spark, sf_dir, "documents"))


_P = "CAST(1 + (1000000000 * CAST({n} + 1 AS HUGEINT)) // ({total} + v) AS HUGEINT)"
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL),
t AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, {_P.format(n="coalesce(c.n, 0)", total="t.total")} AS p, {_P.format(n="k.n", total="v.total")} AS q FROM t JOIN k ON k.lang = t.lang JOIN v ON v.lang = t.lang LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r) x WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
