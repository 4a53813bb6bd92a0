"""Genomics tables derived from the driver's tables by integer arithmetic and text functions.

One SQL text serves Spark and the checking engine; ``{G}``, ``{EXPLODE:n}`` and ``{LIST:n:i:expr}`` stand
for what they write differently.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

AZ = "abcdefghijklmnopqrstuvwxyz"
NT = "ACGTACGTACGTACGTACGTACGTAC"
NB = "ACGTNCGTACGTANGTNCGTACGTAC"
QA = "II+III5IIIIIIIIIIIIII+IIIII"
QB = "II+II&5IIIIII&III+I5IIIIII"
CHUNK = 256


def div(a: str, b: str) -> str:
    return f"CAST(floor(({a}) / ({b})) AS BIGINT)"


def sub(s: str, start: str, n: str) -> str:
    return f"substring({s}, CAST({start} AS INT), CAST({n} AS INT))"


def rep(s: str, n: str) -> str:
    return f"repeat({s}, CAST({n} AS INT))"


CHROM = "CASE k WHEN 22 THEN 'chrX' WHEN 23 THEN 'chrY' WHEN 24 THEN 'chrM' ELSE concat('chr', CAST(k + 1 AS STRING)) END"

#: In order: each uses those before it.
TABLES = {
    "clean": "SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^a-z]', ''{G}) AS s FROM documents",
    "fill": f"SELECT doc_id, doc_id % 25 AS k, s, greatest({div('length(s) + 255', '256')}, 1) AS n FROM clean",
    "filled": "SELECT *, CAST(sum(n) OVER (PARTITION BY k ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - n AS BIGINT) AS base FROM fill",
    "cut": "SELECT k, base, s, {EXPLODE:n} AS i FROM filled",
    "genome_k": f"SELECT k, base + i AS chunk, substring(concat(translate({sub('s', f'i * {CHUNK} + 1', str(CHUNK))}, '{AZ}', '{NT}'), repeat('ACGT', 64)), 1, {CHUNK}) AS seq FROM cut",
    "genome": f"SELECT {CHROM} AS chr, chunk, seq FROM genome_k",
    "glen": f"SELECT least(CAST(min(n) AS BIGINT) * {CHUNK}, (SELECT greatest(4096, 4 * {div('count(*)', '25')}) FROM lineitem)) AS g FROM (SELECT k, sum(n) AS n FROM fill GROUP BY k) x",
    "pile0": "SELECT k, pos, CAST(sum(qty) AS BIGINT) AS depth, max(con_q) AS con_q, max(var_q) AS var_q, max(map_q) AS map_q, max(pk) AS pk FROM (SELECT l_orderkey % 25 AS k, (l_orderkey * 7 + l_linenumber * 131 + l_partkey * 13) % g + 1 AS pos, CAST(l_quantity AS BIGINT) AS qty, l_partkey % 100 AS con_q, l_orderkey * 3 % 100 AS var_q, l_orderkey % 61 AS map_q, l_partkey AS pk FROM lineitem CROSS JOIN glen) x GROUP BY k, pos",
    "pile1": f"SELECT p.*, {sub('g.seq', '(p.pos - 1) % 256 + 1', '1')} AS ref, {sub(chr(39) + 'ACGTMRWSYK' + chr(39), 'pk % 10 + 1', '1')} AS cons, {div('depth * (pk % 4)', '4')} AS a FROM pile0 p JOIN genome_k g ON p.k = g.k AND {div('p.pos - 1', '256')} = g.chunk",
    "pile2": "SELECT *, CASE WHEN pk % 19 = 0 THEN depth - a ELSE 0 END AS dels FROM pile1",
    "sites": f"""SELECT concat('s', CAST(pk % 2 AS STRING)) AS sample, {CHROM} AS chr, CAST(pos AS INT) AS pos, ref, cons, CAST(con_q AS INT) AS con_q, CAST(var_q AS INT) AS var_q, CAST(map_q AS INT) AS map_q, CAST(depth AS INT) AS depth,
        concat(CASE WHEN pk % 5 = 0 THEN '^]' ELSE '' END, {rep("'.'", 'depth - a - dels')}, {rep(sub("'ACGTacgt'", div('pk', '10') + ' % 8 + 1', '1'), 'a')}, {rep("'*'", 'dels')}, CASE WHEN pk % 6 = 0 THEN '+2AC' ELSE '' END, CASE WHEN pk % 3 = 0 THEN '$' ELSE '' END) AS bases, pk FROM pile2""",
    "indels0": f"SELECT *, concat(CASE WHEN pk % 2 = 0 THEN '+' ELSE '-' END, {sub(chr(39) + 'ACGTAC' + chr(39), '1', '1 + pk % 5')}) AS allele2, {div('depth * (pk % 4)', '4')} AS n2, CASE WHEN pk % 13 = 0 THEN {div('depth', '4')} WHEN pk % 3 = 0 THEN 1 ELSE 0 END AS n_other FROM sites WHERE pk % 11 = 0",
    "indels": "SELECT sample, chr, pos, CASE WHEN pk % 3 = 0 THEN concat(allele2, '/', allele2) ELSE concat('*/', allele2) END AS genotype, con_q, var_q, map_q, depth, '*' AS allele1, allele2, CAST(greatest(depth - n2 - n_other, 0) AS INT) AS n1, CAST(n2 AS INT) AS n2, CAST(n_other AS INT) AS n_other FROM indels0",
    "regions": f"SELECT {CHROM} AS chr, CAST(sta AS INT) AS start, CAST(sta + 5 + c % 40 AS INT) AS stop FROM (SELECT o_orderkey % 25 AS k, (o_orderkey * 11 + o_custkey * 17) % (g - 200) AS sta, o_custkey AS c FROM orders CROSS JOIN glen) x",
    "tx0": "SELECT p_partkey AS tx_id, p_partkey % 25 AS k, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, (p_partkey * 37) % (g - 1500) + 100 AS sta, 1 + p_size % 5 AS ecnt, 30 + 3 * (p_size % 20) AS elen, 20 + p_partkey % 50 AS ilen, p_name, p_brand FROM part CROSS JOIN glen",
    "tx1": "SELECT *, sta + ecnt * elen + (ecnt - 1) * ilen AS stop FROM tx0",
    "transcripts": f"SELECT CAST(tx_id AS BIGINT) AS tx_id, {CHROM} AS chr, strand, CAST(sta AS INT) AS sta, CAST(stop AS INT) AS stop, CAST(CASE WHEN tx_id % 7 = 0 THEN sta WHEN tx_id % 13 = 0 THEN sta WHEN tx_id % 11 = 0 THEN sta + 13 ELSE sta + 12 END AS INT) AS c_sta, CAST(CASE WHEN tx_id % 7 = 0 THEN sta ELSE stop - 9 END AS INT) AS c_end, {{LIST:ecnt:CAST(sta + i * (elen + ilen) AS INT)}} AS e_sta, {{LIST:ecnt:CAST(sta + i * (elen + ilen) + elen AS INT)}} AS e_end FROM tx1",
    "genes": f"SELECT CAST(tx_id AS BIGINT) AS tx_id, CASE WHEN tx_id % 10 = 9 THEN NULL ELSE concat('g', CAST({div('tx_id', '2')} AS STRING)) END AS gene_id, p_name AS description, p_brand AS symbol FROM tx0",
    "known": f"SELECT event_id AS line, {CHROM} AS chr, CAST(sta AS INT) AS sta, CAST(CASE WHEN m = 0 THEN sta ELSE sta + 1 END AS INT) AS stop, CASE m WHEN 0 THEN 'insertion' WHEN 1 THEN 'deletion' ELSE 'single' END AS class, CASE WHEN event_id % 2 = 0 THEN '+' ELSE '-' END AS strand, CASE WHEN event_id % 97 = 0 THEN 'lengthTooLong' WHEN m = 0 THEN '-/ACG' WHEN m = 1 THEN '-/A' ELSE CASE event_id % 6 WHEN 0 THEN 'A/C' WHEN 1 THEN 'A/G' WHEN 2 THEN 'A/T' WHEN 3 THEN 'C/G' WHEN 4 THEN 'C/T' ELSE 'G/T' END END AS obs FROM (SELECT event_id, user_id % 25 AS k, (event_id * 29 + user_id * 7) % g AS sta, event_id % 10 AS m FROM events CROSS JOIN glen) x",
    "reads0": f"SELECT doc_id, s, {{EXPLODE:2 * greatest({div('length(s) + 199', '200')}, 1)}} AS i FROM clean",
    "reads1": f"SELECT doc_id, i, CAST(100 + (doc_id * 3 + i * 7) % 61 AS INT) AS len, s, CASE WHEN (doc_id * 7 + i) % 4 = 0 THEN (doc_id + i) % 130 ELSE 0 END AS t, {div('doc_id', '4')} % 2 AS b, {div('i', '2')} AS pair FROM reads0 WHERE length(s) > 0",
    "reads2": f"SELECT *, {sub('s', 'i * 100 + 1', 'len')} AS win FROM reads1 WHERE length(s) > i * 100 OR i < 2",
    "reads3": f"SELECT *, concat({sub(f'''translate(win, '{AZ}', CASE WHEN (doc_id + i) % 7 = 0 THEN '{QB}' ELSE '{QA[:26]}' END)''', '1', 'greatest(length(win) - t, 0)')}, {rep(chr(39) + '#' + chr(39), 'least(t, length(win))')}) AS q FROM reads2",
    "reads": f"SELECT concat('s', CAST(doc_id % 4 AS STRING)) AS sample, CASE WHEN b = 0 THEN 'a' ELSE 'b' END AS run, CAST(i % 2 + 1 AS INT) AS dir, doc_id * 1000000 + pair AS ordinal, concat('@', CAST(doc_id AS STRING), ':', CAST(pair AS STRING), '/', CAST(i % 2 + 1 AS STRING)) AS name, translate(win, '{AZ}', CASE WHEN (doc_id + i) % 9 = 0 THEN '{NB}' ELSE '{NT}' END) AS seq, CASE WHEN b = 0 THEN q ELSE translate(q, 'I5+&#', 'hTJEB') END AS qual FROM reads3",
}

#: What Spark reads instead of the text above, for the same rows: chunks are numbered without the texts, by
#: runs of documents and then within each, and a text is cut into pieces once.
SPARK = {
    "fill": f"SELECT doc_id, doc_id % 25 AS k, CAST(floor(doc_id / 65536) AS BIGINT) AS run, greatest({div('length(s) + 255', '256')}, 1) AS n FROM clean",
    "filled": """SELECT f.doc_id, f.k, CAST(r.before + sum(f.n) OVER (PARTITION BY f.k, f.run ORDER BY f.doc_id ROWS UNBOUNDED PRECEDING) - f.n AS BIGINT) AS base
        FROM fill f JOIN (SELECT k, run, sum(sum(n)) OVER (PARTITION BY k ORDER BY run ROWS UNBOUNDED PRECEDING) - sum(n) AS before FROM fill GROUP BY k, run) r ON f.k = r.k AND f.run = r.run""",
    "cut": f"SELECT k, base, posexplode(CASE WHEN s = '' THEN array('') ELSE regexp_extract_all(s, '.{{{{1,{CHUNK}}}}}', 0) END) AS (i, piece) FROM clean JOIN filled USING (doc_id)",
    "genome_k": f"SELECT k, base + i AS chunk, substring(concat(translate(piece, '{AZ}', '{NT}'), repeat('ACGT', 64)), 1, {CHUNK}) AS seq FROM cut",
    # A window has at most 160 letters: a piece of 100 and the next one. The first two windows are there in any case.
    "reads0": "SELECT doc_id, regexp_extract_all(s, '.{{1,100}}', 0) AS pieces FROM clean WHERE s <> ''",
    "reads1": f"SELECT doc_id, CAST(i AS BIGINT) AS i, CAST(100 + (doc_id * 3 + i * 7) % 61 AS INT) AS len, two, CASE WHEN (doc_id * 7 + i) % 4 = 0 THEN (doc_id + i) % 130 ELSE 0 END AS t, {div('doc_id', '4')} % 2 AS b, {div('i', '2')} AS pair FROM (SELECT doc_id, posexplode(transform(CASE WHEN size(pieces) = 1 THEN array_append(pieces, '') ELSE pieces END, (p, j) -> concat(p, coalesce(get(pieces, j + 1), '')))) AS (i, two) FROM reads0) x",
    "reads2": "SELECT *, substring(two, 1, len) AS win FROM reads1",
}


def _dialect(sql: str, spark: bool) -> str:
    sql = sql.replace("{G}", "" if spark else ", 'g'")
    sql = re.sub(r"\{EXPLODE:(.*?)\}", (lambda m: f"explode(sequence(CAST(0 AS BIGINT), {m[1]} - 1))") if spark else (lambda m: f"unnest(range(0, {m[1]}))"), sql)
    sql = re.sub(r"\{LIST:(\w+):(.*?)\}", (lambda m: f"transform(sequence(0, CAST({m[1]} AS INT) - 1), i -> {m[2]})") if spark else (lambda m: f"list_transform(range(0, CAST({m[1]} AS BIGINT)), lambda i: {m[2]})"), sql)
    return sql if spark else sql.replace("AS STRING)", "AS VARCHAR)")


@functools.cache
def _needs(name: str) -> list[str]:
    """Names of the derived tables that a table's text uses, itself last."""
    out: list[str] = []
    for other in TABLES:
        if other != name and any(re.search(rf"\b(?:FROM|JOIN)\s+{other}\b", x.get(name, "")) for x in (TABLES, SPARK)):
            out += [x for x in _needs(other) if x not in out]
    return [*out, name]


def table(spark: SparkSession, sf_dir: str, name: str, stored: Callable[[str], DataFrame | None] = lambda t: None) -> DataFrame:
    """A derived table as a DataFrame. stored: gives those behind it that exist already."""
    made: dict[str, DataFrame] = {}

    def make(t: str) -> DataFrame:
        if t not in made:
            made[t] = (stored(t) if t != name else None) or built(t)
        return made[t]

    def built(t: str) -> DataFrame:
        sql = _dialect(SPARK.get(t, TABLES[t]), True)
        used = lambda x: re.search(rf"\b(?:FROM|JOIN)\s+{x}\b", sql)
        inputs = {x: make(x) for x in TABLES if x != t and used(x)}
        inputs |= {raw: spark.read.parquet(f"{sf_dir}/{raw}.parquet") for raw in ("documents", "lineitem", "orders", "part", "events") if used(raw)}
        for x in inputs:
            sql = re.sub(rf"\b(FROM|JOIN)\s+{x}\b", rf"\1 {{{x}}}", sql)
        return spark.sql(sql, **inputs)

    return make(name)


def with_clause(*names: str) -> str:
    """Common table expressions of derived tables for the checking SQL."""
    order: list[str] = []
    for n in names:
        order += [x for x in _needs(n) if x not in order]
    return ", ".join(f"{n} AS ({_dialect(TABLES[n], False)})" for n in order)
