"""Merkle manifest of a table: a leaf for each row, a tree for each source, one root, and a proof a row.

H is the lowercase hex SHA-256 of its inputs' concatenation, digests as hex text. A leaf is H of the row's
fields, each ``-`` if null, else its number of UTF-8 bytes, ``:`` and itself. A source's leaves ascend by
doc_id; every 16 consecutive nodes become one while there are several. The sources' roots, null first and
then by UTF-8 bytes, become the root in the same way.

Rows are ranked within their source by a range sort and the partitions' counts. Blocks of 4,096 nodes are
reduced in tasks, level upon level, until at most ``TOP`` nodes are left; the driver builds the tree above
them and broadcasts the suffix of the path of each. Going down again, tasks put the siblings inside a
block before the block's suffix. Where there are more sources than that, their roots are reduced in
blocks as well. No task holds more than a block and a batch, the driver no more than ``TOP`` nodes and one row
for each partition.

Nulls are values of their own: a null source is a source, null doc_ids come first and are not tampered
with by the query. Rows that share source and doc_id follow each other by leaf; equal rows have equal leaves
and each its own place. An empty text is ``0:``. A very long text is hashed by Spark in one expression, which
needs a few times its size in the executor's heap. An empty table gives no rows. Other columns aren't read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables

FAN = 16
#: Levels that a block is reduced by: it has at most FAN ** BLOCK nodes.
BLOCK = 3
#: Nodes that the driver takes at most.
TOP = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PATH = "lefts array<string>, rights array<string>, subroot string"


def leaf(text: Column) -> Column:
    """The leaf of a row as binary, with ``text`` for its text."""

    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*(field(text if c == "text" else F.col(c)) for c in FIELDS)), 256))


def H(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def grown(nodes: list[str], depth: int | None = None) -> list[list[str]]:
    """The levels over nodes: until one is left, or just ``depth`` more."""
    levels = [nodes]
    while len(nodes) > 1 if depth is None else len(levels) <= depth:
        nodes = [H("".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)]
        levels.append(nodes)
    return levels


def siblings(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """What stands left and right of node i's path in each run, lowest level first."""
    out = []
    for nodes in levels[:-1]:
        a = i - i % FAN
        out.append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + FAN])))
        i //= FAN
    return out


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """rows, stored, with their rank ``i`` in the order of ``order`` within ``group`` (nulls first).

    Rows equal in all of these are dealt to partitions by chance: their order means nothing.
    """
    spark = rows.sparkSession
    by = [F.asc_nulls_first(c) for c in (group, *order)]
    rows = rows.withColumn("_chance", F.rand(7)).repartitionByRange(tables.parts(spark), *by, "_chance")
    rows = rows.sortWithinPartitions(*by).drop("_chance").withColumn("pid", F.spark_partition_id())
    schema = rows.withColumn("i", F.lit(0).cast("long")).schema

    def numbered(batches):
        last, n = object(), 0
        for pdf in batches:
            if len(pdf):
                g = pdf[group].astype(object).where(pdf[group].notna(), None).to_numpy()
                new = np.array([True, *(g[1:] != g[:-1])])
                new[0] = g[0] != last
                at = np.arange(len(g))
                begin = np.maximum.accumulate(np.where(new, at, -1))
                i = np.where(begin < 0, n + at, at - begin)
                last, n = g[-1], int(i[-1]) + 1
                yield pdf.assign(i=i)

    stored = tables.stored(rows.mapInPandas(numbered, schema), name)
    ends = stored.groupBy("pid").agg(F.min(F.struct(group)).alias("a"), F.max(F.struct(group, "i")).alias("b")).orderBy("pid").collect()
    carried, offsets = None, []
    for r in ends:
        before = carried[1] if carried and carried[0] == r["a"][group] else 0
        offsets.append((r["pid"], r["a"][group], before))
        carried = r["b"][group], r["b"]["i"] + 1 + (before if r["b"][group] == r["a"][group] else 0)
    offset = spark.createDataFrame(offsets, "_pid int, _group string, _before long")
    out = stored.join(F.broadcast(offset), (F.col("pid") == F.col("_pid")) & F.col(group).eqNullSafe(F.col("_group")), "left")
    return out.withColumn("i", F.col("i") + F.coalesce("_before", F.lit(0))).drop("pid", "_pid", "_group", "_before")


def _blocks(batches):
    """(first row's index, frame) of each block in rows that come sorted by source, block and i; only one
    block and a batch are held."""
    import pandas as pd

    held = None
    for pdf in batches:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        s, b = pdf["source"].astype(object).where(pdf["source"].notna(), None).to_numpy(), pdf["block"].to_numpy()
        cut = np.flatnonzero((s[1:] != s[:-1]) | (b[1:] != b[:-1])) + 1
        begin = np.concatenate([[0], cut])
        for a, z in zip(begin, cut):
            yield pdf.iloc[a:z].reset_index(drop=True)
        held = pdf.iloc[begin[-1] :]
    if held is not None and len(held):
        yield held.reset_index(drop=True)


def _dealt(nodes: DataFrame, block: int) -> DataFrame:
    """nodes (source, i, ..) with the blocks that they are in, each block whole in one partition."""
    return nodes.withColumn("block", F.floor(F.col("i") / FAN**block)).repartition("source", "block").sortWithinPartitions("source", "block", "i")


def reduced(nodes: DataFrame, block: int, name: str) -> DataFrame:
    """(source, i, digest) of the blocks of nodes (source, i, digest)."""

    def run(batches):
        import pandas as pd

        out = []
        for pdf in _blocks(batches):
            k = int(pdf["block"].iloc[0])
            top = grown([x.hex() for x in pdf["digest"]], block if k else None)[-1][0]
            out.append((pdf["source"].iloc[0], k, bytes.fromhex(top)))
            if len(out) == 5000:
                yield pd.DataFrame(out, columns=["source", "i", "digest"])
                out = []
        yield pd.DataFrame(out, columns=["source", "i", "digest"]).astype({"i": "int64"})

    return tables.stored(_dealt(nodes.select("source", "i", "digest"), block).mapInPandas(run, "source string, i long, digest binary"), name)


def upper(rows: list, subroots: bool) -> tuple[dict, str | None]:
    """({(source, i): (lefts, rights, subroot)}, root) of the top nodes; with ``subroots`` they are of
    several sources, else all nodes over the subroots."""
    by: dict = {}
    for r in sorted(rows, key=lambda r: (r["source"] is not None, (r["source"] or "").encode(), r["i"])):
        by.setdefault(r["source"], []).append(bytes(r["digest"]).hex())
    trees = {s: grown(d) for s, d in by.items()}
    whole = grown([t[-1][0] for t in trees.values()]) if trees else [[None]]
    paths = {}
    for k, (s, levels) in enumerate(trees.items()):
        for i in range(len(levels[0])):
            path = siblings(levels, i) + siblings(whole, k)
            paths[s, i] = [x for x, _ in path], [x for _, x in path], levels[-1][0] if subroots else None
    return paths, whole[-1][0]


def _below(nodes: DataFrame, paths, block: int, finish, schema: str, payload: list[str]) -> DataFrame:
    """finish(rows of a block, its levels, its suffix) for all blocks of nodes. paths: a broadcast dict, or a
    table (source, i and the path) whose rows come first in their blocks."""
    sent = None if isinstance(paths, DataFrame) else paths
    rows = nodes.select("source", "i", "digest", *payload)
    if sent is None:
        head = paths.withColumnRenamed("i", "block")
        rows = rows.withColumn("block", F.floor(F.col("i") / FAN**block)).unionByName(head.withColumn("i", F.lit(-1).cast("long")), allowMissingColumns=True)
        rows = rows.repartition("source", "block").sortWithinPartitions("source", "block", "i")
    else:
        rows = _dealt(rows, block)

    def run(batches):
        for pdf in _blocks(batches):
            k, source = int(pdf["block"].iloc[0]), pdf["source"].iloc[0]
            if sent is not None:
                lefts, rights, subroot = sent.value[None if source is None or source != source else source, k]
            else:
                lefts, rights, subroot = pdf["lefts"].iloc[0], pdf["rights"].iloc[0], pdf["subroot"].iloc[0]
                pdf = pdf.iloc[1:]
            levels = grown([x.hex() for x in pdf["digest"]], block if k else None)
            yield finish(pdf, levels, list(zip(lefts, rights)), subroot)

    return rows.mapInPandas(run, schema)


def _middle(subroots: bool):
    """Paths of the nodes of a block: those inside it, then the block's own. subroots: these nodes are the
    sources' roots."""

    def finish(pdf, levels, suffix, subroot):
        import pandas as pd

        out = []
        for j, x in enumerate(levels[0]):
            path = siblings(levels, j) + suffix
            out.append(([a for a, _ in path], [b for _, b in path], x if subroots else subroot))
        cols = pd.DataFrame(out, columns=["lefts", "rights", "subroot"])
        if subroots:
            return cols.assign(source=pdf["of"].to_numpy(), i=0)[["source", "i", "lefts", "rights", "subroot"]]
        return cols.assign(source=pdf["source"].to_numpy(), i=pdf["i"].to_numpy())[["source", "i", "lefts", "rights", "subroot"]]

    return finish


def _leaves(root: str | None):
    def finish(pdf, levels, suffix, subroot):
        import pandas as pd

        proofs, folds, run, inner, tail = [], [], None, [], ""
        for j, (found, own) in enumerate(zip(pdf["found"], levels[0])):
            if len(levels) > 1 and run != j // FAN:
                run = j // FAN
                inner = siblings(levels[1:], run) + suffix
                tail = "".join(a + b for a, b in inner)
            elif run is None:
                run, inner, tail = 0, suffix, "".join(a + b for a, b in suffix)
            path = siblings(levels[:2], j) + inner
            proofs.append(H("".join(a + b for a, b in path[: len(path) - len(inner)]) + tail))
            d = own if found is None else found.hex()
            for a, b in path:
                d = H(a + d + b)
            folds.append(d)
        return pd.DataFrame({"doc_id": pdf["doc_id"], "leaf": levels[0], "subroot": subroot, "root": root, "proof_sha256": proofs, "folded_root": folds, "verified": [x == root for x in folds]})

    return finish


def manifest(docs: DataFrame, found: Column | None = None, block: int | None = None, top: int | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row of docs (FIELDS).

    found: the text as it is met when the proof is folded, null where it is the text itself.
    """
    block, top = block or BLOCK, top or TOP
    # A null doc_id is told by a flag: pandas has no null integers.
    rows = docs.select("source", "doc_id", leaf(F.col("text")).alias("digest"), (F.lit(None).cast("binary") if found is None else F.when(found.isNotNull(), leaf(found))).alias("found"))
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("source", F.col("source").cast("string"))
    rows = rows.withColumn("_id", F.col("doc_id").cast("decimal(38,0)"))
    base = ranked(tables.stored(rows, "merkle-leaves"), "source", ["_id", "digest"], "merkle-ranked").drop("_id")
    spark = docs.sparkSession
    up = [(base, False)]  # (nodes, whether they are the sources' roots under one name)
    nodes, united = reduced(base, block, "merkle-blocks"), False
    while True:
        n, most = nodes.agg(F.count("*"), F.max("i")).first()
        if n <= top:
            break
        if most == 0 and not united:
            of = nodes.select(F.lit("").alias("source"), F.col("source").alias("of"), "digest")
            nodes, united = ranked(of, "source", ["of"], "merkle-sources"), True
            up.append((nodes, True))
        else:
            up.append((nodes, False))
        nodes = reduced(nodes, block, "merkle-blocks")
    paths, root = upper(nodes.select("source", "i", "digest").collect(), not united)
    paths = spark.sparkContext.broadcast(paths)
    for nodes, are_subroots in reversed(up[1:]):
        made = _below(nodes, paths, block, _middle(are_subroots), f"source string, i long, {_PATH}", ["of"] if are_subroots else [])
        paths = tables.stored(made, "merkle-paths")
    out = _below(base, paths, block, _leaves(root), "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean", ["doc_id", "found"])
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def tampered(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text in lower case (A-Z) where 5 divides the crc32 of the decimal doc_id, null elsewhere."""
    return F.when(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.translate(text, _UPPER, _UPPER.lower()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents")
    return manifest(docs, tampered())


def _crc32(x: str) -> str:
    """crc32 of an ASCII text: each byte and seven zeros, one shift for each."""
    items = f"flatten(list_transform(range(1, length({x}) + 1), lambda j: [CAST(ascii(substring({x}, CAST(j AS INT), 1)) AS UBIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS UBIGINT)], {items}), lambda c, e: xor(xor(c, e) // 2, CASE WHEN xor(c, e) % 2 = 1 THEN CAST(3988292384 AS UBIGINT) ELSE CAST(0 AS UBIGINT) END)), CAST(4294967295 AS UBIGINT))"


def _oracle(depth: int = 6, wide: int = 3) -> str:
    """SQL for sources of up to 16 ** depth rows and 16 ** wide sources."""
    fields = lambda t: " || ".join(f"coalesce(CAST(strlen({c}) AS VARCHAR) || ':' || {c}, '-')" for c in (t if f == "text" else f"CAST(d.{f} AS VARCHAR)" for f in FIELDS))
    low = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
    parts = [
        f"crc AS (SELECT doc_id, {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 AS bad FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) x)",
        f"docs AS (SELECT d.doc_id, coalesce('1' || source, '0') AS s, sha256({fields('text')}) AS leaf, CASE WHEN bad AND text IS NOT NULL THEN sha256({fields(low)}) END AS found FROM documents d LEFT JOIN crc ON crc.doc_id = d.doc_id)",
        "lf AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM docs)",
        "a0 AS (SELECT s, i, leaf AS d, count(*) OVER (PARTITION BY s) AS n FROM lf)",
    ]
    for k in range(depth):
        parts.append(f"ar{k} AS (SELECT s, i // 16 AS i, list(d ORDER BY i) AS ds, min(n) AS n FROM a{k} GROUP BY s, i // 16)")
        parts.append(f"a{k + 1} AS (SELECT s, i, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d, count(*) OVER (PARTITION BY s) AS n FROM ar{k})")
    parts.append(f"b0 AS (SELECT s, d, row_number() OVER (ORDER BY s) - 1 AS i, count(*) OVER () AS n FROM a{depth})")
    for k in range(wide):
        parts.append(f"br{k} AS (SELECT i // 16 AS i, list(d ORDER BY i) AS ds, min(n) AS n FROM b{k} GROUP BY i // 16)")
        parts.append(f"b{k + 1} AS (SELECT i, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d, count(*) OVER () AS n FROM br{k})")
    parts.append(f"x0 AS (SELECT lf.*, b0.i AS b, b0.d AS subroot, (SELECT d FROM b{wide}) AS root, '' AS proof, coalesce(found, leaf) AS f FROM lf JOIN b0 ON lf.s = b0.s)")
    levels = [(f"ar{k}", 16**k, "i", "r.s = x.s AND ") for k in range(depth)] + [(f"br{k}", 16**k, "b", "") for k in range(wide)]
    for k, (runs, span, i, same) in enumerate(levels):
        at = f"(x.{i} // {span}) % 16"
        left, right = f"array_to_string(r.ds[1:{at}], '')", f"array_to_string(r.ds[{at} + 2:], '')"
        parts.append(f"x{k + 1} AS (SELECT x.* EXCLUDE (proof, f), proof || CASE WHEN r.n > 1 THEN {left} || {right} ELSE '' END AS proof, CASE WHEN r.n > 1 THEN sha256({left} || x.f || {right}) ELSE x.f END AS f FROM x{k} x JOIN {runs} r ON {same}r.i = x.{i} // {span * 16})")
    return f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM x{len(levels)}"


ORACLE_SQL = _oracle()
