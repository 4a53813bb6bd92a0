"""Merkle manifests against a tree built in one piece."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from readloom.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest("".join(map(part, (doc_id, source, lang, n_chars, text))))


def tree(nodes):
    """(root, the siblings of each node)."""
    paths, where = [""] * len(nodes), list(range(len(nodes)))
    folds = [[] for _ in nodes]
    while len(nodes) > 1:
        for j, w in enumerate(where):
            a = w - w % 16
            left, right = "".join(nodes[a:w]), "".join(nodes[w + 1 : a + 16])
            paths[j] += left + right
            folds[j].append((left, right))
            where[j] = w // 16
        nodes = [digest("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], paths, folds


def brute(rows):
    by, out = {}, []
    for r in rows:
        by.setdefault(r[3], []).append((leaf(*r), r))
    trees = {}
    for s in sorted(by, key=lambda s: (s is not None, (s or "").encode())):
        by[s].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees[s] = tree([x[0] for x in by[s]])
    if not trees:
        return []
    root, upper, ufolds = tree([t[0] for t in trees.values()])
    for k, (s, (subroot, paths, folds)) in enumerate(trees.items()):
        for (own, r), path, fold in zip(by[s], paths, folds):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None
            d = leaf(r[0], r[1].encode().translate(LOW).decode(), *r[2:]) if bad else own
            for a, b in fold + ufolds[k]:
                d = digest(a + d + b)
            out.append((r[0], own, subroot, root, digest(path + upper[k]), d, d == root))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def rows_of(seed, n=700):
    r = random.Random(seed)
    sources = [None, "", "é", "zz", "a", "hot", "hot", "hot"]
    out = [(i, r.choice([None, "", "Abc", "ÉCOLE Große", "x" * 5000, f"Text {i % 9}"]), r.choice(["en", None]), r.choice(sources), r.choice([None, i])) for i in range(n)]
    return out + [(5, "Same", "en", "hot", 1)] * 40 + [(5, "Other", "en", "hot", 1), (None, "No id", "en", "a", 3), (None, "No id", "en", "a", 3), (1000, "alone", "en", "single", 2)]


@pytest.mark.parametrize("block,top", [(3, 4096), (1, 40), (1, 3), (2, 2)])
def test_is_one_tree(spark, block, top):
    rows = rows_of(block * top)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7).withColumns({c: F.lit("x") for c in ("leaf", "i", "block", "pid", "digest", "subroot")})
    assert found(merkle.manifest(docs, merkle.tampered(), block, top)) == brute(rows)


def test_many_sources(spark):
    rows = [(i, f"T{i}", "en", f"s{i % 97}", i) for i in range(300)]
    assert found(merkle.manifest(spark.createDataFrame(rows, SCHEMA), merkle.tampered(), 1, 5)) == brute(rows)


def test_empty_and_alone(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA), merkle.tampered()).count() == 0
    one = [(5, "Alone", "en", "s", 1)]
    got = found(merkle.manifest(spark.createDataFrame(one, SCHEMA)))
    own = leaf(*one[0])
    assert got == [(5, own, own, own, digest(""), own, True)]


def test_query_is_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = merkle.query(spark, sf)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({merkle.ORACLE_SQL}) x").fetchall()
    assert found(got) == sorted(want, key=str) and {r[-1] for r in want} == {True, False}
