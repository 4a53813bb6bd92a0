"""The corpus pipeline and its stages against brute force, and edges of each stage's operator."""

import random
import zlib

import pytest
from pyspark.sql import functions as F
from test_llm import WORDS, components, corpus

import corpus_pipeline
from readloom.llm import decontaminate, near_dedup, packing, quality, substring_dedup, suffix_dedup, tables

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(21)
    junk = lambda: " ".join(w + "&&&" for w in r.choices(WORDS, k=50))
    good = lambda: " ".join(r.choices(WORDS, k=50))
    items = [(k, " ".join(r.choices(WORDS, k=14)).capitalize() + ". " + " ".join(r.choices(WORDS, k=8)) + ".") for k in range(12)] + [(50, None), (51, "")]
    rows = [(i, good() if i % 3 else junk()) for i in range(240)]
    rows += [(1000 + i, t) for i, t in corpus(8, 40)] + [(2000 + k, f"{good()} {items[k][1]} {good()}") for k in range(5)] + [(None, good()), (3000, None), (3001, "")]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, dict(items)


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def without_windows(rows):
    seen, out = {}, []
    for i, t in sorted((x for x in rows if x[0] is not None), key=lambda x: x[0]):
        w, n = (t or "").split(), 13
        gone = [False] * len(w)
        for j in range(len(w) - n + 1):
            if seen.setdefault(tuple(w[j : j + n]), i) < i:
                gone[j : j + n] = [True] * n
        out.append((i, " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else t))
    return out + [x for x in rows if x[0] is None]


def test_stages_are_brute_force(spark, folder):
    path, items = folder
    docs = tables.table(spark, path, "documents")
    names, stages = zip(*corpus_pipeline.STAGES)
    assert len(names) == 5
    by = lambda rows: sorted(rows, key=str)

    kept = tables.stored(stages[0](spark, docs, path), "t")
    scores = {r.doc_id: r.score for r in quality.scored(docs, tables.table(spark, path, "labels")).collect()}
    assert by(texts(kept)) == by([x for x in texts(docs) if scores[x[0]] >= 0.3]) and kept.columns == docs.columns
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((i in {x for x, _ in texts(kept)}) == (i % 3 > 0) for i in held) >= 0.9 * len(held)

    one = tables.stored(stages[1](spark, kept, path), "t")
    group = components([x for x in texts(kept) if x[0] is not None])
    assert by(texts(one)) == by([x for x in texts(kept) if x[0] is None or group[x[0]][1] == x[0]]) and one.columns == docs.columns

    cut = tables.stored(stages[2](spark, one, path), "t")
    assert by(texts(cut)) == by(without_windows(texts(one))) and cut.columns == docs.columns

    clean = tables.stored(stages[3](spark, cut, path), "t")
    leaked = {i for i, t in texts(cut) if any(x and x in (t or "") for x in items.values())}
    assert leaked == {2000 + k for k in range(5)} & {i for i, _ in texts(cut)} and leaked
    assert by(texts(clean)) == by([(i, t) for i, t in texts(cut) if not any(x and x in (t or "") for x in items.values())]) and clean.columns == docs.columns

    packed = stages[4](spark, clean, path).toPandas()
    sizes = {i: len((t or "").split()) + 1 for i, t in texts(clean) if i is not None}
    assert packed.dropna().groupby("doc_id")["length"].sum().to_dict() == sizes
    uppers = packing.boundaries(*map(list, zip(*packed["length"].value_counts().items())))
    assert all(b == min(u for u in uppers if u >= n) and p == b - n for b, n, p in zip(packed["bucket"], packed["length"], packed["padding"]))
    for bucket, rows in packed.groupby("bucket"):
        full = max(1, packing.BUDGET // bucket)
        assert sorted(rows["batch"]) == [k // full for k in range(len(rows))]

    whole = corpus_pipeline.run(spark, path).toPandas()
    assert set(whole["doc_id"].dropna()) == set(sizes)


CLASHING = ("packs", "_id", "_key", "key", "score", "_score", "item_id", "bucket", "rep", "n", "sig", "x")


@pytest.mark.parametrize("module", [quality, near_dedup, substring_dedup, suffix_dedup, decontaminate])
def test_edges(spark, folder, module):
    """Clashing names, null ids and texts, repeated rows, a long text, an empty table."""
    path, items = folder
    r = random.Random(4)
    rows = [(None, "a b c"), (1, None), (2, ""), (3, " \n"), (4, " ".join(r.choices(WORDS, k=30_000))), (5, "w1 w2 w3 w4 w5 w6"), (5, "w1 w2 w3 w4 w5 w6"), (6, "x" * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in CLASHING:
        docs = docs.withColumn(c, F.lit("z"))
    more = {quality: "labels", decontaminate: "benchmark"}.get(module)
    args = [tables.table(spark, path, more)] if more else []
    out = module.apply(docs, *args)
    assert out.columns == docs.columns
    got = texts(out)
    if module is not quality:
        # Of rows equal in id and text one stays after near duplicates.
        want = list(dict.fromkeys(rows)) if module is near_dedup else rows
        assert sorted(map(str, got)) == sorted(map(str, want))
    assert module.apply(docs.limit(0), *args).count() == 0
    if args:
        assert module.apply(docs, args[0].limit(0)).columns == docs.columns


def test_copies_under_any_id(spark):
    """Rows count by their own texts: null ids, two texts under one id, rows that repeat."""
    r = random.Random(6)
    a, b, c, d = (" ".join(r.choices(WORDS, k=40)) for _ in range(4))
    near = lambda t: t + " more"
    rows = [(1, a), (1, a), (None, a), (None, a), (2, near(a)), (3, b), (3, near(c)), (4, c), (None, d), (None, near(d)), (None, d), (5, ""), (5, ""), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit(1)).withColumn("first", F.lit("x"))
    got = sorted(texts(near_dedup.apply(docs)), key=str)
    left = [x for x in got if x[1] not in (d, near(d))]
    assert left == sorted([(1, a), (3, b), (3, near(c)), (5, ""), (5, ""), (None, None), (None, None)], key=str) and len(got) == len(left) + 1


def test_a_row_without_an_id_can_leak(spark, folder):
    path, items = folder
    leak = f"before {items[0]} behind"
    rows = [(None, leak), (None, "clean words only"), (7, leak), (7, "clean words too"), (8, None)]
    got = decontaminate.apply(spark.createDataFrame(rows, "doc_id long, text string"), tables.table(spark, path, "benchmark"))
    assert sorted(texts(got), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)


def test_pipeline_over_nothing(spark, folder, tmp_path):
    """No documents, no labels or no items: each stage has a defined result."""
    path, _ = folder
    for empty in ("documents", "labels", "benchmark"):
        there = f"{tmp_path}/{empty}"
        for name in ("documents", "labels", "benchmark"):
            t = tables.table(spark, path, name)
            (t.limit(0) if name == empty else t).write.parquet(f"{there}/{name}.parquet")
        n = corpus_pipeline.run(spark, there).count()
        assert (n == 0) == (empty == "documents"), empty


def test_packing_edges(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None), (1, ""), (2, "w " * 5000)], "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("bucket", F.lit("x"))
    got = packing.pack(docs)
    assert got.agg(F.sum("length")).first()[0] == 3 + 3 + 1 + 1 + 5001 and got.where("doc_id is null").count() == 2
    assert packing.pack(docs.limit(0)).count() == 0
