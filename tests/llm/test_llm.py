"""Operators over documents against brute force, on small hand-made tables."""

import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.llm import cross_polytope, decontaminate, gsaca, licence_scan, licences, maxent_lm, near_dedup, packing, pfor, quality, substring_dedup, suffix_dedup, token_output
from readloom.llm.licences import MIT

WORDS = [f"w{i}" for i in range(400)]


def corpus(seed=3, n=60):
    """Texts with exact and near copies, shared passages, nulls, blanks, long and repeated rows."""
    r = random.Random(seed)
    passage = " ".join(r.choices(WORDS, k=60))
    texts = []
    for i in range(n):
        t = " ".join(r.choices(WORDS, k=r.randrange(1, 120)))
        if i % 5 == 1 and texts:
            w = r.choice(texts).split(" ")
            w[r.randrange(len(w))] = "changed"
            t = " ".join(w)
        elif i % 5 == 2 and texts:
            t = r.choice(texts)
        elif i % 5 == 3:
            t = f"{t} {passage} É{i}"
        texts.append(t)
    rows = list(enumerate(texts)) + [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "ab " * 3000), (1004, "a" * 5000), (1005, "É" * 200)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))


def written(tmp_path, spark, rows, name="documents"):
    frame(spark, rows).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_substring(spark, tmp_path):
    rows = corpus()
    got = {r.doc_id: r for r in substring_dedup.query(spark, written(tmp_path, spark, rows)).collect()}
    seen = {}
    for i, t in sorted(rows):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            if seen.setdefault(tuple(w[j : j + 13]), i) < i:
                gone[j : j + 13] = [True] * 13
        kept = [x for x, g in zip(w, gone) if not g]
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())


def test_suffix(spark, tmp_path):
    rows = corpus(5)
    got = {r.doc_id: r for r in suffix_dedup.query(spark, written(tmp_path, spark, rows)).collect()}
    seen = {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - 49):
            if seen.setdefault(b[j : j + 50], i) < i:
                gone[j : j + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())


def test_suffix_array():
    r = random.Random(1)
    for _ in range(800):
        t = [r.randrange(r.randrange(1, 5)) for _ in range(r.randrange(25))]
        assert gsaca.suffix_array(np.array(t, int)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def components(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_copies(spark, tmp_path):
    r = random.Random(9)
    base = r.choices(WORDS, k=60)
    rows = corpus(7, 40)
    for i in range(90):  # a crowded group: copies with none to five words changed
        w = list(base)
        for _ in range(i % 6):
            w[r.randrange(60)] = f"x{r.randrange(9999)}"
        rows.append((2000 + i, " ".join(w)))
    want = components(rows)
    got = near_dedup.query(spark, written(tmp_path, spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_tokens(spark, tmp_path):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rows = corpus(2, 20) + [(3000, "don't  stop.\n\nÉa!? 漢字 \x1c x")]
    got = {r.doc_id: r for r in token_output.query(spark, written(tmp_path, spark, rows)).collect()}
    start = 0
    for i, t in sorted(rows):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_pfor():
    r = np.random.default_rng(1)
    for n, hi in itertools.product((0, 1, 5, 1023, 1024, 1025, 5000), (1, 2, 300, 60000, 2**32)):
        x = r.integers(0, hi, n, dtype=np.uint32)
        y = pfor.encode(x)
        assert (pfor.decode(y) == x).all() and (pfor.decode(y, n // 3, n // 2) == x[n // 3 : n // 2]).all()


def test_language_model(spark):
    rows = corpus(4, 50)
    df = frame(spark, rows).withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
    got = {r.doc_id: r for r in maxent_lm.score(df).collect()}
    count = collections.Counter()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    for i, t in rows:
        if not held[i]:
            count.update([*(t or "").encode().lower().split(), None])
    n, v = sum(count.values()), len(count)
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), None]
        base = sum(np.log10((count[x] + 1) / (n + v + 1)) for x in w)
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (held[i], len(w), sum(count[x] > 0 for x in w), n)
        assert abs(got[i].base_score - base) < 1e-6 * max(1, abs(base)) and got[i].score <= 0


def test_neighbours(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(600, 16)).astype("float32")
    x[40:300] = x[0] + r.normal(size=(260, 16)).astype("float32") * 0.05
    x[300:340] = x[1]
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)] + [(900, None), (950, [0.0] * 16), (901, [float("nan")] * 16), (902, [1.0, None] + [0.0] * 14), (903, [1.0])]
    index = cross_polytope.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = collections.defaultdict(list)
    for a in cross_polytope.search(index, index.where("vec_id % 50 = 0")).orderBy("rank").collect():
        got[a.query_id].append(a.vec_id)
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hit = 0
    for i in range(0, 600, 50):
        s = u @ u[i]
        s[i] = -9
        hit += len(set(np.lexsort((np.arange(600), -np.round(s, 12)))[:5]) & set(got[i]))
    assert set(got) == set(range(0, 600, 50)) and hit >= 0.9 * 60
    assert cross_polytope.search(index.limit(0), index.limit(0)).count() == 0


def test_licences(spark):
    rows = [(1, "Copyright (c) 2020 Foo Bar\n" + MIT.upper().replace("SUBLICENSE", "sublicence") + "\nAll rights reserved."), (2, MIT + " extra"), (3, None), (4, "")]
    got = {r.doc_id: r.license_id for r in licence_scan.scan(frame(spark, rows), licence_scan.known(spark)).collect()}
    assert got == {1: "MIT", 2: None, 3: None, 4: None}


def test_every_known_licence_is_found(spark, tmp_path):
    """Whole texts of each licence, written otherwise, through the query; one word more is no match."""
    rows, want = [], {}
    for k, (name, text) in enumerate(licences.KNOWN):
        other = text.upper().replace(",", " ;").replace("\n", " \n\t ")
        for good, bad in licences.SPELLINGS:
            other = other.replace(f" {good.upper()} ", f" {bad.upper()} ")
        rows += [(10 * k, text), (10 * k + 1, f"Copyright © 2001-2020, Someone Else\n(c) Another\n{other}\n  All rights reserved.  "), (10 * k + 2, f"{text} indeed"), (10 * k + 3, text[: len(text) // 2])]
        want |= {10 * k: name, 10 * k + 1: name, 10 * k + 2: None, 10 * k + 3: None}
    rows += [(5000, " \n"), (5001, "words " * 100_000), (None, MIT)]
    want |= {5000: None, 5001: None, None: "MIT"}
    docs = frame(spark, rows + rows[:1]).withColumns({c: F.lit("x") for c in ("digest", "license_id", "known_digest")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = licence_scan.query(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + 1 and {r.doc_id: r.license_id for r in got} == want


def test_tables_of_licences(spark):
    texts = spark.createDataFrame([("b", "Same words."), ("a", "same WORDS"), ("c", "other"), ("d", None), ("e", " ")], "id string, text string")
    known = licence_scan.digests(texts, "id")
    docs = frame(spark, [(1, "Same, words"), (2, "other!"), (3, ""), (4, None), (5, "none")])
    assert {r.doc_id: r.license_id for r in licence_scan.scan(docs, known).collect()} == {1: "a", 2: "c", 3: None, 4: None, 5: None}
    assert licence_scan.scan(docs.limit(0), known).count() == 0
    assert [r.license_id for r in licence_scan.scan(docs, known.limit(0)).collect()] == [None] * 5


def test_buckets(spark, tmp_path):
    r = random.Random(3)
    for _ in range(60):
        x = r.sample(range(1, 30), r.randrange(1, 8))
        c = [r.randrange(1, 9) for _ in x]
        most = r.randrange(1, 5)
        cost = lambda u: sum(min(b for b in u if b >= n) * k for n, k in zip(x, c))  # noqa: B023, E731
        best = min(cost(u) for k in range(1, most + 1) for u in itertools.combinations(sorted(x), min(k, len(x))) if max(u) == max(x))
        assert cost(packing.boundaries(x, c, most)) == best
    rows = corpus(6, 40)
    got = packing.query(spark, written(tmp_path, spark, rows)).toPandas()
    assert got.groupby("doc_id")["length"].sum().to_dict() == {i: len((t or "").split()) + 1 for i, t in rows}
    for (bucket, _), n in got.groupby(["bucket", "batch"]).size().items():
        assert n <= max(1, packing.BUDGET // bucket)


def test_leaks(spark):
    r = random.Random(8)
    item = lambda: " ".join(r.choices(WORDS, k=12)).capitalize() + ". " + " ".join(r.choices(WORDS, k=8)) + "."
    items = [(k, item()) for k in range(30)] + [(90, None), (91, ""), (92, "one")]
    rows = corpus(11, 30)
    leaks = {(500 + k, k) for k in (3, 7, 11)}
    rows += [(d, "filler words before " + items[k][1].upper() + " and after") for d, k in leaks]
    rows.append((600, items[5][1].split(".")[0]))  # a question without its answer
    got = decontaminate.leaks(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id) for x in got.collect()} == leaks


def index_of(texts, threshold=0.5):
    """An index made without Spark."""
    words = [decontaminate._words([t.encode()]).hash for t in texts]
    df = collections.Counter(h for w in words for h in set(w.tolist()))
    items = []
    for k, (t, w) in enumerate(zip(texts, words)):
        terms, tf = np.unique(w, return_counts=True)
        items.append((k, t, len(w), terms, tf, np.array([df[h] for h in terms.tolist()])))
    return decontaminate.Index(items, len(texts), float(np.mean([len(w) for w in words])), max(map(len, words)), threshold)


def test_wand_is_brute_force(monkeypatch):
    r = random.Random(5)
    for _ in range(30):
        monkeypatch.setattr(decontaminate, "BLOCK", r.choice([1, 2, 4, 64]))
        texts = [" ".join(r.choices(WORDS[:60], k=r.randrange(3, 30))) for _ in range(r.randrange(1, 150))]
        index = index_of(texts)
        terms = sorted(r.sample(range(len(index.terms)), min(len(index.terms), r.randrange(1, 60))))
        score = np.zeros(len(index.ids))
        for t in terms:
            for k in range(index.start[t], index.start[t + 1]):
                score[index.item[k]] += index.impact[k]
        for threshold in (0.03, 0.1, 0.3):
            assert [k for k, _ in decontaminate.wand(index, terms, threshold)] == np.flatnonzero(score >= threshold - 1e-9).tolist()
            bounded = index_of(texts, threshold)
            hopeful = bounded.hopeful(np.zeros(len(terms), np.int64), np.array(terms))
            assert len(hopeful) or not (score >= threshold - 1e-9).any()


def test_passages_are_searched_for_all_items(spark):
    """Scores of BM25 over words, from their definition; the same with one shard and with many."""
    r = random.Random(2)
    items = [(k, " ".join(r.choices(WORDS[:150], k=r.randrange(3, 14))) + ". " + " ".join(r.choices(WORDS[:150], k=4)) + ".") for k in range(40)] + [(41, None), (42, "one"), (7, "zz zz zz zz"), (43, "")]
    docs = [(i, " ".join(r.choices(WORDS[:150], k=r.randrange(1, 90)))) for i in range(30)]
    docs += [(100 + k, f"{docs[k][1]} {items[k][1].lower()} {docs[k + 1][1]}") for k in range(12)]
    docs += [(200, items[5][1]), (200, items[5][1]), (None, items[6][1]), (201, None), (202, ""), (203, "w1 " * 20000)]
    frame_ = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("score", F.lit(0))
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(3))
    got = {n: {(x.doc_id, x.item_id): x.score for x in decontaminate.leaks(frame_, table, shard_bytes=n).collect()} for n in (1 << 20, 700, 200)}
    one = got[1 << 20]
    assert all(set(g) == set(one) and all(abs(g[k] - one[k]) < 1e-12 for k in g) for g in got.values())
    clean = {}
    for k, t in sorted(items, key=lambda x: x[1] or "", reverse=True):
        if len((t or "").split()) >= 3:
            clean[k] = t
    words = {k: t.lower().replace(".", "").split() for k, t in clean.items()}
    df, mean = collections.Counter(x for w in words.values() for x in set(w)), np.mean([len(w) for w in words.values()])
    longest = max(map(len, words.values()))
    want = {}
    for i, t in docs:
        w = (t or "").lower().replace(".", "").split()
        for a in range(0, max(1, len(w) - longest), longest):
            mine = w[a : a + 2 * longest]
            for k, x in words.items():
                weight = {y: np.log(1 + (len(words) - df[y] + 0.5) / (df[y] + 0.5)) * x.count(y) * 2.2 / (x.count(y) + 1.2 * (0.25 + 0.75 * len(x) / mean)) for y in set(x)}
                score = sum(v for y, v in weight.items() if y in mine) / sum(weight.values())
                grams = lambda z, g: {tuple(z[j : j + g]) for j in range(len(z) - g + 1)}
                sides = [p.lower().replace(".", "").split() for p in decontaminate.parted(clean[k])]
                held = [len(grams(z, min(3, len(z))) & grams(mine, min(3, len(z)))) / max(1, len(grams(z, min(3, len(z))))) if z else 1 for z in sides]
                if score >= 0.5 - 1e-9 and min(held) >= 0.5:
                    want[i, k] = max(score, want.get((i, k), 0))
    assert set(one) == set(want) and all(abs(one[k] - want[k]) < 1e-9 for k in want) and {(100 + k, k) for k in range(12)} - {(107, 7)} <= set(one)
    assert decontaminate.leaks(frame_.limit(0), table).count() == 0 and decontaminate.leaks(frame_, table.limit(0)).count() == 0
    kept = decontaminate.apply(frame_, table)
    assert kept.columns == frame_.columns and kept.where("doc_id is null").count() == 0 and not {r.doc_id for r in kept.collect()} & {i for i, _ in want if i is not None}


def test_an_index_is_small():
    r = random.Random(3)
    texts = [" ".join("".join(r.choices("abcdefghij", k=r.randrange(2, 9))) for _ in range(60)) for _ in range(2000)]
    index = index_of(texts)
    held = sum(x.nbytes for x in vars(index).values() if isinstance(x, np.ndarray))
    assert held < 10 * sum(map(len, texts))


def test_quality(spark):
    r = random.Random(1)
    rows = [(i, " ".join(r.choices(WORDS, k=40)) if i % 3 else " ".join(w + "&&&" for w in r.choices(WORDS, k=40))) for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(240)], "doc_id long, quality int")
    got = {x.doc_id: x.score for x in quality.scored(frame(spark, [*rows, (900, None), (901, "")]), labels).collect()}
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.3) == (i % 3 > 0) for i in held]) >= 0.9 and 0 <= got[900] <= 1 and 0 <= got[901] <= 1
    kept = quality.apply(frame(spark, rows), labels)
    assert kept.columns == ["doc_id", "text", "lang"]


@pytest.mark.parametrize("apply", [near_dedup.apply, substring_dedup.apply, suffix_dedup.apply])
def test_empty_tables_and_null_ids(spark, apply):
    empty = frame(spark, [])
    assert apply(empty).count() == 0
    rows = [(None, "some words " * 30), (1, "some words " * 30), (1, "some words " * 30), (2, None)]
    out = apply(frame(spark, rows).withColumn("key", F.lit(7)).withColumn("score", F.lit(1)))
    assert out.columns == ["doc_id", "text", "lang", "key", "score"]
    # Among near duplicates a row without an id is a copy like any other.
    near = apply is near_dedup.apply
    assert out.where("doc_id is null").count() == (0 if near else 1) and out.count() == (2 if near else 4)


def test_neighbours_with_two_hashes(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(30, 64))[r.integers(0, 30, 1500)] + r.normal(size=(1500, 64))
    index = cross_polytope.vectors(spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>"))
    queries = index.where("vec_id % 50 = 0")
    got = collections.defaultdict(set)
    for a in cross_polytope.search(index, queries, hashes=2).collect():
        got[a.query_id].add(a.vec_id)
    u = x.astype("float32").astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hit = sum(len({j for j in np.argsort(-(u @ u[i]))[:6] if j != i} & got[i]) for i in range(0, 1500, 50))
    assert hit >= 0.9 * 150


@pytest.mark.parametrize("bucket", [1, 1024])
def test_neighbours_past_the_switch(spark, monkeypatch, bucket):
    monkeypatch.setattr(cross_polytope, "BUCKET", bucket)  # 1: two hashes from 1,500 vectors on
    r = np.random.default_rng(5)
    x = r.normal(size=(1500, 64))
    index = cross_polytope.vectors(spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>"))
    got = collections.defaultdict(set)
    for a in cross_polytope.search(index, index.where("vec_id % 50 = 0")).collect():
        got[a.query_id].add(a.vec_id)
    u = x.astype("float32").astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hit = sum(len({j for j in np.argsort(-(u @ u[i]))[:6] if j != i} & got[i]) for i in range(0, 1500, 50))
    assert hit >= 0.9 * 150


def test_neighbours_of_few(spark):
    r = np.random.default_rng(6)
    for n in (1, 2, 3, 6):
        rows = [(i, [float(a) for a in v]) for i, v in enumerate(r.normal(size=(n, 64)))]
        index = cross_polytope.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        got = cross_polytope.search(index, index).collect()
        assert sorted((a.query_id, a.vec_id) for a in got) == [(i, j) for i in range(n) for j in range(n) if i != j]


def test_suffix_hot_minimizer(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 20)
    r = random.Random(12)
    hot = "Licensed under the Apache License, Version 2.0."
    rows = [(i, f"{' '.join(r.choices(WORDS, k=9))} {hot} {r.choice(['See', 'It is', 'x' * i])} {' '.join(r.choices(WORDS, k=4))}") for i in range(120)]
    docs = frame(spark, rows).select("doc_id", "text").withColumn("key", F.xxhash64("doc_id", "text"))
    bits = suffix_dedup.countmin.sketch_bits(1e4)
    sketch = spark.sparkContext.broadcast(suffix_dedup.countmin.repeated_cells(docs, suffix_dedup._minimizers, bits))
    often = suffix_dedup.hot_minimizers(docs, bits, sketch, 4)
    sent = docs.mapInArrow(suffix_dedup._sent(bits, sketch, 4, spark.sparkContext.broadcast(often)), suffix_dedup.PACKED).collect()
    count = collections.Counter(m for x in sent if x.kind == 1 for m in np.frombuffer(x.mins, np.uint64).tolist())
    assert len(often) and not set(often.tolist()) & set(count) and len({x.bucket for x in sent if x.kind == 1}) == 4
    got = {r.doc_id: r for r in suffix_dedup.query(spark, written(tmp_path, spark, rows)).collect()}
    seen = {}
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for j in range(len(b) - 49):
            if seen.setdefault(b[j : j + 50], i) < i:
                gone[j : j + 50] = b"\1" * 50
        assert got[i].kept_sha256 == hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()
