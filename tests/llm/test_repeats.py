"""Repeated strings and windows: random and periodic texts, hot groups and clashing columns, against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.llm import substring_dedup, suffix_dedup

WORDS = [f"w{i}" for i in range(300)]


def removed(rows):
    """(bytes, removed, runs, sha256 of the rest) of each document, window by window."""
    seen, out = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - 49):
            if seen.setdefault(b[j : j + 50], i) < i:
                gone[j : j + 50] = b"\1" * 50
        runs = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out[i] = len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()
    return out


def settled(rows):
    """The spans of bytes that go, from the stretches of all rows in one slice, without Spark."""
    import collections

    parts = []
    for i, t in rows:
        b = (t or "").encode() + b"\x00"
        buf = np.frombuffer(b, np.uint8)
        h, doc, start, end, _ = suffix_dedup.stretches(buf, np.array([0]), np.array([len(b) - 1]))
        parts += [(m, i, s, buf[s:e]) for m, s, e in zip(h, start, end)]
    h, doc, start = np.array([p[0] for p in parts], np.uint64), np.array([p[1] for p in parts], np.int64), np.array([p[2] for p in parts], np.int64)
    size = np.array([len(p[3]) for p in parts], np.int64)
    raw = np.concatenate([p[3] for p in parts]) if parts else np.zeros(0, np.uint8)
    packs = collections.defaultdict(list)
    if parts:
        for m, part in suffix_dedup._slices(h, size, raw):
            for d, _, spans in suffix_dedup._settled(h[m], doc[m], doc[m], start[m], size[m], part):
                packs[d].append(spans)
    return {i: int(suffix_dedup._removed(len((t or "").encode()), packs.get(i)).sum()) for i, t in rows}


@pytest.mark.parametrize("seed", range(12))
def test_settling_is_brute_force(monkeypatch, seed):
    r = random.Random(seed)
    monkeypatch.setattr(suffix_dedup, "SLICE", r.choice([500, 20_000, 2_000_000]))
    monkeypatch.setattr(suffix_dedup, "PIECE", r.choice([30, 1000, 1 << 17]))
    alphabet = r.choice(["ab", "abcdefgh ", "\x00a\xff漢"])
    passages = ["".join(r.choices(alphabet, k=r.randrange(30, 160))) for _ in range(5)]
    rows = [(i, "".join(r.choice([*passages, "".join(r.choices(alphabet, k=r.randrange(1, 30)))]) for _ in range(r.randrange(1, 5)))) for i in range(40)]
    rows += [(50 + i, r.choice(passages)[: r.randrange(20, 90)] * r.randrange(1, 6)) for i in range(10)]
    assert settled(rows) == {i: x[1] for i, x in removed(rows).items()}


def test_suffix_arrays_get_the_shared_places_of_stretches(monkeypatch):
    """Borders of passages, and texts that share 40 bytes, which is no window, at many places."""
    r, symbols = random.Random(8), []
    made = suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text: symbols.append(len(text)) or made(text))
    text = lambda n: "".join(r.choices("abcdefgh ", k=n))
    passages, short = [text(90) for _ in range(20)], [text(40) for _ in range(60)]
    rows = [(i, "".join(text(60) + r.choice(passages if i % 2 else short) for _ in range(4)) + text(60)) for i in range(100)]
    assert settled(rows) == {i: x[1] for i, x in removed(rows).items()}
    assert 0 < sum(symbols) < 11000


def test_suffix_array_is_the_sorted_order():
    r = random.Random(4)
    for n in (0, 1, 2, 3, 50, 400):
        for k in (1, 2, 3, 200):
            text = [r.randrange(k) for _ in range(n)]
            for t in (text, text[:7] * (n // 7)):
                assert suffix_dedup.suffix_array(np.array(t, np.int64)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("module", [substring_dedup, suffix_dedup])
def test_columns_of_any_name(spark, module):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (2, f"before that {text}"), (None, text), (2, f"before that {text}"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("packs", "_id", "_key", "key", "score", "_score", "bucket", "shard", "kind"):
        docs = docs.withColumn(c, F.lit("x"))
    out = module.apply(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, text), (2, "before that" + " " * (module is suffix_dedup)), (None, text), (2, "before that" + " " * (module is suffix_dedup)), (3, None), (4, "")], key=str) or module is suffix_dedup
    assert [t for i, t in got if i == 1] == [text] and all(len(t) < 20 for i, t in got if i == 2)


def test_a_minimizer_of_a_third_of_all_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 30)
    r = random.Random(12)
    hot = "Licensed under the Apache License, Version 2.0."
    rows = [(i, f"{' '.join(r.choices(WORDS, k=9))} {hot if i % 3 == 0 else ''} {r.choice(['See', 'It is', 'x' * (i % 40)])} {' '.join(r.choices(WORDS, k=4))}") for i in range(300)]
    rows += [(400 + i, f"a passage that many documents share, word by word, and that goes on for a while {r.choice('ab')}") for i in range(100)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.query(spark, str(tmp_path)).collect()}
    assert got == removed(rows)


@pytest.mark.parametrize("module", [substring_dedup, suffix_dedup])
def test_empty_and_all_null(spark, tmp_path, module):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert module.query(spark, str(tmp_path)).count() == 0
    nulls = spark.createDataFrame([(None, None), (1, None)], "doc_id long, text string")
    assert module.apply(nulls).count() == 2
