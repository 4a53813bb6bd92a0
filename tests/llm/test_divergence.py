"""Divergence of sources against sums over all terms in whole numbers."""

import collections
import random
import re

import duckdb
import pytest

from readloom.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, rank string, n string, term string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=3, top=200):
    docs, counts, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for x, s in groups if x == lang)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        ps = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), collections.Counter()))
        for a in sources:
            pairs = [(b, sum((ps[a][t] - ps[b][t]) ** 2 // ps[b][t] for t in kept)) for b in sources if b != a]
            terms = [(t, (ps[a][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, a][t] and ps[a][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, a, part, x, v, k + 1) for k, (x, v) in enumerate(sorted(items, key=lambda y: (-y[1], y[0].encode()))[:most])]
    return sorted(out)


def rows_of(seed, n=300):
    r = random.Random(seed)
    words = ["The", "the", "É", "école", "x", "İ", "K", "naïve-ish", "a_b", "漢字"] + [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = [(" ".join(r.choices(words, k=r.choice([0, 1, 5, 40]), weights=[1 / (1 + i) for i in range(len(words))])), r.choice(["en", "en", None, "fr"]), r.choice(["hot", "hot", "b", "", None, f"s{r.randrange(6)}"])) for _ in range(n)]
    return rows + rows[:20] + [(None, "xx", "alone"), ("", "yy", "p"), ("only once", "yy", "q"), ("Hot " * 20_000, "en", "hot"), ("q" * 50_000, "en", "b")] + [("same text", "zz", s) for s in "abcd"]


@pytest.mark.parametrize("seed,small", [(1, 1 << 25), (2, 0)])
def test_is_brute_force(spark, seed, small):
    rows = rows_of(seed)
    docs = spark.createDataFrame([(i, *r, "x", "y", "z") for i, r in enumerate(rows)], SCHEMA).repartition(5)
    got = divergence.audit(docs, top=7, meta_bytes=small).collect()
    assert sorted(map(tuple, got)) == brute(rows, top=7)


def test_pieces_cut_no_word():
    text = "Some Words über alles " * 50
    for most in (1, 7, 100, 10_000):
        assert [w for part in divergence.pieces(text.encode(), most) for w in part] == text.translate(LOW).encode().split()


def test_counts_are_sent_in_parts():
    import pyarrow as pa

    rows = rows_of(4)
    batch = pa.RecordBatch.from_pydict({"lang": [r[1] for r in rows], "source": [r[2] for r in rows], "text": pa.array([r[0] for r in rows], pa.string())})
    whole, parts = (list(divergence.counted([batch], *x)) for x in ((10**9, 10**9), (50, 9)))
    total = collections.Counter()
    for b in parts:
        for x in b.to_pylist():
            total[x["lang"], x["source"], x["term"]] += 1000003 * x["n"] + x["df"]
    assert len(parts) > 5 and total == {(x["lang"], x["source"], x["term"]): 1000003 * x["n"] + x["df"] for x in whole[0].to_pylist()}


def test_empty(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_is_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = divergence.query(spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(f"SELECT {', '.join(got.columns)} FROM ({divergence.ORACLE_SQL}) x").fetchall())
