"""The language model against its definition."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from readloom.llm import maxent_lm as lm


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")


def chains(n, words, seed=1):
    """Texts in which a word mostly tells the next one, over a vocabulary far beyond the head classes."""
    r = random.Random(seed)
    texts = []
    for _ in range(n):
        w = [r.randrange(words)]
        while len(w) < 80:
            w.append((w[-1] * 7 + 3) % words if r.random() < 0.8 else r.randrange(words))
        texts.append(" ".join(f"v{x}" for x in w))
    return texts


def test_held_out_texts_and_word_order(spark):
    r = random.Random(2)
    texts = chains(400, 1500)
    shuffled = []
    for t in texts[:40]:
        w = t.split()
        r.shuffle(w)
        shuffled.append(" ".join(w))
    rows = [(i, t, i < 40) for i, t in enumerate(texts)] + [(1000 + i, t, True) for i, t in enumerate(shuffled)]
    got = {x.doc_id: x for x in lm.score(frame(spark, rows)).collect()}
    gain = sum(got[i].score - got[i].base_score for i in range(40)) / sum(got[i].n_tokens for i in range(40))
    assert gain > 0.2  # log10 a token
    # The order of words counts, of those beyond the head too.
    assert np.mean([got[i].score > got[1000 + i].score for i in range(40)]) > 0.9


def test_score_by_definition(spark):
    texts = chains(60, 900, 3)
    rows = [(i, t, False) for i, t in enumerate(texts)] + [(900, "V1 v2 never seen v3", True), (901, None, True), (902, "", True), (903, "v1 " * 4000, True)]
    df = frame(spark, rows)
    vocabulary, model, counts, n, v, _ = lm.fit(df)
    known = {}
    for r in counts.collect():
        known.update(zip(np.frombuffer(r.tokens, np.uint64).tolist(), lm.mindoc.unsqueeze(r.counts, np.int64).tolist()))
    rank = dict(zip(vocabulary.tokens.tolist(), vocabulary.rank.tolist()))
    half = lm.ROWS // 2

    def log_softmax(rows, place):
        z = [sum(float(x) for x in column) for column in zip(*rows)]
        return z[place] - max(z) - math.log(sum(math.exp(x - max(z)) for x in z))

    def total(text):
        h = lm._tokens([(text or "").encode()])[0].tolist()
        row = [rank[x] if rank.get(x, half) < half else half + int(lm.mix(np.array([x], np.uint64))[0]) % (half - 1) for x in h]
        out = 0.0
        for i, x in enumerate(h):
            one, two = (row[i - 1] if i > 0 else lm.START), (row[i - 2] if i > 1 else lm.START)
            pair = 1 + 2 * lm.ROWS + int(lm.mix(np.array([two * lm.ROWS + one], np.uint64))[0]) % lm.PAIRS
            head = rank.get(x, lm.TOP) < lm.TOP
            cls = rank[x] // lm.SIZE if head else int(lm.tail_class(np.array([x], np.uint64))[0])
            out += log_softmax([model.classes[k] for k in (0, 1 + one, 1 + lm.ROWS + two, pair)], cls)
            if head:
                a, b = (int(lm._word_row(np.array([y]))[0]) for y in (one, two))
                out += log_softmax([model.words[k, cls] for k in (0, 1 + a, 1 + lm.WORD_ROWS + b)], rank[x] % lm.SIZE)
            else:
                t = cls - lm.HEAD
                out += math.log((known.get(x, 0) + 1) / (vocabulary.n[t] + vocabulary.v[t] + 1))
        return out / math.log(10)

    got = {x.doc_id: x.score for x in lm.score(df).collect()}
    for i, t, _ in [*rows[:5], *rows[-4:]]:
        assert abs(got[i] - total(t)) < 1e-3 * max(1, abs(got[i]))
    # Each context's probabilities sum to 1: classes by softmax, tail classes by their counts.
    for t in range(lm.TAIL):
        mine = [x for x in known if rank.get(x, lm.TOP) >= lm.TOP and int(lm.tail_class(np.array([x], np.uint64))[0]) == lm.HEAD + t]
        assert sum(known[x] + 1 for x in mine) + 1 == vocabulary.n[t] + vocabulary.v[t] + 1


def test_edges(spark):
    names = lambda df: df.withColumn("score", F.lit("x")).withColumn("key", F.lit(1)).withColumn("n_tokens", F.lit(0))
    assert lm.score(names(frame(spark, []))).count() == 0
    rows = [(None, "a b", False), (1, "a b", False), (1, "a b", False), (2, None, True), (3, "", True)]
    got = sorted((x.doc_id or -1, x.n_tokens, x.n_known, x.train_tokens) for x in lm.score(names(frame(spark, rows))).collect())
    assert got == [(-1, 3, 3, 9), (1, 3, 3, 9), (1, 3, 3, 9), (2, 1, 1, 9), (3, 1, 1, 9)]
    alone = lm.score(frame(spark, [(2, "a", True)])).first()
    assert (alone.n_tokens, alone.n_known, alone.train_tokens, alone.base_score) == (2, 0, 0, 0.0) and math.isfinite(alone.score)
