"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network
with temperature-calibrated probabilities.

Random indexing: each word and each word shape (runs of capitals, small letters, digits and other
characters) has a sparse index vector of ``DIM`` places with ``NONZERO`` of +-1, made from its hash.
A word's vector is the sum of the index vectors of its neighbours within ``REACH`` over all
documents, words sharing ``WORDS`` buckets and shapes ``SHAPES``: the matrix has a fixed size however
large the corpus is. A document is the means of its words' vectors, of its shapes' vectors and of
its own index vectors, with the lengths of these means (a text that repeats few words has long ones)
and the logarithm of its number of words.

The network is fitted on the driver to at most ``SAMPLE`` labelled rows (those of the smallest
doc_id hashes) whose crc32(doc_id) mod 5 is neither 0 (held out) nor 1; rows of remainder 1 among
them set the temperature. Everything else covers all rows.

Defined cases: a null, empty or blank text has the zero vector and so a score of its own; a null
doc_id is scored and never learned from; a doc_id with several labels takes the largest, one with
several texts is learned from by the least, and each of its rows is scored; a very long text is pooled
whole; without labels of both kinds every score is the share of label 1, or 0.5 where there are none;
an empty table has no rows; other columns are never inputs and are kept by ``apply``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables
from .words import Words, chunks, hashed, mix, utf8

DIM, NONZERO, REACH = 64, 4, 2
WORDS, SHAPES = 8192, 1024
SAMPLE, HIDDEN, EPOCHS, THRESHOLD = 20_000, 32, 30, 0.3
SHARDS = 8
INPUTS = 3 * DIM + 5
#: A name that no table's own column has.
SCORE = "__readloom_score"
_KIND = np.full(256, ord("a"), np.uint8)
_KIND[:128] = np.arange(128)
_KIND[65:91], _KIND[97:123], _KIND[48:58] = ord("A"), ord("a"), ord("0")


def _units(texts: list[bytes]):
    """(Words, hashes of the words' shapes): a shape has each run of one kind once."""
    w = Words(texts, lower=True)
    kind = _KIND[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    run = np.concatenate([[True], kind[1:] != kind[:-1]])
    return w, hashed(kind[run])[2]


def _index(h: np.ndarray):
    """(len, NONZERO) places and signs of the index vectors of hashes."""
    x = mix(h ^ np.uint64(0x243F6A8885A308D3))
    shift = np.arange(NONZERO, dtype=np.uint64) * np.uint64(12)
    part = x[:, None] >> shift
    return (part % np.uint64(DIM)).astype(np.int64), 1.0 - 2.0 * ((part >> np.uint64(8)) & np.uint64(1)).astype(np.float64)


def _cells(w, shape):
    return (w.hash % np.uint64(WORDS)).astype(np.int64), WORDS + (shape % np.uint64(SHAPES)).astype(np.int64)


def _contexts(batches):
    """mapInArrow: a task's sums of neighbours' index vectors, in SHARDS rows."""
    total = np.zeros((WORDS + SHAPES) * DIM, np.float64)
    some = False
    for batch in batches:
        texts = utf8(batch.column("text"))
        for a, b in chunks(np.fromiter(map(len, texts), np.int64, len(texts))):
            w, shape = _units(texts[a:b])
            n = len(w.hash)
            if not n:
                continue
            some = True
            rows = _cells(w, shape)
            index = [_index(w.hash), _index(shape)]
            for step in range(1, REACH + 1):
                near = w.doc[:-step] == w.doc[step:] if n > step else np.zeros(0, bool)
                i = np.flatnonzero(near)
                for me, other in ((i, i + step), (i + step, i)):
                    for places, signs in index:
                        for r in rows:
                            total += np.bincount((r[me][:, None] * DIM + places[other]).ravel(), signs[other].ravel(), len(total))
    if some:
        part = total.reshape(SHARDS, -1).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"shard": pa.array(range(SHARDS), pa.int32()), "sums": [p.tobytes() for p in part]})


def _added(pdf):
    import pandas as pd

    total = np.zeros((WORDS + SHAPES) * DIM // SHARDS, np.int64)
    for x in pdf["sums"]:
        total += np.frombuffer(x, np.int64)
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "sums": [total.tobytes()]})


def word_vectors(docs: DataFrame) -> np.ndarray:
    """(WORDS + SHAPES, DIM) unit vectors, from all documents."""
    schema = "shard int, sums binary"
    made = tables.folded(docs.select("text").mapInArrow(_contexts, schema), ["shard"], _added, schema)
    out = np.zeros((SHARDS, (WORDS + SHAPES) * DIM // SHARDS))
    for r in made.collect():
        out[r["shard"]] = np.frombuffer(r["sums"], np.int64)
    out = out.reshape(-1, DIM)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """(texts, INPUTS) document vectors."""
    out = np.zeros((len(texts), INPUTS), np.float32)
    for a, b in chunks(np.fromiter(map(len, texts), np.int64, len(texts))):
        w, shape = _units(texts[a:b])
        n = np.diff(w.first)
        some = np.flatnonzero(n)
        if not len(some):
            continue
        at = w.first[:-1][some]
        for k, rows in enumerate(_cells(w, shape)):
            out[a + some, k * DIM : (k + 1) * DIM] = np.add.reduceat(vectors[rows], at) / n[some, None]
        for k, h in enumerate((w.hash, shape)):
            places, signs = _index(h)
            own = np.bincount((w.doc[:, None] * DIM + places).ravel(), signs.ravel(), (b - a) * DIM)
            own = own.reshape(-1, DIM)[some] / n[some, None]
            out[a + some, 2 * DIM : 3 * DIM] += own
            out[a + some, 3 * DIM + 2 + k] = np.linalg.norm(own, axis=1)
        for k in range(2):
            out[a + some, 3 * DIM + k] = np.linalg.norm(out[a + some, k * DIM : (k + 1) * DIM], axis=1)
        out[a + some, 3 * DIM + 4] = np.log(n[some])
    return out


class Network:
    """Standardised inputs, one hidden layer of ReLU, a logit, a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.constant, self.temperature = None, 1.0
        if not len(y) or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = (x - self.mean) / self.scale
        d = x.shape[1]
        p = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for i in range(0, len(y), 128):
                j = order[i : i + 128]
                hidden = np.maximum(x[j] @ p[0] + p[1], 0)
                error = (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -30, 30))) - y[j]) / len(j)
                back = error[:, None] * p[2] * (hidden > 0)
                grads = [x[j].T @ back + 1e-4 * p[0], back.sum(0), hidden.T @ error, error.sum(keepdims=True)]
                t += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - 3e-3 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        self.p = p

    def logits(self, x):
        return np.maximum((x - self.mean) / self.scale @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3]

    def calibrate(self, x, y):
        """The temperature of least log loss on rows that weren't trained on."""
        if self.constant is not None or not len(y):
            return
        z = self.logits(x)

        def loss(t):
            q = np.clip(1 / (1 + np.exp(-np.clip(z / t, -30, 30))), 1e-9, 1 - 1e-9)
            return -(y * np.log(q) + (1 - y) * np.log(1 - q)).mean()

        self.temperature = float(min(np.geomspace(0.25, 16, 61), key=loss))

    def probability(self, x):
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -700, 700)))


def fold(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5, F.lit(0))


def train(docs: DataFrame, labels: DataFrame, vectors) -> Network:
    """vectors: a broadcast of word_vectors. At most SAMPLE rows and their vectors are collected."""
    known = labels.where("doc_id is not null and quality is not null").where(fold() != 0).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # Of rows that share a doc_id one text is learned from: SAMPLE rows at most.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = rows.select("text", "quality", fold().alias("fold"))

    def run(batches):
        for batch in batches:
            x = pooled(utf8(batch.column("text")), vectors.value)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), batch.column("quality").cast(pa.int32()), batch.column("fold").cast(pa.int32())], ["x", "quality", "fold"])

    got = rows.mapInArrow(run, "x binary, quality int, fold int").toPandas()
    x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(-1, INPUTS).astype(float)
    y, f = got["quality"].to_numpy(float), got["fold"].to_numpy()
    order = np.lexsort((*x[:, :3].T, f)) if len(x) else np.zeros(0, int)
    x, y, f = x[order], y[order], f[order]
    net = Network(x[f != 1], y[f != 1])
    net.calibrate(x[f == 1], y[f == 1])
    return net


def scored(docs: DataFrame, labels: DataFrame, name: str = "score") -> DataFrame:
    """docs with the score in a last column of that name (one that docs has is replaced)."""
    sc = docs.sparkSession.sparkContext
    vectors = sc.broadcast(word_vectors(docs))
    net = sc.broadcast(train(docs, labels, vectors))
    docs = docs.drop(name)
    schema = docs.withColumn(name, F.lit(0.0)).schema

    def run(batches):
        for batch in batches:
            p = net.value.probability(pooled(utf8(batch.column("text")), vectors.value).astype(float))
            yield batch.append_column(name, pa.array(p, pa.float64()))

    return docs.mapInArrow(run, schema)


def apply(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without those that score under the threshold; same columns, whatever their names."""
    return scored(docs, labels, SCORE).where(F.col(SCORE) >= threshold).select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scored(tables.table(spark, sf_dir, "documents").select("doc_id", "text"), tables.table(spark, sf_dir, "labels"))
    return out.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
