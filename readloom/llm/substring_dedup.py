"""Removes words covered by a window that also starts in a document with a smaller doc_id.

Two passes. The first makes count-min sketches of every task's windows (distinct within a
document), merges them and keeps one bit a cell: estimated count at least 2. Estimates are never
too low, so no repeated window is lost. The second pass groups exactly only the windows whose
cells are all repeated.

Defined cases: a null text has no words; a text of fewer words than the window loses none; a null
doc_id takes part in nothing and its text stays whole; rows that share a doc_id never remove each
other's words; columns besides doc_id and text are kept by ``apply`` and ignored by ``query``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import countmin, mindoc, tables
from .words import Words, chunks, utf8, windows

WINDOW = 13
#: Windows that a task holds before it sends them.
HELD = 1_200_000


def _texts(batch: pa.RecordBatch):
    """Chunks of a batch: (rows, Words)."""
    texts = utf8(batch.column("text"))
    for a, b in chunks(np.fromiter(map(len, texts), np.int64, len(texts))):
        yield a, b, Words(texts[a:b], lower=False)


def _window_rows(w: Words, window: int):
    """(hash, text index, first word's index in its text) of every window."""
    h = windows(w.hash, window)
    whole = w.doc[: len(h)] == w.doc[window - 1 : window - 1 + len(h)]
    doc = w.doc[: len(h)][whole]
    return h[whole], doc, np.flatnonzero(whole) - w.first[doc]


def _elements(window: int):
    def run(batch):
        for _, _, w in _texts(batch):
            yield _window_rows(w, window)[:2]

    return run


def candidates(window: int, bits: int, sketch, n_buckets: int):
    """mapInArrow: windows whose cells are repeated in both rows, for the exact step."""

    def run(batches):
        bit = sketch.value
        held, n = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            for a, _, w in _texts(batch):
                h, doc, at = _window_rows(w, window)
                maybe = countmin.repeated(bit, h, bits)
                doc = doc[maybe] + a
                held.append((h[maybe], ids[doc].astype(np.int64), keys[doc].astype(np.int64), at[maybe]))
                n += len(doc)
                if n >= HELD:
                    yield from mindoc.send(*map(np.concatenate, zip(*held)), n_buckets)
                    held, n = [], 0
        if n:
            yield from mindoc.send(*map(np.concatenate, zip(*held)), n_buckets)

    return run


def flags(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, key, packs): packed starts of windows that also start in a smaller document."""
    spark = docs.sparkSession
    n = tables.n_bytes(docs)
    bits = countmin.sketch_bits(n / 6)
    n_buckets = max(tables.parts(spark), n >> 24)
    sketch = spark.sparkContext.broadcast(countmin.repeated_cells(docs, _elements(window), bits))
    keyed = docs.where("doc_id is not null and text is not null").select("doc_id", "text", tables.row_key().alias("key"))
    sent = keyed.mapInArrow(candidates(window, bits, sketch, n_buckets), mindoc.PACKED).repartition(n_buckets, "bucket")
    return sent.groupBy("bucket").applyInPandas(mindoc.settle(n_buckets), mindoc.SHARDED).groupBy("shard").applyInPandas(mindoc.united, mindoc.UNITED)


def _kept_words(text: bytes, packs, window: int) -> tuple[list[bytes], int]:
    words = text.split()
    if packs is None or not len(packs):
        return words, len(words)
    cover = np.zeros(len(words) + 1, np.int32)
    at = np.concatenate([mindoc.unpack_at(p) for p in packs])
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    gone = np.cumsum(cover[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g], len(words)


def with_flags(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with a column ``mindoc.PACKS`` (null where no window of the document is repeated)."""
    return mindoc.joined(docs, flags(docs, window))


def apply(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the repeated words gone from ``text``: a text that loses any is its kept words
    joined by one space, others stay as they are. Columns and their order are kept."""
    schema = docs.schema

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, packs in enumerate(batch.column(mindoc.PACKS).to_pylist()):
                if packs and texts[i] is not None:
                    texts[i] = b" ".join(_kept_words(texts[i].encode(), packs, window)[0]).decode()
            at = batch.schema.get_field_index("text")
            out = batch.set_column(at, "text", pa.array(texts, pa.string()))
            yield out.select(schema.names)

    return with_flags(docs, window).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", "text")

    def run(batches):
        for batch in batches:
            rows = []
            for text, packs in zip(utf8(batch.column("text")), batch.column(mindoc.PACKS).to_pylist()):
                kept, n = _kept_words(text, packs, WINDOW)
                rows.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            n, gone, sha = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return with_flags(docs).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
