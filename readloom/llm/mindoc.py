"""For every hash, which occurrences have one in a document with a smaller doc_id.

Occurrences travel as packed numpy arrays, one row for a task and bucket. A task first settles
what it can see itself: per hash it keeps the occurrences in its smallest document and decides the
others there, so that a hash of a third of all documents sends one entry from each task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tables

PACKED = "kind int, bucket int, doc_id long, key long, hashes binary, owners binary, at binary"
SHARDED = "shard long, heads binary, sizes binary, data binary"
UNITED = "doc_id long, key long, packs array<binary>"
_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("doc_id", pa.int64()), ("key", pa.int64()), ("hashes", pa.binary()), ("owners", pa.binary()), ("at", pa.binary())])


#: A name that no table's own column has.
PACKS = "__readloom_packs"


def squeeze(x: np.ndarray, level: int = 1) -> bytes:
    """zstd of an integer array, after the number of its bytes."""
    raw = np.ascontiguousarray(x).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True)


def unsqueeze(x: bytes, dtype) -> np.ndarray:
    n = int.from_bytes(x[:8], "little")
    return np.frombuffer(pa.decompress(x[8:], n, codec="zstd", asbytes=True), dtype) if n else np.zeros(0, dtype)


def pack_at(at: np.ndarray) -> bytes:
    """Ascending positions as zstd of their gaps."""
    return squeeze(np.diff(at, prepend=0).astype(np.uint32))


def unpack_at(x: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(x, np.uint32).astype(np.int64))


def first_owner(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The smallest doc among the occurrences of each one's hash."""
    order = np.argsort(h, kind="stable")
    hs = h[order]
    begin = np.flatnonzero(np.concatenate([[True], hs[1:] != hs[:-1]]))
    least = np.minimum.reduceat(doc[order], begin)
    out = np.empty_like(doc)
    out[order] = np.repeat(least, np.diff(np.append(begin, len(hs))))
    return out


def by_owner(doc: np.ndarray, key: np.ndarray, at: np.ndarray):
    """(doc, key, ascending positions) of each document."""
    if not len(doc):
        return
    order = np.lexsort((at, key, doc))
    d, k, a = doc[order], key[order], at[order]
    cut = np.flatnonzero((d[1:] != d[:-1]) | (k[1:] != k[:-1])) + 1
    begin = np.concatenate([[0], cut])
    for i, j in zip(begin, np.append(cut, len(d))):
        yield int(d[i]), int(k[i]), a[i:j]


def send(h: np.ndarray, doc: np.ndarray, key: np.ndarray, at: np.ndarray, n_buckets: int):
    """Record batches of one task's occurrences: decided flags (kind 0) and open entries (kind 1).

    No field that pandas reads as a number is null there: it would become a float.
    """
    if not len(h):
        return
    opened = first_owner(h, doc) == doc
    rows = {n: [] for n in _SCHEMA.names}

    def add(**kw):
        for n in rows:
            rows[n].append(kw.get(n))

    if not opened.all():
        shut = ~opened
        for d, k, a in by_owner(doc[shut], key[shut], at[shut]):
            add(kind=0, bucket=k % n_buckets, doc_id=d, key=k, at=pack_at(a))
    h, doc, key, at = h[opened], doc[opened], key[opened], at[opened]
    bucket = ((h >> np.uint64(33)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.lexsort((at, key, doc, bucket))
    h, doc, key, at, bucket = h[order], doc[order], key[order], at[order], bucket[order]
    cut = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    for i, j in zip(np.concatenate([[0], cut]), np.append(cut, len(h))):
        d, k, a = doc[i:j], key[i:j], at[i:j]
        new = np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])])
        owner = np.cumsum(new) - 1
        heads = np.stack([d[new], k[new]], 1)
        gap = np.where(new, a, np.diff(a, prepend=0))
        add(kind=1, bucket=int(bucket[i]), doc_id=0, key=0, hashes=h[i:j].tobytes(), owners=squeeze(heads), at=squeeze(np.concatenate([np.diff(owner, prepend=0), gap]).astype(np.uint32)))
    yield pa.RecordBatch.from_pydict(rows, schema=_SCHEMA)


def opened(row_hashes: bytes, row_owners: bytes, row_at: bytes):
    """(hashes, docs, keys, positions) of one open row."""
    h = np.frombuffer(row_hashes, np.uint64)
    heads = unsqueeze(row_owners, np.int64).reshape(-1, 2)
    both = unsqueeze(row_at, np.uint32).astype(np.int64)
    owner = np.cumsum(both[: len(h)])
    gap = both[len(h) :]
    new = np.concatenate([[True], owner[1:] != owner[:-1]])
    total = np.cumsum(gap)
    base = (total - gap)[new]
    return h, heads[owner, 0], heads[owner, 1], total - base[owner]


def sharded(rows: list[tuple[int, int, bytes]], n_shards: int):
    """(doc, key, pack) entries as one row for each shard of documents."""
    import pandas as pd

    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r[1] % n_shards, []).append(r)
    out = [(s, squeeze(np.array([r[:2] for r in part], np.int64)), squeeze(np.array([len(r[2]) for r in part], np.uint32)), b"".join(r[2] for r in part)) for s, part in by.items()]
    return pd.DataFrame(out, columns=["shard", "heads", "sizes", "data"]).astype({"shard": "int64"})


def united(pdf):
    """applyInPandas over a shard of documents: all packs of each document."""
    import pandas as pd

    packs: dict[tuple, list[bytes]] = {}
    for heads, sizes, data in zip(pdf["heads"], pdf["sizes"], pdf["data"]):
        ends = np.cumsum(unsqueeze(sizes, np.uint32).astype(np.int64)).tolist()
        a = 0
        for (d, k), b in zip(unsqueeze(heads, np.int64).reshape(-1, 2).tolist(), ends):
            packs.setdefault((d, k), []).append(data[a:b])
            a = b
    return pd.DataFrame([(d, k, p) for (d, k), p in packs.items()], columns=["doc_id", "key", "packs"]).astype({"doc_id": "int64", "key": "int64"})


def settle(n_shards: int):
    """applyInPandas over one bucket: flags of the occurrences that a smaller document has too, and
    those that tasks had decided, packed by shards of documents."""

    def run(pdf):
        is_open = pdf["kind"] == 1
        done = pdf[~is_open]
        rows = list(zip(done["doc_id"].tolist(), done["key"].tolist(), done["at"]))
        pdf = pdf[is_open]
        if len(pdf):
            got = [opened(*x) for x in zip(pdf["hashes"], pdf["owners"], pdf["at"])]
            h, doc, key, at = (np.concatenate(x) for x in zip(*got))
            late = first_owner(h, doc) < doc
            rows += [(d, k, pack_at(a)) for d, k, a in by_owner(doc[late], key[late], at[late])]
        return sharded(rows, n_shards)

    return run


def joined(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with the packs (UNITED) of each row in a last column PACKS; docs may have columns of any
    other name."""
    found = found.select(F.col("doc_id").alias(f"{PACKS}_id"), F.col("key").alias(f"{PACKS}_key"), F.col("packs").alias(PACKS))
    return docs.join(found, (F.col("doc_id") == F.col(f"{PACKS}_id")) & (tables.row_key() == F.col(f"{PACKS}_key")), "left").drop(f"{PACKS}_id", f"{PACKS}_key")
