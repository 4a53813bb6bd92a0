"""Count-min sketches of hashes, made by tasks and merged in parts.

Every hash counts once for a document. Merging keeps counts up to 2, and one bit a cell tells which
estimates are at least 2; estimates are never too low. The merged bits have ``DEPTH << bits`` cells:
two rows of at most 2**28 are 64 MB, whatever the input. With more hashes than cells more of them are
estimated repeated, and none is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import mindoc, tables
from .words import mix

DEPTH, MOST_BITS, SHARDS = 2, 28, 32
#: Hashes that a task holds before it sends them.
HELD = 1_200_000
_SALT = (np.uint64(0), np.uint64(0x6C62272E07BB0142))


def cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return ((mix(h ^ _SALT[row]) if row else h) >> np.uint64(64 - bits)).astype(np.int64)


def sketches(elements, bits: int):
    """mapInArrow: one row for each part of the sketch that a task has cells in. ``elements`` gives the
    (hashes, text indexes) of a batch in pieces."""

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for h, doc in elements(batch):
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                held.append(h[np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])] if len(h) else h)
                n += len(held[-1])
                if n >= HELD:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)

    def flush(held):
        h = np.concatenate(held)
        size = DEPTH << bits
        shard, ones, twos = [], [], []
        for row in range(DEPTH):
            c, count = np.unique(cells(h, row, bits), return_counts=True)
            per = size // SHARDS
            place = (row << bits) + c
            cut = np.searchsorted(place, np.arange(0, size + 1, per))
            for s in range(SHARDS):
                part, many = place[cut[s] : cut[s + 1]] - s * per, count[cut[s] : cut[s + 1]] > 1
                if len(part):
                    shard.append(s)
                    ones.append(mindoc.pack_at(part[~many]))
                    twos.append(mindoc.pack_at(part[many]))
        yield pa.RecordBatch.from_pydict({"shard": pa.array(shard, pa.int32()), "ones": pa.array(ones, pa.binary()), "twos": pa.array(twos, pa.binary())})

    return run


def merged(bits: int):
    """applyInPandas over one part: the sum of its sketches (counts up to 2), as a sketch again."""

    def run(pdf):
        import pandas as pd

        count = np.zeros((DEPTH << bits) // SHARDS, np.uint8)
        for column, weight in (("ones", 1), ("twos", 2)):
            for x in pdf[column]:
                at = mindoc.unpack_at(x)
                count[at] = np.minimum(count[at] + weight, 2)
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], **{c: [mindoc.pack_at(np.flatnonzero(count == k))] for c, k in (("ones", 1), ("twos", 2))}})

    return run


def sketch_bits(n: float) -> int:
    """Cells in a row, as a power of 2: about four for each of n hashes, within bounds."""
    return int(min(MOST_BITS, max(12, np.ceil(np.log2(max(n, 1) * 4)))))


def repeated_cells(docs: DataFrame, elements, bits: int) -> np.ndarray:
    """The merged sketch's bits; its size is set by ``bits`` and not by the input."""
    per = (DEPTH << bits) // SHARDS // 8
    schema = "shard int, ones binary, twos binary"
    made = tables.folded(docs.select("text").mapInArrow(sketches(elements, bits), schema), ["shard"], merged(bits), schema)
    out = np.zeros(per * SHARDS, np.uint8)
    for r in made.select("shard", "twos").collect():
        cell = np.zeros(per * 8, bool)
        cell[mindoc.unpack_at(r["twos"])] = True
        out[r["shard"] * per : (r["shard"] + 1) * per] = np.packbits(cell, bitorder="little")
    return out


def repeated(bit: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes are estimated to be in two documents or more."""
    maybe = np.ones(len(h), bool)
    for row in range(DEPTH):
        c = cells(h[maybe], row, bits) + (row << bits)
        maybe[maybe] = (bit[c >> 3] >> (c & 7).astype(np.uint8)) & 1 > 0
    return maybe
