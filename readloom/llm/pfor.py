"""Patched frame-of-reference blocks of token ids.

File format, little-endian: ``PFR1``; ids (u64); ids a block (u32); blocks (u32); byte offset of each
block from the file's begin (u64 each); the blocks. A block: minimum (u32), width in bits (u8), number
of exceptions (u16), their positions (u16 each) and whole values (u32 each), then every id less the
minimum, cut to the width, packed low bits first. The width holds the ``PERCENTILE``-th percentile of
the block; larger values are exceptions.
"""

from __future__ import annotations

import numpy as np

BLOCK, PERCENTILE = 1024, 90
_HEAD = 20


def _packed(x: np.ndarray, width: int) -> np.ndarray:
    """(blocks, ids) to (blocks, bytes)."""
    x = np.ascontiguousarray(x, "<u2" if width <= 16 else "<u4")
    bits = np.unpackbits(x.view(np.uint8).reshape(*x.shape, -1), axis=2, count=width, bitorder="little")
    return np.packbits(bits.reshape(len(x), -1), axis=1, bitorder="little")


def encode(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    ids = np.asarray(ids, np.uint32)
    n_blocks = -(-len(ids) // block)
    blocks: list[bytes] = [b""] * n_blocks
    whole = len(ids) // block
    for rows, first in ((ids[: whole * block].reshape(whole, block), 0), (ids[whole * block :].reshape(1, -1), whole)):
        if not rows.size:
            continue
        low = rows.min(1)
        over = rows - low[:, None]
        at = min(over.shape[1] - 1, over.shape[1] * percentile // 100)
        edge = np.partition(over, at, axis=1)[:, at]
        width = np.ceil(np.log2(edge.astype(np.float64) + 1)).astype(np.int64)
        for w in np.unique(width):
            mine = np.flatnonzero(width == w)
            for i in range(0, len(mine), 64):
                part = mine[i : i + 64]
                x = over[part]
                odd = x >> np.uint32(w) > 0 if w < 32 else np.zeros(x.shape, bool)
                body = _packed(np.where(odd, 0, x).astype(np.uint32), int(w))
                for k, r in enumerate(part):
                    p = np.flatnonzero(odd[k])
                    blocks[first + r] = low[r].tobytes() + bytes([w]) + len(p).to_bytes(2, "little") + p.astype("<u2").tobytes() + rows[r][p].astype("<u4").tobytes() + body[k].tobytes()
    sizes = np.fromiter(map(len, blocks), np.uint64, n_blocks)
    starts = np.uint64(_HEAD + 8 * n_blocks) + np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.uint64) if n_blocks else sizes
    return b"PFR1" + len(ids).to_bytes(8, "little") + block.to_bytes(4, "little") + n_blocks.to_bytes(4, "little") + starts.astype("<u8").tobytes() + b"".join(blocks)


def decode(data: bytes, begin: int = 0, end: int | None = None) -> np.ndarray:
    """Ids begin..end; only their blocks are touched."""
    if data[:4] != b"PFR1":
        raise ValueError("not a file of patched frame-of-reference blocks")
    n, block, n_blocks = int.from_bytes(data[4:12], "little"), int.from_bytes(data[12:16], "little"), int.from_bytes(data[16:20], "little")
    end = n if end is None else min(end, n)
    if begin >= end:
        return np.zeros(0, np.uint32)
    starts = np.frombuffer(data, "<u8", n_blocks, _HEAD)
    first, last = begin // block, -(-end // block)
    out = np.zeros((last - first) * block, np.uint32)
    heads = []
    for b in range(first, last):
        s = int(starts[b])
        odd = int.from_bytes(data[s + 5 : s + 7], "little")
        heads.append((data[s + 4], min(block, n - b * block), b - first, int.from_bytes(data[s : s + 4], "little"), s, odd))
    by: dict[tuple[int, int], list] = {}
    for h in heads:
        by.setdefault(h[:2], []).append(h)
    for (width, count), group in by.items():
        size = -(-count * width // 8)
        for i in range(0, len(group), 64):
            part = group[i : i + 64]
            if width:
                raw = np.stack([np.frombuffer(data, np.uint8, size, s + 7 + 6 * odd) for *_, s, odd in part])
                bits = np.unpackbits(raw, axis=1, count=count * width, bitorder="little").reshape(len(part), count, width)
                values = np.zeros((len(part), count), np.uint32)
                for j in range(width):
                    values |= bits[:, :, j].astype(np.uint32) << np.uint32(j)
            else:
                values = np.zeros((len(part), count), np.uint32)
            for (_, _, b, low, s, odd), v in zip(part, values):
                v += np.uint32(low)
                v[np.frombuffer(data, "<u2", odd, s + 7)] = np.frombuffer(data, "<u4", odd, s + 7 + 2 * odd)
                out[b * block : b * block + count] = v
    return out[begin - first * block : end - first * block]
