"""Vectorised word handling inside tasks.

A *word* is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; lower-casing touches only
A-Z. Texts of a batch are joined into one byte buffer, so hashing costs a few numpy passes per
byte and no Python object per word. Hashes are 64-bit polynomial hashes with a random byte table,
mixed at the end; they depend on the bytes only, so every task and every retry agrees.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240611)
BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(BASE), -1, 2**64))
_POW: dict[str, np.ndarray] = {"p": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}
#: Bytes of text handled at once; one longer document is still handled whole.
CHUNK_BYTES = 1_000_000


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**0..n and its inverses, modulo 2**64; kept for the next call up to a bounded size."""
    if len(_POW["p"]) <= n:
        size = n + 1 if n > 2 * CHUNK_BYTES else min(max(2 * n, 1024), 2 * CHUNK_BYTES) + 1
        made = []
        for b in (BASE, _INV):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        if size > 2 * CHUNK_BYTES + 1:
            return made[0], made[1]
        _POW["p"], _POW["i"] = made
    return _POW["p"], _POW["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hashed(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of the words of a buffer that ends in white space."""
    space = SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    p, inv = powers(len(buf))
    total = np.empty(len(buf) + 1, np.uint64)
    total[0] = 0
    np.cumsum(BYTE[buf] * p[: len(buf)], out=total[1:])
    return start, end, mix((total[end] - total[start]) * inv[start] + (end - start).astype(np.uint64))


class Words:
    """Words of a batch of byte strings.

    start, end: byte offsets in ``buf``; doc: index of the text; first: index of each text's first
    word (one more entry than texts); hash: 64-bit hash of the word's bytes.
    """

    __slots__ = ("buf", "start", "end", "doc", "first", "hash")

    def __init__(self, texts: list[bytes], lower: bool, table: np.ndarray | None = None):
        """table: what each byte counts as, instead of lower-casing."""
        raw = b"\n".join(texts) + b"\n"
        buf = np.frombuffer(raw, np.uint8)
        if table is None and lower:
            table = LOWER
        self.buf = buf if table is None else table[buf]
        self.start, self.end, self.hash = hashed(self.buf)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        begins = np.concatenate([[0], np.cumsum(sizes)])
        self.first = np.searchsorted(self.start, begins)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.buf[self.start[i] : self.end[i]].tobytes()


_SEQ = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of every k consecutive entries (len(h)-k+1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += h[j : j + n] * _SEQ[j]
    return mix(out)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes of each text: (hashes, offsets with one more entry than texts).

    A text of fewer than k words gives its whole sequence as one shingle, one without words none.
    """
    every = windows(w.hash, k)
    out, at = [], np.zeros(len(w.first), np.int64)
    for d in range(len(w.first) - 1):
        a, b = int(w.first[d]), int(w.first[d + 1])
        if b - a >= k:
            x = np.unique(every[a : b - k + 1])
        elif b > a:
            x = short(w.hash[a:b])
        else:
            x = every[:0]
        out.append(x)
        at[d + 1] = at[d] + len(x)
    return (np.concatenate(out) if out else every[:0]), at


def short(h: np.ndarray) -> np.ndarray:
    """One hash for a whole sequence of fewer words than a shingle has."""
    return mix(windows(h, len(h)) ^ np.uint64(0xA5A5A5A5A5A5A5A5 + len(h)))


def chunks(sizes: np.ndarray, most: int = CHUNK_BYTES):
    """(a, b) ranges of consecutive texts of at most ``most`` bytes together, one text at least."""
    a, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield a, i
            a, total = i, 0
        total += int(n)
    if a < len(sizes):
        yield a, len(sizes)


def utf8(column) -> list[bytes]:
    """Bytes of a column of texts (Arrow or pandas); null is empty."""
    if hasattr(column, "to_pylist"):
        import pyarrow as pa

        return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
    return [x.encode("utf-8") if isinstance(x, str) else b"" for x in column]
