"""Removes bytes covered by a 50-byte string that also starts in a document with a smaller doc_id.

Every 50-byte window has a minimizer, the smallest hash of its 24-byte strings; neighbouring windows
that share one form a stretch, and equal windows lie in stretches of the same minimizer wherever they
are. A count-min sketch of minimizers leaves only stretches whose minimizer may be in two documents
(it loses none); those go to buckets by minimizer, with their bytes. There, equal stretches are
pre-aggregated to that of the smallest document, and different stretches of one minimizer are ordered
by a suffix array: windows with the same first 50 bytes are neighbours in it, and of neighbours that
are equal the smallest document's stays. (A window shares the 43 or 44 bytes about the minimizer that its
place among ``EDGES`` fixes; stretches are cut to the places where they share those with another, and
stay out without any; a minimizer with one stretch left has nothing to order.) Suffix arrays are built
by linear grouping (``gsaca``) over pieces of a bucket's stretches; stretches of one minimizer stay in
one piece. They stand there as sequences of symbols: the bytes before the minimizer, which windows
begin at, and one for the minimizer and the bytes after it, whose order is that of the bytes.

Hot minimizers, with ``HOT`` stretches or more (counted exactly; on large tables a millionth of all
at least), would make groups that grow with the corpus. Their windows become stretches of their own,
with the hash of all 50 bytes in place of the minimizer, so that such a group is spread over all
buckets and equal windows still meet.

Hot strings: a task sends one copy of a stretch, its smallest document's; other copies are settled
before. Hashes only choose where strings meet: equality is always that of bytes.

Defined cases: null is empty; a null doc_id takes part in nothing and stays whole; rows that share a
doc_id never remove each other's bytes; texts shorter than the window lose nothing; a very long text
is handled whole; columns besides doc_id and text are kept by ``apply``, whatever their names, and
ignored by ``query``; an empty table gives no rows. ``apply`` removes whole characters only: one that
loses a byte goes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import countmin, mindoc, tables
from .gsaca import suffix_array
from .words import BYTE, chunks, mix, powers, utf8

WINDOW, GRAM = 50, 24
#: Bytes of a window before its minimizer: places that are looked at together lie between two of these.
EDGES = (0, 7, 13, 20, 26)
#: Bytes of stretches that a task holds before it sends them.
HELD_BYTES = 24_000_000
#: Symbols that one suffix array is built over, and stretches of a minimizer from which it is hot.
PIECE = 1 << 17
HOT, SHARE = 4096, 1_000_000
#: Bytes of a bucket's stretches that are settled at once, whole minimizers.
SLICE = 2_000_000
COUNTED = 1_200_000
PACKED = "kind int, bucket int, doc_id long, key long, mins binary, starts binary, sizes binary, owners binary, strings binary"
_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("doc_id", pa.int64()), ("key", pa.int64()), *((c, pa.binary()) for c in ("mins", "starts", "sizes", "owners", "strings"))])


class Rolling:
    """Hashes of substrings of one buffer."""

    def __init__(self, buf: np.ndarray):
        self.p, self.inv = powers(len(buf))
        self.total = np.empty(len(buf) + 1, np.uint64)
        self.total[0] = 0
        np.cumsum(BYTE[buf] * self.p[: len(buf)], out=self.total[1:])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return mix((self.total[start + size] - self.total[start]) * self.inv[start] + np.asarray(size).astype(np.uint64))

    def every(self, size: int) -> np.ndarray:
        n = len(self.total) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.total[size:] - self.total[:n]) * self.inv[:n] + np.uint64(size))


def stretches(buf: np.ndarray, begins: np.ndarray, ends: np.ndarray):
    """(minimizer, text index, start, end) of the stretches of texts that lie in a buffer; ends are
    of the stretch's bytes. Texts don't touch: windows over two are no windows."""
    roll = Rolling(buf)
    least = roll.every(GRAM)
    reach, width = WINDOW - GRAM + 1, 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:]) if len(least) > width else least[:0]
        width *= 2
    if reach > width:
        rest = reach - width
        least = np.minimum(least[:-rest], least[rest:]) if len(least) > rest else least[:0]
    doc = np.full(len(least), -1, np.int64)
    for d, (a, b) in enumerate(zip(begins, ends)):
        if b - a >= WINDOW:
            doc[a : b - WINDOW + 1] = d
    new = np.concatenate([[True], (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])]) if len(least) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(least))
    keep = doc[start] >= 0
    start, end = start[keep], end[keep]
    return least[start], doc[start], start, end - 1 + WINDOW, roll


def _buffers(batch):
    texts = utf8(batch.column("text"))
    for a, b in chunks(np.fromiter(map(len, texts), np.int64, len(texts))):
        part = texts[a:b]
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        yield a, np.frombuffer(b"\x00".join(part) + b"\x00", np.uint8), begins, begins + sizes


def _minimizers(batch):
    for _, buf, begins, ends in _buffers(batch):
        h, doc, *_ = stretches(buf, begins, ends)
        yield h, doc


def _spans(start, end) -> bytes:
    return mindoc.squeeze(np.stack([start, end]).astype(np.uint32))


def _unspans(x: bytes) -> np.ndarray:
    return mindoc.unsqueeze(x, np.uint32).astype(np.int64).reshape(2, -1)


def _by_document(doc, key, start, end):
    for d, k, at in mindoc.by_owner(doc, key, np.arange(len(doc))):
        yield d, k, _spans(start[at], end[at])


def _counting(bits, sketch, n_buckets):
    """mapInArrow: packed (minimizer, stretches) for each bucket."""

    def send(held):
        h, c = np.unique(np.concatenate(held), return_counts=True)
        bucket = ((h >> np.uint64(33)) % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        h, c, bucket = h[order], c[order], bucket[order]
        begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        parts = list(zip(begin, np.append(begin[1:], len(h))))
        return pa.RecordBatch.from_pydict({"bucket": pa.array(bucket[begin].astype(np.int32)), "mins": [h[i:j].tobytes() for i, j in parts], "counts": [mindoc.squeeze(c[i:j]) for i, j in parts]})

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for h, _ in _minimizers(batch):
                h = h[countmin.repeated(sketch.value, h, bits)]
                held.append(h)
                n += len(h)
                if n >= COUNTED:
                    yield send(held)
                    held, n = [], 0
        if n:
            yield send(held)

    return run


def _most(pdf):
    """A bucket's minimizers of HOT stretches or more, and how many stretches it has."""
    import pandas as pd

    h = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["mins"]])
    c = np.concatenate([mindoc.unsqueeze(x, np.int64) for x in pdf["counts"]])
    h, at = np.unique(h, return_inverse=True)
    c = np.bincount(at, c).astype(np.int64)
    often = c >= pdf["least"].iloc[0]
    return pd.DataFrame({"mins": [h[often].tobytes()], "counts": [c[often].tobytes()], "n": [int(c.sum())]})


def hot_minimizers(keyed: DataFrame, bits: int, sketch, n_buckets: int) -> np.ndarray:
    """Sorted minimizers whose windows are sent one by one; at most SHARE of them."""
    counts = keyed.mapInArrow(_counting(bits, sketch, n_buckets), "bucket int, mins binary, counts binary").withColumn("least", F.lit(HOT))
    rows = counts.groupBy("bucket").applyInPandas(_most, "mins binary, counts binary, n long").collect()
    h, c = (np.concatenate([np.frombuffer(r[x], t) for r in rows] or [np.zeros(0, t)]) for x, t in (("mins", np.uint64), ("counts", np.int64)))
    return np.sort(h[c >= -(-sum(r["n"] for r in rows) // SHARE)])


def _inside(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places begin..begin+size of every string, one string after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _classes(raw: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A number for each of the strings that follow each other, the same for strings of the same bytes."""
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    strings = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(raw))])
    return strings.dictionary_encode().indices.to_numpy().astype(np.int64)


def _send(held, n_buckets):
    """One task's stretches: spans of those that an earlier document here has too (kind 0), and one
    row of packed stretches for each bucket (kind 1)."""
    h, doc, key, start, size = (np.concatenate([x[i] for x in held]) for i in range(5))
    raw = np.concatenate([x[5] for x in held])
    offset = np.cumsum(size) - size
    opened = mindoc.first_owner(_classes(raw, size), doc) == doc
    rows = {n: [] for n in _SCHEMA.names}

    def add(**kw):
        for n in rows:
            rows[n].append(kw.get(n))

    if not opened.all():
        shut = ~opened
        for d, k, spans in _by_document(doc[shut], key[shut], start[shut], start[shut] + size[shut]):
            add(kind=0, bucket=k % n_buckets, doc_id=d, key=k, mins=spans)
    mine = np.flatnonzero(opened)
    bucket = ((h[mine] >> np.uint64(33)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.lexsort((start[mine], key[mine], doc[mine], bucket))
    mine, bucket = mine[order], bucket[order]
    cut = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    for i, j in zip(np.concatenate([[0], cut]), np.append(cut, len(mine))):
        if j > i:
            m = mine[i:j]
            d, k, n = doc[m], key[m], size[m]
            new = np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])])
            heads = np.stack([d[new], k[new], np.diff(np.append(np.flatnonzero(new), len(m)))])
            add(kind=1, bucket=int(bucket[i]), doc_id=0, key=0, mins=h[m].tobytes(), starts=mindoc.squeeze(start[m].astype(np.uint32)), sizes=mindoc.squeeze(n.astype(np.uint8 if n.max() < 256 else np.uint32)), owners=mindoc.squeeze(heads), strings=mindoc.squeeze(raw[_inside(offset[m], n)], 6))
    return pa.RecordBatch.from_pydict(rows, schema=_SCHEMA)


def _sent(bits, sketch, n_buckets, hot):
    """mapInArrow: stretches whose minimizer may be in two documents, those of hot ones as windows."""

    def run(batches):
        bit, often = sketch.value, hot.value
        held, n = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            for a, buf, begins, ends in _buffers(batch):
                h, doc, start, end, roll = stretches(buf, begins, ends)
                maybe = countmin.repeated(bit, h, bits)
                h, doc, start, size = h[maybe], doc[maybe], start[maybe], (end - start)[maybe]
                if len(often) and len(h):
                    is_hot = often[np.minimum(np.searchsorted(often, h), len(often) - 1)] == h
                    count = (size - WINDOW + 1)[is_hot]
                    at, owner = _inside(start[is_hot], count), np.repeat(doc[is_hot], count)
                    h, doc, start = (np.concatenate(x) for x in ((h[~is_hot], roll.of(at, WINDOW)), (doc[~is_hot], owner), (start[~is_hot], at)))
                    size = np.append(size[~is_hot], np.full(len(at), WINDOW))
                for i, j in [(0, len(h))] if size.sum() <= HELD_BYTES else chunks(size, HELD_BYTES):
                    o = doc[i:j]
                    held.append((h[i:j], ids[a + o].astype(np.int64), keys[a + o].astype(np.int64), start[i:j] - begins[o], size[i:j], buf[_inside(start[i:j], size[i:j])]))
                    n += int(size[i:j].sum())
                    if n >= HELD_BYTES:
                        yield _send(held, n_buckets)
                        held, n = [], 0
        if n:
            yield _send(held, n_buckets)

    return run


def _anchors(buf, begin, size, h):
    """Where each stretch holds its minimizer: (stretch, place in buf) of every occurrence."""
    gram = Rolling(buf).every(GRAM)
    count = size - GRAM + 1
    owner, at = np.repeat(np.arange(len(begin)), count), _inside(begin, count)
    hit = gram[at] == h[owner]
    return owner[hit], at[hit]


def _shared_parts(buf, begin, size, owner, at, group):
    """(most, fewest) bytes before its minimizer that a window of each stretch has if another of its group
    has it too; most is -1 where there is no such window. Stretches that hold their minimizer not once
    are kept whole."""
    most = np.where(np.bincount(owner, minlength=len(begin)) != 1, EDGES[-1], -1)
    fewest = np.where(most < 0, EDGES[-1], 0)
    roll, salt = Rolling(buf), mix(group.astype(np.uint64))
    for low, high in zip(EDGES, EDGES[1:]):
        n = WINDOW - (high - low)
        ok = (at - low >= begin[owner]) & (at - low + n <= begin[owner] + size[owner])
        o = owner[ok]
        _, inverse, count = np.unique(roll.of(at[ok] - low, n) ^ salt[o], return_inverse=True, return_counts=True)
        hit = np.zeros(len(begin), bool)
        hit[o[count[inverse] > 1]] = True
        most, fewest = np.where(hit, np.maximum(most, high), most), np.where(hit, np.minimum(fewest, low), fewest)
    return most, fewest


def _settle(n_shards):
    """applyInPandas over a bucket: spans of bytes that a smaller document has too, packed by shards of
    documents."""

    def run(pdf):
        rows = [(d, k, m) for d, k, m, kind in zip(pdf["doc_id"].tolist(), pdf["key"].tolist(), pdf["mins"], pdf["kind"]) if kind == 0]
        pdf = pdf[pdf["kind"] == 1]
        if len(pdf):
            h = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["mins"]])
            start = np.concatenate([mindoc.unsqueeze(x, np.uint32) for x in pdf["starts"]]).astype(np.int64)
            size = np.concatenate([mindoc.unsqueeze(x, np.uint8 if int.from_bytes(x[:8], "little") * 8 == len(m) else np.uint32).astype(np.int64) for x, m in zip(pdf["sizes"], pdf["mins"])])
            heads = np.concatenate([mindoc.unsqueeze(x, np.int64).reshape(3, -1) for x in pdf["owners"]], 1)
            doc, key = np.repeat(heads[0], heads[2]), np.repeat(heads[1], heads[2])
            raw = np.concatenate([mindoc.unsqueeze(x, np.uint8) for x in pdf["strings"]])
            for m, part in _slices(h, size, raw):
                rows += _settled(h[m], doc[m], key[m], start[m], size[m], part)
        return mindoc.sharded(rows, n_shards)

    return run


def _slices(h, size, raw):
    """Stretches of whole minimizers of about SLICE bytes together, and their bytes."""
    begin = np.cumsum(size) - size
    order = np.argsort(h, kind="stable")
    last = np.flatnonzero(np.append(h[order][1:] != h[order][:-1], True)) + 1
    total = np.concatenate([[0], np.cumsum(size[order])])
    a = 0
    while a < len(order):
        b = int(last[max(int(np.searchsorted(total[last], total[a] + SLICE, "right")) - 1, int(np.searchsorted(last, a, "right")))])
        m = order[a:b]
        yield m, raw[_inside(begin[m], size[m])]
        a = b


def _settled(h, doc, key, start, size, raw):
    """(doc, key, spans) of the bytes of some stretches, of whole minimizers, that smaller documents have."""
    begin = np.cumsum(size) - size
    string = _classes(raw, size)
    late = mindoc.first_owner(string, doc) < doc
    out = list(_by_document(doc[late], key[late], start[late], start[late] + size[late]))
    # One of each string, of its smallest document; repeats in that document follow it.
    order = np.lexsort((start, doc, string))
    head = order[np.concatenate([[True], string[order][1:] != string[order][:-1]])]
    _, group, strings = np.unique(h[head], return_inverse=True, return_counts=True)
    head, group = head[strings[group] > 1], group[strings[group] > 1]
    if not len(head):
        return out
    order = np.argsort(group, kind="stable")
    head, group = head[order], group[order]
    buf = raw[_inside(begin[head], size[head])]
    at = np.cumsum(size[head]) - size[head]
    owner, place = _anchors(buf, at, size[head], h[head])
    most, fewest = _shared_parts(buf, at, size[head], owner, place, group)
    anchor = np.full(len(head), -1)
    anchor[owner] = place - at[owner]
    # A group aligns at its minimizer if every stretch holds it once; others go byte by byte.
    once = np.bincount(owner, minlength=len(head)) == 1
    anchor[np.isin(group, group[~once])] = -1
    # Bytes that no shared window has are cut from both ends.
    cut = np.where(anchor >= 0, np.maximum(anchor - most, 0), 0)
    n = np.where(anchor >= 0, np.minimum(size[head], anchor + WINDOW - fewest), size[head]) - cut
    anchor = np.where(anchor >= 0, anchor - cut, -1)
    found = []
    for aligned in (True, False):
        m = np.flatnonzero((most >= 0) & ((anchor >= 0) == aligned))
        symbols = anchor[m] + 1 if aligned else n[m] + 1
        last = np.flatnonzero(np.append(group[m][1:] != group[m][:-1], True)) + 1 if len(m) else []
        a, done, total = 0, 0, np.cumsum(symbols)
        for c in last:
            if total[c - 1] - done >= PIECE or c == len(m):
                found += [(int(head[k]), int(cut[k]) + s, int(cut[k]) + e) for k, s, e in _piece(m[a:c], buf, at + cut, n, doc[head], anchor if aligned else None, group)]
                a, done = int(c), total[c - 1]
    if found:
        # The spans of a head hold for all that equal it in the same document.
        first = dict(zip(string[head].tolist(), head.tolist()))
        twins: dict[int, list[int]] = {}
        for k in np.flatnonzero(np.isin(string, string[head])).tolist():
            if doc[k] == doc[first[int(string[k])]]:
                twins.setdefault(first[int(string[k])], []).append(k)
        d, k, s, e = (np.asarray(x, np.int64) for x in zip(*((doc[t], key[t], start[t] + s, start[t] + e) for m, s, e in found for t in twins[m])))
        out += _by_document(d, k, s, e)
    return out


def _symbols(mine, buf, at, size, anchor, group):
    """The sequence of symbols of some stretches, and for every symbol its stretch and byte in it; -1 for
    symbols that no window begins at."""
    n = size[mine]
    if anchor is None:
        begin = np.cumsum(n + 1) - n - 1
        text, owner, byte = np.zeros(int((n + 1).sum()), np.int64), np.zeros(int((n + 1).sum()), np.int64), np.full(int((n + 1).sum()), -1)
        to = _inside(begin, n)
        text[to] = buf[_inside(at[mine], n)].astype(np.int64) + 1
        to = _inside(begin, n - WINDOW + 1)
        owner[to], byte[to] = np.repeat(np.arange(len(mine)), n - WINDOW + 1), _inside(np.zeros_like(n), n - WINDOW + 1)
        return text, owner, byte
    before = anchor[mine]
    after = n - before - GRAM
    total = before + 1
    begin = np.cumsum(total) - total
    text, owner, byte = np.zeros(int(total.sum()), np.int64), np.zeros(int(total.sum()), np.int64), np.full(int(total.sum()), -1)
    text[_inside(begin, before)] = buf[_inside(at[mine], before)].astype(np.int64) + 1
    # Minimizers and the bytes after them, filled up with zeros, by rank.
    width = WINDOW - GRAM
    tail = np.zeros((len(mine), 8 + width), np.uint8)
    tail[:, :8] = group[mine].astype(">u8").view(np.uint8).reshape(-1, 8)
    tail.reshape(-1)[_inside(np.arange(len(mine)) * (8 + width) + 8, after)] = buf[_inside(at[mine] + before + GRAM, after)]
    _, rank = np.unique(tail.view(f"S{8 + width}").ravel(), return_inverse=True)
    text[begin + before] = 257 + rank
    windows = n - WINDOW + 1
    to = _inside(begin, windows)
    owner[to], byte[to] = np.repeat(np.arange(len(mine)), windows), _inside(np.zeros_like(n), windows)
    return text, owner, byte


def _piece(mine, buf, at, size, doc, anchor, group):
    """Spans of the stretches ``mine`` that others of smaller documents have: (stretch, start, end)."""
    if len(mine) < 2:
        return []
    text, owner, byte = _symbols(mine, buf, at, size, anchor, group)
    order = suffix_array(text)
    order = order[byte[order] >= 0]
    owner, byte = owner[order], byte[order]
    place = at[mine][owner] + byte
    same = np.zeros(len(order), bool)
    for i in range(1, len(order), 8192):
        j = min(i + 8192, len(order))
        x = buf[place[i - 1 : j, None] + np.arange(WINDOW)]
        same[i:j] = (x[1:] == x[:-1]).all(1)
    begins = np.flatnonzero(~same)
    own = doc[mine][owner]
    least = np.repeat(np.minimum.reduceat(own, begins), np.diff(np.append(begins, len(order))))
    late = least < own
    owner, byte = owner[late], byte[late]
    order = np.lexsort((byte, owner))
    owner, byte = owner[order], byte[order]
    cut = np.flatnonzero((owner[1:] != owner[:-1]) | (byte[1:] > byte[:-1] + 1)) + 1 if len(owner) else np.zeros(0, int)
    return [(int(mine[owner[i]]), int(byte[i]), int(byte[j - 1]) + WINDOW) for i, j in zip(np.concatenate([[0], cut]).astype(int), np.append(cut, len(owner)).astype(int)) if j > i]


def with_spans(docs: DataFrame) -> DataFrame:
    """docs with a column ``mindoc.PACKS``: packed spans of bytes to remove, null where there are none."""
    spark = docs.sparkSession
    n = tables.n_bytes(docs)
    bits = countmin.sketch_bits(n / ((WINDOW - GRAM + 2) / 2))
    n_buckets = max(tables.parts(spark), n >> 23)
    keyed = docs.where("doc_id is not null and text is not null").select("doc_id", "text", tables.row_key().alias("key"))
    sketch = spark.sparkContext.broadcast(countmin.repeated_cells(keyed, _minimizers, bits))
    hot = spark.sparkContext.broadcast(hot_minimizers(keyed, bits, sketch, n_buckets))
    sent = keyed.mapInArrow(_sent(bits, sketch, n_buckets, hot), PACKED).repartition(n_buckets, "bucket")
    found = sent.groupBy("bucket").applyInPandas(_settle(n_buckets), mindoc.SHARDED).groupBy("shard").applyInPandas(mindoc.united, mindoc.UNITED)
    return mindoc.joined(docs, found)


def _removed(n: int, packs) -> np.ndarray:
    """Which of n bytes go."""
    cover = np.zeros(n + 1, np.int32)
    if packs:
        start, end = np.concatenate([_unspans(p) for p in packs], 1)
        np.add.at(cover, start, 1)
        np.add.at(cover, end, -1)
    return np.cumsum(cover[:-1]) > 0


def apply(docs: DataFrame) -> DataFrame:
    """docs with the repeated strings gone from ``text``; same columns."""
    schema = docs.schema

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, packs in enumerate(batch.column(mindoc.PACKS).to_pylist()):
                if packs:
                    raw = np.frombuffer(texts[i].encode(), np.uint8)
                    gone = _removed(len(raw), packs)
                    lead = (raw & 0xC0) != 0x80
                    letter = np.cumsum(lead) - 1
                    texts[i] = raw[~(np.bincount(letter, gone) > 0)[letter]].tobytes().decode()
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string())).select(schema.names)

    return with_spans(docs).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            out = []
            for text, packs in zip(utf8(batch.column("text")), batch.column(mindoc.PACKS).to_pylist()):
                kept, runs = text, 0
                if packs:
                    gone = _removed(len(text), packs)
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])
                out.append((len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
            n, removed, runs, sha = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    docs = tables.table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_spans(docs).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
