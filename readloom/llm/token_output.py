"""Token ids of all documents in ascending doc_id order, in files of patched frame-of-reference blocks.

``write`` range-partitions documents by doc_id, encodes each partition in order and stores segments:
one row holds a whole file in the format of ``pfor`` and the doc_ids and lengths in it. Rows live in
a Parquet folder, so that Spark commits them once whatever tasks are retried, in any store that it
writes to. ``read`` gives each document its place among all ids from the segments' lengths alone.

Where the tokenizer's own first step cuts before every space that a visible character follows (a
byte-level pre-tokenizer with its usual pattern and no normalizer), texts are cut there too, the
distinct pieces of a chunk are found by Arrow's dictionary encoding, and only pieces not met before
are encoded; the ids are those of the whole text. A piece of plain characters (ASCII without the
apostrophe, Latin letters, single line breaks) is cut further, where that first step cuts it, and its
distinct words go to the tokenizer's model as bytes already spelled its way. Texts with other white
space after a space, texts that hold the content of an added token, and all texts of other tokenizers
are encoded whole.

Defined cases: a null or empty text is its end id alone; null doc_ids come first; rows that share a
doc_id keep one place each, in the order of their texts' hashes, equal rows one after the other; a
very long text is one document of its segment; an empty table has no rows; columns besides doc_id and
text are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import pfor, tables
from .words import BYTE, chunks, mix, powers

END_ID = 2
SEGMENT_IDS = 1_000_000
#: Pieces that a worker remembers, and bytes of text cut at once (one longer text is cut whole).
REMEMBERED, CHUNK_BYTES = 500_000, 4_000_000
PARTITION_BYTES = 32 << 20
STORED = "part int, seg int, before long, n long, doc_ids array<long>, lengths array<long>, data binary"
#: Partitions (one row each, under 100 bytes) up to which their offsets are broadcast.
SMALL = 1_000_000
#: After these characters' kind a space surely begins a piece: no white space among them.
_PLAIN = "!-~À-ɏ"
_ODD = f" (?:[^{_PLAIN}]|$)"
#: Pieces whose words _words cuts: between letters, digits and other characters, and at line breaks. The
#: apostrophe begins words of its own kind, and more line breaks than one are cut by what follows them.
_LETTERS = "!-&(-~À-ÖØ-öø-ɏ"
_SIMPLE = f"^ ?[{_LETTERS}]+(\\n[{_LETTERS}]+)*\\n?$"
_KIND = np.full(256, 3, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58], _KIND[10], _KIND[32] = 2, 4, 0
#: How a byte-level tokenizer spells each byte: a visible character as itself, others from U+0100.
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELLED = np.zeros(256, "<u4")
_SPELLED[_SEEN] = _SEEN
_SPELLED[np.setdiff1d(np.arange(256), _SEEN)] = 256 + np.arange(256 - len(_SEEN))
#: Words of one text that are encoded together, and texts that the tokenizer gets at once.
WORDS, TEXTS = 256, 256
_workers: dict = {}


def _strings(x: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an array of strings without nulls."""
    _, offsets, data = x.buffers()
    at = np.frombuffer(offsets, np.int32, len(x) + 1, 4 * x.offset).astype(np.int64) if len(x) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8, int(at[-1] - at[0]), int(at[0])) if at[-1] > at[0] else np.zeros(0, np.uint8), at - at[0]


def _inside(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places begin..begin+size of every string, one string after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    p, inv = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * p[: len(data)], out=total[1:])
    return mix((total[at[1:]] - total[at[:-1]]) * inv[at[:-1]] + np.diff(at).astype(np.uint64))


class Encoder:
    """Ids of whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        first = made.get("pre_tokenizer") or {}
        self.cuts = made.get("normalizer") is None and first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space", True)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([_ODD, *added])
        if self.cuts:
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = CharDelimiterSplit("\n")
        self.forget()

    def forget(self) -> None:
        """Known pieces: ascending hashes, the place of each among ids and bytes of all pieces."""
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.at = np.zeros(0, self.dtype), np.zeros(1, np.int64)
        self.bytes, self.bytes_at = np.zeros(0, np.uint8), np.zeros(1, np.int64)

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(texts), TEXTS):
            out += [np.asarray(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts[i : i + TEXTS], add_special_tokens=False)]
        return out

    def _words(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of pieces that _SIMPLE holds for: their distinct words are encoded, as the lines of
        a few texts."""
        if not len(pieces):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        data, at = _strings(pieces)
        kind = _KIND[data]
        begins = np.concatenate([[True], (kind[1:] != kind[:-1]) & (kind[:-1] != 0)])
        begins[at[:-1]] = True
        start = np.flatnonzero(begins)
        offsets = pa.py_buffer(np.append(start, len(data)).astype(np.int32))
        words = pa.Array.from_buffers(pa.binary(), len(start), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        data, ends = _strings(words.dictionary)
        n = len(words.dictionary)
        spelled = np.full(len(data) + n, ord("\n"), "<u4")
        spelled[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(ends))] = _SPELLED[data]
        line = ends + np.arange(n + 1)
        texts = [spelled[line[i] : line[min(i + WORDS, n)] - 1].tobytes().decode("utf-32-le") for i in range(0, n, WORDS)]
        ids, owner = [], []
        for i in range(0, len(texts), TEXTS):
            for k, e in enumerate(self.model.encode_batch(texts[i : i + TEXTS], add_special_tokens=False), i):
                ids.append(np.asarray(e.ids, self.dtype))
                owner.append(np.asarray(e.word_ids, np.int64) + k * WORDS)
        ids, size = self._joined(ids), np.bincount(np.concatenate(owner), minlength=n)
        row = words.indices.to_numpy()
        place = _inside((np.cumsum(size) - size)[row], size[row])
        return ids[place], np.add.reduceat(size[row], np.searchsorted(start, at[:-1]))

    def _joined(self, ids):
        return np.concatenate(ids) if ids else np.zeros(0, self.dtype)

    def _found(self, h: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places of strings among the known pieces, -1 for others; of equal hashes the bytes decide."""
        out = np.full(len(h), -1)
        if not len(self.known):
            return out
        order = np.argsort(h)
        near = np.empty(len(h), np.int64)
        near[order] = np.minimum(np.searchsorted(self.known, h[order]), len(self.known) - 1)
        place, size = self.place[near], np.diff(at)
        begin = self.bytes_at[place]
        mine = np.flatnonzero((self.known[near] == h) & (self.bytes_at[place + 1] - begin == size))
        other = data[_inside(at[mine], size[mine])] != self.bytes[_inside(begin[mine], size[mine])]
        wrong, end = np.concatenate([[0], np.cumsum(other)]), np.cumsum(size[mine])
        mine = mine[wrong[end] == wrong[end - size[mine]]]
        out[mine] = place[mine]
        return out

    def _learn(self, pieces: pa.Array) -> np.ndarray:
        """Places of distinct pieces among the known ones; only new ones are encoded."""
        if len(self.known) > REMEMBERED:
            self.forget()
        data, at = _strings(pieces)
        h = _hashes(data, at)
        row = self._found(h, data, at)
        fresh = np.flatnonzero(row < 0)
        new = pieces.take(pa.array(fresh))
        simple = pc.match_substring_regex(new, _SIMPLE)
        ids, lengths = self._words(new.filter(simple))
        other = self._encoded(new.filter(pc.invert(simple)).to_pylist())
        simple = simple.to_numpy(zero_copy_only=False)
        fresh = np.concatenate([fresh[simple], fresh[~simple]])
        row[fresh] = len(self.known) + np.arange(len(fresh))
        sizes = np.concatenate([lengths, np.fromiter(map(len, other), np.int64, len(other))])
        self.ids = np.concatenate([self.ids, ids, *other])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
        sizes = np.diff(at)[fresh]
        self.bytes = np.concatenate([self.bytes, data[_inside(at[fresh], sizes)]])
        self.bytes_at = np.concatenate([self.bytes_at, self.bytes_at[-1] + np.cumsum(sizes)])
        fresh = fresh[np.argsort(h[fresh])]
        among = np.searchsorted(self.known, h[fresh])
        self.known, self.place = np.insert(self.known, among, h[fresh]), np.insert(self.place, among, row[fresh])
        return row

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of texts cut at their spaces."""
        parts = pc.split_pattern(texts, " ")
        begin = parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()
        flat = parts.flatten().dictionary_encode()
        head = flat.take(pa.array(begin[:-1])).dictionary_decode().dictionary_encode()
        place = self._learn(pa.concat_arrays([pc.binary_join_element_wise(" ", flat.dictionary, ""), head.dictionary]))
        n = len(flat.dictionary)
        row = place[:n][flat.indices.to_numpy()]
        row[begin[:-1]] = place[n:][head.indices.to_numpy()]
        size = np.diff(self.at)[row]
        end = np.cumsum(size)
        ids = self.ids[np.repeat(self.at[row] - (end - size), size) + np.arange(end[-1])]
        return ids, np.add.reduceat(size, begin[:-1])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of each text's ids)."""
        if not len(texts):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        texts = texts.cast(pa.string()).fill_null("")
        cut = pc.invert(pc.match_substring_regex(texts, self.odd)).to_numpy(zero_copy_only=False) if self.cuts else np.zeros(len(texts), bool)
        if cut.all():
            return self._cut(texts)
        whole = self._encoded(texts.filter(pa.array(~cut)).to_pylist())
        lengths = np.zeros(len(texts), np.int64)
        lengths[~cut] = np.fromiter(map(len, whole), np.int64, len(whole))
        some = np.zeros(0, self.dtype)
        if cut.any():
            some, lengths[cut] = self._cut(texts.filter(pa.array(cut)))
        out = np.empty(int(lengths.sum()), self.dtype)
        mine = np.repeat(cut, lengths)
        out[mine], out[~mine] = some, self._joined(whole)
        return out, lengths


def _encoder(path: str) -> Encoder:
    if path not in _workers:
        _workers[path] = Encoder(path)
    return _workers[path]


def _segments(path: str, end_id: int):
    """mapInArrow over a partition in order: its segments."""

    def run(batches):
        from pyspark import TaskContext

        part, seg = TaskContext.get().partitionId(), 0
        encoder = _encoder(path)
        held, n, before = [], 0, 0

        def segment():
            doc_ids = pa.concat_arrays([h[0] for h in held])
            lengths, ids = (np.concatenate([h[i] for h in held]) for i in (1, 2))
            lists = [pa.ListArray.from_arrays([0, len(x)], x) for x in (doc_ids.cast(pa.int64()), pa.array(lengths, pa.int64()))]
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()), *lists, pa.array([pfor.encode(ids)], pa.binary())], ["part", "seg", "before", "n", "doc_ids", "lengths", "data"])

        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)
            for a, b in chunks(sizes, CHUNK_BYTES):
                ids, lengths = encoder.encode(batch.column("text").slice(a, b - a))
                lengths = lengths + 1
                closed = np.empty(len(ids) + len(lengths), encoder.dtype)
                end = np.cumsum(lengths)
                is_end = np.zeros(len(closed), bool)
                is_end[end - 1] = True
                closed[is_end], closed[~is_end] = end_id, ids
                i = 0
                while i < len(lengths):
                    first = int(end[i] - lengths[i])
                    j = min(int(np.searchsorted(end, first + SEGMENT_IDS - n)) + 1, len(lengths))
                    held.append((batch.column("doc_id").slice(a + i, j - i), lengths[i:j], closed[first : end[j - 1]]))
                    n += int(end[j - 1]) - first
                    i = j
                    if n >= SEGMENT_IDS:
                        yield segment()
                        seg, before = seg + 1, before + n
                        held, n = [], 0
        if held:
            yield segment()

    return run


def segments(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    n = max(tables.parts(docs.sparkSession), tables.n_bytes(docs) // PARTITION_BYTES)
    key = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id", key).sortWithinPartitions("doc_id", key)
    return ordered.mapInArrow(_segments(tokenizer, end_id), STORED)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    segments(docs, tokenizer, end_id).write.parquet(path)


def placed(stored: DataFrame) -> DataFrame:
    """stored with ``start``: ids of all documents before each segment, from counts alone. One row a
    partition is summed in one task and broadcast; more than SMALL of them are joined as Spark sees fit."""
    sums = stored.groupBy("part").agg(F.sum("n").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    if sums.count() <= SMALL:
        offsets = F.broadcast(offsets)
    return stored.join(offsets, "part").withColumn("start", F.col("base") + F.col("before"))


def _documents(batches):
    for batch in batches:
        for start, doc_ids, lengths, data in zip(*(batch.column(c).to_pylist() for c in ("start", "doc_ids", "lengths", "data"))):
            ids = pfor.decode(data).astype("<u4")
            ends = np.cumsum(np.asarray(lengths, np.int64))
            begins = ends - lengths
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(begins + start, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read(stored: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files' contents."""
    return placed(stored).select("start", "doc_ids", "lengths", "data").mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = tables.table(spark, sf_dir, "documents")
    return read(tables.stored(segments(docs, public_tokenizers.path("byte_bpe_50k.json")), "tokens"))
