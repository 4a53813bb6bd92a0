"""Benchmark decontamination: a BM25 inverted index of test items, queried with every passage.

Words are runs of letters and digits in lower case (other ASCII characters separate them); they are
the index's terms. A term's impact in an item is its BM25 weight divided by the item's score with
itself, so scores lie between 0 and 1 and one threshold serves long and short items. Number of items,
document frequencies and mean length are those of all items, whatever the shards. Postings are cut
into blocks with their largest impact, and passages are searched by block-max WAND.

Most passages are passed over before that by a bound that loses nothing: of each item the terms in
most items, as far as their impacts sum to ``REST`` of the threshold, count as found; a passage is
searched if what it holds of the other terms of some item can reach the threshold with them.

Passages of twice the longest item's words start every such length, so each item that a text holds
lies whole in one of them. An item's answer is its last sentence, the question what stands before;
an item of one sentence is cut at two thirds. A found item counts as leaked when the passage holds
``OVERLAP`` of the distinct ``GRAM``-word sequences of both.

The index is broadcast: items are taken in shards of at most about ``SHARD_BYTES`` of text, one pass
each; it takes under ten bytes for each byte of them.

Defined cases: null or empty texts and items give nothing; items of fewer words than ``GRAM`` can't be
told from prose and give nothing; repeated rows give one result; items that share an item_id are one
item of the smallest text; a very long text is cut in passages like any other; empty tables give no
rows; a null doc_id's results carry a null. Texts of fewer words than a passage are one passage.
Columns besides doc_id, item_id and text are ignored by ``leaks`` and kept by ``apply``.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables
from .words import Words, chunks, utf8, windows

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, GRAM = 0.5, 0.5, 3
REST = 0.5
BLOCK = 64
SHARD_BYTES = 16 << 20
LEAKS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[:128] = 0x20
for _a, _b in ((48, 58), (97, 123)):
    _TABLE[_a:_b] = np.arange(_a, _b)
_TABLE[65:91] = np.arange(97, 123)


def _words(texts: list[bytes]) -> Words:
    return Words(texts, lower=True, table=_TABLE)


def _grams(h: np.ndarray) -> tuple[int, np.ndarray]:
    """(words a sequence, hashes of the distinct sequences); a short part is one sequence."""
    g = min(GRAM, len(h))
    return g, np.unique(windows(h, g)) if g else np.zeros(0, np.uint64)


def parted(text: str) -> tuple[str, str]:
    """(question, answer) of an item."""
    sentences = [x for x in re.split(r"(?<=[.!?])\s+|\n+", text.strip()) if x.strip()]
    if len(sentences) > 1:
        return " ".join(sentences[:-1]), sentences[-1]
    words = text.split()
    cut = -(-len(words) * 2 // 3)
    return " ".join(words[:cut]), " ".join(words[cut:])


def _described(batches):
    """mapInArrow over items: (item_id, words, term, tf) of each distinct term."""
    for batch in batches:
        w = _words(utf8(batch.column("text")))
        rows = [(k, np.unique(w.hash[w.first[k] : w.first[k + 1]], return_counts=True)) for k in range(batch.num_rows) if w.first[k + 1] - w.first[k] >= GRAM]
        if rows:
            n = [len(t) for _, (t, _) in rows]
            at = np.repeat([k for k, _ in rows], n)
            words = np.diff(w.first)[at]
            term, tf = (np.concatenate([r[1][i] for r in rows]) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(at)), pa.array(words, pa.int64()), pa.array(term.view(np.int64)), pa.array(tf, pa.int64())], ["item_id", "words", "term", "tf"])


def described(items: DataFrame) -> DataFrame:
    """(item_id, text, words, terms): terms with their count in the item and their number of items."""
    each = tables.stored(items.mapInArrow(_described, "item_id long, words long, term long, tf long"), "item-terms")
    df = each.groupBy("term").agg(F.count("*").alias("df"))
    terms = F.array_sort(F.collect_list(F.struct("term", "tf", "df"))).alias("terms")
    return items.join(each.join(df, "term").groupBy("item_id", "words").agg(terms), "item_id")


def _places(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Index:
    """Inverted index of items in flat arrays: terms in order of their hashes, postings in order of
    items. items: (item_id, text, words, terms, tf, df) of each; n, mean: number of all items and their
    mean of words, of which these may be a part."""

    def __init__(self, items: list[tuple], n: int, mean: float, longest: int, threshold: float = THRESHOLD):
        self.ids = np.array([i[0] for i in items], np.int64)
        self.longest, self.threshold = longest, threshold
        parts = [_grams(h) for i in items for h in self._sides(i[1])]
        self.gram_size = np.array([g for g, _ in parts], np.uint8)
        self.gram_at = np.concatenate([[0], np.cumsum([len(g) for _, g in parts])]).astype(np.int64)
        self.grams = np.concatenate([g for _, g in parts]) if parts else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(items)), [len(i[3]) for i in items]) if items else np.zeros(0, np.int64)
        term, tf, df = (np.concatenate([i[k] for i in items]) if items else np.zeros(0, t) for k, t in ((3, np.uint64), (4, np.int64), (5, np.int64)))
        norm = K1 * (1 - B + B * np.array([i[2] for i in items], float) / max(mean, 1))
        impact = np.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + norm[owner])
        impact /= np.bincount(owner, impact, len(items))[owner] if items else 1
        # Terms in many items first: those that sum to less than REST of the threshold are no keys.
        order = np.lexsort((term, -df, owner))
        total = np.cumsum(impact[order])
        first = np.searchsorted(owner[order], np.arange(len(items)))
        total -= np.concatenate([[0.0], total])[first][owner[order]]
        plain = np.zeros(len(owner), bool)
        plain[order] = total < REST * threshold
        self.rest = np.bincount(owner[plain], impact[plain], len(items))
        order = np.lexsort((owner, term))
        self.terms, counts = np.unique(term, return_counts=True)
        self.start = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.item, self.impact = owner[order].astype(np.int32), impact[order]
        key = ~plain[order]
        self.key_start = np.concatenate([[0], np.cumsum(key)])[self.start]
        self.keys = np.flatnonzero(key).astype(np.int32)
        # Blocks: each term's postings by BLOCK, with largest impact and last item.
        blocks = -(-counts // BLOCK)
        self.block_start = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64)
        begin = np.repeat(self.start[:-1], blocks) + BLOCK * _places(np.zeros_like(blocks), blocks)
        self.block_most = np.maximum.reduceat(self.impact, begin) if len(begin) else np.zeros(0)
        self.block_last = self.item[np.append(begin[1:], len(self.item)) - 1] if len(begin) else np.zeros(0, np.int32)
        self.most = np.maximum.reduceat(self.impact, self.start[:-1]) if len(self.terms) else np.zeros(0)

    @staticmethod
    def _sides(text: str):
        q = _words([x.encode() for x in parted(text)])
        return [q.hash[q.first[k] : q.first[k + 1]] for k in range(2)]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Term numbers of hashes, -1 for others."""
        if not len(self.terms):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return np.where(self.terms[at] == h, at, -1)

    def hopeful(self, passage: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Passages that may hold an item of the threshold, from distinct (passage, term)."""
        count = (self.key_start[1:] - self.key_start[:-1])[term]
        at = self.keys[_places(self.key_start[term], count)]
        pair, inverse = np.unique(np.repeat(passage, count) * len(self.ids) + self.item[at], return_inverse=True)
        bound = np.bincount(inverse, self.impact[at], len(pair)) + self.rest[pair % max(len(self.ids), 1)]
        return np.unique(pair[bound >= self.threshold - 1e-9] // max(len(self.ids), 1))

    def parts(self, item: int):
        """(words a sequence, sequences) of the item's question and answer."""
        return [(int(self.gram_size[k]), self.grams[self.gram_at[k] : self.gram_at[k + 1]]) for k in (2 * item, 2 * item + 1)]


def wand(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All items whose summed impacts over the distinct terms reach the threshold (block-max WAND)."""
    low = threshold - 1e-9
    # A cursor: next item, its place among the postings, term.
    cursors = [[int(index.item[index.start[t]]), int(index.start[t]), t] for t in terms]
    found = []

    def block(t, item, at=0):
        """The term's first block from ``at`` on that ends at the item or after it."""
        a, b = max(int(index.block_start[t]), at), int(index.block_start[t + 1])
        return a + int(np.searchsorted(index.block_last[a:b], item))

    def forward(c, item):
        """Moves a cursor to its first item >= item; over whole blocks first. False at the end."""
        t = c[2]
        a, end = int(index.start[t]), int(index.start[t + 1])
        b = block(t, item, int(index.block_start[t]) + (c[1] - a) // BLOCK)
        if b >= index.block_start[t + 1]:
            return False
        begin = max(c[1], a + (b - int(index.block_start[t])) * BLOCK)
        c[1] = begin + int(np.searchsorted(index.item[begin : min(begin + BLOCK, end)], item))
        c[0] = int(index.item[c[1]])
        return True

    while cursors:
        cursors.sort()
        bound, pivot = 0.0, None
        for k, c in enumerate(cursors):
            bound += index.most[c[2]]
            if bound >= low:
                pivot = k
                break
        if pivot is None:
            break
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        blocks, until = 0.0, None
        for c in cursors[: pivot + 1]:
            b = block(c[2], item)
            if b < index.block_start[c[2] + 1]:
                blocks += index.block_most[b]
                until = int(index.block_last[b]) if until is None else min(until, int(index.block_last[b]))
        if blocks < low:
            # No item up to the nearest block end can reach the threshold with these terms.
            goal = item if until is None else until + 1
            if pivot + 1 < len(cursors):
                goal = min(goal, cursors[pivot + 1][0])
            goal = max(goal, item + 1) if cursors[0][0] == item else max(goal, item)
        elif cursors[0][0] == item:
            score = sum(float(index.impact[c[1]]) for c in cursors[: pivot + 1])
            if score >= low:
                found.append((item, score))
            goal = item + 1
        else:
            goal = item
        ended = [c for c in cursors[: pivot + 1] if c[0] < goal and not forward(c, goal)]
        if ended:
            cursors = [c for c in cursors if not any(c is e for e in ended)]
    return found


def _passages(w: Words, term: np.ndarray, longest: int):
    """(passage, term) of the indexed words of all passages, and each passage's text, first and last
    word."""
    n = np.diff(w.first)
    many = np.maximum(1, -(-(n - longest) // longest)) * (n > 0)
    base = np.cumsum(many) - many
    text = np.repeat(np.arange(len(n)), many)
    begin = w.first[:-1][text] + longest * _places(np.zeros_like(many), many)
    end = np.minimum(begin + 2 * longest, w.first[1:][text])
    at = np.flatnonzero(term >= 0)
    doc = w.doc[at]
    step = (at - w.first[doc]) // longest
    pairs = []
    for back in (0, 1):
        ok = (step - back >= 0) & (step - back < many[doc])
        pairs.append((base[doc[ok]] + step[ok] - back) * (int(term.max(initial=0)) + 1) + term[at[ok]])
    pair = np.unique(np.concatenate(pairs))
    return *np.divmod(pair, int(term.max(initial=0)) + 1), text, begin, end


def _searched(shared, overlap):
    """mapInArrow: (doc_id, item_id, score, question_overlap, answer_overlap) of each leak."""

    def run(batches):
        index = shared.value
        for batch in batches:
            texts = utf8(batch.column("text"))
            out = []
            for a, b in chunks(np.fromiter(map(len, texts), np.int64, len(texts))):
                w = _words(texts[a:b])
                if not len(w.hash):
                    continue
                passage, term, text, begin, end = _passages(w, index.find(w.hash), index.longest)
                for p in index.hopeful(passage, term).tolist():
                    i, j = np.searchsorted(passage, [p, p + 1])
                    grams = {}
                    for item, score in wand(index, term[i:j].tolist(), index.threshold):
                        share = []
                        for g, want in index.parts(item):
                            if g and g not in grams:
                                grams[g] = windows(w.hash[begin[p] : end[p]], g)
                            share.append(float(np.isin(want, grams[g]).mean()) if len(want) else 1.0)
                        if min(share) >= overlap:
                            out.append((a + int(text[p]), int(index.ids[item]), score, *share))
            if out:
                row, item, score, q, s = zip(*out)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), pa.array(item, pa.int64()), pa.array(score, pa.float64()), pa.array(q, pa.float64()), pa.array(s, pa.float64())], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return run


def indexes(items: DataFrame, threshold: float = THRESHOLD, shard_bytes: int = SHARD_BYTES):
    """The indexes of the items' shards, one after the other; scores are the same with any number."""
    items = items.where("item_id is not null and text is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    rows = tables.stored(described(items), "items")
    n, mean, longest, size = rows.agg(F.count("*"), F.avg("words"), F.max("words"), F.sum(F.octet_length("text"))).first()
    shards = 1 + (size or 0) // shard_bytes
    for s in range(shards if n else 0):
        # The hash of item_id spreads items evenly: a shard has about shard_bytes of text.
        part = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == s).select("item_id", "text", "words", "terms.term", "terms.tf", "terms.df").orderBy("item_id").collect()
        if part:
            yield Index([(r[0], r[1], r[2], np.array(r[3], np.int64).view(np.uint64), np.array(r[4], np.int64), np.array(r[5], np.int64)) for r in part], n, mean, longest, threshold)


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap), the best passage of each pair."""
    spark = docs.sparkSession
    texts = docs.where("text is not null").select("doc_id", "text")
    found = [texts.mapInArrow(_searched(spark.sparkContext.broadcast(index), overlap), LEAKS) for index in indexes(items, threshold, shard_bytes)]
    out = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], LEAKS)
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.score", "b.question_overlap", "b.answer_overlap")


def apply(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without the rows whose text holds a test item, whatever their doc_id."""
    row = "__readloom_row"
    found = leaks(docs.select(tables.row_key().alias("doc_id"), "text"), items).select(F.col("doc_id").alias(row)).distinct()
    return docs.withColumn(row, tables.row_key()).join(found, row, "left_anti").select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(tables.table(spark, sf_dir, "documents"), tables.table(spark, sf_dir, "benchmark"))
