"""A hashed maximum-entropy language model with class-factored softmax.

Words are looked up by 64-bit hashes. Every token has a class: the ``TOP`` most frequent training tokens
form ``HEAD`` classes by rank, all others ``TAIL`` classes by hash. A token's probability is that of its
class given the two tokens before it, times that of the token within its class. Both are softmaxes
over weights of features: bias, previous token, the token before it (skip), and for the class also both
together. Features of all tokens count: frequent ones have rows of their own among ``ROWS``, others
share rows by hash, and pairs share ``PAIRS`` rows. Within a head class the softmax has a place for each
token (rows for ``WORD_ROWS`` tokens before it); within a tail class a token with training count c has
probability (c+1)/(N+V+1) of the class's N tokens and V distinct ones, an unseen one included.

Training: tasks write every training text's (two tokens before, token) with its counts, dealt by
document over ``ROUNDS`` slices, so this table grows with the corpus. Each round takes the next slice:
tasks sum observed and, under the broadcast weights, expected feature counts; the sums are merged by
groups and levels, and the driver makes a step along their difference, the gradient, each weight at a
rate of its own. Each text is used once.
Weights start at the unigram model; their number is fixed by the parameters above.

Scoring looks up frequent tokens (at least one ``FREQUENT``-th of all, so at most ``FREQUENT`` of
them) in a broadcast table and sends the others to their counts by a shuffle.

Defined cases: a null or empty text is its end token alone; a null doc_id counts as training; with
no training text every token has probability 1/(N+V+1) = 1 in ``base_score``; repeated rows are learned
from and scored each; a very long text is scored whole, in one pass over its tokens; an empty table
gives no rows; columns besides doc_id, text and held_out are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mindoc, tables
from .words import Words, chunks, mix, utf8

HEAD, SIZE, TAIL = 16, 32, 48
TOP, CLASSES = HEAD * SIZE, HEAD + TAIL
#: Rows of context features for classes, and within classes; half of them for the most frequent tokens.
ROWS, PAIRS, WORD_ROWS = 2048, 2048, 512
START = ROWS - 1
#: What follows a context: a class and a place in it (SIZE in tail classes).
TARGETS = CLASSES * (SIZE + 1)
CLASS_FEATURES, WORD_FEATURES = 1 + 2 * ROWS + PAIRS, 1 + 2 * WORD_ROWS
ROUNDS, RATE, SMOOTH = 6, 0.7, 2.0
FREQUENT = 1_000_000
#: Training tokens to a task of a round, and least tasks; contexts whose softmax is made at once.
TASK_TOKENS, TASKS, AT_ONCE = 20_000_000, 6, 4096
SHARDS = 8
HELD = 500_000
END = np.uint64(0x51ED270B7A3C9F55)


def _tokens(texts: list[bytes]):
    """(hash, text index, offsets) of the tokens of texts, each closed by END."""
    w = Words(texts, lower=True)
    n = np.diff(w.first) + 1
    at = np.concatenate([[0], np.cumsum(n)])
    out = np.full(at[-1], END, np.uint64)
    doc = np.repeat(np.arange(len(texts)), n)
    is_word = np.ones(at[-1], bool)
    is_word[at[1:] - 1] = False
    out[is_word] = w.hash
    return out, doc, at


def _chunks(batch):
    texts = utf8(batch.column("text"))
    for a, b in chunks(np.fromiter(map(len, texts), np.int64, len(texts))):
        yield a, b, _tokens(texts[a:b])


def _bucket(h, n):
    return ((h >> np.uint64(20)) % np.uint64(n)).astype(np.int64)


def _by_bucket(bucket, *columns):
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cut = np.flatnonzero(b[1:] != b[:-1]) + 1
    for i, j in zip(np.concatenate([[0], cut]), np.append(cut, len(b))):
        yield int(b[i]), *(c[order[i:j]] for c in columns)


def _summed(keys: np.ndarray, counts: np.ndarray):
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    begin = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, int)
    return k[begin], np.add.reduceat(counts[order], begin) if len(k) else counts


def _counting(n_buckets):
    """mapInArrow over training texts: packed (token, count) for each bucket."""

    def send(held):
        k, c = np.unique(np.concatenate(held), return_counts=True)
        rows = list(_by_bucket(_bucket(k, n_buckets), k, c))
        return pa.RecordBatch.from_pydict({"bucket": pa.array([r[0] for r in rows], pa.int32()), "tokens": [r[1].tobytes() for r in rows], "counts": [mindoc.squeeze(r[2]) for r in rows]})

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for _, _, (h, _, _) in _chunks(batch):
                held.append(h)
                n += len(h)
                if n >= HELD:
                    yield send(held)
                    held, n = [], 0
        if n:
            yield send(held)

    return run


def tail_class(h: np.ndarray) -> np.ndarray:
    return HEAD + ((h >> np.uint64(9)) % np.uint64(TAIL)).astype(np.int64)


def _counted(pdf):
    """A bucket's tokens and counts, and the sums of counts and of tokens by tail class."""
    import pandas as pd

    k, c = _summed(np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["tokens"]]), np.concatenate([mindoc.unsqueeze(x, np.int64) for x in pdf["counts"]]))
    t = tail_class(k) - HEAD
    n, v = (np.bincount(t, x, TAIL).astype(np.int64).tolist() for x in (c, np.ones(len(k))))
    return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "tokens": [k.tobytes()], "counts": [mindoc.squeeze(c)], "n": [n], "v": [v]})


def _frequent(least):
    def run(batches):
        for batch in batches:
            for t, c in zip(batch.column("tokens").to_pylist(), batch.column("counts").to_pylist()):
                t, c = np.frombuffer(t, np.uint64), mindoc.unsqueeze(c, np.int64)
                ok = c >= least
                yield pa.RecordBatch.from_pydict({"tokens": [t[ok].tobytes()], "counts": [c[ok].tobytes()]})

    return run


class Vocabulary:
    """Frequent tokens in order of their hashes, with counts and ranks; n, v: training tokens and
    distinct ones by tail class, of those beyond the top."""

    def __init__(self, tokens, counts, n, v):
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order]
        rank = np.empty(len(tokens), np.int64)
        by = np.lexsort((self.tokens, -self.counts))
        rank[by] = np.arange(len(by))
        self.rank = rank
        self.top = self.counts[by[:TOP]]
        head = tail_class(self.tokens[by[:TOP]]) - HEAD
        self.n = n - np.bincount(head, self.top, TAIL).astype(np.int64)
        self.v = v - np.bincount(head, minlength=TAIL)

    def find(self, h):
        """(count, rank) of tokens; 0 and the number of frequent tokens for those that aren't frequent."""
        if not len(self.tokens):
            return np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, h), len(self.tokens) - 1)
        known = self.tokens[at] == h
        return np.where(known, self.counts[at], 0), np.where(known, self.rank[at], len(self.tokens))

    def described(self, h):
        """(row, target, count) of tokens: the context row that each has, and its target."""
        u, inverse = np.unique(h, return_inverse=True)
        count, rank = self.find(u)
        half = ROWS // 2
        row = np.where((count > 0) & (rank < half), rank, half + (mix(u) % np.uint64(half - 1)).astype(np.int64))
        head = (count > 0) & (rank < TOP)
        target = np.where(head, rank // SIZE * (SIZE + 1) + rank % SIZE, tail_class(u) * (SIZE + 1) + SIZE)
        return row[inverse], target[inverse], count[inverse]


def _before(rows, at):
    """Rows of the second and of the first token before each, START at a text's begin."""
    one = np.concatenate([[START], rows[:-1]])
    one[at[:-1]] = START
    two = np.concatenate([[START], one[:-1]])
    two[at[:-1]] = START
    return two, one


def _contexts(shared):
    """mapInArrow over training texts: packed counts of (two tokens before, target), for each slice."""

    def send(held):
        part, code = (np.concatenate(x) for x in zip(*held))
        rows = []
        for k, mine in _by_bucket(part, code):
            u, c = np.unique(mine, return_counts=True)
            rows.append((k, mindoc.squeeze(np.diff(u, prepend=0)), mindoc.squeeze(c)))
        k, codes, counts = zip(*rows)
        return pa.RecordBatch.from_pydict({"slice": pa.array(k, pa.int32()), "codes": pa.array(codes, pa.binary()), "counts": pa.array(counts, pa.binary())})

    def run(batches):
        held, n = [], 0
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False) % ROUNDS
            for a, _, (h, doc, at) in _chunks(batch):
                row, target, _ = shared.value.described(h)
                two, one = _before(row, at)
                held.append((keys[a + doc], (two * ROWS + one) * TARGETS + target))
                n += len(h)
                if n >= HELD:
                    yield send(held)
                    held, n = [], 0
        if n:
            yield send(held)

    return run


def _word_row(row):
    half = WORD_ROWS // 2
    return np.where(row == START, WORD_ROWS - 1, np.where(row < half, row, half + row % (half - 1)))


class Model:
    """Weights: classes (CLASS_FEATURES, CLASSES) and words (WORD_FEATURES, HEAD, SIZE)."""

    def __init__(self, vocabulary: Vocabulary):
        self.classes = np.zeros((CLASS_FEATURES, CLASSES), np.float32)
        self.words = np.zeros((WORD_FEATURES, HEAD, SIZE), np.float32)
        by = np.zeros(TOP)
        by[: len(vocabulary.top)] = vocabulary.top
        by = by.reshape(HEAD, SIZE)
        mass = np.concatenate([by.sum(1), vocabulary.n + 1.0])
        with np.errstate(divide="ignore"):
            self.classes[0] = np.maximum(np.log(mass / mass.sum()), -1e9)
            self.words[0] = np.maximum(np.log(by / np.maximum(by.sum(1, keepdims=True), 1)), -1e9)

    @staticmethod
    def class_rows(two, one):
        pair = (mix((two * ROWS + one).astype(np.uint64)) % np.uint64(PAIRS)).astype(np.int64)
        return np.zeros(len(one), np.int64), 1 + one, 1 + ROWS + two, 1 + 2 * ROWS + pair

    @staticmethod
    def word_rows(two, one):
        return np.zeros(len(one), np.int64), 1 + _word_row(one), 1 + WORD_ROWS + _word_row(two)

    def class_scores(self, two, one):
        """(contexts, CLASSES) exponents, not normalised."""
        _, *rows = self.class_rows(two, one)
        return _summed_rows(self.classes, rows)

    def word_scores(self, two, one, cls):
        """(contexts, SIZE) exponents of the places of a class."""
        flat = self.words.reshape(-1, SIZE)
        return _summed_rows(flat, [r * HEAD + cls for r in self.word_rows(two, one)], 0.0)


def _summed_rows(table, rows, start=None):
    z = table[rows[0]]
    for r in rows[1:]:
        z += table[r]
    if start is None:
        z += table[0]
    return z


def _log_normal(z):
    """Logarithm of the sum of the exponentials of each row; z is used up."""
    m = z.max(1)
    z -= m[:, None]
    return m + np.log(np.exp(z, out=z).sum(1))


def _shares(z, total):
    """Softmax of each row times its total, in z."""
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z *= (total / z.sum(1))[:, None]
    return z


def _add_rows(total, rows, values):
    """total[rows] += values, row by row."""
    if not rows.any():
        total[0] += values.sum(0)
        return
    if (rows[1:] < rows[:-1]).any():
        order = np.argsort(rows, kind="stable")
        rows, values = rows[order], values[order]
    begin = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    total[rows[begin]] += np.add.reduceat(values, begin, axis=0)


def _gradients(shared):
    """mapInArrow over a slice's contexts: a task's observed and expected feature counts, in shards."""

    def run(batches):
        model, some = shared.value, False
        sums = [[np.zeros(model.classes.shape), np.zeros((WORD_FEATURES * HEAD, SIZE))] for _ in range(2)]
        for batch in batches:
            for codes, counts in zip(batch.column("codes").to_pylist(), batch.column("counts").to_pylist()):
                code, c = np.cumsum(mindoc.unsqueeze(codes, np.int64)), mindoc.unsqueeze(counts, np.int64).astype(float)
                ctx, target = np.divmod(code, TARGETS)
                begin = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]]))
                some = True
                for i in range(0, len(begin), AT_ONCE):
                    a, b = begin[i], begin[i + AT_ONCE] if i + AT_ONCE < len(begin) else len(ctx)
                    _add(model, sums, ctx[a:b], target[a:b], c[a:b])
        if some:
            # Both tables side by side, cut into shards of whole rows.
            for k, (classes, words) in enumerate(sums):
                flat = np.concatenate([classes.ravel(), words.ravel()]).astype(np.float32)
                parts = np.array_split(flat, SHARDS)
                yield pa.RecordBatch.from_pydict({"shard": pa.array(np.arange(SHARDS) + k * SHARDS, pa.int32()), "sums": pa.array([mindoc.squeeze(p) for p in parts], pa.binary())})

    return run


def _add(model, sums, ctx, target, c):
    """Adds some contexts' observed counts to sums[0] and the expected ones to sums[1]."""
    begin = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]]))
    where = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(ctx))))
    two, one = np.divmod(ctx[begin], ROWS)
    cls, slot = np.divmod(target, SIZE + 1)
    guess = _shares(model.class_scores(two, one), np.bincount(where, c).astype(np.float32))
    for rows in model.class_rows(two, one):
        np.add.at(sums[0][0].ravel(), rows[where] * CLASSES + cls, c)
        _add_rows(sums[1][0], rows, guess)
    inside = np.flatnonzero(cls < HEAD)
    if not len(inside):
        return
    pair, at = np.unique(where[inside] * HEAD + cls[inside], return_inverse=True)
    p, pcls = np.divmod(pair, HEAD)
    guess = _shares(model.word_scores(two[p], one[p], pcls), np.bincount(at, c[inside]).astype(np.float32))
    for rows in model.word_rows(two[p], one[p]):
        np.add.at(sums[0][1].ravel(), (rows[at] * HEAD + pcls[at]) * SIZE + slot[inside], c[inside])
        _add_rows(sums[1][1], rows * HEAD + pcls, guess)


def _merged(pdf):
    import pandas as pd

    total = 0.0
    for x in pdf["sums"]:
        total = total + mindoc.unsqueeze(x, np.float32).astype(np.float64)
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "sums": [mindoc.squeeze(total.astype(np.float32))]})


def train(contexts: DataFrame, vocabulary: Vocabulary, n: int, rounds: int = ROUNDS) -> Model:
    """contexts: slice, codes, counts; n: training tokens. The driver gets two tables of the model's size
    each round."""
    sc = contexts.sparkSession.sparkContext
    model = Model(vocabulary)
    schema = "shard int, sums binary"
    for k in range(rounds):
        shared = sc.broadcast(model)
        part = contexts.where(F.col("slice") == k % ROUNDS).select("codes", "counts").coalesce(max(TASKS, n // TASK_TOKENS))
        got = tables.folded(part.mapInArrow(_gradients(shared), schema), ["shard"], _merged, schema).collect()
        shared.unpersist()
        if not got:
            continue
        flat = [mindoc.unsqueeze(r["sums"], np.float32) for r in sorted(got, key=lambda r: r["shard"])]
        seen, guess = np.concatenate(flat[:SHARDS]), np.concatenate(flat[SHARDS:])
        # The gradient is seen - guess; a weight's rate falls with the occurrences that it stands for.
        step = (RATE * (seen - guess) / (np.maximum(seen, guess) + SMOOTH)).astype(np.float32)
        model.classes += step[: model.classes.size].reshape(model.classes.shape)
        model.words += step[model.classes.size :].reshape(model.words.shape)
    return model


def _portions(values, where):
    """(tokens, values, places among these) of AT_ONCE distinct values after the other."""
    order = np.argsort(where, kind="stable")
    cut = np.searchsorted(where[order], np.arange(0, len(values) + AT_ONCE, AT_ONCE))
    for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
        if b > a:
            yield order[a:b], values[i * AT_ONCE : (i + 1) * AT_ONCE], where[order[a:b]] - i * AT_ONCE


def token_logs(vocabulary, model, two, one, target, logs):
    """log10 probabilities of tokens (less log10(c+1) of those whose count isn't known here): two, one,
    target of each, and log10(count + 1)."""
    cls, slot = np.divmod(target, SIZE + 1)
    p = np.empty(len(target))
    ctx, where = np.unique(two * ROWS + one, return_inverse=True)
    for mine, part, at in _portions(ctx, where):
        z = model.class_scores(part // ROWS, part % ROWS)
        p[mine] = z[at, cls[mine]]
        p[mine] -= _log_normal(z)[at]
    inside = np.flatnonzero(cls < HEAD)
    pair, where = np.unique((two[inside] * ROWS + one[inside]) * HEAD + cls[inside], return_inverse=True)
    for mine, part, at in _portions(pair, where):
        mine = inside[mine]
        z = model.word_scores(part // HEAD // ROWS, part // HEAD % ROWS, part % HEAD)
        p[mine] += z[at, slot[mine]]
        p[mine] -= _log_normal(z)[at]
    p /= np.log(10)
    tail = cls >= HEAD
    p[tail] += logs[tail] - np.log10(vocabulary.n + vocabulary.v + 1.0)[cls[tail] - HEAD]
    return p


def _scores(vocabulary, model, n_buckets):
    """mapInArrow: per text what frequent tokens give (kind 0), and packed other tokens (kind 1)."""
    names = ["kind", "bucket", "doc_id", "key", "n_tokens", "n_known", "logs", "score", "tokens", "owners", "at"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds)))

    def send(held):
        h, doc, key = (np.concatenate(x) for x in zip(*held))
        rows = {n: [] for n in names}
        for b, t, d, k in _by_bucket(_bucket(h, n_buckets), h, doc, key):
            order = np.lexsort((k, d))
            t, d, k = t[order], d[order], k[order]
            new = np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])])
            for n, x in zip(names, (1, b, None, None, None, None, None, None, t.tobytes(), mindoc.squeeze(np.stack([d[new], k[new]], 1)), mindoc.squeeze(np.diff(np.append(np.flatnonzero(new), len(t))).astype(np.uint32)))):
                rows[n].append(x)
        return pa.RecordBatch.from_pydict(rows, schema=schema)

    def run(batches):
        voc, mod = vocabulary.value, model.value
        held, n = [], 0
        for batch in batches:
            doc_ids = batch.column("doc_id").fill_null(-(2**63)).to_numpy(zero_copy_only=False)
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            out = {x: [] for x in ("n_tokens", "n_known", "logs", "score")}
            for a, b, (h, doc, at) in _chunks(batch):
                row, target, count = voc.described(h)
                logs = np.log10(count + 1.0)
                p = token_logs(voc, mod, *_before(row, at), target, logs)
                add = lambda x: np.bincount(doc, x, len(at) - 1)
                out["n_tokens"].append(np.diff(at))
                out["n_known"].append(add((count > 0).astype(float)).astype(np.int64))
                out["logs"].append(add(logs))
                out["score"].append(add(p))
                open_ = count == 0
                if open_.any():
                    held.append((h[open_], doc_ids[a + doc[open_]], keys[a + doc[open_]]))
                    n += int(open_.sum())
                if n >= HELD:
                    yield send(held)
                    held, n = [], 0
            rows = batch.num_rows
            if rows:
                none = pa.nulls(rows, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(rows, np.int32)), pa.nulls(rows, pa.int32()), batch.column("doc_id"), batch.column("key"), *(pa.array(np.concatenate(out[x])) for x in ("n_tokens", "n_known", "logs", "score")), none, none, none], schema=schema)
        if n:
            yield send(held)

    return run


def _looked_up(n_shards):
    """cogroup of one bucket: sums of log10(c+1) and known tokens of the texts that sent to it, packed
    by shards of texts."""

    def run(key, tokens, counts):
        import pandas as pd

        if not len(tokens):
            return pd.DataFrame({"shard": [], "sums": []}).astype({"shard": "int64", "sums": object})
        k = np.concatenate([np.frombuffer(x, np.uint64) for x in counts["tokens"]]) if len(counts) else np.zeros(0, np.uint64)
        c = np.concatenate([mindoc.unsqueeze(x, np.int64) for x in counts["counts"]]) if len(counts) else np.zeros(0, np.int64)
        rows = []
        for t, owners, n in zip(tokens["tokens"], tokens["owners"], tokens["at"]):
            t, heads, n = np.frombuffer(t, np.uint64), mindoc.unsqueeze(owners, np.int64).reshape(-1, 2), mindoc.unsqueeze(n, np.uint32)
            at = np.minimum(np.searchsorted(k, t), max(len(k) - 1, 0))
            count = np.where(k[at] == t, c[at], 0) if len(k) else np.zeros(len(t), np.int64)
            begin = np.concatenate([[0], np.cumsum(n.astype(np.int64))[:-1]])
            rows.append(np.rec.fromarrays([heads[:, 0], heads[:, 1], np.add.reduceat(np.log10(count + 1.0), begin), np.add.reduceat(np.minimum(count, 1), begin)], dtype=SUMS))
        got = np.concatenate(rows)
        parts = list(_by_bucket((got["key"].view(np.uint64) % np.uint64(n_shards)).astype(np.int64), got))
        return pd.DataFrame({"shard": [p[0] for p in parts], "sums": [mindoc.squeeze(p[1].view(np.uint8)) for p in parts]})

    return run


SUMS = [("doc_id", np.int64), ("key", np.int64), ("more", np.float64), ("seen", np.int64)]


def _totalled(pdf):
    """A shard of texts: (doc_id, key, sum, known tokens)."""
    import pandas as pd

    got = np.concatenate([mindoc.unsqueeze(x, np.uint8).view(SUMS) for x in pdf["sums"]])
    return pd.DataFrame({n: got[n] for n, _ in SUMS}).groupby(["doc_id", "key"], as_index=False).sum()


def fit(docs: DataFrame) -> tuple[Vocabulary, Model, DataFrame, int, int, int]:
    """(vocabulary, model, token counts by bucket, training tokens, distinct ones, buckets) of the rows of
    docs (doc_id, text, held_out) that aren't held out."""
    sc = docs.sparkSession.sparkContext
    n_buckets = max(tables.parts(docs.sparkSession), tables.n_bytes(docs) >> 24)
    training = docs.where("not held_out").select("text", F.pmod(tables.row_key(), F.lit(1 << 40)).alias("key"))
    counts = training.select("text").mapInArrow(_counting(n_buckets), "bucket int, tokens binary, counts binary")
    counts = tables.stored(counts.groupBy("bucket").applyInPandas(_counted, "bucket int, tokens binary, counts binary, n array<long>, v array<long>"), "token-counts")
    sums = counts.agg(*(F.sum(F.get(c, F.lit(i))).alias(f"{c}{i}") for c in "nv" for i in range(TAIL))).first()
    n, v = (np.array([sums[f"{c}{i}"] or 0 for i in range(TAIL)], np.int64) for c in "nv")
    got = counts.select("tokens", "counts").mapInArrow(_frequent(max(2, -(-int(n.sum()) // FREQUENT))), "tokens binary, counts binary").collect()
    tokens, often = (np.concatenate([np.frombuffer(r[c], t) for r in got] or [np.zeros(0, t)]) for c, t in (("tokens", np.uint64), ("counts", np.int64)))
    vocabulary = Vocabulary(tokens, often, n, v)
    contexts = training.mapInArrow(_contexts(sc.broadcast(vocabulary)), "slice int, codes binary, counts binary")
    contexts = tables.stored(contexts, "contexts", ["slice"])
    return vocabulary, train(contexts, vocabulary, int(n.sum())), counts, int(n.sum()), int(v.sum()), n_buckets


def score(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text, held_out. Returns per row doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score and score (log10)."""
    sc = docs.sparkSession.sparkContext
    vocabulary, model, counts, n, v, n_buckets = fit(docs)
    shared, model = sc.broadcast(vocabulary), sc.broadcast(model)
    keyed = docs.select("doc_id", "text", tables.row_key().alias("key"))
    schema = "kind int, bucket int, doc_id long, key long, n_tokens long, n_known long, logs double, score double, tokens binary, owners binary, at binary"
    made = tables.stored(keyed.mapInArrow(_scores(shared, model, n_buckets), schema), "scored")
    sent = made.where("kind = 1").select("bucket", "tokens", "owners", "at")
    more = sent.groupBy("bucket").cogroup(counts.select("bucket", "tokens", "counts").groupBy("bucket")).applyInPandas(_looked_up(n_buckets), "shard long, sums binary")
    more = more.groupBy("shard").applyInPandas(_totalled, "doc_id long, key long, more double, seen long")
    # Rows equal in doc_id and text sent the same tokens more than once.
    mine = made.where("kind = 0").select("doc_id", "key", "n_tokens", "n_known", "logs", "score").withColumn("id", F.coalesce("doc_id", F.lit(-(2**63))))
    repeats = mine.groupBy("id", "key").agg(F.count("*").alias("times"))
    more = more.withColumnRenamed("doc_id", "id").join(repeats, ["id", "key"]).select("id", "key", (F.col("more") / F.col("times")).alias("more"), F.expr("seen div times").alias("seen"))
    out = mine.join(more, ["id", "key"], "left")
    extra = F.coalesce("more", F.lit(0.0))
    all_log = float(np.log10(n + v + 1))
    return out.select(
        "doc_id",
        _held_out().alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + extra - F.col("n_tokens") * F.lit(all_log)).alias("base_score"),
        (F.col("score") + extra).alias("score"),
    )


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(tables.table(spark, sf_dir, "documents").select("doc_id", "text", _held_out().alias("held_out")))
