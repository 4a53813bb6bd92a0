"""Approximate nearest neighbours by cross-polytope hashing.

A table's hash is three rounds of random signs and fast Hadamard transform, then the nearest signed
axis; up to ``n_hashes`` of them are concatenated so that buckets stay near ``BUCKET`` vectors as data
grow. A query probes the ``probes`` buckets of each table whose axes it is nearest to. Hashes and probes
come from the data (``plan``): the true neighbours of ``SAMPLE`` queries tell how many probes find the
share ``RECALL`` of them with each number of hashes, and the cheapest such pair is taken. With one hash
all buckets can be probed, so there is always one.

Equal vectors are one: of those that share a vector only the k+1 smallest ids can be among anyone's
nearest, so an index row is a vector with these ids, and equal queries are searched once. Candidates are
compared exactly, in double precision, inside blocks of at most about ``BLOCK`` vectors and as many
queries, so a bucket with a third of all vectors, or of all queries, is many tasks' work; each block
returns the k+1 nearest, ties to the smaller id, and of the best of those a query takes k, without
itself. No candidate is dropped before it is compared. A query that meets fewer than k+1 ids is compared
with all vectors, in blocks too.

``recall`` holds a result against brute force; the README has figures. Vectors that are null, zero, of
another length than most, or hold null or non-finite components take no part, nor do null vec_ids. Rows
that share a vec_id are one candidate by their nearest vector, and as queries one each if their vectors
differ; ties go to the smaller vec_id; repeated rows count once; an empty table gives no rows; columns
besides vec_id and embedding are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tables

TABLES, PROBES, NEAREST = 10, 12, 5
BUCKET, BLOCK = 1024, 4096
#: Queries whose true neighbours are found, and the share of them that probes must reach: above 0.9 by
#: what a sample of this size may err.
SAMPLE, RECALL = 128, 0.95
#: Comparisons that cost as much as sending one probe.
SENT = 64


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows of x, whose length is a power of 2."""
    rows, n = x.shape
    h = 1
    while h < n:
        y = x.reshape(rows, -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(rows, n)
        h *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, table: int, h: int) -> np.ndarray:
    """A pseudo-rotation of unit vectors, the same for every task."""
    n = 1 << max(0, int(x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, n - x.shape[1])))
    signs = np.random.default_rng([table, h, 97]).choice([-1.0, 1.0], (3, n))
    for s in signs:
        x = hadamard(x * s)
    return x


def _axes(x, table, hashes, many):
    """The ``many`` nearest signed axes and their products, for each hash: lists of (rows, many)."""
    out = []
    for h in range(hashes):
        r = rotated(x, table, h)
        both = np.concatenate([r, -r], 1)
        many = min(many, both.shape[1])
        at = np.argpartition(-both, many - 1, axis=1)[:, :many]
        value = np.take_along_axis(both, at, 1)
        order = np.argsort(-value, axis=1, kind="stable")
        out.append((np.take_along_axis(at, order, 1), np.take_along_axis(value, order, 1), both.shape[1]))
    return out


def buckets(x: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """(rows, probes) buckets of unit vectors, the likeliest first."""
    keys, score = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    for at, value, size in _axes(x, table, hashes, probes):
        keys = (keys[:, :, None] * size + at[:, None, :]).reshape(len(x), -1)
        score = (score[:, :, None] + value[:, None, :]).reshape(len(x), -1)
        order = np.argsort(-score, axis=1, kind="stable")[:, :probes]
        keys, score = np.take_along_axis(keys, order, 1), np.take_along_axis(score, order, 1)
    return keys


def vectors(df: DataFrame) -> DataFrame:
    """(vec_id, v): usable vectors, all of the most common length."""
    e = F.col("embedding")
    usable = df.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0)
        & F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))), F.lit(False))
        & F.exists(e, lambda x: x != 0)
    )
    common = usable.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return usable.where(F.size("embedding") == (common[0]["d"] if common else 0)).select("vec_id", F.col("embedding").alias("v"))


def _matrix(column) -> np.ndarray:
    """Vectors as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _sides(column) -> int:
    """Signed axes of a hash of a column's vectors."""
    return sides(len(column[0]) if len(column) else 1)


def _unit(x):
    return x / np.linalg.norm(x / np.abs(x).max(1, keepdims=True), axis=1, keepdims=True) / np.abs(x).max(1, keepdims=True)


def _placed(n_tables, hashes, probes, carried=()):
    """mapInArrow: a row for each vector, table and probed bucket, with the columns that are carried;
    vectors travel as bytes of their own type."""

    def run(batches):
        for batch in batches:
            rows = max(1, min(2048, (1 << 21) // (probes * min(probes, _sides(batch.column("v"))))))
            for a in range(0, batch.num_rows, rows):
                part = batch.slice(a, rows)
                u = _unit(_matrix(part.column("v")))
                held = part.set_column(part.schema.get_field_index("v"), "v", _raw(part.column("v")))
                for t in range(n_tables):
                    b = buckets(u, t, hashes, probes)
                    row = pa.array(np.repeat(np.arange(len(u)), b.shape[1]))
                    columns = {"tab": pa.array(np.full(len(row), t, np.int32)), "bucket": pa.array(b.ravel())}
                    yield pa.RecordBatch.from_pydict(columns | {c: held.column(c).take(row) for c in carried})

    return run


def _raw(column) -> pa.Array:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return pa.array([r.tobytes() for r in flat.reshape(len(column), -1)], pa.binary())


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of q with each row of x; rows that are equal give equal numbers."""
    dot = (x * q).sum(1)
    return dot / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum()))


def nearest(q, x, ids, k):
    """For each row of q the k nearest ids: (row of q, id, cosine). ids: (rows of x, ids of each)."""
    rough = _unit(q) @ _unit(x).T
    owner = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
    flat = np.concatenate(ids)
    out = []
    for i in range(len(q)):
        s = rough[i]
        ok = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k] - 1e-9) if len(s) > k else np.arange(len(s))
        exact = np.zeros(len(s))
        exact[ok] = cosines(q[i], x[ok])
        near = np.zeros(len(s), bool)
        near[ok] = True
        mine = np.flatnonzero(near[owner])
        best = mine[np.lexsort((flat[mine], -exact[owner[mine]]))]
        best = best[np.sort(np.unique(flat[best], return_index=True)[1])][:k]
        out.append((np.full(len(best), i), flat[best], exact[owner[best]]))
    return [np.concatenate(c) for c in zip(*out)]


def _compared(k, dtype):
    def run(key, index, queries):
        import pandas as pd

        if not len(index) or not len(queries):
            return pd.DataFrame({"qid": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        x, q = (np.frombuffer(b"".join(f["v"]), dtype).astype(np.float64).reshape(len(f), -1) for f in (index, queries))
        qid, ids = queries["qid"].to_numpy(), [np.asarray(i, np.int64) for i in index["ids"]]
        parts = [nearest(q[i : i + 512], x, ids, k) for i in range(0, len(q), 512)]
        return pd.DataFrame({"qid": np.concatenate([qid[512 * n + p[0]] for n, p in enumerate(parts)]), "vec_id": np.concatenate([p[1] for p in parts]), "score": np.concatenate([p[2] for p in parts])})

    return run


def sides(dim: int) -> int:
    return 2 * (1 << max(0, int(dim - 1).bit_length()))


def n_hashes(n: int, dim: int) -> int:
    """Hashes to concatenate at most, so that a bucket has about BUCKET vectors; one at least."""
    return max(1, round(np.log(max(n / BUCKET, 1)) / np.log(sides(dim))))


def _closest(s, ids, k):
    """Places of the k largest of s, one for each id."""
    order = np.argsort(-s, kind="stable")
    order = order[s[order] > -2]
    return order[np.sort(np.unique(ids[order], return_index=True)[1])][:k]


def _true(sample, k):
    """mapInArrow: the k nearest of a task's vectors to each sampled query."""

    def run(batches):
        q = sample.value
        held = [(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, q.shape[1])))] * len(q)
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                x, ids = _matrix(part.column("v")), part.column("rid").to_numpy(zero_copy_only=False)
                score = _unit(q) @ _unit(x).T
                score[score > 1 - 1e-12] = -9  # the query itself
                for i, old in enumerate(held):
                    some = np.flatnonzero(score[i] >= (old[1][-1] if len(old[1]) == k else -2))
                    if len(some):
                        both = [np.concatenate(c) for c in zip(old, (ids[some], score[i][some], x[some]))]
                        best = _closest(both[1], both[0], k)
                        held[i] = tuple(c[best] for c in both)
        n = [len(h[0]) for h in held]
        if sum(n):
            ids, score, v = (np.concatenate(c) for c in zip(*held))
            yield pa.RecordBatch.from_pydict({"q": pa.array(np.repeat(np.arange(len(q)), n).astype(np.int32)), "rid": pa.array(ids), "score": pa.array(score), "v": pa.array([r.tobytes() for r in v], pa.binary())})

    return run


def _probes_needed(q, x, hashes, n_tables):
    """For each row of q and the same row of x, both unit vectors: the fewest probes that find x."""
    least = np.full(len(q), np.iinfo(np.int64).max)
    for t in range(n_tables):
        own, before, last = np.zeros(len(q)), np.zeros((len(q), 1)), None
        for h in range(hashes):
            r, other = rotated(q, t, h), rotated(x, t, h)
            r, other = (np.concatenate([m, -m], 1) for m in (r, other))
            own += r[np.arange(len(q)), other.argmax(1)]
            if last is not None:
                before = (before[:, :, None] + last[:, None, :]).reshape(len(q), -1)
            last = r
        for i in range(len(q)):
            better = np.sort(before[i])
            n = (len(better) - np.searchsorted(better, own[i] - last[i] + 1e-9, "right")).sum()
            least[i] = min(least[i], n + 1)
    return least


def plan(index: DataFrame, queries: DataFrame, size, k: int, n_tables: int, probes: int, hashes: int | None = None) -> tuple[int, int]:
    """(hashes, probes) that find RECALL of the true neighbours of a sample of queries and cost least;
    ``probes`` at least. hashes: the only number to look at."""
    n, d = size["n"], size["d"] or 1
    sampled = queries.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    found = None
    if sampled:
        q = np.array([r["v"] for r in sampled], float)
        shared = index.sparkSession.sparkContext.broadcast(q)
        best = lambda pdf: pdf.iloc[_closest(pdf["score"].to_numpy(), pdf["rid"].to_numpy(), k)]
        schema = "q int, rid long, score double, v binary"
        found = index.select("rid", "v").mapInArrow(_true(shared, k), schema).groupBy("q").applyInPandas(best, schema).select("q", "v").collect()
    options = []
    for h in [hashes] if hashes else range(1, n_hashes(n, d) + 1):
        most, p = sides(d) ** h, probes
        if found:
            needed = np.sort(_probes_needed(_unit(q[[r["q"] for r in found]]), _unit(np.array([np.frombuffer(r["v"]) for r in found])), h, n_tables))
            p = max(p, int(needed[int(np.ceil(RECALL * len(needed))) - 1]))
        p = min(p, most)
        options.append((p * (n / most + SENT), h, p))
    return min(options)[1:]


def _distinct(df: DataFrame, k: int) -> DataFrame:
    """(rid, v, ids): each vector once, with its k+1 smallest ids. Spark cuts groups to that many before
    it shuffles them."""
    top = df.withColumn("place", F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    return top.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).withColumn("rid", F.monotonically_increasing_id())


def search(index: DataFrame, queries: DataFrame, k: int = NEAREST, n_tables: int = TABLES, probes: int = PROBES, hashes: int | None = None) -> DataFrame:
    """index and queries: (vec_id, v). The k nearest found of each query: query_id, rank, vec_id, score."""
    dtype = np.dtype("f4" if "float" in index.schema["v"].dataType.simpleString() else "f8")
    index = tables.stored(_distinct(index, k), "vectors")
    asked = tables.stored(queries.select("v").distinct().withColumn("qid", F.monotonically_increasing_id()), "queries")
    size = index.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    hashes, probes = plan(index, asked, size, k, n_tables, probes, hashes)
    blocks = lambda df, name: df.groupBy("tab", "bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    left = index.select("v").mapInArrow(_placed(n_tables, hashes, 1), "tab int, bucket long")
    right = asked.select("v").mapInArrow(_placed(n_tables, hashes, probes), "tab int, bucket long")
    counts = tables.stored(blocks(left, "blocks").join(blocks(right, "asked"), ["tab", "bucket"]), "buckets")
    left = index.select("v", "ids").mapInArrow(_placed(n_tables, hashes, 1, ("ids", "v")), "tab int, bucket long, ids array<long>, v binary")
    right = asked.mapInArrow(_placed(n_tables, hashes, probes, ("qid", "v")), "tab int, bucket long, qid long, v binary")
    keys = ["tab", "bucket", "block", "part"]
    mine = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = left.join(counts, ["tab", "bucket"]).select("tab", "bucket", mine("v", "blocks").alias("block"), every("asked").alias("part"), "ids", "v")
    right = right.join(counts, ["tab", "bucket"]).select("tab", "bucket", mine("qid", "asked").alias("part"), every("blocks").alias("block"), "qid", "v")
    found = left.groupBy(*keys).cogroup(right.select(*keys, "qid", "v").groupBy(*keys)).applyInPandas(_compared(k + 1, dtype), FOUND)
    found = tables.stored(_best(found, k + 1), "found")
    full = found.where(F.col("place") == k + 1).select("qid")
    short = tables.stored(asked.join(full, "qid", "left_anti"), "short")
    if not short.isEmpty():
        more = against_all(index, short, k + 1, dtype)
        found = _best(found.select("qid", "vec_id", "score").unionByName(more), k + 1)
    members = queries.join(asked, "v").select(F.col("vec_id").alias("query_id"), "qid").distinct()
    out = members.join(found, "qid").where("query_id <> vec_id")
    order = Window.partitionBy("query_id", "qid").orderBy("place")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


FOUND = "qid long, vec_id long, score double"


def _best(found: DataFrame, k: int) -> DataFrame:
    found = found.groupBy("qid", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _as_bytes(batches):
    for batch in batches:
        if batch.num_rows:
            yield batch.set_column(batch.schema.get_field_index("v"), "v", _raw(batch.column("v")))


def against_all(index: DataFrame, queries: DataFrame, k: int, dtype) -> DataFrame:
    """The k nearest of each block of the index (v, ids), for each query (qid, v)."""
    blocks, parts = (-(-df.count() // BLOCK) or 1 for df in (index, queries))
    left = index.select("ids", "v").mapInArrow(_as_bytes, "ids array<long>, v binary")
    right = queries.select("qid", "v").mapInArrow(_as_bytes, "qid long, v binary")
    own = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).alias
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias
    left = left.select(own("v", blocks)("block"), every(parts)("part"), "ids", "v")
    right = right.select(every(blocks)("block"), own("qid", parts)("part"), "qid", "v")
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(_compared(k, dtype), FOUND)


def recall(found: DataFrame, index: DataFrame, queries: DataFrame, k: int = NEAREST) -> float:
    """Share of the true k nearest that a result of ``search`` has, by comparing all with all: a
    neighbour counts as found with a score of at least the k-th true one."""
    dtype = np.dtype("f4" if "float" in index.schema["v"].dataType.simpleString() else "f8")
    asked = tables.stored(queries.select("v", "vec_id").distinct().withColumn("qid", F.monotonically_increasing_id()), "queries")
    true = _best(against_all(_distinct(index, k), asked, k + 1, dtype), k + 1)
    true = asked.select("qid", F.col("vec_id").alias("query_id")).join(true, "qid").where("query_id <> vec_id")
    true = true.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("place"))).where(F.col("rank") <= k)
    least = true.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    got = found.join(least, "query_id").groupBy("query_id", "n").agg(F.count_if(F.col("score") >= F.col("least") - 1e-12).alias("hit"))
    x = least.select("query_id", "n").join(got.select("query_id", "hit"), "query_id", "left").agg(F.sum(F.least("hit", "n")), F.sum("n")).first()
    return (x[0] or 0) / x[1] if x[1] else 1.0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = vectors(tables.table(spark, sf_dir, "embeddings"))
    return search(index, index.where("vec_id % 50 = 0"))
