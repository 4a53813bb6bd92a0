"""Near duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets.

Every distinct shingle set gets 128 MinHash values, split over 32 trees of depth 4. A tree is a
sorted order of its four values; documents that are neighbours in it with a common prefix of two
values or more share a region. A region of more than ``REGION`` documents is split at the next
value, down to depth 4, so the depth adapts to how crowded that part of the order is.

Two texts of similarity s share a region at depth d in one of the trees with probability
1 - (1 - s**d)**32: at s = 0.75 a miss has a chance of 3e-12 at depth 2 and 5e-6 at depth 4.
Candidates whose signatures agree in fewer than ``AGREE`` values are dropped (1.9e-7 at 0.75). All
others are confirmed on the full sets of their whole texts.

Work stays linear in a group of copies: equal sets become one class first; then every document is
confirmed against the smallest documents of its regions; and only in regions that still hold more
than one component are all pairs between different components compared, in blocks, by signatures;
those left are confirmed until a document has one link to a component, with each text sent once to
its component's task, and a component of many texts to several.

Defined cases: a null, empty or blank text has an empty set and links with nothing; in ``groups`` and
``query`` a row with a null doc_id links with nothing, and rows that share a doc_id are meant to be one document:
of different texts under one doc_id some may stay without their links (``apply`` goes by rows); a
very long text is one set; repeated rows have one class; an empty table gives no rows; columns besides
doc_id and text are kept by ``apply``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables
from .components import components
from .words import Words, chunks, mix, shingles, utf8

WORDS, PERCENT = 5, 75
TREES, DEPTH, SHALLOW = 32, 4, 2
REGION = 64
#: Rows of a region compared at once with as many others.
BLOCK = 2048
BUCKET_ROWS = 20_000
#: Rows of trees that a task sorts, and bytes of a component's texts that are compared in one group.
SORTED_ROWS, GROUP_BYTES = 2_000_000, 8 << 20
#: Of 128 values, those that must agree: a pair of similarity 0.75 has fewer with a chance of 1.9e-7.
AGREE = 70
_A = np.random.default_rng(41).integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sh: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts with shingles, 128) MinHash values of 32 bits."""
    some = np.flatnonzero(np.diff(at) > 0)
    out = np.empty((TREES * DEPTH, len(some)), np.uint32)
    for j, a in enumerate(_A):
        out[j] = np.minimum.reduceat(((sh * a) >> np.uint64(32)).astype(np.uint32), at[some]) if len(some) else 0
    return np.ascontiguousarray(out.T)


def _signed(batches):
    for batch in batches:
        texts = utf8(batch.column("text"))
        n, h1, h2, sigs = [], [], [], []
        for a, b in chunks(np.fromiter(map(len, texts), np.int64, len(texts))):
            sh, at = shingles(Words(texts[a:b], lower=True), WORDS)
            size = np.diff(at)
            sig = iter(signatures(sh, at))
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(sh ^ np.uint64(s)))]) for s in (1, 0x5851F42D4C957F2D)]
            n.append(size)
            h1.append((sums[0][at[1:]] - sums[0][at[:-1]]).view(np.int64))
            h2.append((sums[1][at[1:]] - sums[1][at[:-1]]).view(np.int64))
            sigs += [next(sig).tobytes() if s else None for s in size]
        cat = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), cat(n), cat(h1), cat(h2), pa.array(sigs, pa.binary())], ["doc_id", "key", "n", "h1", "h2", "sig"])


def _rows_of_trees(batches):
    """Per document and tree the sort keys: tree and two values in one number, two more in another."""
    for batch in batches:
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, TREES, DEPTH).astype(np.int64)
        rep = np.repeat(batch.column("rep").to_numpy(), TREES)
        high = (np.arange(TREES) << 56) | ((sig[:, :, 0] >> 4) << 28) | (sig[:, :, 1] >> 4)
        low = (((sig[:, :, 2] >> 4) << 28) | (sig[:, :, 3] >> 4)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(high.ravel()), pa.array(low), pa.array(rep)], ["high", "low", "rep"])


def _regions(batches):
    """Sorted rows of one partition to (region, tree, rep), for regions of two documents or more.

    The first and last region of a partition may go on in its neighbours; their rows get a region
    at every depth that they may need.
    """
    got = [(b.column("high").to_numpy(), b.column("low").to_numpy(), b.column("rep").to_numpy()) for b in batches if b.num_rows]
    if not got:
        return
    high, low, rep = (np.concatenate(x) for x in zip(*got))
    ids = {d: k for d, k in ((2, mix(high.view(np.uint64))), (3, mix(mix(high.view(np.uint64)) ^ (low >> 28).view(np.uint64) ^ np.uint64(3 << 60))), (4, mix(mix(high.view(np.uint64)) ^ low.view(np.uint64) ^ np.uint64(5 << 60))))}

    def runs(x):
        new = np.concatenate([[True], x[1:] != x[:-1]])
        size = np.diff(np.append(np.flatnonzero(new), len(x)))
        return np.repeat(size, size)

    edge = (high == high[0]) | (high == high[-1])
    live = np.ones(len(rep), bool)
    for d in range(SHALLOW, DEPTH + 1):
        size = runs(ids[d])
        small = (size <= REGION) | (d == DEPTH)
        out = live & small & ((size > 1) | edge)
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(ids[d][out].view(np.int64)), pa.array((high[out] >> 56).astype(np.int32)), pa.array(rep[out])], ["region", "tree", "rep"])
        live &= ~small | edge


def _alike(batches):
    """(a, b, sig_a, sig_b) to the pairs whose signatures agree in AGREE of their values."""
    for b in batches:
        x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(-1, TREES * DEPTH) for c in ("sig_a", "sig_b"))
        yield b.filter(pa.array((x == y).sum(1) >= AGREE)).select(["a", "b"])


def _across(pdf):
    """A bucket's blocks of regions to the pairs of different components whose signatures are near:
    (probe, comp, targets), the probe's targets in the component of the smaller label. Texts that agree in
    all values of a tree share a region there, so the first such tree has the pair and later ones pass it
    over."""
    import pandas as pd

    pdf = pdf.sort_values(["region", "i", "j", "side"], kind="stable")
    sig = np.frombuffer(b"".join(pdf["sig"]), np.uint32).reshape(-1, TREES * DEPTH)
    rep, comp, n, side, tree = (pdf[c].to_numpy() for c in ("rep", "comp", "n", "side", "tree"))
    where = pdf[["region", "i", "j"]].to_numpy()
    cut = np.flatnonzero((where[1:] != where[:-1]).any(1)) + 1
    found, waiting, size = [], [], 0

    def near():
        pair = np.unique(np.concatenate(waiting), axis=0)
        pair = pair[np.argsort(tree[pair[:, 0]], kind="stable")]
        _, first = np.unique(rep[pair], axis=0, return_index=True)
        pair = pair[first]
        for k in range(0, len(pair), 50_000):
            x = pair[k : k + 50_000]
            same = sig[x[:, 0]] == sig[x[:, 1]]
            whole = same.reshape(-1, TREES, DEPTH).all(2)
            before = np.where(whole.any(1), whole.argmax(1), TREES) < tree[x[:, 0]]
            found.append(x[(same.sum(1) >= AGREE) & ~before])

    for a, b in zip(np.concatenate([[0], cut]), np.append(cut, len(rep))):
        mid = a + int(np.searchsorted(side[a:b], 1))
        one = mid in (a, b)
        left, right = (np.arange(a, b),) * 2 if one else (np.arange(a, mid), np.arange(mid, b))
        for k in range(0, len(left), 256):
            x = left[k : k + 256]
            y = right[k:] if one else right
            p, q = np.nonzero(_near_sizes(comp, n, x, y))
            if one:
                p, q = p[q > p], q[q > p]
            if len(p):
                waiting.append(np.stack([x[p], y[q]], 1))
                size += len(p)
            if size > 400_000:
                near()
                waiting, size = [], 0
    if waiting:
        near()
    got = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    swap = comp[got[:, 0]] < comp[got[:, 1]]
    probe, target = np.where(swap, got[:, 1], got[:, 0]), np.where(swap, got[:, 0], got[:, 1])
    order = np.lexsort((rep[target], comp[target], rep[probe]))
    p, c, t = rep[probe][order], comp[target][order], rep[target][order]
    cut = np.flatnonzero((p[1:] != p[:-1]) | (c[1:] != c[:-1])) + 1 if len(p) else []
    rows = [(p[a], c[a], np.unique(t[a:b]).tobytes()) for a, b in zip(np.concatenate([[0], cut]).astype(int), np.append(cut, len(p)).astype(int)) if b > a]
    return pd.DataFrame(rows, columns=["probe", "comp", "targets"]).astype({"probe": "int64", "comp": "int64"})


def _near_sizes(comp, n, x, y):
    return (comp[x, None] != comp[None, y]) & (np.minimum(n[x, None], n[None, y]) * 100 >= np.maximum(n[x, None], n[None, y]) * PERCENT)


def _joined(pdf):
    """A bucket of components' members (side 0) and probes (side 1) to one confirmed link for each
    probe and component that have any."""
    import pandas as pd

    out = []
    pdf = pdf.sort_values("side", kind="stable").reset_index(drop=True)
    texts = utf8(pdf["text"])
    sets: list[np.ndarray] = []
    for a, b in chunks(np.fromiter(map(len, texts), np.int64, len(texts))):
        sh, at = shingles(Words(texts[a:b], lower=True), WORDS)
        sets += [sh[at[k] : at[k + 1]] for k in range(b - a)]
    side, rep, comp, sub = (pdf[c].to_numpy() for c in ("side", "rep", "comp", "sub"))
    member = {(c, s, r): k for k, (c, s, r) in enumerate(zip(comp, sub, rep)) if side[k] == 0}
    linked = set()
    for k in np.flatnonzero(side == 1):
        mine = sets[k]
        if (rep[k], comp[k]) in linked:
            continue
        others = [m for t in np.unique(np.frombuffer(b"".join(pdf["targets"].iloc[k]), np.int64)).tolist() if (m := member.get((comp[k], sub[k], t))) is not None]
        for a in range(0, len(others), 64):
            part = others[a : a + 64]
            sizes = np.fromiter((len(sets[m]) for m in part), np.int64, len(part))
            every = np.concatenate([sets[m] for m in part])
            at = np.minimum(np.searchsorted(mine, every), len(mine) - 1)
            both = np.add.reduceat((mine[at] == every).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            good = np.flatnonzero(100 * both >= PERCENT * (sizes + len(mine) - both))
            if len(good):
                out.append((rep[k], rep[part[good[0]]]))
                linked.add((rep[k], comp[k]))
                break
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _confirmed(batches):
    """(a, b, text_a, text_b) to the linked (a, b)."""
    for batch in batches:
        x, y = utf8(batch.column("text_a")), utf8(batch.column("text_b"))
        keep = np.zeros(len(x), bool)
        for i, j in chunks(np.fromiter((len(p) + len(q) for p, q in zip(x, y)), np.int64, len(x))):
            sh, at = shingles(Words(x[i:j] + y[i:j], lower=True), WORDS)
            for k in range(j - i):
                p, q = sh[at[k] : at[k + 1]], sh[at[k + j - i] : at[k + j - i + 1]]
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep[i + k] = both > 0 and 100 * both >= PERCENT * (len(p) + len(q) - both)
        yield batch.filter(pa.array(keep)).select(["a", "b"])


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    side = lambda s: texts.select(F.col("rep").alias(s), F.col("text").alias(f"text_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(_confirmed, "a long, b long")


def _texts(docs: DataFrame, reps: DataFrame, needed: DataFrame) -> DataFrame:
    """Whole texts of the documents in ``needed`` (rep), once each."""
    wanted = reps.join(needed.distinct(), "rep").select("rep", "key")
    return docs.select(tables.row_key().alias("key"), "doc_id", "text").join(wanted, "key").where("doc_id = rep").select("rep", "text").dropDuplicates(["rep"])


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_shingles, component_id) for every row of docs."""
    spark = docs.sparkSession
    n_parts = tables.parts(spark)
    signed = tables.stored(docs.select("doc_id", "text", tables.row_key().alias("key")).mapInArrow(_signed, "doc_id long, key long, n long, h1 long, h2 long, sig binary"), "signatures")
    linkable = signed.where("n > 0 and doc_id is not null")
    reps = linkable.groupBy("h1", "h2", "n").agg(F.min(F.struct("doc_id", "key")).alias("r"), F.count("*").alias("members"), F.first("sig").alias("sig"))
    reps = tables.stored(reps.select(F.col("r.doc_id").alias("rep"), F.col("r.key").alias("key"), "h1", "h2", "n", "members", "sig"), "classes")
    ordered = reps.select("rep", "sig").mapInArrow(_rows_of_trees, "high long, low long, rep long").repartitionByRange(max(n_parts, reps.count() * TREES // SORTED_ROWS), "high", "low", "rep").sortWithinPartitions("high", "low", "rep")
    regions = tables.stored(ordered.mapInArrow(_regions, "region long, tree int, rep long"), "regions")

    pivots = tables.stored(regions.groupBy("region").agg(F.min("rep").alias("a"), F.max("rep").alias("top")).where("top > a").select("region", "a"), "pivots")
    shared = regions.join(pivots, "region").where("rep > a").select("a", F.col("rep").alias("b"))
    counted = shared.groupBy("b", "a").agg(F.count("*").alias("trees"))
    # Most trees first: these three join almost everything; what they leave apart is compared below.
    best = counted.groupBy("b").agg(F.slice(F.sort_array(F.collect_list(F.struct(F.col("trees"), -F.col("a"))), asc=False), 1, 3).alias("best"))
    first = best.select("b", F.explode("best").alias("x")).select((-F.col("x.col2")).alias("a"), "b")
    sig = lambda s: reps.select(F.col("rep").alias(s), F.col("sig").alias(f"sig_{s}")).dropDuplicates([s])
    alike = tables.stored(first.join(sig("a"), "a").join(sig("b"), "b").select("a", "b", "sig_a", "sig_b").mapInArrow(_alike, "a long, b long"), "pairs")
    texts = tables.stored(_texts(docs, reps, regions.select("rep")), "texts")
    links = tables.stored(_confirm(alike, texts), "links")
    comps = tables.stored(components(links), "components")

    labelled = regions.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("region", "tree", "rep", F.coalesce("component", "rep").alias("comp"))
    mixed = labelled.groupBy("region").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size")).where("lo < hi").select("region", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    mixed = tables.stored(mixed, "mixed")
    rows = tables.stored(labelled.join(mixed, "region"), "mixed_rows")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.select("region", "tree", "rep", "comp", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("mine"), other.alias("other"))
    # Block k stands left in the pairs (k, k) and (k, larger), right in (smaller, k).
    rows = rows.select("region", "tree", "rep", "comp", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") > F.col("other")).cast("int").alias("side"))
    n_rows = rows.count()
    n_buckets = max(n_parts, n_rows // BUCKET_ROWS)
    rows = rows.join(reps.select("rep", "n", "sig").dropDuplicates(["rep"]), "rep").withColumn("bucket", F.pmod(F.xxhash64("region", "i", "j"), F.lit(n_buckets)))
    packs = rows.groupBy("bucket").applyInPandas(_across, "probe long, comp long, targets binary")
    # A pair comes from many trees: a probe meets a component once.
    packs = tables.stored(packs.groupBy("probe", "comp").agg(F.collect_list("targets").alias("targets")), "packs")

    # One link between a probe and a component is enough: they are one component then.
    label = texts.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("rep", "text", F.coalesce("component", "rep").alias("comp"))
    subs = label.groupBy("comp").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.octet_length("text")) / GROUP_BYTES)).cast("int").alias("subs")).join(packs.select("comp").distinct(), "comp", "left_semi")
    subs = tables.stored(subs, "subs")
    members = label.join(subs, "comp").select(F.lit(0).alias("side"), "rep", "comp", F.pmod(F.xxhash64("rep"), F.col("subs")).cast("int").alias("sub"), F.lit(None).cast("array<binary>").alias("targets"), "text")
    probes = packs.join(subs, "comp").select(F.col("probe").alias("rep"), "comp", "targets", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"))
    probes = probes.join(texts, "rep").select(F.lit(1).alias("side"), "rep", "comp", "sub", "targets", "text")
    both = members.unionByName(probes).withColumn("bucket", F.pmod(F.xxhash64("comp", "sub"), F.lit(max(n_parts, tables.n_bytes(texts) >> 24))))
    links = links.unionByName(both.groupBy("bucket").applyInPandas(_joined, "a long, b long"))
    comps = tables.stored(components(links), "components")

    changed = reps.join(comps.withColumnRenamed("node", "rep"), "rep", "left").where("members > 1 or component is not null")
    changed = tables.stored(changed.select("h1", "h2", "n", F.coalesce("component", "rep").alias("component")), "changed")
    slim = signed.select("doc_id", "key", "n", "h1", "h2")
    return slim.join(changed, ["h1", "h2", "n"], "left").select("doc_id", "key", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def row_ids(docs: DataFrame, name: str) -> DataFrame:
    """docs with a long of its own for each different row (doc_id, text): the doc_id, but for rows without one and for
    further texts under one, which get hashes above all ids under 2 ** 62."""
    key = tables.row_key()
    texts = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(key).alias(f"{name}_first"), F.max(key).alias(f"{name}_last"))
    several = texts.where(F.col(f"{name}_first") != F.col(f"{name}_last")).select(F.col("doc_id").alias(f"{name}_of"), f"{name}_first")
    several = tables.stored(several, "several-texts")
    other = key.bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    own = F.when(F.col("doc_id").isNull() | (key != F.col(f"{name}_first")), other).otherwise(F.col("doc_id"))
    return docs.join(several, docs["doc_id"] == F.col(f"{name}_of"), "left").withColumn(name, own).select(*docs.columns, name)


def apply(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest doc_id, null last. Every row counts by its own
    text: rows without an id and different texts under one id are linked like any others, and of rows equal
    in id and text one stays. Rows without words all stay."""
    row = "__readloom_row"
    rows = row_ids(docs, row)
    found = tables.stored(groups(rows.select(F.col(row).alias("doc_id"), "text")).where("n_shingles > 0").select(F.col("doc_id").alias(row), "component_id"), "rows")
    gone = found.where(F.col(row) != F.col("component_id")).select(row).distinct()
    twice = tables.stored(found.groupBy(row).agg(F.count("*").alias("n")).where("n > 1").select(row), "repeated-rows")
    # What goes grows with the corpus: it is merged, never broadcast, and the texts are dealt once.
    once = rows.join(gone.unionByName(twice).hint("merge"), row, "left_anti")
    repeated = rows.join(twice, row, "left_semi").join(gone, row, "left_anti").dropDuplicates([row])
    return once.unionByName(repeated).select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = groups(tables.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
