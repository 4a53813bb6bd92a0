"""Merging and range joins against brute force, over small and large ranges, hot places and long intervals."""

import random

import pytest

from readloom.operators import intervals


@pytest.fixture(params=[3, 64, 1 << 16])
def span(monkeypatch, request):
    monkeypatch.setattr(intervals, "SPAN", request.param)
    return request.param


def islands(rows):
    out = []
    for c, a, b in sorted(r for r in rows if r[1] < r[2]):
        if out and out[-1][0] == c and a <= out[-1][2]:
            out[-1][2] = max(out[-1][2], b)
        else:
            out.append([c, a, b])
    return sorted(map(tuple, out))


@pytest.mark.parametrize("partitions", [1, 3, 50])
def test_merge(spark, span, partitions):
    r = random.Random(partitions * span)
    rows = [(c, a := r.randrange(500), a + r.choice([0, 1, 2, 5, 30])) for c in ("chr1", "chr2", None) for _ in range(60)]
    rows += [("chr3", 10, 400), ("chr3", 20, 30), ("chr3", 399, 401), ("chr3", 401, 402), ("chr3", 403, 404), ("chr3", 5, 2)] + [("chr1", 77, 90)] * 50
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(rows, "chr string, start int, stop int").repartition(partitions)
        got = intervals.merge(df.where("chr is not null"), ["chr"], span)
        assert sorted(map(tuple, got.select("chr", "start", "stop").collect())) == islands([x for x in rows if x[0]])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def brute(a, b):
    return sorted((p[1], q[1]) for p in a for q in b if p[0] == q[0] and p[0] is not None and p[2] <= p[3] and q[2] <= q[3] and p[2] <= q[3] and q[2] <= p[3])


@pytest.mark.parametrize("rows", [1, 7, 50_000])
def test_overlapping(spark, span, rows):
    r = random.Random(rows + span)
    place = lambda hot: 700 if hot and r.random() < 1 / 3 else r.randrange(-5, 1500)
    a = [(r.choice(["chr1", "chr1", "chr2", "only", None]), i, s := place(True), s + r.choice([0, 0, 0, 1, 9, 200, -3])) for i in range(260)]
    b = [(r.choice(["chr1", "chr2", "other", None]), i, s := place(False), s + r.choice([0, 3, 50, -1])) for i in range(120)]
    b += [("chr1", 1000 + i, 0, 1_000_000) for i in range(3)] + [("chr2", 1005, 650, 2_000_000)]
    left = spark.createDataFrame(a, "chr string, i int, s int, e int").selectExpr("*", "array(i, s) as both").repartition(5)
    right = spark.createDataFrame(b, "chr string, j int, x int, y int").selectExpr("*", "named_struct('n', j) as more").repartition(3)
    got = intervals.overlapping(left, right, "s", "e", "x", "y", ["chr"], rows)
    assert got.columns == ["chr", "i", "s", "e", "both", "j", "x", "y", "more"]
    found = got.collect()
    assert sorted((g.i, g.j) for g in found) == brute(a, b)
    assert all(g.both == [g.i, g.s] and g.more.n == g.j for g in found)


def test_nothing_to_join(spark):
    none = spark.createDataFrame([], "chr string, i int, s int, e int")
    some = spark.createDataFrame([("chr1", 1, 5, 9)], "chr string, j int, x int, y int")
    assert intervals.overlapping(none, some, "s", "e", "x", "y", ["chr"]).count() == 0
    assert intervals.overlapping(some, none, "x", "y", "s", "e", ["chr"]).count() == 0


def test_a_long_gene_is_one_row_and_a_hot_place_many_parts(spark):
    """A 2 Mb gene takes a row for each range that it reaches, and a range with a third of all variants is dealt out."""
    hot = [("chr1", i, 5_000_000 + i % 3, 5_000_000 + i % 3) for i in range(3000)]
    rest = [("chr1", 5000 + i, 1000 * i, 1000 * i) for i in range(6000)]
    left = spark.createDataFrame(hot + rest, "chr string, i int, s int, e int")
    cuts = intervals._dealt(left, "s", ["chr"], 500).first()
    assert len(cuts["_ranges"]) <= 92 and max(cuts["_salts"]) == 4 and len(cuts["_salts"]) < 20
    wide = intervals._dealt(left, "s", ["chr"], 50_000).first()
    assert wide["_salts"] == [1]
    genes = [("chr1", 1, 4_000_000, 5_999_999), ("chr1", 2, 5_000_001, 5_000_001)]
    right = spark.createDataFrame(genes, "chr string, j int, x int, y int")
    got = sorted((g.i, g.j) for g in intervals.overlapping(left, right, "s", "e", "x", "y", ["chr"], 500).collect())
    assert got == brute(hot + rest, genes)


def test_genomic_order(spark):
    rows = [(c, p) for c in ("chr10", "chr2", "chrM", "chrUn_gl000249", "what", "chr1_gl000191_random", "chr1") for p in (30, 4, 100)]
    df = spark.createDataFrame(rows, "chr string, pos int").repartition(5)
    got = [tuple(r) for r in intervals.in_genomic_order(df, partitions=3).collect()]
    rank = ["chr1", "chr1_gl000191_random", "chr2", "chr10", "chrM", "chrUn_gl000249", "what"]
    assert got == [(c, p) for c in rank for p in (4, 30, 100)]
