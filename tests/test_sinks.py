"""Ordered tables and named outputs: what was written is read back whole."""

import os

import pytest
from pyspark.sql import functions as F

from readloom.sources import named, ordered


def test_order_manifest_and_ranges(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select((F.col("id") * 37 % 11).cast("int").alias("k"), (F.col("id") * 7919 % 1000).cast("int").alias("pos"), F.col("id").cast("string").alias("x"))
    m = ordered.write_ordered(df, path, ["k", "pos"], 6).orderBy("file").collect()
    want = sorted((r.k, r.pos, r.x) for r in df.collect())
    assert sum(r["rows"] for r in m) == 1000 and len(m) > 3 and [r.before for r in m] == [sum(x["rows"] for x in m[:i]) for i in range(len(m))]
    assert all(tuple(a["last"]) <= tuple(b["first"]) for a, b in zip(m, m[1:]))
    got = sorted(ordered.with_ordinals(spark, path).collect(), key=lambda r: r.ordinal)
    assert [(r.k, r.pos) for r in got] == [w[:2] for w in want] and [r.ordinal for r in got] == list(range(1, 1001)) and sorted((r.k, r.pos, r.x) for r in got) == want
    for first, last in (({"k": 3}, {"k": 3}), ({"k": 2, "pos": 500}, {"k": 4, "pos": 20}), ({"k": 20}, {"k": 30}), ({"k": 9}, {"k": 2})):
        rows = ordered.read_range(spark, path, first, last)
        a, b = tuple(first.values()), tuple(last.values())
        assert sorted(map(tuple, rows.collect())) == [w for w in want if w[: len(a)] >= a and w[: len(b)] <= b]
    assert len(ordered.read_range(spark, path, {"k": 3}, {"k": 3}).inputFiles()) < len(m)


def test_named_outputs(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [(f"s{i % 3}.1.fastq", f"line {i}\nof two") for i in range(400)] + [(f"only{i}.txt", "") for i in range(100)]
    named.write_named(ordered.in_order(spark.createDataFrame(rows, "file string, value string"), ["file", "value"]), path)
    got = named.read_named(spark, path).collect()
    want = sorted((f, x) for f, v in rows for x in v.split("\n"))
    assert sorted(map(tuple, got)) == want
    files = set(os.listdir(path))
    assert {f"only{i}.txt" for i in range(100)} <= files and all(f.split(".0")[0] in {r[0] for r in rows} for f in files)
    for f in sorted({r[0] for r in rows}):
        lines = "".join((tmp_path / "out" / x).read_text() for x in sorted(files) if x == f or x.startswith(f"{f}.")).splitlines()
        assert lines == [x for _, v in sorted(r for r in rows if r[0] == f) for x in v.split("\n")]


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    named.write_named(spark.createDataFrame([("a.txt", "first")], "file string, value string"), path)
    with pytest.raises(Exception):
        named.write_named(spark.createDataFrame([(f"b{i}.txt" if i < 39 else "../c", "x") for i in range(40)], "file string, value string").repartition(4), path)
    assert os.listdir(path) == ["a.txt"]
