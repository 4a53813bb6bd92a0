"""FASTA files cut into pieces of 256 bases, a file by as many tasks as it has byte ranges.

The first pass tells of each range which contig it ends in and how many bases stand behind the last
name. An associative scan over the ranges gives each one the contig and the place that it begins in; the second
pass cuts. Only pieces that a range's end cuts through are grouped, a few for each range. A line is read whole.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .lines import ranged, with_ranges
from .scratch import stored

CHUNK = 256


def _bases(line: str) -> str:
    return "".join(line.split())


def _name(line: str) -> str:
    return (line[1:].split() or [""])[0]


def _by_range(batches, begin, line, end):
    """Calls begin(key, state) where a range's lines begin, line(text), end() behind its last one."""
    now = None
    for batch in batches:
        states = batch["state"].to_pylist() if "state" in batch.schema.names else None
        for i, (key, text) in enumerate(zip(batch["key"].to_pylist(), batch["value"].to_pylist())):
            if key != now:
                if now is not None:
                    yield from end(now)
                now = key
                begin(states[i] if states else None)
            yield from line(text)
    if now is not None:
        yield from end(now)


def _summed(batches):
    """(key, name, bases) of each range: its last name, and the bases behind it or in all if it has none."""
    s = {}

    def begin(_):
        s.update(name=None, bases=0)

    def line(text):
        if text.startswith(">"):
            s.update(name=_name(text), bases=0)
        else:
            s["bases"] += len(_bases(text))
        return ()

    def end(key):
        yield key, s["name"], s["bases"]

    rows = list(_by_range(batches, begin, line, end))
    cols = list(zip(*rows)) or [[]] * 3
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64()))], names=["key", "name", "bases"])


def _cut(batches, size=CHUNK, rows_at_once=5000):
    """(key, chr, chunk, at, seq, whole) of the ranges' bases: ``at`` is the place in the piece, and ``whole`` says that
    no other range has a part of it."""
    s = {"name": None, "at": 0, "held": ""}

    def piece(whole):
        if s["name"] is not None and s["held"]:
            yield s["name"], s["at"] // size, s["at"] % size, s["held"], whole and s["at"] % size == 0
        s.update(at=s["at"] + len(s["held"]), held="")

    def begin(state):
        s.update(name=state["name"], at=state["bases"], held="")

    def line(text):
        if text.startswith(">"):
            yield from piece(True)
            s.update(name=_name(text), at=0)
            return
        rest = _bases(text)
        while rest:
            room = size - s["at"] % size - len(s["held"])
            s["held"] += rest[:room]
            if len(rest) < room:
                return
            rest = rest[room:]
            yield from piece(True)

    def end(_):
        # The range that follows may go on with this piece.
        yield from piece(False)

    import itertools

    it = _by_range(batches, begin, line, end)
    while part := list(itertools.islice(it, rows_at_once)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))], names=["chr", "chunk", "at", "seq", "whole"])


def chunked(spark: SparkSession, path, runs_on: bool = False) -> DataFrame:
    """(chr, chunk, seq); lines before the first name are skipped, contigs without bases have no rows."""
    lines = ranged(spark, path).select("value", "file", "block", F.xxhash64("file", "block").alias("key"))
    ends = lines.select("key", "value").mapInArrow(_summed, "key long, name string, bases long")
    ranges = stored(lines.groupBy("file", "block", "key").agg(F.count("*").alias("n")).drop("n").join(ends, "key"), "fasta-ranges")
    files = [] if runs_on else ["file"]
    order = lambda *keys: Window.partitionBy(*keys).orderBy("file", "block")
    x = ranges.withColumn("contigs", F.count("name").over(order(*files)))
    x = x.withColumn("end_name", F.last("name", ignorenulls=True).over(order(*files))).withColumn("end_bases", F.sum("bases").over(order(*files, "contigs")))
    state = F.struct(F.lag("end_name").over(order(*files)).alias("name"), F.coalesce(F.lag("end_bases").over(order(*files)), F.lit(0)).alias("bases"))
    states = stored(x.select("file", "block", state.alias("state")), "fasta-states")
    cut = with_ranges(lines, states).select("key", "value", "state").mapInArrow(_cut, "chr string, chunk long, at long, seq string, whole boolean")
    cut = stored(cut, "fasta-pieces")
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "seq"))), lambda p: p["seq"]), "")
    return cut.where("whole").select("chr", "chunk", "seq").unionByName(cut.where("not whole").groupBy("chr", "chunk").agg(ordered.alias("seq")))
