"""Readers: numbered lines, bad rows, contigs over many ranges, mixed folders, parsers."""

import random

import pytest
from pyspark.sql import functions as F

from readloom.functions import calls
from readloom.operators import annotate
from readloom.sources import lines, text
from readloom.sources.fastq import FastqReader


@pytest.fixture(params=[97, 1 << 27])
def ranges(spark, request):
    """Bytes of a range; several ranges share a task where the cost of opening one is small."""
    for k, v in (("maxPartitionBytes", request.param), ("openCostInBytes", 1 + request.param % 5)):
        spark.conf.set(f"spark.sql.files.{k}", v)
    yield request.param
    for k in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{k}")


def test_lines_are_numbered(spark, tmp_path, ranges):
    r = random.Random(1)
    want = []
    for f in ("b", "a", "c", "empty"):
        rows = [] if f == "empty" else ["x" * r.randrange(0, 60) for _ in range(70)]
        (tmp_path / f).write_text("".join(x + "\n" for x in rows))
        want += [(f, i + 1, x) for i, x in enumerate(rows)]
    got = lines.numbered(spark, str(tmp_path)).select(F.regexp_extract("file", "([^/]+)$", 1), "line", "value", "ordinal").collect()
    assert sorted(tuple(g)[:3] for g in got) == sorted(want)
    assert [tuple(g)[:3] for g in sorted(got, key=lambda g: g["ordinal"])] == sorted(want) and sorted(g["ordinal"] for g in got) == list(range(1, 211))


def test_no_lines(spark, tmp_path):
    (tmp_path / "empty").write_text("")
    assert lines.numbered(spark, str(tmp_path)).count() == 0
    bed = text.read_bed(spark, str(tmp_path))
    assert bed.rows["region"].count() == bed.bad.count() == 0 and bed.counts == {"lines": 0, "region": 0, "bad": 0}


def errors(bad):
    return {(r.line, r.error, r.value) for r in bad.collect()}


def test_pileup_loses_nothing(spark, tmp_path, ranges):
    site, indel = ["chr1", "7", "A", "G", "30", "31", "32", "9", "..", "II"], ["chr1", "8", "*", "*/+A", "30", "31", "32", "9", "*", "+A", "4", "5", "0", "0", "0"]
    with_cell = lambda row, i, x: [*row[:i], x, *row[i + 1 :]]
    rows = [site, indel, site[:9], [*site, "more"], indel[:14], [*indel, "more"], with_cell(site, 1, "x7"), with_cell(site, 7, ""), with_cell(indel, 11, "5.5x"), with_cell(site, 2, "A*"), ["track name=x"], ["# remark"], [""], ["chr1"], site]
    path = tmp_path / "p.pileup"
    path.write_text("".join("\t".join(r) + "\n" for r in rows))
    got = text.read_pileup(spark, str(path))
    want = {3: "width", 4: "width", 5: "width", 6: "width", 7: "pos", 8: "depth", 9: "n2", 10: "ref", 11: "header", 12: "header", 13: "blank", 14: "width"}
    assert errors(got.bad) == {(i, e, "\t".join(rows[i - 1])) for i, e in want.items()}
    assert sorted(r.line for r in got.rows["site"].collect()) == [1, 15] and [r.line for r in got.rows["indel"].collect()] == [2]
    assert got.counts == {"lines": 15, "site": 2, "indel": 1, "bad": 12}
    sites, bad = text.read_sites(spark, str(path))
    assert sites.columns == [f.name for f in text.SITES] and sites.count() == 2 and bad.count() == 12


def test_bed_and_vbed_lose_nothing(spark, tmp_path):
    rows = ["chr1\t5\t9\tname", "chr1\tfive\t9", "chr1\t5", "track name=a", "browser position", "chr2\t1\t2", "", "chr1\t5\t99999999999"]
    (tmp_path / "a.bed").write_text("\n".join(rows) + "\n")
    bed = text.read_bed(spark, str(tmp_path / "a.bed"))
    assert {tuple(r)[3:] for r in bed.rows["region"].collect()} == {("chr1", 5, 9), ("chr2", 1, 2)}
    assert {(r.line, r.error) for r in bed.bad.collect()} == {(2, "start"), (3, "width"), (4, "header"), (5, "header"), (7, "blank"), (8, "stop")}
    rows = ["chr1\t1\t2\tA=>G(9;G:9)\t50\t+", "chr1\t1\t2\tA=>G(9;G:9)\t50", "five", "chr1\t1\tx\tA=>G(9;G:9)\t50\t+", "chr1\t1\t2\tA>G(9;G:9)\t50\t+", "chr1\t1\t2\tA=>GG(9;G:9)\t50\t+", "chr1\t1\t2\tA=>G(9;G:9)\t50\t+\tmore"]
    (tmp_path / "v.vbed").write_text("\n".join(rows) + "\n")
    vbed = text.read_vbed(spark, str(tmp_path / "v.vbed"))
    assert {r.line for r in vbed.rows["call"].collect()} == {1, 2}
    assert {(r.line, r.error) for r in vbed.bad.collect()} == {(3, "width"), (4, "stop"), (5, "descr"), (6, "descr"), (7, "width")}


def test_mixed_folder(spark, tmp_path):
    (tmp_path / "ensGtp.txt").write_text("g1\tt1\tp1\ng2\tt2\t\nshort\n")
    (tmp_path / "knownIsoforms.txt").write_text("1\tt1\n")
    (tmp_path / "snp131.txt").write_text("\t".join(["1", "chr1", "5", "6", "rs1", "0", "+", "A", "A", "A/G", "genomic", "single", "u", "0", "0.5", "u", "e", "1"]) + "\nx\ty\n")
    (tmp_path / "other.txt").write_text("what\tis\tthis\n")
    got = text.read_mixed(spark, str(tmp_path))
    assert got.counts == {"lines": 7, "row": 4, "bad": 3}
    assert {(r.file.rsplit("/", 1)[1], r.line, r.error) for r in got.bad.collect()} == {("ensGtp.txt", 3, "width"), ("snp131.txt", 2, "width"), ("other.txt", 1, "layout")}
    assert {(r.gene, r.id, r.protein) for r in text.of_layout(got, "ensGtp").collect()} == {("g1", "t1", "p1"), ("g2", "t2", "")}
    snp = text.of_layout(got, "knownVariants").first()
    assert (snp.sta, snp.av_het_se, snp["class"]) == (5, 0.5, "single")


def contigs(parts, size=256):
    out, name, held = {}, None, ""
    for line in parts:
        if line.startswith(">"):
            name = (line[1:].split() or [""])[0]
            out[name] = ""
        elif name is not None:
            out[name] += "".join(line.split())
    return sorted((c, i // size, s[i : i + size]) for c, s in out.items() for i in range(0, len(s), size))


@pytest.mark.parametrize("runs_on", [False, True])
def test_contigs_over_ranges(spark, tmp_path, ranges, runs_on):
    r = random.Random(ranges)
    parts = []
    for k in range(3):
        rows = ["skipped"] if k == 0 else []
        for c in range(5):
            if not (runs_on and k and c == 0):
                rows.append(f">c{k}_{c} about it")
            rows += ["".join(r.choices("ACGTN", k=r.choice([0, 1, 60, 60, 300]))) + r.choice(["", " ", "\r"]) for _ in range(r.randrange(0, 9))]
        (tmp_path / f"part{k}.fa").write_text("\n".join(rows) + "\n")
        parts.append(rows)
    got = sorted(map(tuple, text.read_fasta(spark, str(tmp_path), runs_on).collect()))
    assert got == (contigs(sum(parts, [])) if runs_on else sorted(sum((contigs(p) for p in parts), [])))


def test_call_descriptions(spark):
    cases = {"A=>G(9;A:1,G:8)": ("A", "G", 9, "snp", "hom", {"A": 1, "G": 8}), "A => R (9; A:1, g:8,)": ("A", "R", 9, "snp", "het", {"A": 1, "G": 8}), "C=>*/+CC(5;*:2,+CC:3)": ("C", "*/+CC", 5, "indel", "het", {"*": 2, "+CC": 3}), "C=>-A/-A(5;-A:3,-A:4,bad,x:y)": ("C", "-A/-A", 5, "indel", "hom", {"-A": 4})}
    none = ["", "A", "A=>", "A=>G", "A=>G(", "A=>G(9", "A=>G(9;", "A=>G(9;)", "A=>G(;G:9)", "A=>G(x;G:9)", "=>G(9;G:9)", "A=>(9;G:9)", "A=B=>G(9;G:9)", "A=>G(9)", "A=>G(99999999999;G:9)", "A=>G[9;G:9]"]
    df = spark.createDataFrame([(x,) for x in [*cases, *none]], "d string").withColumn("c", calls.call(F.col("d")))
    got = {r.d: (r.ref, r["var"], r.depth, r.kind, r.hom, r.obs) for r in df.select("d", "c.*", calls.kind(F.col("c.var")).alias("kind"), calls.zygosity(F.col("c.var")).alias("hom"), calls.observed(F.col("c.counts")).alias("obs")).where("ref is not null").collect()}
    assert got == cases
    kinds = spark.createDataFrame([(x,) for x in ["A", "n", "AC", "*", "+", "*/+A", "A/", "/A", "+A/-C", "A!/C", "*/+A/-C"]], "v string").select("v", calls.kind(F.col("v"))).collect()
    assert {k: v for k, v in kinds if v} == {"A": "snp", "n": "snp", "*/+A": "indel", "+A/-C": "indel", "*/+A/-C": "indel"}


def test_snp_ids(spark):
    rows = ["chr12:51696879.GC.uc001ryg.2", "chrX:5.A.t", "12:5.A.t", "chr1:x.A.t", "chr1:5.A", "chr1:5", "", None]
    got = spark.createDataFrame([(x,) for x in rows], "t string").select(F.array(*(c.cast("string") for c in calls.snp_id(F.col("t"))))).collect()
    assert [r[0] for r in got] == [["chr12", "51696879", "GC", "uc001ryg.2"], ["chrX", "5", "A", "t"], *[[None] * 4] * 6]


def test_predictions(spark, tmp_path):
    (tmp_path / "p.txt").write_text("#Comments \t o_snp_id\tprediction\nv1;tag;novel\t chr1:5.AC.uc1.2 \tbenign\n# remark\nv2\tnonsense\n")
    got = [tuple(r) for r in text.read_predictions(spark, str(tmp_path / "p.txt")).select("line", "var_id", "tag", "status", "tx_id", "prediction").orderBy("line").collect()]
    assert got == [(2, "v1", "tag", "novel", "uc1.2", "benign"), (4, "v2", None, None, None, None)]


def test_first_and_last_rows_from_files(spark, tmp_path):
    """The four rules of first and last rows, by the files' own line numbers."""
    (tmp_path / "ensGtp.txt").write_text("g1\tt1\tp\ng2\tt1\tp\n\tt1\tp\ng3\tt2\tp\n")
    genes = text.gene_map(text.read_numbered(spark, str(tmp_path / "ensGtp.txt")).rows["row"], "id", "gene", "line")
    assert {tuple(r) for r in genes.collect()} == {("t1", "g2"), ("t2", "g3")}
    (tmp_path / "s.vbed").write_text("chr1\t5\t6\tA=>G(9;G:9)\t70\t+\nchr1\t5\t6\tA=>G(8;G:8)\t60\t+\n")
    v = text.read_vbed(spark, str(tmp_path / "s.vbed")).rows["call"].withColumn("sample", F.lit("s")).withColumnRenamed("ordinal", "idx")
    assert [(r.qual, r.idx) for r in annotate.parse_vbed(v).collect()] == [(70, 1)]


def test_heads_and_pushed_filters(spark, tmp_path):
    """The first records of a file cost no more than themselves; filters on path and place open few ranges."""
    record = lambda i: f"@r{i}/1\nACGT\n+\nIIII\n"
    (tmp_path / "a.x.1.fastq.00000").write_text("".join(map(record, range(30))))
    (tmp_path / "a.x.1.fastq.00001").write_text("".join(map(record, range(30, 5000))))
    (tmp_path / "b.x.1.fastq").write_text("".join(map(record, range(7))))
    reader = FastqReader(str(tmp_path), 1000, head=50)
    seen = []
    lines_of = reader.lines
    reader.lines = lambda path, start=0: (seen.append(x) or x for x in lines_of(path, start))
    parts = reader.partitions()
    got = [n for p in parts for b in reader.read(p) for n in b.column("name").to_pylist()]
    assert len(parts) == 2 and sorted(got) == sorted([f"@r{i}/1" for i in range(50)] + [f"@r{i}/1" for i in range(7)]) and len(seen) <= 4 * 57 + 1
    assert text.read_fastq(spark, str(tmp_path), head=50).count() == 57
    whole = text.read_fastq(spark, str(tmp_path))
    place = {r.name: r.ordinal for r in whole.where(F.col("path").endswith(".00001")).collect()}
    path = f"{tmp_path}/a.x.1.fastq.00001"
    few = whole.where((F.col("path") == path) & (F.col("ordinal") >= place["@r700/1"]) & (F.col("ordinal") < place["@r900/1"]))
    assert sorted(r.name for r in few.collect()) == [f"@r{i}/1" for i in range(700, 900)]
    pushed = FastqReader(str(tmp_path), 1000)
    EqualTo, AtLeast, Less = (type(n, (), {"__init__": lambda self, a, v: self.__dict__.update(attribute=a, value=v)}) for n in ("EqualTo", "GreaterThanOrEqual", "LessThan"))
    left = list(pushed.pushFilters([EqualTo(("path",), path), AtLeast(("ordinal",), 20_000), Less(("ordinal",), 23_000)]))
    assert len(left) == 3 and {p.value[0][:2] for p in pushed.partitions()} == {(path, a) for a in (20_000, 21_000, 22_000)}
