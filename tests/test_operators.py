"""Hand-made rows, one case for each edge."""

import re

from pyspark.sql import functions as F

from readloom.functions import calls
from readloom.functions import exprs as X
from readloom.functions.constants import CODONS, CONTIGS
from readloom.operators import annotate, calling, coverage, intervals, reads, rollup
from readloom.sources import text
from readloom.sources.fastq import FastqReader, records


def col(spark, rows, expr, names="a string"):
    return [r[0] for r in spark.createDataFrame(rows, names).select(expr).collect()]


def test_contigs_and_codons():
    assert len(CONTIGS) == 93 and CONTIGS[9:11] == ["chr5", "chr6"] and CONTIGS[53] == "chrM"
    assert CODONS["ATG"] == "M" and CODONS["TGA"] == "X" and CODONS["AGA"] == "R" and len(CODONS) == 64


def test_bases_parser(spark):
    rows = [("^].,$",), ("..+2ACg",), (".-12ACGTACGTACGT,",), ("*",), ("^+.",), ("^$,",), ("",)]
    assert col(spark, rows, X.bases_only(F.col("a"))) == [".,", "..g", ".,", "*", ".", ",", ""]
    got = spark.createDataFrame([("A", ".,gG*tA")], "r string, b string").select(X.count_text(X.allele_counts(F.col("r"), F.col("b")))).first()[0]
    assert got == "A:3,D:1,G:2,T:1"


def test_translate_and_complement(spark):
    assert col(spark, [("ATGTAAC",), ("",), ("AT",), ("ANN",)], X.translated(F.col("a"))) == ["MX", "", "", ""]
    assert col(spark, [("AaCcNgT",)], X.reverse_complement(F.col("a"))) == ["ACNGGTT"]


def test_overlap(spark):
    rows = [(1, 5, 6, 9), (1, 5, 5, 9), (1, 9, 3, 4), (3, 4, 1, 9), (5, 4, 4, 4), (5, 4, 6, 6)]
    got = spark.createDataFrame(rows, "a int, b int, c int, d int").select(X.overlap(*map(F.col, "abcd"))).collect()
    assert [r[0] for r in got] == [0, 1, 2, 2, 1, 0]


def test_reject_cascade(spark):
    good, off = "A" * 50, 33
    cases = [("A" * 39, "I" * 39, "too_short"), ("A" * 40, "I" * 40, None), ("N" * 4 + "A" * 46, "I" * 50, None), ("N" * 5 + "A" * 45, "I" * 50, "too_many_N"), (good, "&" * 5 + "I" * 45, None), (good, "&" * 6 + "I" * 44, "under10"), (good, "4" * 10 + "I" * 40, None), (good, "4" * 11 + "I" * 39, "under20"), (good, "I" * 39 + "#" * 11, "too_short"), (good, "#" * 50, "too_short")]
    rows = [("s", "a", 1, i, f"@r{i}/1", s, q) for i, (s, q, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "sample string, run string, dir int, ordinal int, name string, seq string, qual string")
    got = {r.ordinal: r.reason for r in reads.classified(df, offset=off).collect()}
    assert got == {i: c[2] for i, c in enumerate(cases)}


def test_routing(spark):
    rows = [("s", "a", d, i, f"@{n}/{d}", "A" * 50, ("I" if ok else "!") * 50) for i, (n, d, ok) in enumerate([("p", 1, 1), ("p", 2, 1), ("q", 1, 1), ("q", 2, 0), ("r", 1, 0), ("r", 2, 0), ("t", 1, 1)])]
    df = spark.createDataFrame(rows, "sample string, run string, dir int, ordinal int, name string, seq string, qual string")
    got = {(r.name, r.out) for r in reads.routed(reads.classified(df, offset=33)).collect()}
    assert got == {("@p/1", "1"), ("@p/2", "2"), ("@q/1", "S")}


def test_merge_and_points(spark):
    regions = spark.createDataFrame([("chr1", 10, 20), ("chr1", 20, 30), ("chr1", 15, 18), ("chr1", 40, 50), ("chr1", 40, 50), ("chr2", 5, 5)], "chr string, start int, stop int")
    merged = intervals.merge(regions, ["chr"])
    assert {tuple(r) for r in merged.select("chr", "start", "stop").collect()} == {("chr1", 10, 30), ("chr1", 40, 50)}
    points = spark.createDataFrame([("chr1", p) for p in (9, 10, 29, 30, 49, 50)], "chr string, pos int")
    for size in (1, 7, 1024):
        got = {r.pos for r in intervals.points_in(points, F.col("pos"), merged, size).collect() if r.start is not None}
        assert got == {10, 29, 49}


def test_base80(spark):
    sites = spark.createDataFrame([("s", "chr1", p, "A", "A", 40, 40, 40, d, "", 0) for p, d in enumerate([1, 2, 2, 3, 4])], "sample string, chr string, pos int, ref string, cons string, con_q int, var_q int, map_q int, depth int, bases string, pk int")
    regions = spark.createDataFrame([("chr1", 0, 5)], "chr string, start int, stop int")
    cube = coverage.cube(sites, regions)
    # cum: 5, 4, 2, 1; the first below 0.8 of 5 follows depth 2.
    assert coverage.base80(cube, coverage.target_size(regions)).first()["base80"] == 2.0
    assert [r.cum for r in coverage.cumulative(cube).where("scope = 'bed'").orderBy("depth").collect()] == [5, 4, 2, 1]


def test_indels(spark):
    rows = [("s", "chr1", 100, "*/+A", 40, 40, 40, 20, "*", "+A", 10, 10, 0), ("s", "chr1", 200, "-AC/-AC", 40, 40, 40, 16, "-AC", "-AC", 0, 12, 2), ("s", "chr1", 300, "*/+A", 40, 40, 40, 11, "*", "+A", 1, 10, 0), ("s", "chr1", 400, "*/+A", 40, 40, 40, 16, "*", "+A", 10, 3, 3), ("s", "chr1", 500, "*/+A", 40, 40, 40, 12, "*", "+A", 10, 2, 0)]
    df = spark.createDataFrame(rows, "sample string, chr string, pos int, genotype string, con_q int, var_q int, map_q int, depth int, allele1 string, allele2 string, n1 int, n2 int, n_other int")
    x = calling.indels(df)
    assert {(r.pos, r.sta, r.stop, r.call_stop, r.hom_het) for r in x.collect()} == {(100, 99, 99, 100, "het"), (200, 200, 202, 201, "hom")}
    assert {(r.ref, r.alt, r.type) for r in calling.indel_calls(x).collect()} == {("-", "A", "ins"), ("AC", "-", "del")}


def test_vbed_rows(spark):
    lines = [("chr7", 40, 41, "T=>C(9;C:9)", 51), ("chr7", 90, 90, "A=>*/+GTT(30;*:18,+GTT:12)", 77), ("chr7", 12, 13, "C=>R(20;A:11,G:9)", 60), ("chr7", 1, 2, "nonsense", 1)]
    df = spark.createDataFrame(lines, "chr string, sta int, stop int, descr string, qual int").withColumn("sample", F.lit("s")).withColumn("idx", F.col("sta").cast("long"))
    got = {r.sta: (r.var_type, r.hom_het, r.alleles, r.stop) for r in annotate.parse_vbed(df).collect()}
    assert got == {40: ("snp", "hom", ["C"], 41), 90: ("indel", "het", ["*", "+GTT"], 92), 12: ("snp", "het", ["A", "G"], 13)}
    assert annotate.bad_vbed(df).count() == 1


def test_known_windows(spark):
    rows = [(1, "chr1", 10, 10, "insertion", "-", "-/ACG"), (2, "chr1", 10, 11, "single", "+", "A/G"), (3, "chr1", 1, 2, "single", "+", "lengthTooLong")]
    got = {r.line: (r.x_sta, r.x_stop, r.obs_set) for r in annotate.known_windows(spark.createDataFrame(rows, "line int, chr string, sta int, stop int, class string, strand string, obs string")).collect()}
    assert got == {1: (7, 13, ["*", "CGT"]), 2: (10, 11, ["A", "G"])}


def test_fastq_records():
    text = ["junk", "@a/1", "ACGT", "+", "@III", "@b/1", "A", "+b", "I"]
    assert list(records(enumerate(text))) == [(1, "@a/1", "ACGT", "@III"), (5, "@b/1", "A", "I")]


def test_fastq_ranges(tmp_path):
    """Whatever the ranges, each record is read once; qualities may begin with '@' or '+'."""
    want = [(f"@r{i}/1", "ACGT" * (i % 5 + 1), ("@+I!"[i % 4] + "@II") * (i % 5 + 1)) for i in range(40)]
    (tmp_path / "s1.runA.PE.fastq").write_text("junk\n" + "".join(f"{n}\n{s}\n+\n{q}\n" for n, s, q in want))
    for size in (1, 7, 40, 101, 100_000):
        reader = FastqReader(str(tmp_path), size)
        got = [r for p in reader.partitions() for b in reader.read(p) for r in zip(*(b.column(c).to_pylist() for c in ("name", "seq", "qual")))]
        assert got == want


def test_sources_name_samples(spark, tmp_path):
    for name in ("s1.runA.PE.fastq", "s2.runB.PE.fastq"):
        (tmp_path / name).write_text("@a/1\nACGT\n+\nIIII\n")
    got = text.with_sample(text.read_fastq(spark, str(tmp_path)))
    assert {(r["sample"], r["run"], r["seq"]) for r in got.collect()} == {("s1", "runA", "ACGT"), ("s2", "runB", "ACGT")}


def test_repeated_pair_names(spark):
    rows = [("s", "a", d, i, f"@p/{d}", "A" * 50, ("I" if ok else "!") * 50) for i, (d, ok) in enumerate([(1, 1), (2, 1), (1, 1), (2, 0), (1, 1)])]
    df = spark.createDataFrame(rows, "sample string, run string, dir int, ordinal int, name string, seq string, qual string")
    x = reads.classified(df, offset=33)
    assert sorted((r.ordinal, r.out) for r in reads.routed(x).collect()) == [(0, "1"), (1, "2"), (2, "S")]
    assert sorted((r.pass1, r.pass2) for r in reads.mates(x).collect()) == [(True, False), (True, True)]


def test_stored_database_stays_in_its_buckets(spark, tmp_path):
    rows = [("chr1", i % 50, i % 50, "A", "C" if i % 3 else "G", i / 200) for i in range(200)]
    db = spark.createDataFrame(rows, "chr string, start int, stop int, ref string, alt string, score double")
    annotate.store_database(db, "scores_of_a_test", f"file://{tmp_path}/scores", 4)
    calls = spark.createDataFrame([(f"c{i}", "chr1", i, i, "A", "C") for i in range(0, 80, 3)], "call_id string, chr string, start int, stop int, ref string, alt string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for threshold, reverse in ((None, False), (0.5, False), (0.5, True)):
            out = annotate.database_filter(calls, spark.table("scores_of_a_test"), threshold, reverse)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1, plan
            fits = lambda s: threshold is None or (s <= threshold if reverse else s >= threshold)
            best = {}
            for c, a, b, ref, alt, s in rows:
                if fits(s) and (ref, alt) == ("A", "C"):
                    best[a] = max(s, best.get(a, s))
            assert {(r.call_id, r.kind, r.score) for r in out.collect()} == {(f"c{i}", "dropped" if i in best else "filtered", best.get(i)) for i in range(0, 80, 3)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE scores_of_a_test")


def test_duration_of_a_hundred_days_and_more(spark):
    df = spark.createDataFrame([(0,), (86399,), (100 * 86400 + 3661,), (None,)], "s long")
    assert [r[0] for r in df.select(X.duration(F.col("s"))).collect()] == ["00-00:00:00", "00-23:59:59", "100-01:01:01", None]


PAIR = "v_sample string, v_var_id string, v_sta int, v_stop int, v_var_type string, v_hom_het string, v_status string, tx_id string, strand string, sta int, stop int, c_sta int, c_end int, e_sta array<int>, e_end array<int>"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ties_of_one_transcript(spark):
    tx = ("t", "-", 2000, 2300, 2010, 2290, [2000, 2200], [2100, 2300])
    rows = [("s", v, a, b, kind, "het", "novel", *tx) for v, a, b, kind in (("up", 2400, 2401, "snp"), ("down", 1500, 1501, "snp"), ("utr", 2000, 2001, "snp"), ("ss", 2100, 2101, "snp"), ("long", 2098, 2203, "indel"))]
    got = {}
    for r in annotate.ties(spark.createDataFrame(rows, PAIR)).collect():
        got.setdefault(r.var_id, []).append((r.tag, r.exon_no))
    key = lambda x: (x[0], -1 if x[1] is None else x[1])
    assert {v: sorted(t, key=key) for v, t in got.items()} == {
        "up": [("upStr", None)],
        "down": [("dnStr", None)],
        "utr": [("5pUTR", None), ("cGene", None), ("exon", 0), ("utr3_stranded", None)],
        "ss": [("cGene", None), ("candidateGenes", 0), ("intron", 1), ("ss", 0)],
        "long": [("cGene", None), *[("cIndel", i) for i in (0, 1)], *[("candidateGenes", i) for i in (0, 0, 1, 1)], *[("cds", i) for i in (0, 1)], *[("exon", i) for i in (0, 1)], ("intron", 1), ("ss", 0), ("ss", 1)],
    }


def test_ties_are_compiled(spark):
    """HotSpot leaves methods of over 8,000 bytes to its interpreter, as Spark does functions of lambdas."""
    df = annotate.ties(spark.createDataFrame([], PAIR))
    assert "lambda" not in optimized(df)
    code = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    assert all(int(n) < 8000 for n in re.findall(r"maxMethodCodeSize:(\d+)", code))


def test_rows_are_parsed_once(spark):
    sites = spark.createDataFrame([], "sample string, chr string, pos int, ref string, cons string, con_q int, var_q int, map_q int, depth int, bases string")
    assert optimized(calling.snv_vbed(calling.snvs(sites))).count("regexp_replace") <= 4
    vbed = spark.createDataFrame([], "sample string, idx long, chr string, sta int, stop int, descr string, qual int")
    assert optimized(annotate.parse_vbed(vbed)).count("split(") <= 30


def test_last_of_an_allele_counts(spark):
    rows = [("A:1,C:2",), ("a:1,C:2,A:3,C:x",), ("A:1,A:2,A:3",), ("",)]
    assert col(spark, rows, calls.observed(F.col("a"))) == [{"A": 1, "C": 2}, {"A": 3, "C": 2}, {"A": 3}, {}]


def test_pairs_leave_out_what_only_lines_have(spark):
    v = spark.createDataFrame([("s", "v", 1, "chr1", 5, 6, "A", "C", 9, 40, "snp", "hom", ["C"], {"C": 9}, "novel")], "sample string, var_id string, idx long, chr string, sta int, stop int, ref string, var string, depth int, qual int, var_type string, hom_het string, alleles array<string>, observed map<string,int>, status string")
    t = spark.createDataFrame([("t", "chr1", "+", 1, 9, 1, 9, [1], [9])], "tx_id string, chr string, strand string, sta int, stop int, c_sta int, c_end int, e_sta array<int>, e_end array<int>")
    got = annotate.candidates(v, t)
    assert got.count() == 1 and not {"v_idx", "v_var", "v_depth", "v_qual", "v_observed"} & set(got.columns)


def test_ties_are_summed_once(spark):
    rows = [("s", "t", "cds", "hom", "known"), ("s", "t", "cds", "het", "novel"), ("s", "t", "cds", "het", "novel")]
    sums = rollup.transcript_sums(spark.createDataFrame(rows, "sample string, tx_id string, tag string, hom_het string, status string"))
    assert sorted(map(tuple, sums.select("grp", "any", "sum", "hom", "het").collect())) == [("all", 3, 2.0, 1, 2), ("known", 1, 1.0, 1, 0), ("novel", 2, 1.0, 0, 2)]
    plan = optimized(sums)
    assert plan.index("Generate") < plan.rindex("Aggregate")


def test_lists_describe_transcripts_and_genes(spark):
    lists = spark.createDataFrame([("variant", "t"), ("transcript", "1"), ("gene", "g")], "level string, id string").selectExpr("level", "'all' as grp", "'cds' as tag", "'s' as sample", "id")
    genes = spark.createDataFrame([(1, "g", "one"), (2, "g", "two")], "tx_id long, gene_id string, description string")
    got = rollup.id_lines(lists, genes)
    assert {r.level: r.value for r in got.collect()} == {"variant": "t", "transcript": "1\tone", "gene": "g\tone\ttwo"}


def test_counts_of_letters(spark):
    assert col(spark, [("AaCAN",), ("",), ("é*.,.",)], X.count_of(F.col("a"), "Aa")) == [3, 0, 0]
    assert col(spark, [("AaCAN",), ("é*.,.",)], X.count_of(F.col("a"), ".,")) == [0, 3]
    assert col(spark, [("AaCAN",)], X.count_of(F.col("a"), "ACN")) == [4]
