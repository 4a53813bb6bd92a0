"""Registered queries of the genomics jobs, by the ids of the inventory, with checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.constants import ALIASES, CANONICAL, CONTIGS
from ..operators import annotate, calling, coverage, genome, reads, rollup
from ..sources import named, ordered, text
from . import frames as made
from .checks import CALLABLE, HQ, codon, sql

QUERIES: dict = {}
SQL: dict[str, str] = {}


def q(name: str, f, check: str | None = None, *uses: str) -> None:
    """f takes Frames; check selects over the named checking tables."""
    QUERIES[name] = lambda spark, sf_dir: f(made.frames(spark, sf_dir))
    if check:
        SQL[name] = sql(check, *uses)


def long(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.col(c).cast("long"))
    return df


_CHR = "CASE {a} " + " ".join(f"WHEN '{a}' THEN '{c}'" for a, c in ALIASES.items()) + " ELSE {a} END"
_CANON = ", ".join(f"'{c}'" for c in CANONICAL)
_RANK = "CASE chr " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CONTIGS)) + " ELSE 999 END"
_DIM = "(VALUES " + ", ".join(f"('{c}', {i + 1})" for i, c in enumerate(CANONICAL)) + ") d(chr, idx)"
_IC = "SELECT sample, chr, pos AS start, {stop} AS stop, {ref} AS ref, {alt} AS alt, chr || ':' || pos || '-' || {stop} || '_' || {name} AS call_id, {type} AS type, depth, counts, con_q, var_q, map_q, hom_het"
SNV_CALLS = _IC.format(stop="pos", ref="ref", alt="alt", name="alt", type="'snv'") + " FROM (SELECT *, unnest(alts) AS alt FROM sv) x"
INDEL_CALLS = _IC.format(stop="call_stop", ref="CASE WHEN allele2[1] = '+' THEN '-' ELSE substring(allele2, 2) END", alt="CASE WHEN allele2[1] = '+' THEN substring(allele2, 2) ELSE '-' END", name="allele2", type="CASE WHEN del_len = 0 THEN 'ins' ELSE 'del' END") + " FROM ix"
CALL_TEXT = "SELECT sample, concat_ws(chr(9), chr, start, stop, ref, alt, 'id:' || call_id || ';type:' || type || ';covr:' || depth || ';cnts:(' || counts || ');snpQ:' || con_q || ';conQ:' || var_q || ';mapQ:' || map_q || ';' || hom_het) AS value FROM ({}) c"
VBED_DESCR = "ref || '=>' || upper(var) || '(' || depth || ';' || counts || ')'"

# Predicates and projections.
_RENAMED = "CASE WHEN pos % 2 = 0 THEN replace(chr, 'chr', '') WHEN pos % 7 = 0 THEN 'chr1_gl000191_random' ELSE chr END"
q("P1", lambda f: coverage.canonical(f.sites.withColumn("chr", F.when(F.col("pos") % 2 == 0, F.regexp_replace("chr", "^chr", "")).otherwise(F.when(F.col("pos") % 7 == 0, "chr1_gl000191_random").otherwise(F.col("chr"))))).select("sample", "chr", "pos"),
  "SELECT * FROM (SELECT sample, " + _CHR.format(a="c") + f" AS chr, pos FROM (SELECT sample, pos, {_RENAMED} AS c FROM sites) x) y WHERE chr IN ({_CANON})", "sites")
q("P2", lambda f: f.classified.select("sample", "name", "seq", "qual"), "SELECT sample, name, seq, qual FROM cl", "cl")
q("P3", lambda f: f.classified.select("sample", "name", "reason"), "SELECT sample, name, reason FROM cl", "cl")
q("P4", lambda f: f.classified.select("sample", "name", "present", "same_length"), "SELECT sample, name, length(name) > 0 AND length(seq) > 0 AND length(qual) > 0 AS present, length(seq) = length(qual) AS same_length FROM cl", "cl")
q("P4_warnings", lambda f: reads.warnings(f.classified), "SELECT sample, run, count(*) AS reads, count(*) FILTER (WHERE NOT (length(name) > 0 AND length(seq) > 0 AND length(qual) > 0)) AS incomplete, count(*) FILTER (WHERE length(seq) <> length(qual)) AS unequal, count(*) FILTER (WHERE (sample, run, pair_key) NOT IN (SELECT (sample, run, pair_key) FROM pr)) AS unpaired FROM cl GROUP BY sample, run", "cl", "pr")
q("P5", lambda f: f.sites.where(X.high_quality()).select("sample", "chr", "pos", "depth"), f"SELECT sample, chr, pos, depth FROM sites WHERE {HQ}", "sites")
q("P6", lambda f: f.sites.where(X.callable_site()).select("sample", "chr", "pos", "ref", "cons"), f"SELECT sample, chr, pos, ref, cons FROM sites WHERE {CALLABLE}", "sites")
q("P7", lambda f: f.snvs.select("sample", "chr", "pos", "ref", "code"), "SELECT sample, chr, pos, ref, cons AS code FROM sv", "sv")
q("P8", lambda f: f.called_indels.select("sample", "chr", "pos", "genotype", "n1", "n2"), "SELECT sample, chr, pos, genotype, n1, n2 FROM ix", "ix")
q("P9", lambda f: f.called_indels.select("sample", "chr", "pos", "sta", "stop", "call_stop", "del_len"), "SELECT sample, chr, pos, CAST(sta AS INT) AS sta, CAST(stop AS INT) AS stop, CAST(call_stop AS INT) AS call_stop, CAST(del_len AS INT) AS del_len FROM ix", "ix")
q("P10", lambda f: calling.snv_vbed(f.snvs), f"SELECT sample, chr, pos - 1 AS sta, pos AS stop, {VBED_DESCR} AS descr, var_q AS qual, '+' AS strand FROM (SELECT *, cons AS var FROM sv) x", "sv")
q("P11", lambda f: calling.indel_calls(f.called_indels), INDEL_CALLS, "ix")
q("P12", lambda f: annotate.known_windows(f.known).select("line", "x_sta", "x_stop", F.array_join("obs_set", ",").alias("obs_set")), "SELECT line, x_sta, x_stop, array_to_string(obs_set, ',') AS obs_set FROM kw", "kw")
q("P13", lambda f: annotate.eligible(f.transcripts).select("tx_id"), "SELECT tx_id FROM transcripts JOIN cl3 USING (tx_id) WHERE c_sta = c_end OR cds_len % 3 = 0", "transcripts", "cl3")
q("P14", lambda f: f.transcripts.select("tx_id", annotate.cds_length().cast("long").alias("cds_len")), "SELECT tx_id, cds_len FROM cl3", "cl3")

# Joins.
q("J1", lambda f: reads.mates(f.classified), "SELECT sample, run, pair_key, pass1, pass2 FROM pr", "pr")
q("J2", lambda f: coverage.flagged(f.sites, f.regions).select("sample", "chr", "pos", "in_bed", "hq"), "SELECT sample, chr, pos, in_bed, hq FROM fl", "fl")
q("J3", lambda f: f.hits, "SELECT sample, var_id, line FROM hi", "hi")
q("J4", lambda f: f.variants.select("sample", "var_id", "status"), "SELECT sample, var_id, status FROM vs", "vs")
q("J5", lambda f: f.pairs.select(F.col("v_sample").alias("sample"), F.col("v_var_id").alias("var_id"), "tx_id"), "SELECT sample, var_id, tx_id FROM ps", "ps")
q("J6", lambda f: f.canonical_tx.select("tx_id", "chr"), "SELECT tx_id, chr FROM transcripts WHERE tx_id % 3 <> 0", "transcripts")
q("J7", lambda f: genome.fetch(f.transcripts.select("tx_id", "chr", F.col("sta").alias("start"), (F.col("stop") - F.col("sta")).alias("len")), f.genome, ["tx_id"]).select("tx_id", "seq"),
  "SELECT tx_id, CASE WHEN count(*) = max(stop - sta) THEN string_agg(b, '' ORDER BY p) END AS seq FROM (SELECT tx_id, sta, stop, p, substring(seq, CAST(p % 256 + 1 AS INT), 1) AS b FROM (SELECT tx_id, chr, sta, stop, unnest(range(sta, stop)) AS p FROM transcripts) x JOIN genome g ON g.chr = x.chr AND g.chunk = x.p // 256) y GROUP BY tx_id", "transcripts", "genome")
q("J8", lambda f: rollup.without_gene(f.groups, f.genes), "SELECT DISTINCT sample, tx_id FROM gr WHERE tx_id NOT IN (SELECT tx_id FROM genes WHERE gene_id IS NOT NULL)", "gr", "genes")
q("J9", lambda f: rollup.prediction_ties(rollup.merged_predictions(f.predictions, f.effects.where("ref_aa <> alt_aa"))).select("sample", "var_id", "tx_id", "tag", "hom_het"),
  "SELECT * FROM (SELECT DISTINCT e.sample, e.var_id, e.tx_id, e.hom_het, e.status || '_polyphen-2' AS tag FROM ef e JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY var_id, tx_id ORDER BY line) AS rn FROM (SELECT DISTINCT var_id, tx_id, allele, rel_start % 3 AS m, rel_start * 8 + ascii(allele) % 8 AS line FROM ef WHERE ref_aa <> alt_aa) x) y WHERE rn = 1 AND m <> 0) p USING (var_id, tx_id, allele) WHERE ref_aa <> alt_aa) z", "ef")
q("J10", lambda f: coverage.per_chromosome(f.cube.where("chr <> 'chr3'"), f.sizes).select("sample", "chr", "coverage"), f"SELECT s.sample, d.chr, coalesce(CASE WHEN d.chr <> 'chr3' THEN coverage END, 0) AS coverage FROM (SELECT DISTINCT sample FROM sites) s CROSS JOIN {_DIM} LEFT JOIN tot t ON t.sample = s.sample AND t.scope = d.chr", "sites", "tot")
_J11 = f"SELECT sample, call_id, CASE WHEN score IS NULL THEN 'filtered' ELSE 'dropped' END AS kind, score FROM ({SNV_CALLS}) c LEFT JOIN (SELECT chr, stop AS start, left(obs, 1) AS ref, right(obs, 1) AS alt, max(line % 10 / 10) AS score FROM known WHERE class = 'single' AND obs LIKE '_/_' AND line % 10 / 10 {{}} GROUP BY ALL) k USING (chr, start, ref, alt)"
q("J11", lambda f: annotate.database_filter(calling.snv_calls(f.snvs), _scores(f), 0.3).select("sample", "call_id", "kind", "score"), _J11.format(">= 0.3"), "sv", "known")
q("J11_stored", lambda f: annotate.database_filter(calling.snv_calls(f.snvs), _stored_scores(f), 0.6, reverse=True).select("sample", "call_id", "kind", "score"), _J11.format("<= 0.6"), "sv", "known")


def _scores(f):
    """A database of scores of single-base changes."""
    one = f.known.where("class = 'single' and obs like '_/_'")
    return one.select("chr", F.col("stop").alias("start"), "stop", F.substr("obs", F.lit(1), F.lit(1)).alias("ref"), F.substr("obs", F.lit(3), F.lit(1)).alias("alt"), (F.col("line") % 10 / 10).alias("score"))


def _stored_scores(f):
    path = made.shared(f.spark, "scores")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    annotate.store_database(_scores(f), name, path, 8)
    return f.spark.table(name)


_PIECES = "SELECT tx_id, chr, 'exon' AS kind, es AS a, ee AS b FROM ex UNION ALL SELECT tx_id, chr, 'cds', lo, hi FROM ex WHERE lo < hi UNION ALL SELECT tx_id, chr, 'splice', ee, ee + 2 FROM ex WHERE i < n - 1 UNION ALL SELECT tx_id, chr, 'splice', es - 2, es FROM ex WHERE i > 0"
_PPOS = f"SELECT DISTINCT tx_id, chr, kind, unnest(range(a, b)) AS p FROM ({_PIECES}) z"
q("J12", lambda f: coverage.gene_pieces(f.transcripts), f"SELECT tx_id, chr, kind, a AS start, b AS stop FROM ({_PIECES}) z", "ex")

# Aggregations: reads.
_AG1 = "SELECT sample, run, CAST(sum(len(list_filter(string_split(qual, ''), lambda c: c <> '' AND ascii(c) < 63))) AS BIGINT) AS n33, CAST(sum(len(list_filter(string_split(qual, ''), lambda c: c <> '' AND ascii(c) > 74))) AS BIGINT) AS n64, CASE run WHEN 'a' THEN 33 ELSE 64 END AS \"offset\" FROM (SELECT *, row_number() OVER (PARTITION BY sample, run, dir ORDER BY ordinal) AS rn FROM reads) x WHERE rn <= 250 GROUP BY sample, run"
q("AG1", lambda f: reads.offsets(f.reads).select("sample", "run", "n33", "n64", "offset"), _AG1, "reads")
q("AG1_heads", lambda f: reads.offsets_of(text.with_sample(text.read_fastq(f.spark, _mate_files(f), head=reads.HEAD))).select("sample", "run", "n33", "n64", "offset"), _AG1, "reads")
q("AG2", lambda f: reads.rejected(f.classified), "SELECT sample, reason, reads, (100 * reads / t) AS pct FROM (SELECT sample, reason, count(*) AS reads, sum(count(*)) OVER (PARTITION BY sample) AS t FROM cl GROUP BY sample, reason) x WHERE reason IS NOT NULL", "cl")
q("AG2_totals", lambda f: reads.totals(f.classified), "SELECT sample, count(*) AS reads, CAST(sum(bases) AS BIGINT) AS bases FROM cl GROUP BY sample", "cl")
q("AG3", lambda f: reads.passed(f.classified), """SELECT x.sample, x.out, x.reads, (100 * x.reads / p.reads) AS reads_pct_passed, (100 * x.reads / t.reads) AS reads_pct_all, x.bases, (100 * x.bases / p.bases) AS bases_pct_passed, (100 * x.bases / t.bases) AS bases_pct_all
  FROM (SELECT sample, out, count(*) AS reads, CAST(sum(len) AS BIGINT) AS bases FROM ro GROUP BY ALL UNION ALL SELECT sample, 'total', count(*), CAST(sum(len) AS BIGINT) FROM ro GROUP BY sample) x JOIN (SELECT sample, count(*) AS reads, sum(len) AS bases FROM ro GROUP BY sample) p USING (sample) JOIN (SELECT sample, count(*) AS reads, sum(bases) AS bases FROM cl GROUP BY sample) t USING (sample)""", "ro", "cl")
_NP = "(SELECT sample, count(*) AS np FROM ro GROUP BY sample) p"
q("AG4", lambda f: reads.length_histogram(f.classified), f"SELECT sample, len, count(*) AS reads, (100 * count(*) / max(np)) AS pct FROM cl JOIN {_NP} USING (sample) WHERE reason IS NULL GROUP BY sample, len", "cl", "ro")
q("AG5", lambda f: reads.gc_histogram(f.classified), f"SELECT sample, gc, count(*) AS reads, (100 * count(*) / max(np)) AS pct FROM (SELECT sample, CAST(floor(least(round_even(100 * length(regexp_replace(seq, '[^GCgc]', '', 'g')) / len, 1), 99.99999) / 4) * 4 + 2 AS DOUBLE) AS gc FROM cl WHERE reason IS NULL) x JOIN {_NP} USING (sample) GROUP BY sample, gc", "cl", "ro")
q("AG6", lambda f: reads.position_profile(f.classified), "SELECT sample, CAST(p AS INT) AS pos, (sum(ascii(substring(qual, CAST(p AS INT), 1)) - offs) / count(*)) AS mean_quality, count(*) FILTER (WHERE upper(substring(seq, CAST(p AS INT), 1)) = 'N') AS n, (100 * count(*) FILTER (WHERE upper(substring(seq, CAST(p AS INT), 1)) = 'N') / count(*)) AS n_pct, count(*) AS bases FROM (SELECT *, unnest(range(1, length(qual) + 1)) AS p FROM cl WHERE reason IS NULL) x GROUP BY sample, p", "cl")

# Aggregations: coverage.
q("AG7", lambda f: long(coverage.depth_histogram(f.cube), "positions"), "SELECT sample, scope, depth, count(*) AS positions FROM sc GROUP BY ALL", "sc")
q("AG8", lambda f: coverage.totals(f.cube), "SELECT * FROM tot", "tot")
q("AG9", lambda f: f.target, "SELECT * FROM beds", "beds")
_W = "SELECT t.sample, bed_positions, covered_positions AS np, coverage AS cov, hq_positions AS hq, coalesce(b.c, 0) AS bc, coalesce(b.h, 0) AS bh, g, base80 FROM tot t CROSS JOIN beds CROSS JOIN (SELECT sum(size) AS g FROM sizes) z LEFT JOIN (SELECT sample, coverage AS c, hq_positions AS h FROM tot WHERE scope = 'bed') b ON b.sample = t.sample LEFT JOIN b80 ON b80.sample = t.sample WHERE scope = 'all'"
q("AG10", lambda f: coverage.summary(f.cube, f.target, f.sizes), f"SELECT sample, bed_positions, np AS pileup_positions, cov AS coverage, CAST(g AS BIGINT) AS genome_size, (cov / g) AS mean_genome, (cov / np) AS mean_covered, (bc / bed_positions) AS mean_bed, hq AS hq_positions, (hq / g) AS hq_genome, (hq / np) AS hq_covered, bh AS hq_bed_positions, (bh / bed_positions) AS hq_bed, bc AS coverage_bed, (bc / nullif(cov, 0)) AS coverage_share, (bh / nullif(hq, 0)) AS hq_share, base80 AS base80, (bc / bed_positions / nullif(base80, 0)) AS base80_penalty FROM ({_W}) w", "tot", "beds", "sizes", "b80")
q("AG11", lambda f: genome.with_total(f.sizes), "SELECT chr, size FROM sizes UNION ALL SELECT 'Total_size', CAST(sum(size) AS BIGINT) FROM sizes", "sizes")
q("AG12", lambda f: coverage.per_chromosome(f.cube, f.sizes), f"SELECT s.sample, d.idx, d.chr, coalesce(z.size, 0) AS size, coalesce(hq_positions, 0) AS hq_positions, coalesce(coverage, 0) AS coverage, (coalesce(coverage, 0) / nullif(z.size, 0)) AS mean FROM (SELECT DISTINCT sample FROM sites) s CROSS JOIN {_DIM} LEFT JOIN tot t ON t.sample = s.sample AND t.scope = d.chr LEFT JOIN sizes z ON z.chr = d.chr", "sites", "tot", "sizes")
q("AG16", lambda f: coverage.gene_coverage(f.sites, f.transcripts), f"SELECT s.sample, tx_id, kind, count(DISTINCT (chr, p)) AS bases, CAST(coalesce(sum(depth), 0) AS BIGINT) AS coverage, (coalesce(sum(depth), 0) / count(*)) AS mean_depth, (count(*) FILTER (WHERE hq) / count(*)) AS hq_fraction FROM ({_PPOS}) y CROSS JOIN (SELECT DISTINCT sample FROM sites) s LEFT JOIN (SELECT sample, chr, pos - 1 AS p, depth, {HQ} AS hq FROM sites) t USING (sample, chr, p) GROUP BY s.sample, tx_id, kind", "ex", "sites")

# Aggregations: calls.
_ALT = "SELECT sample, CAST(floor(100 * ((depth - ref_reads) / (depth + 1e-9))) AS BIGINT) AS p FROM pc"
q("AG13", lambda f: calling.snv_summary(f.snvs), "SELECT sample, count(*) AS snvs, count(*) FILTER (WHERE hom_het = 'hom') AS hom, count(*) FILTER (WHERE hom_het = 'het') AS het, CAST(sum(len(list_filter(alts, lambda a: ref || a IN ('AG', 'GA', 'CT', 'TC')))) AS BIGINT) AS transitions, CAST(sum(len(list_filter(alts, lambda a: ref || a NOT IN ('AG', 'GA', 'CT', 'TC')))) AS BIGINT) AS transversions FROM sv GROUP BY sample", "sv")
q("AG14", lambda f: calling.base_changes(f.snvs), "SELECT sample, ref, " + ", ".join(f"count(*) FILTER (WHERE alt = '{b}') AS \"{b}\"" for b in "ACGT") + " FROM (SELECT sample, ref, unnest(alts) AS alt FROM sv) x GROUP BY sample, ref", "sv")
q("AG14_codes", lambda f: calling.code_changes(f.snvs), "SELECT sample, ref, cons AS code, count(*) AS n FROM sv GROUP BY ALL", "sv")
q("AG15", lambda f: calling.allele_ranks(f.sites), "SELECT sample, CAST(alleles AS INT) AS alleles, CAST(rank AS INT) AS rank, count(*) AS sites, CAST(sum(CAST(round(100 * round_even(100 * n / (depth + 1e-9), 2)) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS mean_pct FROM (SELECT sample, depth, n, count(*) OVER w AS alleles, row_number() OVER (PARTITION BY sample, chr, pos ORDER BY n DESC, base) AS rank FROM al WINDOW w AS (PARTITION BY sample, chr, pos)) x GROUP BY ALL", "al")
q("AG17", lambda f: calling.alternative_share(f.sites), f"SELECT z.sample, z.pct, count(y.p) AS sites FROM (SELECT sample, unnest(range(0, max(p) + 1)) AS pct FROM ({_ALT}) y GROUP BY sample) z LEFT JOIN ({_ALT}) y ON y.sample = z.sample AND y.p = z.pct GROUP BY z.sample, z.pct", "pc")
q("AG18", lambda f: calling.indel_summary(f.called_indels), "SELECT sample, CASE WHEN allele2[1] = '+' THEN 'insertion' ELSE 'deletion' END AS kind, CAST(length(allele2) - 1 AS INT) AS length, count(*) AS n FROM ix GROUP BY ALL", "ix")

# Aggregations: annotation.
_ONCE = "(SELECT DISTINCT sample, var_id, tag, status FROM ti) x"
q("AG19", lambda f: rollup.variant_report(f.ties), f"SELECT sample, tag, count(*) AS variants, count(*) FILTER (WHERE status = 'known') AS known, count(*) FILTER (WHERE status = 'novel') AS novel FROM {_ONCE} GROUP BY sample, tag", "ti")
q("AG19_types", lambda f: rollup.variant_counts(f.variants), "SELECT sample, vt AS var_type, count(*) AS variants, count(*) FILTER (WHERE status = 'known') AS known, count(*) FILTER (WHERE status = 'novel') AS novel, (count(*) FILTER (WHERE status = 'known') / count(*)) AS known_share, (1 - count(*) FILTER (WHERE status = 'known') / count(*)) AS novel_share FROM (SELECT *, unnest([var_type, 'all']) AS vt FROM vs) x GROUP BY sample, vt", "vs")
q("AG20", lambda f: rollup.tag_combinations(f.variants, f.ties), "SELECT sample, tags, count(*) AS variants FROM (SELECT v.sample, v.var_id, coalesce(string_agg(DISTINCT tag, '_' ORDER BY tag), 'no_annotations') AS tags FROM vs v LEFT JOIN ti USING (sample, var_id) GROUP BY v.sample, v.var_id) x GROUP BY ALL", "vs", "ti")
q("AG21", lambda f: f.sums, 'SELECT sample, tx_id, grp, tag, "any", "sum", hom, het FROM su', "su")
q("AG22", lambda f: rollup.model_counts(f.groups), "SELECT sample, tag, " + ", ".join(f"count(*) FILTER (WHERE grp = '{g}') AS {g if g != 'all' else chr(34) + 'all' + chr(34)}" for g in rollup.GROUPS) + " FROM gr GROUP BY sample, tag", "gr")
q("AG23", lambda f: rollup.gene_counts(f.gene_groups), "SELECT sample, grp, tag, count(DISTINCT gene_id) AS genes FROM gg GROUP BY ALL", "gg")
q("AG23_candidates", lambda f: rollup.candidate_genes(f.gene_groups), "SELECT DISTINCT sample, gene_id FROM gg WHERE grp = 'novel_recessive' AND tag = 'candidateGenes'", "gg")
q("AG24", lambda f: rollup.gene_descriptions(f.gene_groups), "SELECT sample, gene_id, string_agg(DISTINCT description, chr(9) ORDER BY description) AS descriptions FROM gg GROUP BY sample, gene_id", "gg")
q("AG25", lambda f: rollup.mutation_map(f.effects, f.predictions).select("sample", "tx_id", F.array_join(F.array_sort(F.map_keys("changes")), ",").alias("changes")), "SELECT sample, tx_id, string_agg(DISTINCT aa_change, ',' ORDER BY aa_change) AS changes FROM ef WHERE ref_aa <> alt_aa GROUP BY sample, tx_id", "ef")

# Windows, order, sets.
q("W1", lambda f: coverage.cumulative(f.cube), "SELECT sample, scope, depth, cum FROM cum", "cum")
q("W2", lambda f: coverage.targets(f.regions).select("chr", "start", "stop"), "SELECT chr, CAST(min(p) AS INT) AS start, CAST(max(p) + 1 AS INT) AS stop FROM (SELECT chr, p, p - row_number() OVER (PARTITION BY chr ORDER BY p) AS island FROM (SELECT DISTINCT chr, unnest(range(start, stop)) AS p FROM regions) x) y GROUP BY chr, island", "regions")
q("W3", lambda f: coverage.base80(f.cube, f.target), "SELECT sample, base80 FROM b80", "b80")
# First and last rows by the line numbers of files that were written in a known order.
q("W4", lambda f: _twice_called(f), "SELECT sample, var_id, qual + CASE WHEN sta % 3 = 0 THEN 1000 ELSE 0 END AS qual FROM va", "va")
q("W4_known", lambda f: _first_known(f), "SELECT sample, var_id, 'rs' || line AS name FROM hi", "hi")
q("W4_genes", lambda f: text.gene_map(text.read_numbered(f.spark, _gene_lines(f), "ensGtp").rows["row"], "id", "gene", "ordinal"),
  "SELECT 't' || tx_id AS tx_id, gene_id || '_' || CASE WHEN tx_id % 4 = 3 THEN 1 ELSE tx_id % 4 END AS gene_id FROM genes WHERE gene_id IS NOT NULL", "genes")
q("W4_predictions", lambda f: _first_predictions(f), "SELECT var_id, 'uc' || tx_id || '.1' AS tx_id, CASE WHEN sum(ascii(allele)) % 3 = 0 THEN 'second' ELSE 'first' END AS prediction FROM (SELECT DISTINCT var_id, tx_id, allele FROM ef WHERE ref_aa <> alt_aa) x GROUP BY var_id, tx_id", "ef")
q("W5", lambda f: f.effects.select("sample", "var_id", "tx_id", "allele", "exon_no", "rel_start"), "SELECT sample, var_id, tx_id, allele, exon_no, rel_start FROM ef", "ef")
q("W6", lambda f: calling.parsed(f.sites).select("sample", "chr", "pos", X.count_text(F.col("alleles"), True).alias("ranked")), "SELECT sample, chr, pos, string_agg(base || ':' || n, ',' ORDER BY n DESC, base) AS ranked FROM al GROUP BY ALL", "al")
q("O1", lambda f: ordered.with_ordinals(f.spark, _ordered_sites(f)).select("sample", "chr", "pos", "rank", "ordinal"), f"SELECT sample, chr, pos, {_RANK} AS rank, row_number() OVER (ORDER BY {_RANK}, pos) AS ordinal FROM sites", "sites")
q("O1_range", lambda f: ordered.read_range(f.spark, _ordered_sites(f), {"rank": 4, "pos": 500}, {"rank": 13, "pos": 2000}).select("sample", "chr", "pos"), f"SELECT sample, chr, pos FROM (SELECT *, {_RANK} AS rank FROM sites) x WHERE (rank > 4 OR rank = 4 AND pos >= 500) AND (rank < 13 OR rank = 13 AND pos <= 2000)", "sites")
q("O2", lambda f: reads.passed(f.classified).select("sample", "out", "reads"), "SELECT sample, out, count(*) AS reads FROM ro GROUP BY ALL UNION ALL SELECT sample, 'total', count(*) FROM ro GROUP BY sample", "ro")
q("O3", lambda f: coverage.histogram_report(f.cube, f.target, f.sizes).groupBy("sample").agg(F.max("depth").alias("last"), F.count("*").alias("rows")), "SELECT sample, CAST(least(max(depth), 500) AS INT) AS last, CAST(least(max(depth), 500) + 1 AS BIGINT) AS rows FROM sites GROUP BY sample", "sites")
q("O3_records", lambda f: text.with_sample(text.read_fastq(f.spark, _mate_files(f), head=reads.HEAD)).select("sample", "run", "name", "seq", "qual"), "SELECT sample, run, name, seq, qual FROM (SELECT *, row_number() OVER (PARTITION BY sample, run, dir ORDER BY ordinal) AS rn FROM reads) x WHERE rn <= 250", "reads")
q("U1", lambda f: _pooled_sets(f), "SELECT sample, run, CASE WHEN out = 'S' THEN 'SE' ELSE 'PE' END AS read_set, name, seq, qual FROM ro", "ro")
q("U2", lambda f: f.routed.select("sample", "name", "out"), "SELECT sample, name, out FROM ro", "ro")
_U3 = "SELECT c.sample, c.depth, coalesce(b.cum, 0) AS n_bed, (100 * coalesce(b.cum, 0) / bed_positions) AS pct_bed, c.cum AS n_covered, (100 * c.cum / covered_positions) AS pct_covered, (100 * c.cum / g) AS pct_genome FROM cum c JOIN (SELECT * FROM tot WHERE scope = 'all') t ON t.sample = c.sample CROSS JOIN beds CROSS JOIN (SELECT sum(size) AS g FROM sizes) z LEFT JOIN (SELECT * FROM cum WHERE scope = 'bed') b ON b.sample = c.sample AND b.depth = c.depth WHERE c.scope = 'all' AND c.depth <= 500"
q("U3", lambda f: coverage.histogram_report(f.cube, f.target, f.sizes), f"{_U3} UNION ALL SELECT sample, 0, bed_positions, 100, covered_positions, 100, 100 FROM tot CROSS JOIN beds WHERE scope = 'all'", "cum", "tot", "beds", "sizes")
q("U4", lambda f: coverage.histogram_by_chromosome(f.cube, f.sizes), "SELECT sample, depth, " + ", ".join(f"coalesce(max(CASE WHEN scope = '{c}' THEN cum / size END), 0) AS {c}" for c in CANONICAL) + " FROM cum LEFT JOIN sizes ON chr = scope WHERE depth <= 500 GROUP BY sample, depth UNION ALL SELECT DISTINCT sample, 0, " + ", ".join("100.0" for _ in CANONICAL) + " FROM sites", "cum", "sizes", "sites")
q("U5", lambda f: f.snvs.select("sample", "chr", "pos", F.explode("alts").alias("alt")), "SELECT sample, chr, pos, unnest(alts) AS alt FROM sv", "sv")
q("U6", lambda f: f.ties.where("tag = 'candidateGenes'").select("sample", "var_id", "tx_id", "exon_no", "hom_het"), "SELECT sample, var_id, tx_id, exon_no, hom_het FROM ti WHERE tag IN ('ss', 'ns', 'cIndel')", "ti")

# Scalar expressions.
q("O-SC1", lambda f: f.genome.select("chr", "chunk", X.count_of(F.col("seq"), "N").cast("long").alias("n"), X.gc_fraction(F.col("seq")).alias("gc")), "SELECT chr, chunk, length(seq) - length(replace(seq, 'N', '')) AS n, (length(regexp_replace(seq, '[^GCgc]', '', 'g')) / length(seq)) AS gc FROM genome", "genome")
q("O-SC2", lambda f: calling.parsed(f.sites).select("sample", "chr", "pos", X.count_text(F.col("alleles")).alias("counts"), F.col("parsed").cast("long").alias("parsed"), F.col("deletions").cast("long").alias("deletions"), "mismatch"), "SELECT sample, chr, pos, counts, parsed, deletions, parsed <> depth AS mismatch FROM pc", "pc")
q("O-SC2_warnings", lambda f: calling.warnings(f.sites), "SELECT sample, count(*) AS sites, count(*) FILTER (WHERE parsed <> depth) AS mismatched, CAST(sum(abs(parsed - depth)) AS BIGINT) AS bases_off FROM pc GROUP BY sample", "pc")
q("O-SC3", lambda f: f.called_indels.select("sample", "chr", "pos", X.count_text(F.col("alleles"), True).alias("counts")), "SELECT sample, chr, pos, counts FROM ix", "ix")
q("O-SC4", lambda f: f.genome.select("chr", "chunk", X.reverse_complement(F.col("seq")).alias("rc"), X.complement(F.lower("seq")).alias("c")), "SELECT chr, chunk, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc, translate(lower(seq), 'acgt', 'TGCA') AS c FROM genome", "genome")
q("O-SC5", lambda f: f.genome.select("chr", "chunk", X.translated(F.col("seq")).alias("protein")), f"SELECT chr, chunk, array_to_string(list_transform(range(0, length(seq) // 3), lambda i: {codon('substring(seq, CAST(i * 3 + 1 AS INT), 3)')}), '') AS protein FROM genome", "genome")
q("O-SC6", lambda f: f.sites.select("cons", F.array_join(X.iupac_bases(F.col("cons")), "").alias("bases"), X.iupac_code(F.concat("ref", "cons", "ref")).alias("code")).where("cons in ('A', 'C', 'G', 'T')").groupBy("cons", "bases", "code").agg(F.count("*").alias("n")),
  "SELECT cons, cons AS bases, CASE least(ref, cons) || greatest(ref, cons) WHEN 'AC' THEN 'M' WHEN 'AG' THEN 'R' WHEN 'AT' THEN 'W' WHEN 'CG' THEN 'S' WHEN 'CT' THEN 'Y' WHEN 'GT' THEN 'K' ELSE cons END AS code, count(*) AS n FROM sites WHERE cons IN ('A', 'C', 'G', 'T') GROUP BY ALL", "sites")
q("O-SC7", lambda f: f.sites.groupBy("ref", "cons").agg(F.count("*").alias("n")).withColumn("kind", X.change_class(F.col("ref"), F.col("cons"))), "SELECT ref, cons, count(*) AS n, CASE WHEN ref || cons IN ('AG', 'GA', 'CT', 'TC') THEN 'transition' WHEN ref <> cons AND cons IN ('A', 'C', 'G', 'T') THEN 'transversion' END AS kind FROM sites GROUP BY ref, cons", "sites")
q("O-SC8", lambda f: f.regions.select("chr", "start", "stop", X.overlap(F.col("start"), F.col("stop"), F.col("stop") + 3 - F.col("start") % 9, F.col("stop") - 6).alias("n")), "SELECT chr, start, stop, CAST(greatest(0, least(stop, greatest(stop + 3 - start % 9, stop - 6)) - greatest(start, least(stop + 3 - start % 9, stop - 6)) + 1) AS INT) AS n FROM regions", "regions")
q("O-SC9", lambda f: f.parsed_variants.select("sample", "var_id", "var_type", "hom_het"), "SELECT sample, var_id, var_type, hom_het FROM va", "va")
q("O-SC10", lambda f: f.transcripts.select("tx_id", X.duration(F.col("tx_id") * 977).alias("t"), F.bround(F.col("tx_id") / 16, 2).alias("r"), F.format_number(F.col("tx_id") * 1001, 0).alias("k")), "SELECT tx_id, printf('%02d-%02d:%02d:%02d', tx_id * 977 // 86400, tx_id * 977 // 3600 % 24, tx_id * 977 // 60 % 60, tx_id * 977 % 60) AS t, round_even(tx_id / 16, 2) AS r, format('{:,}', tx_id * 1001) AS k FROM transcripts", "transcripts")

# Annotation.
for _id, _tags in {"T1": ["ncGene"], "T2": ["upStr"], "T3": ["dnStr"], "T4": ["cGene"], "T5": ["5pUTR", "3pUTR", "utr5_stranded", "utr3_stranded"], "T6": ["intron"], "T7": ["exon"], "T8": ["ss"], "T9": ["cds", "cIndel"]}.items():
    q(_id, lambda f, t=_tags: f.plain_ties.where(F.col("tag").isin(*t)).drop("status"), "SELECT sample, var_id, tx_id, tag, exon_no, hom_het FROM ti0 WHERE tag IN (" + ", ".join(f"'{t}'" for t in _tags) + ")", "ti0")
q("T10", lambda f: annotate.effect_ties(f.effects).drop("status"), "SELECT sample, var_id, tx_id, unnest(list_filter(['ns', 'candidateGenes', CASE WHEN alt_aa = 'X' THEN 'nsense' END, CASE WHEN ref_aa = 'X' THEN 'mutStop' END], lambda x: x IS NOT NULL)) AS tag, exon_no, hom_het FROM ef WHERE ref_aa <> alt_aa", "ef")
q("T11", lambda f: f.effects.drop("called"), "SELECT sample, var_id, tx_id, allele, exon_no, rel_start, frame, ref_codon, ref_aa, alt_codon, alt_aa, nt_change, aa_change, ref_ok, hom_het, status FROM ef", "ef")
q("T11_mutated", lambda f: annotate.mutated_sequences(f.effects, f.cds).select("sample", "var_id", "tx_id", "allele", "mutated"), "SELECT sample, var_id, tx_id, allele, left(cds, CAST(rel AS INT)) || allele || substring(cds, CAST(rel + 2 AS INT)) AS mutated FROM ef4", "ef4")


# Sources and sinks: what was written is read back.
def _lines(f, df, name, *partition_by):
    path = made.shared(f.spark, name)
    text.write_text(df, path, *partition_by)
    return path


def _in_order(f, df, name, *keys):
    """Lines (value) in files that follow each other in the keys' order."""
    path = made.shared(f.spark, name)
    ordered.write_lines(df, path, list(keys))
    return path


def _named(f, df, name):
    """Lines (file, value) under the files' names, read back."""
    path = made.shared(f.spark, name)
    named.write_named(df, path)
    return named.read_named(f.spark, path)


def _ordered_sites(f):
    path = made.shared(f.spark, "ordered-sites")
    ordered.write_ordered(f.sites.withColumn("rank", X.contig_rank(F.col("chr"))), path, ["rank", "pos"])
    return path


def _twice_called(f):
    """Variants read from a file in which some stand twice, the better one first: the first row stays."""
    v = f.vbed.select("*", F.explode(F.when(F.col("sta") % 3 == 0, F.array(F.lit(1000), F.lit(0))).otherwise(F.array(F.lit(0)))).alias("more"))
    v = v.select("sample", "chr", "sta", "descr", (-F.col("more")).alias("turn"), F.concat_ws("\t", "chr", "sta", "stop", "descr", F.col("qual") + F.col("more"), "strand").alias("value"))
    got = [text.read_vbed(f.spark, _in_order(f, v.where(F.col("sample") == s), "vbed", "turn", "chr", "sta", "descr")).rows["call"].withColumn("sample", F.lit(s)) for s in ("s0", "s1")]
    return annotate.parse_vbed(got[0].unionByName(got[1]).withColumnRenamed("ordinal", "idx")).select("sample", "var_id", "qual")


_known_cells = lambda: [F.lit("1"), "chr", "sta", "stop", F.concat(F.lit("rs"), "line"), F.lit("0"), "strand", F.lit("-"), F.lit("-"), "obs", F.lit("genomic"), "class", F.lit("u"), F.lit("0"), F.lit("0"), F.lit("u"), F.lit("e"), F.lit("1")]


def _first_known(f):
    """The first row of the file for each variant that it has."""
    path = _in_order(f, f.known.select("line", F.concat_ws("\t", *_known_cells()).alias("value")), "snp131", "line")
    rows = text.read_numbered(f.spark, path, "knownVariants").rows["row"].drop("line").withColumnRenamed("ordinal", "line")
    return annotate.known_hits(f.parsed_variants, rows).join(rows.select("line", "name"), "line").select("sample", "var_id", "name")


def _gene_lines(f):
    """Up to four lines for a transcript; the last of four has no gene, and the third none where there are four."""
    x = f.genes.select("tx_id", "gene_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tx_id") % 4)).alias("turn"))
    gene = F.when((F.col("tx_id") % 4 == 3) & (F.col("turn") >= 2), F.lit("")).otherwise(F.coalesce(F.concat("gene_id", F.lit("_"), "turn"), F.lit("")))
    return _in_order(f, x.select("turn", "tx_id", F.concat_ws("\t", gene, F.concat(F.lit("t"), "tx_id"), F.lit("p")).alias("value")), "ensGtp", "turn", "tx_id")


def _first_predictions(f):
    """One row for each id of a predictor's file in which each id stands twice."""
    e = f.effects.where("ref_aa <> alt_aa").select("var_id", "tx_id", "allele").distinct().groupBy("var_id", "tx_id").agg(F.sum(F.ascii("allele")).alias("n"))
    x = e.select("var_id", "tx_id", "n", F.explode(F.array(F.lit(1), F.lit(2))).alias("turn"))
    note = F.when((F.col("n") % 3 == 0) == (F.col("turn") == 1), "second").otherwise("first")
    x = x.select("turn", "var_id", "tx_id", F.concat_ws("\t", F.concat("var_id", F.lit(";candidateGenes;novel")), F.concat(F.lit("chr1:"), "n", F.lit(".AC.uc"), "tx_id", F.lit(".1")), note).alias("value"))
    head = f.spark.range(1).select(F.lit(0).alias("turn"), F.lit("").alias("var_id"), F.lit(0).cast("long").alias("tx_id"), F.lit("#Comments\to_snp_id\tprediction").alias("value"))
    rows = text.read_predictions(f.spark, _in_order(f, head.unionByName(x), "predictions", "turn", "var_id", "tx_id"))
    return rollup.first_predictions(rows.withColumn("snp_id", F.concat_ws("/", "var_id", "o_snp_id"))).select("var_id", "tx_id", "prediction")


def _tsv(f, df, name):
    path = made.shared(f.spark, name)
    text.write_tsv(df, path)
    return f.spark.read.csv(path, sep="\t", header=True, schema=df.schema)


_SITE_TEXT = ["chr", "pos", "ref", "cons", "con_q", "var_q", "map_q", "depth", "bases"]
#: What the files of sites, regions and calls have instead of some of their rows, by a number of the row.
_SPOILT = {"width": 7, "letter": 11, "header": 13}


def _spoilt(df, n, width, letter):
    """df with ``value`` spoilt: a cell less, a letter for a number, a track line before the row."""
    m = F.pmod(n, F.lit(41))
    x = df.withColumn("value", F.when(m == _SPOILT["width"], width).when(m == _SPOILT["letter"], letter).when(m == _SPOILT["header"], F.concat(F.lit("track name=x\n"), "value")).otherwise(F.col("value")))
    return x


def _pileup_text(f):
    site = lambda con_q: F.concat_ws("\t", "chr", "pos", "ref", "cons", con_q, "var_q", "map_q", "depth", "bases", F.lit("I"))
    sites = f.sites.withColumn("value", site("con_q"))
    sites = _spoilt(sites, F.col("pos"), F.concat_ws("\t", "chr", "pos", "ref"), site(F.concat(F.lit("q"), "con_q"))).select("value")
    indel = lambda n1: F.concat_ws("\t", "chr", "pos", F.lit("*"), "genotype", "con_q", "var_q", "map_q", "depth", "allele1", "allele2", n1, "n2", "n_other", F.lit("0"), F.lit("0"))
    indels = f.indels.withColumn("value", indel("n1"))
    indels = _spoilt(indels, F.col("pos"), F.concat_ws("\t", "chr", "pos", F.lit("*"), "genotype"), indel(F.lit("many"))).select("value")
    return _lines(f, sites.unionByName(indels), "pileup")


def _bed_text(f):
    bed = lambda start: F.concat_ws("\t", "chr", start, "stop", F.lit("name"))
    return _lines(f, _spoilt(f.regions.withColumn("value", bed("start")), F.col("start"), F.concat_ws("\t", "chr", "start"), bed(F.lit("five"))).select("value"), "bed")


def _vbed_text(f):
    line = lambda d: F.concat_ws("\t", "chr", "sta", "stop", d, "qual", "strand")
    return _lines(f, _spoilt(f.vbed.withColumn("value", line("descr")), F.col("stop"), F.concat_ws("\t", "chr", "sta", "stop"), line(F.replace("descr", F.lit("=>"), F.lit(">")))).select("value"), "vbed")


def _bad(r):
    """Good and bad rows by what is wrong with them, and the counts that came with the one pass."""
    kinds = [df.groupBy(F.lit(k).alias("what")).agg(F.count("*").alias("n")) for k, df in r.rows.items()]
    out = r.bad.groupBy(F.col("error").alias("what")).agg(F.count("*").alias("n"))
    for k in kinds:
        out = out.unionByName(k)
    spark = r.bad.sparkSession
    return out.unionByName(spark.createDataFrame([(f"counted_{k}", n) for k, n in sorted(r.counts.items())], "what string, n long"))


def _bad_sql(kinds: dict[str, str], letters: dict[str, str], n: str) -> str:
    """kinds: the table of each kind of row; letters: the error of a row with a letter."""
    m = f"({n} % 41)"
    rows = " UNION ALL ".join(f"SELECT CASE {m} WHEN 7 THEN 'width' WHEN 11 THEN '{letters[k]}' ELSE '{k}' END AS what FROM {t} UNION ALL SELECT 'header' FROM {t} WHERE {m} = 13" for k, t in kinds.items())
    good = "', '".join(kinds)
    return f"WITH x AS ({rows}) SELECT what, count(*) AS n FROM x GROUP BY what UNION ALL SELECT 'counted_lines', count(*) FROM x UNION ALL SELECT 'counted_bad', count(*) FROM x WHERE what NOT IN ('{good}')" + "".join(f" UNION ALL SELECT 'counted_{k}', count(*) FROM x WHERE what = '{k}'" for k in kinds)


_WELL = "{} % 41 NOT IN (7, 11)"
_LISTS = lambda f: rollup.id_lists(f.variants, f.ties, f.gene_groups, f.groups)
q("S1", lambda f: text.read_fastq(f.spark, _fastq(f)).select("name", "seq", "qual"), "SELECT name, seq, qual FROM reads", "reads")
q("S2", lambda f: text.read_sites(f.spark, _pileup_text(f))[0].select(*_SITE_TEXT), f"SELECT {', '.join(_SITE_TEXT)} FROM sites WHERE {_WELL.format('pos')}", "sites")
q("S2_bad", lambda f: _bad(text.read_pileup(f.spark, _pileup_text(f))), "SELECT * FROM (" + _bad_sql({"site": "sites", "indel": "indels"}, {"site": "con_q", "indel": "n1"}, "pos") + ") z", "sites", "indels")
q("S3", lambda f: text.read_indels(f.spark, _pileup_text(f))[0], f"SELECT chr, pos, genotype, con_q, var_q, map_q, depth, allele1, allele2, n1, n2, n_other FROM indels WHERE {_WELL.format('pos')}", "indels")
q("S4", lambda f: text.read_bed(f.spark, _bed_text(f)).rows["region"].select("chr", "start", "stop"), f"SELECT chr, start, stop FROM regions WHERE {_WELL.format('start')}", "regions")
q("S4_bad", lambda f: _bad(text.read_bed(f.spark, _bed_text(f))), "SELECT * FROM (" + _bad_sql({"region": "regions"}, {"region": "start"}, "start") + ") z", "regions")
q("S5", lambda f: annotate.parse_vbed(text.read_vbed(f.spark, _vbed_text(f)).rows["call"].withColumn("sample", F.lit("s")).withColumnRenamed("ordinal", "idx")).select("var_id", "sta", "stop", "var_type", "hom_het", F.array_join(F.array_sort("alleles"), ",").alias("alleles")), f"SELECT DISTINCT var_id, CAST(sta AS INT) AS sta, CAST(v_stop AS INT) AS stop, var_type, hom_het, array_to_string(list_sort(alleles), ',') AS alleles FROM va WHERE {_WELL.format('stop')}", "va")
q("S5_bad", lambda f: _bad(text.read_vbed(f.spark, _vbed_text(f))), "SELECT * FROM (" + _bad_sql({"call": "vb"}, {"call": "descr"}, "stop") + ") z", "vb")
q("S6", lambda f: text.read_layout(f.spark, _lines(f, f.known.select(F.concat_ws("\t", F.lit("1"), "chr", "sta", "stop", F.concat(F.lit("rs"), "line"), F.lit("0"), "strand", F.lit("A"), F.lit("A"), "obs", F.lit("genomic"), "class", F.lit("u"), F.lit("0"), F.lit("0"), F.lit("u"), F.lit("e"), F.lit("1")).alias("value")), "snp131"), "knownVariants").select("chr", "sta", "stop", "name", "strand", "obs", "class"), "SELECT chr, sta, stop, 'rs' || line AS name, strand, obs, class FROM known", "known")
q("S7", lambda f: text.gene_models(text.read_layout(f.spark, _lines(f, f.transcripts.select(F.concat_ws("\t", "tx_id", "chr", "strand", "sta", "stop", "c_sta", "c_end", F.size("e_sta"), F.concat(F.array_join("e_sta", ","), F.lit(",")), F.concat(F.array_join("e_end", ","), F.lit(",")), F.lit("p"), F.lit("a")).alias("value")), "knownGene"), "knownGene")).select("tx_id", "chr", "strand", F.array_join("e_sta", ";").alias("e_sta"), F.array_join("e_end", ";").alias("e_end")), "SELECT CAST(tx_id AS VARCHAR) AS tx_id, chr, strand, array_to_string(e_sta, ';') AS e_sta, array_to_string(e_end, ';') AS e_end FROM transcripts", "transcripts")
q("S8", lambda f: text.gene_map(f.genes.withColumn("line", F.col("tx_id")), "tx_id", "gene_id", "line").join(text.id_set(f.genes.withColumn("id", F.when(F.col("tx_id") % 3 != 0, F.col("tx_id").cast("string"))), "id").select(F.col("id").cast("long").alias("tx_id")), "tx_id", "left_semi"), "SELECT tx_id, gene_id FROM genes WHERE gene_id IS NOT NULL AND tx_id % 3 <> 0", "genes")
q("S9", lambda f: _mixed(f), """SELECT 'ensGtp' AS layout, gene_id AS a, 't' || tx_id AS b, NULL AS error FROM genes WHERE gene_id IS NOT NULL UNION ALL SELECT 'knownIsoforms', '' || tx_id // 2, 't' || tx_id, NULL FROM genes
  UNION ALL SELECT 'knownVariants', 'rs' || line, '' || sta, NULL FROM known UNION ALL SELECT NULL, NULL, 'what ' || tx_id, 'layout' FROM genes WHERE tx_id % 3 = 0 UNION ALL SELECT NULL, NULL, 'short ' || tx_id, 'width' FROM genes WHERE tx_id % 5 = 0""", "genes", "known")
q("S10", lambda f: text.read_fasta(f.spark, _fasta(f), runs_on=True), "SELECT chr, chunk, seq FROM genome", "genome")
q("S11", lambda f: text.read_predictions(f.spark, _predictions_file(f)).select("var_id", "tag", "status", "tx_id", "prediction"), "SELECT DISTINCT var_id, 'candidateGenes' AS tag, 'novel' AS status, 'uc' || tx_id || '.1' AS tx_id, 'benign' AS prediction FROM ef WHERE ref_aa <> alt_aa", "ef")
q("S12", lambda f: text.with_sample(text.read_fastq(f.spark, _fastq(f))).groupBy("sample", "run").agg(F.count("*").alias("reads")), "SELECT sample, run, count(*) AS reads FROM reads GROUP BY ALL", "reads")


def _fastq(f):
    """FASTQ files of all reads, in a folder for each file name that their sample and run give."""
    named = f.reads.withColumn("file", F.concat_ws(".", "sample", "run", F.lit("PE"), F.lit("fastq"))).withColumn("out", F.lit("1"))
    return _lines(f, reads.fastq_text(named, "file").select("value", "file"), "fastq", "file")


def _pooled_sets(f):
    """Filtered reads as paired and single sets of each run in files of their own, read back and pooled."""
    path = made.shared(f.spark, "sets")
    x = reads.fastq_text(f.routed, "run").select(F.concat_ws(".", "sample", "run", F.when(F.col("out") == "S", "SE").otherwise("PE"), F.lit("fastq")).alias("file"), "value")
    named.write_named(x, path)
    every = text.with_sample(text.read_fastq(f.spark, path))
    return reads.pooled(*(every.where(F.col("read_set") == k) for k in ("PE", "SE"))).select("sample", "run", "read_set", "name", "seq", "qual")


def _mate_files(f):
    """A FASTQ file for each mate of each sample and run, in order of the reads."""
    path = made.shared(f.spark, "mates")
    x = f.reads.select(F.concat_ws(".", "sample", "run", "dir", F.lit("fastq")).alias("file"), "ordinal", F.concat_ws("\n", "name", "seq", F.lit("+"), "qual").alias("value"))
    named.write_named(ordered.in_order(x, ["file", "ordinal"]), path)
    return path


def _fasta(f):
    """The genome as lines of up to 60 bases in files that follow each other."""
    rows = f.genome.select("chr", "chunk", F.regexp_replace("seq", "(.{60})(?=.)", "$1\n").alias("value"))
    heads = f.genome.select("chr").distinct().select("chr", F.lit(-1).cast("long").alias("chunk"), F.concat(F.lit(">"), "chr", F.lit(" contig")).alias("value"))
    return _in_order(f, rows.unionByName(heads), "fasta", "chr", "chunk")


def _mixed(f):
    """A folder with files of three layouts and of an unknown one, by kind."""
    row = lambda name, *cells: (F.lit(name).alias("file"), F.concat_ws("\t", *cells).alias("value"))
    t = F.concat(F.lit("t"), "tx_id")
    x = f.genes.where("gene_id is not null").select(*row("ensGtp.txt", "gene_id", t, F.lit("")))
    x = x.unionByName(f.genes.select(*row("knownIsoforms.txt", F.floor(F.col("tx_id") / 2), t))).unionByName(f.known.select(*row("snp131.txt", *_known_cells())))
    x = x.unionByName(f.genes.where("tx_id % 3 = 0").select(*row("notes.txt", F.concat(F.lit("what "), "tx_id")))).unionByName(f.genes.where("tx_id % 5 = 0").select(*row("ensGtp.txt", F.concat(F.lit("short "), "tx_id"))))
    got = text.read_mixed(f.spark, _lines(f, x, "mixed", "file"))
    of = lambda k, a, b: text.of_layout(got, k).select(F.lit(k).alias("layout"), F.col(a).alias("a"), F.col(b).cast("string").alias("b"), F.lit(None).cast("string").alias("error"))
    none = F.lit(None).cast("string")
    return of("ensGtp", "gene", "id").unionByName(of("knownIsoforms", "cluster", "id")).unionByName(of("knownVariants", "name", "sta")).unionByName(got.bad.select(none.alias("layout"), none.alias("a"), F.col("value").alias("b"), "error"))


def _predictions_file(f):
    """A predictor's file: a header line, a remark and its rows."""
    rows = f.effects.where("ref_aa <> alt_aa").select("var_id", "tx_id").distinct()
    rows = rows.select(F.lit(1).alias("o"), F.concat_ws(" \t ", F.concat("var_id", F.lit(";candidateGenes;novel")), F.concat(F.lit("chr1:5.AC.uc"), "tx_id", F.lit(".1")), F.lit("benign")).alias("value"))
    head = f.spark.range(1).select(F.explode(F.array(F.struct(F.lit(0).alias("o"), F.lit("#Comments\to_snp_id\tprediction").alias("value")), F.struct(F.lit(2).alias("o"), F.lit("# remark").alias("value")))).alias("x")).select("x.*")
    return _in_order(f, head.unionByName(rows), "predictions", "o", "value")


q("K1", lambda f: _named(f, reads.fastq_text(f.routed).select(F.concat_ws(".", "sample", "out", F.lit("fastq")).alias("file"), "value"), "filter").groupBy("file", "value").agg(F.count("*").alias("n")), "SELECT sample || '.' || out || '.fastq' AS file, value, count(*) AS n FROM (SELECT sample, out, unnest([name, seq, '+', qual]) AS value FROM ro) x GROUP BY ALL", "ro")
q("K2", lambda f: _tsv(f, coverage.per_chromosome(f.cube, f.sizes), "per_chromosome"), f"SELECT s.sample, d.idx, d.chr, coalesce(z.size, 0) AS size, coalesce(hq_positions, 0) AS hq_positions, coalesce(coverage, 0) AS coverage, (coalesce(coverage, 0) / nullif(z.size, 0)) AS mean FROM (SELECT DISTINCT sample FROM sites) s CROSS JOIN {_DIM} LEFT JOIN tot t ON t.sample = s.sample AND t.scope = d.chr LEFT JOIN sizes z ON z.chr = d.chr", "sites", "tot", "sizes")
q("K3", lambda f: _tsv(f, coverage.bedgraph(f.sites, True), "bedgraph"), f"SELECT sample, chr, pos AS start, pos + 1 AS stop, concat_ws(':', chr, pos, ref, con_q, map_q, depth) AS name, '+' AS strand, depth AS score FROM sites WHERE {HQ}", "sites")
q("K4", lambda f: _named(f, calling.vbed_text(f.vbed).select(F.concat("sample", F.lit(".vbed")).alias("file"), "value"), "vbed"), f"SELECT sample || '.vbed' AS file, concat_ws(chr(9), chr, sta, stop, {VBED_DESCR}, qual, '+') AS value FROM vb", "vb")
q("K5", lambda f: _named(f, calling.call_text(calling.snv_calls(f.snvs).unionByName(calling.indel_calls(f.called_indels))).select(F.concat("sample", F.lit(".calls")).alias("file"), "value"), "calls"), "SELECT sample || '.calls' AS file, value FROM (" + CALL_TEXT.format(f"{SNV_CALLS} UNION ALL {INDEL_CALLS}") + ") z", "sv", "ix")
q("K6", lambda f: f.spark.read.text(_lines(f, rollup.id_lines(_LISTS(f), f.genes), "lists", "level", "grp", "tag", "sample")).select("level", "grp", "tag", "sample", "value"),
  """SELECT DISTINCT 'variant' AS level, grp, tag, sample, var_id AS value FROM (SELECT *, unnest(['all', status]) AS grp FROM ti) x UNION ALL SELECT DISTINCT 'transcript', grp, tag, sample, concat_ws(chr(9), tx_id, description) FROM gr LEFT JOIN (SELECT tx_id, description FROM genes) g USING (tx_id) UNION ALL SELECT DISTINCT 'gene', grp, tag, sample, gene_id || chr(9) || ds FROM gg JOIN (SELECT gene_id, string_agg(DISTINCT description, chr(9) ORDER BY description) AS ds FROM genes WHERE gene_id IS NOT NULL GROUP BY gene_id) d USING (gene_id)""", "ti", "gr", "gg", "genes")


def _report(f):
    path = made.shared(f.spark, "report")
    report = rollup.gene_report(f.gene_groups, f.ties, f.variants)
    report.write.json(path)
    return f.spark.read.schema(report.schema).json(path)


q("K7", lambda f: _report(f).select("sample", "grp", "gene_id", F.explode("transcripts").alias("t")).select("sample", "grp", "gene_id", "t.tx_id", F.explode("t.variants").alias("v")).select("sample", "grp", "gene_id", "tx_id", "v.var_id", "v.hom_het", F.array_join(F.array_sort("v.alleles"), ",").alias("alleles")),
  "SELECT DISTINCT g.sample, g.grp, g.gene_id, g.tx_id, t.var_id, v.hom_het, array_to_string(list_sort(v.alleles), ',') AS alleles FROM gg g JOIN ti t ON t.sample = g.sample AND t.tx_id = g.tx_id AND t.tag = 'candidateGenes' JOIN vs v ON v.sample = t.sample AND v.var_id = t.var_id WHERE g.tag = 'candidateGenes' AND g.grp IN ('novel_recessive', 'novel_homozygous')", "gg", "ti", "vs")
q("K8", lambda f: _named(f, rollup.prediction_input(f.variants, f.ties).select(F.concat("sample", F.lit(".pph")).alias("file"), "value"), "pph"), "SELECT sample || '.pph' AS file, chr || ':' || (v_sta + 1) || ' ' || array_to_string(alleles, '/') || ' #' || var_id || ';candidateGenes;novel' AS value FROM vs WHERE var_type = 'snp' AND status = 'novel' AND (sample, var_id) IN (SELECT sample, var_id FROM ti WHERE tag = 'candidateGenes')", "vs", "ti")
q("K9", lambda f: _tsv(f, genome.with_total(f.sizes), "sizes"), "SELECT chr, size FROM sizes UNION ALL SELECT 'Total_size', CAST(sum(size) AS BIGINT) FROM sizes", "sizes")
