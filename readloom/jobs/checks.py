"""Checking SQL of the jobs' intermediate tables, written apart from the operators."""

from __future__ import annotations

from ..functions.constants import CODONS, IUPAC
from . import domain

HQ = "(depth >= 8 AND con_q >= 30 AND map_q >= 30)"
CALLABLE = "(con_q >= 30 AND var_q >= 30 AND map_q >= 30 AND depth >= 8)"
_CODON = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CODONS.items())
_BASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in IUPAC.items())


def codon(x: str) -> str:
    return f"(CASE {x} {_CODON} ELSE '' END)"


def bases(x: str) -> str:
    return f"(CASE {x} {_BASES} END)"


def cnt(x: str, chars: str) -> str:
    return f"(length({x}) - length(translate({x}, '{chars}', '')))"


def ov(a: str, b: str) -> str:
    """Whether closed [a, b], turned round if need be, meets the variant."""
    return f"(greatest(least({a}, {b}), v_sta) <= least(greatest({a}, {b}), v_stop - 1))"


_PLAIN = r"regexp_replace(regexp_replace(regexp_replace(bases, '\^.', '', 'g'), '\$', '', 'g'), '\+2AC', '', 'g')"

CTE = {
    "fl": (["sites", "regions"], f"SELECT s.*, EXISTS (SELECT 1 FROM regions r WHERE r.chr = s.chr AND s.pos >= r.start AND s.pos < r.stop) AS in_bed, {HQ} AS hq FROM sites s"),
    "beds": (["regions"], "SELECT count(*) AS bed_positions FROM (SELECT DISTINCT chr, unnest(range(start, stop)) AS p FROM regions) x"),
    "sizes": (["genome"], "SELECT chr, CAST(sum(length(regexp_replace(seq, '[^ACGTacgt]', '', 'g'))) AS BIGINT) AS size FROM genome GROUP BY chr"),
    "sc": (["fl"], "SELECT sample, 'all' AS scope, depth, hq FROM fl UNION ALL SELECT sample, 'bed', depth, hq FROM fl WHERE in_bed UNION ALL SELECT sample, chr, depth, hq FROM fl"),
    "tot": (["sc"], "SELECT sample, scope, CAST(sum(depth) AS BIGINT) AS coverage, CAST(count(*) FILTER (WHERE hq) AS BIGINT) AS hq_positions, count(*) AS covered_positions FROM sc GROUP BY ALL"),
    "cum": (["sc"], "SELECT f.sample, f.scope, CAST(f.depth AS INT) AS depth, (SELECT count(*) FROM sc WHERE sc.sample = f.sample AND sc.scope = f.scope AND sc.depth >= f.depth) AS cum FROM (SELECT DISTINCT s.sample, s.scope, d.depth FROM sc s JOIN (SELECT sample, unnest(range(1, m + 1)) AS depth FROM (SELECT sample, max(depth) AS m FROM sc GROUP BY sample) y) d ON s.sample = d.sample) f"),
    "b80": (["cum", "sc", "beds"], "SELECT sample, min_by(depth + (c - CAST(0.8 AS DOUBLE) * bed_positions) / nullif(c - a, 0), depth) AS base80 FROM (SELECT *, coalesce(lead(c) OVER (PARTITION BY sample ORDER BY depth), 0) AS a FROM (SELECT sample, depth, cum AS c FROM cum WHERE scope = 'bed' UNION ALL SELECT sample, 0, count(*) FILTER (WHERE depth = 0) FROM sc WHERE scope = 'bed' GROUP BY sample) x) y CROSS JOIN beds WHERE a / bed_positions < 0.8 GROUP BY sample"),
    "rd": (["reads"], "SELECT r.*, CASE run WHEN 'a' THEN 33 ELSE 64 END AS offs, CASE run WHEN 'a' THEN regexp_replace(qual, '#+$', '') ELSE regexp_replace(qual, 'B+$', '') END AS tq FROM reads r"),
    "rt": (["rd"], "SELECT *, left(seq, greatest(length(seq) - (length(qual) - length(tq)), 0)) AS ts FROM rd"),
    "cl": (["rt"], """SELECT sample, run, dir, ordinal, name, ts AS seq, tq AS qual, offs, length(seq) AS bases, length(ts) AS len, regexp_extract(name, '^([^/]+/)', 1) AS pair_key,
        CASE WHEN length(ts) < 40 THEN 'too_short' WHEN length(regexp_replace(ts, '[^Nn]', '', 'g')) > 4 THEN 'too_many_N'
        WHEN length(CASE run WHEN 'a' THEN regexp_replace(tq, '[^\\x21-\\x2A]', '', 'g') ELSE regexp_replace(tq, '[^@A-I]', '', 'g') END) > 5 THEN 'under10'
        WHEN length(CASE run WHEN 'a' THEN regexp_replace(tq, '[^\\x21-\\x34]', '', 'g') ELSE regexp_replace(tq, '[^@A-S]', '', 'g') END) > 10 THEN 'under20' END AS reason FROM rt"""),
    "pr": (["cl"], "SELECT a.sample, a.run, a.pair_key, a.reason IS NULL AS pass1, b.reason IS NULL AS pass2 FROM cl a JOIN cl b ON a.sample = b.sample AND a.run = b.run AND a.pair_key = b.pair_key AND a.dir = 1 AND b.dir = 2"),
    "ro": (["cl", "pr"], "SELECT c.*, CASE WHEN pass1 AND pass2 THEN CAST(dir AS VARCHAR) ELSE 'S' END AS out FROM cl c JOIN pr USING (sample, run, pair_key) WHERE reason IS NULL"),
    "pa": (["sites"], f"SELECT *, {_PLAIN} AS pl FROM sites WHERE {CALLABLE} AND ref <> cons"),
    "al": (["pa"], "SELECT * FROM (SELECT p.*, b.base, CASE WHEN b.base = 'D' THEN length(regexp_replace(pl, '[^*]', '', 'g')) ELSE length(regexp_replace(upper(pl), '[^' || b.base || ']', '', 'g')) + CASE WHEN b.base = ref THEN length(regexp_replace(pl, '[^.,]', '', 'g')) ELSE 0 END END AS n FROM pa p CROSS JOIN (VALUES ('A'), ('C'), ('G'), ('T'), ('D')) b(base)) x WHERE n > 0"),
    "pc": (["al"], "SELECT sample, chr, pos, ref, cons, con_q, var_q, map_q, depth, string_agg(base || ':' || n, ',' ORDER BY base) AS counts, CAST(sum(n) AS BIGINT) AS parsed, CAST(sum(CASE WHEN base = 'D' THEN n ELSE 0 END) AS BIGINT) AS deletions, count(*) AS alleles, CAST(sum(CASE WHEN base = ref THEN n ELSE 0 END) AS BIGINT) AS ref_reads FROM al GROUP BY ALL"),
    "sv": (["pc"], f"SELECT *, CASE WHEN cons IN ('A','C','G','T') THEN 'hom' ELSE 'het' END AS hom_het, list_filter(string_split({bases('cons')}, ''), lambda b: b <> ref) AS alts FROM pc WHERE deletions / parsed <= 0.75"),
    "ic": (["indels"], f"SELECT *, CASE WHEN allele2[1] = '-' THEN length(allele2) - 1 ELSE 0 END AS del_len FROM indels WHERE {CALLABLE} AND n_other / depth <= 0.125 AND depth >= 12 AND n2 >= 3 AND n2 / depth >= 0.25"),
    "ix": (["ic"], """SELECT *, CASE WHEN del_len = 0 THEN pos - 1 ELSE pos END AS sta, CASE WHEN del_len = 0 THEN pos - 1 ELSE pos + del_len END AS stop, CASE WHEN del_len = 0 THEN pos ELSE pos + del_len - 1 END AS call_stop,
        CASE WHEN genotype[1] = '*' THEN 'het' ELSE 'hom' END AS hom_het, (SELECT string_agg(a || ':' || n, ',' ORDER BY n DESC, a) FROM (VALUES (allele1, n1), (allele2, n2), ('O', n_other)) t(a, n) WHERE a <> 'O' OR n > 0) AS counts FROM ic"""),
    "vb": (["sv", "ix", "genome"], """SELECT sample, chr, pos - 1 AS sta, pos AS stop, ref, cons AS var, depth, counts, var_q AS qual, 'snp' AS var_type, hom_het FROM sv
        UNION ALL SELECT i.sample, i.chr, i.sta, i.stop, coalesce(substring(g.seq, i.sta % 256 + 1, 1), ''), i.genotype, i.depth, i.counts, i.var_q, 'indel', i.hom_het FROM ix i LEFT JOIN genome g ON g.chr = i.chr AND g.chunk = i.sta // 256"""),
    "va": (["vb"], f"SELECT *, chr || ':' || sta || '-' || stop || '_' || var AS var_id, CASE WHEN sta = stop THEN stop + 2 ELSE stop END AS v_stop, sta AS v_sta, CASE WHEN var_type = 'indel' THEN list_distinct(string_split(var, '/')) ELSE string_split({bases('var')}, '') END AS alleles FROM vb"),
    "kw": (["known"], "SELECT line, chr, sta, stop, class, obs, list_transform(string_split(obs, '/'), lambda o: CASE WHEN o = '-' THEN '*' WHEN strand = '-' THEN reverse(translate(o, 'ACGTacgt', 'TGCATGCA')) ELSE o END) AS obs_set, CASE WHEN class = 'insertion' THEN sta - 3 ELSE sta END AS x_sta, CASE WHEN class = 'insertion' THEN stop + 3 ELSE stop END AS x_stop FROM known WHERE obs <> 'lengthTooLong'"),
    "hi": (["va", "kw"], "SELECT sample, var_id, min(line) AS line FROM va v JOIN kw k ON v.chr = k.chr AND v.v_sta < k.x_stop AND k.x_sta < v.v_stop WHERE list_has_all(k.obs_set, CASE WHEN var_type = 'indel' THEN list_transform(list_filter(alleles, lambda a: a <> '*'), lambda a: substring(a, 2)) ELSE list_filter(alleles, lambda a: a <> ref) END) GROUP BY ALL"),
    "vs": (["va", "hi"], "SELECT v.*, CASE WHEN h.line IS NULL THEN 'novel' ELSE 'known' END AS status FROM va v LEFT JOIN hi h USING (sample, var_id)"),
    "ex": (["transcripts"], "SELECT tx_id, chr, strand, sta, stop, c_sta, c_end, CAST(len(e_sta) AS INT) AS n, CAST(i AS INT) AS i, e_sta[i + 1] AS es, e_end[i + 1] AS ee, greatest(e_sta[i + 1], c_sta) AS lo, least(e_end[i + 1], c_end) AS hi FROM (SELECT *, unnest(range(0, len(e_sta))) AS i FROM transcripts) x"),
    "cl3": (["ex"], "SELECT tx_id, CAST(sum(greatest(hi - lo, 0)) AS BIGINT) AS cds_len FROM ex GROUP BY tx_id"),
    "tx": (["transcripts", "cl3"], "SELECT t.*, cds_len FROM transcripts t JOIN cl3 USING (tx_id) WHERE tx_id % 3 <> 0 AND (c_sta = c_end OR cds_len % 3 = 0)"),
    "ps": (["vs", "tx"], "SELECT v.sample, v.var_id, v.v_sta, v.v_stop, v.var_type, v.hom_het, v.status, v.ref AS v_ref, v.alleles, t.* FROM vs v JOIN tx t ON v.chr = t.chr AND v.v_sta <= t.stop + 999 AND v.v_stop - 1 >= t.sta - 1000"),
    "pe": (["ps", "ex"], "SELECT p.*, e.n, e.i, e.es, e.ee, e.lo, e.hi, lag(e.ee) OVER (PARTITION BY p.sample, p.var_id, p.tx_id ORDER BY e.i) AS pee FROM ps p JOIN ex e USING (tx_id)"),
    "ti0": (["ps", "pe"], f"""SELECT sample, var_id, tx_id, hom_het, status, 'ncGene' AS tag, CAST(NULL AS INT) AS exon_no FROM ps WHERE c_sta = c_end AND {ov('sta', 'stop - 1')}
        UNION ALL SELECT sample, var_id, tx_id, hom_het, status, 'upStr', NULL FROM ps WHERE c_sta <> c_end AND CASE WHEN strand = '+' THEN {ov('sta - 1000', 'sta - 1')} ELSE {ov('stop', 'stop + 999')} END
        UNION ALL SELECT sample, var_id, tx_id, hom_het, status, 'dnStr', NULL FROM ps WHERE c_sta <> c_end AND CASE WHEN strand = '-' THEN {ov('sta - 1000', 'sta - 1')} ELSE {ov('stop', 'stop + 999')} END
        UNION ALL SELECT sample, var_id, tx_id, hom_het, status, unnest(list_filter(['cGene', CASE WHEN {ov('sta', 'c_sta - 1')} THEN '5pUTR' END, CASE WHEN {ov('c_end', 'stop - 1')} THEN '3pUTR' END, CASE WHEN CASE WHEN strand = '+' THEN {ov('sta', 'c_sta - 1')} ELSE {ov('c_end', 'stop - 1')} END THEN 'utr5_stranded' END, CASE WHEN CASE WHEN strand = '+' THEN {ov('c_end', 'stop - 1')} ELSE {ov('sta', 'c_sta - 1')} END THEN 'utr3_stranded' END], lambda x: x IS NOT NULL)), NULL FROM ps WHERE c_sta <> c_end AND {ov('sta', 'stop - 1')}
        UNION ALL SELECT sample, var_id, tx_id, hom_het, status, unnest(list_filter([CASE WHEN i > 0 AND {ov('pee', 'es - 1')} THEN 'intron' END, CASE WHEN {ov('es', 'ee - 1')} THEN 'exon' END, CASE WHEN i < n - 1 AND {ov('ee', 'ee + 1')} THEN 'ss' END, CASE WHEN i < n - 1 AND {ov('ee', 'ee + 1')} THEN 'candidateGenes' END, CASE WHEN i > 0 AND {ov('es - 2', 'es - 1')} THEN 'ss' END, CASE WHEN i > 0 AND {ov('es - 2', 'es - 1')} THEN 'candidateGenes' END, CASE WHEN cd THEN 'cds' END, CASE WHEN cd AND var_type = 'indel' THEN 'cIndel' END, CASE WHEN cd AND var_type = 'indel' THEN 'candidateGenes' END], lambda x: x IS NOT NULL)), i FROM (SELECT *, (v_stop - 1 >= c_sta AND v_sta <= c_end - 1 AND lo < hi AND {ov('lo', 'hi - 1')}) AS cd FROM pe) y WHERE c_sta <> c_end AND {ov('sta', 'stop - 1')}"""),
    "cb": (["ex", "genome"], "SELECT tx_id, strand, p, substring(seq, CAST(p % 256 + 1 AS INT), 1) AS b FROM (SELECT tx_id, chr, strand, unnest(range(lo, hi)) AS p FROM ex WHERE lo < hi AND c_sta <> c_end) x JOIN genome g ON g.chr = x.chr AND g.chunk = x.p // 256"),
    "cds": (["cb", "tx"], "SELECT tx_id, CASE WHEN min(strand) = '-' THEN reverse(translate(string_agg(b, '' ORDER BY p), 'ACGT', 'TGCA')) ELSE string_agg(b, '' ORDER BY p) END AS cds, CAST(count(*) AS INT) AS len_nt FROM cb WHERE tx_id IN (SELECT tx_id FROM tx) GROUP BY tx_id"),
    "ef0": (["pe", "cds", "cb"], "SELECT x.*, c.cds, c.len_nt, (SELECT count(*) FROM cb WHERE cb.tx_id = x.tx_id AND cb.p < x.v_sta) AS along, (SELECT b FROM cb WHERE cb.tx_id = x.tx_id AND cb.p = x.v_sta) AS gb FROM pe x JOIN cds c USING (tx_id) WHERE var_type = 'snp' AND c_sta <> c_end AND lo < hi AND v_sta >= lo AND v_sta < hi"),
    "ef1": (["ef0"], "SELECT *, CASE WHEN strand = '-' THEN len_nt - 1 - along ELSE along END AS rel FROM ef0"),
    "ef2": (["ef1"], "SELECT *, unnest(list_filter(alleles, lambda a: a <> v_ref)) AS called, substring(cds, CAST(rel - rel % 3 + 1 AS INT), 3) AS ref_codon FROM ef1"),
    "ef3": (["ef2"], "SELECT *, CASE WHEN strand = '-' THEN translate(called, 'ACGT', 'TGCA') ELSE called END AS allele FROM ef2"),
    "ef4": (["ef3"], "SELECT *, left(ref_codon, CAST(rel % 3 AS INT)) || allele || substring(ref_codon, CAST(rel % 3 + 2 AS INT)) AS alt_codon FROM ef3"),
    "ef": (["ef4"], f"SELECT sample, var_id, tx_id, allele, CAST(CASE WHEN strand = '-' THEN n - 1 - i ELSE i END AS INT) AS exon_no, CAST(rel AS INT) AS rel_start, CAST(rel % 3 AS INT) AS frame, ref_codon, {codon('ref_codon')} AS ref_aa, alt_codon, {codon('alt_codon')} AS alt_aa, CASE WHEN strand = '-' THEN translate(gb, 'ACGT', 'TGCA') ELSE gb END || (rel + 1) || allele AS nt_change, {codon('ref_codon')} || (rel // 3 + 1) || {codon('alt_codon')} AS aa_change, v_ref = gb AS ref_ok, hom_het, status FROM ef4"),
    "ti": (["ti0", "ef"], "SELECT * FROM ti0 UNION ALL SELECT sample, var_id, tx_id, hom_het, status, unnest(list_filter(['ns', 'candidateGenes', CASE WHEN alt_aa = 'X' THEN 'nsense' END, CASE WHEN ref_aa = 'X' THEN 'mutStop' END], lambda x: x IS NOT NULL)), exon_no FROM ef WHERE ref_aa <> alt_aa"),
    "su": (["ti"], "SELECT sample, tx_id, grp, tag, count(*) AS \"any\", CAST(sum(CASE WHEN hom_het = 'hom' THEN 1.0 ELSE 0.5 END) AS DOUBLE) AS \"sum\", count(*) FILTER (WHERE hom_het = 'hom') AS hom, count(*) FILTER (WHERE hom_het = 'het') AS het FROM (SELECT *, unnest(['all', status]) AS grp FROM ti) x GROUP BY ALL"),
    "gr": (["su"], "SELECT sample, tx_id, tag, grp FROM su UNION ALL SELECT sample, tx_id, tag, grp || '_recessive' FROM su WHERE \"sum\" >= 1 UNION ALL SELECT sample, tx_id, tag, grp || '_homozygous' FROM su WHERE hom >= 1"),
    "gg": (["gr", "genes"], "SELECT g.*, gene_id, description FROM gr g JOIN genes USING (tx_id) WHERE gene_id IS NOT NULL"),
}


def sql(select: str, *uses: str) -> str:
    """A statement over the named intermediate and derived tables."""
    order: list[str] = []

    def need(n: str) -> None:
        if n in order:
            return
        for x in CTE[n][0] if n in CTE else domain._needs(n)[:-1]:
            need(x)
        order.append(n)

    for u in uses:
        need(u)
    parts = [f"{n} AS ({CTE[n][1] if n in CTE else domain._dialect(domain.TABLES[n], False)})" for n in order]
    return f"WITH {', '.join(parts)} {select}" if parts else select
