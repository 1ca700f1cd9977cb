"""DuckDB SQL for the catalogue's queries."""

from __future__ import annotations

# Fixed values, written out here so that a wrong list in the library is seen.
STARTS = ["ATG", "ATA", "ATT", "GTG", "TTG"]
STOPS = ["TAA", "TAG", "TGA"]
REVERSE_STARTS = ["CAT", "TAT", "AAT", "CAC", "CAA"]
REVERSE_STOPS = ["TTA", "CTA", "TCA"]
QUALITY_STARTS = ["ATG", "ATA", "ATT", "GTG", "TTG", "CTG"]
QUALITY_REVERSE_STARTS = ["CAT", "TAT", "AAT", "CAC", "CAA", "CAG"]
CODE_11_STARTS = ["TTG", "CTG", "ATT", "ATC", "ATA", "ATG", "GTG"]
STANDARD_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
RESIDUE_CLASSES = {"polar": "STYQNC", "nonpolar": "FLIMPVAWG", "acidic": "DE", "basic": "HKR", "Stop codon": "*", "-----": "-"}
QUALITY_CLASSES = ["good_quality", "bad_quality: no_start", "bad_quality: no_stop", "bad_quality: no_start_stop", "bad_quality: multiple_stop"]
SUMMARY_CLASSES = ["Exact match", "INF", "ASM", "ALM", "LNF", "TPR", "NIPH", "NIPHEM", "PLOT", "ERROR"]

ORACLE_SQL: dict[str, str] = {}


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_DNA = "translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTAC')"
_SEQS = f"a AS (SELECT doc_id, lang AS locus, {_DNA} AS seq FROM documents)"


def _rc(x: str) -> str:
    return f"reverse(translate({x}, 'ACGT', 'TGCA'))"


def _direction(x: str) -> str:
    return (
        f"CASE WHEN substr({x}, 1, 3) IN {_in(STARTS)} OR right({x}, 3) IN {_in(STOPS)} THEN 'forward' "
        f"WHEN right({x}, 3) IN {_in(REVERSE_STARTS)} OR substr({x}, 1, 3) IN {_in(REVERSE_STOPS)} THEN 'reverse' ELSE 'Error' END"
    )


def _first_stop(x: str) -> str:
    return f"list_filter(range(0, greatest(length({x}) - 3, 0) + 1, 3), lambda i: substr({x}, i + 1, 3) IN {_in(STOPS)})[1]"


def _residue(codon: str) -> str:
    index = " + ".join(f"{16 // 4**k} * (strpos('TCAG', substr({codon}, {k + 1}, 1)) - 1)" for k in range(3))
    return f"substr('{STANDARD_CODE}', CAST({index} + 1 AS BIGINT), 1)"


def _protein(x: str) -> str:
    return f"array_to_string(list_transform(range(1, length({x}) - 1, 3), lambda i: {_residue(f'substr({x}, i, 3)')}), '')"


_ORIENTED = f"o AS (SELECT *, CASE WHEN {_direction('seq')} = 'reverse' THEN {_rc('seq')} ELSE seq END AS turned FROM a)"
_STOPPED = f"s AS (SELECT *, {_first_stop('turned')} AS stop FROM o)"
_QUALITY = (
    f"CASE WHEN (substr(seq, 1, 3) IN {_in(QUALITY_STARTS)} OR right(seq, 3) IN {_in(QUALITY_REVERSE_STARTS)}) "
    f"AND (right(seq, 3) IN {_in(STOPS)} OR substr(seq, 1, 3) IN {_in(REVERSE_STOPS)}) "
    "THEN CASE WHEN stop IS NULL OR stop < length(turned) - 3 THEN 'bad_quality: multiple_stop' ELSE 'good_quality' END "
    f"WHEN substr(seq, 1, 3) IN {_in(QUALITY_STARTS)} OR right(seq, 3) IN {_in(QUALITY_REVERSE_STARTS)} THEN 'bad_quality: no_stop' "
    f"WHEN right(seq, 3) IN {_in(STOPS)} OR substr(seq, 1, 3) IN {_in(REVERSE_STOPS)} THEN 'bad_quality: no_start' ELSE 'bad_quality: no_start_stop' END"
)
_CODING = f"CASE WHEN length(turned) % 3 = 0 AND substr(turned, 1, 3) IN {_in(CODE_11_STARTS)} AND stop = length(turned) - 3 THEN 'M' || {_protein('substr(turned, 4, length(turned) - 6)')} ELSE '-' END"
_SEQ_ALL = f"WITH {_SEQS}, {_ORIENTED}, {_STOPPED}"

_CALLS = """
e AS (SELECT user_id AS sample, CAST(extract(day FROM ts) AS BIGINT) AS locus, event_type AS tag FROM events),
calls AS (
  SELECT s.sample, l.locus, coalesce(m.tag, 'LNF') AS tag
  FROM (SELECT DISTINCT sample FROM e) s CROSS JOIN (SELECT DISTINCT locus FROM e) l
  LEFT JOIN (SELECT sample, locus, max(tag) AS tag FROM e GROUP BY ALL) m ON m.sample = s.sample AND m.locus = l.locus)"""
_MISSING = "(contains(tag, 'LNF') OR contains(tag, 'NIPH') OR contains(tag, 'PLOT'))"
_SAMPLES = f"ks AS (SELECT * FROM calls WHERE sample IN (SELECT sample FROM calls GROUP BY sample HAVING count(*) FILTER (WHERE {_MISSING}) * 100.0 / count(*) <= 10))"
_LOCI = f"kl AS (SELECT * FROM ks WHERE locus IN (SELECT locus FROM ks GROUP BY locus HAVING count(*) FILTER (WHERE {_MISSING}) * 100.0 / count(*) <= 12))"


def _hamming(of: str) -> str:
    return (
        f"SELECT a.sample AS sample_1, b.sample AS sample_2, CAST((SELECT count(DISTINCT locus) FROM {of}) - count(*) FILTER (WHERE a.tag = b.tag) AS BIGINT) AS distance "
        f"FROM {of} a JOIN {of} b ON a.locus = b.locus GROUP BY a.sample, b.sample"
    )


ORACLE_SQL["hamming_distance"] = f"WITH {_CALLS} {_hamming('calls')}"
ORACLE_SQL["filtered_distance"] = f"WITH {_CALLS}, {_SAMPLES}, {_LOCI} {_hamming('kl')}"
ORACLE_SQL["missing_sample_filter"] = f"WITH {_CALLS}, {_SAMPLES} SELECT sample, locus, tag FROM ks"
ORACLE_SQL["missing_locus_filter"] = f"WITH {_CALLS}, {_SAMPLES}, {_LOCI} SELECT sample, locus, tag FROM kl"
ORACLE_SQL["missing_filter_report"] = f"""WITH {_CALLS}
SELECT sample, CAST(count(*) FILTER (WHERE contains(tag, 'LNF')) AS VARCHAR) || '/' || CAST(count(*) AS VARCHAR) AS lnf,
       CAST(count(*) FILTER (WHERE contains(tag, 'NIPH')) AS VARCHAR) || '/' || CAST(count(*) AS VARCHAR) AS niph_niphem,
       CAST(count(*) FILTER (WHERE contains(tag, 'PLOT')) AS VARCHAR) || '/' || CAST(count(*) AS VARCHAR) AS plot,
       round(count(*) FILTER (WHERE {_MISSING}) * 100.0 / count(*), 2) AS missing_percent
FROM calls GROUP BY sample HAVING count(*) FILTER (WHERE {_MISSING}) * 100.0 / count(*) > 10"""

_TAGGED = f"""WITH {_CALLS},
t AS (SELECT sample, locus, CASE WHEN (sample + locus) % 11 = 0 THEN 'NIPHEM' WHEN (sample + locus) % 13 = 0 THEN 'ERROR not stop codon' WHEN (sample + locus) % 17 = 0 THEN 'abc_9'
  WHEN tag = 'click' THEN 'INF_l_1_0' WHEN tag = 'view' THEN '7' WHEN tag = 'purchase' THEN 'NIPH' WHEN tag = 'signup' THEN 'ASM_l_2_0' WHEN tag = 'error' THEN 'PLOT_3' ELSE tag END AS tag FROM calls),
k AS (SELECT *, CASE WHEN contains(tag, 'INF_') THEN 'INF' WHEN contains(tag, 'ASM_') THEN 'ASM' WHEN contains(tag, 'ALM_') THEN 'ALM' WHEN contains(tag, 'LNF') THEN 'LNF' WHEN contains(tag, 'TPR') THEN 'TPR'
  WHEN tag = 'NIPH' THEN 'NIPH' WHEN tag = 'NIPHEM' THEN 'NIPHEM' WHEN contains(tag, 'PLOT') THEN 'PLOT' WHEN contains(tag, 'ERROR') THEN 'ERROR'
  WHEN regexp_full_match(tag, '[+-]?[0-9]+') OR (contains(tag, '_') AND regexp_matches(tag, '[0-9]$')) THEN 'Exact match' END AS tag_class FROM t)"""
ORACLE_SQL["tag_summary"] = f"{_TAGGED} SELECT sample, " + ", ".join(f"count(*) FILTER (WHERE tag_class = '{c}') AS {c.lower().replace(' ', '_')}" for c in SUMMARY_CLASSES) + " FROM k GROUP BY sample"
ORACLE_SQL["tag_rollup"] = f"""{_TAGGED},
q AS (SELECT sample, tag_class, CASE WHEN locus % 3 = 0 THEN 'good_quality' ELSE 'bad_quality' END AS quality_group,
  CASE WHEN locus % 3 = 0 THEN 'good_quality' WHEN locus % 3 = 1 THEN 'bad_quality: no_start' ELSE 'bad_quality: no_stop' END AS quality_class FROM k)
SELECT sample, tag_class, quality_group, quality_class, count(*) AS n, CAST(grouping(sample, tag_class, quality_group, quality_class) AS BIGINT) AS level
FROM q GROUP BY ROLLUP (sample, tag_class, quality_group, quality_class)"""
ORACLE_SQL["st_rollup"] = """
SELECT status, st, count(*) AS n, CAST(grouping(status, st) AS BIGINT) AS level
FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'Known' WHEN o_orderstatus = 'O' THEN 'New' ELSE 'Unknown' END AS status, o_orderpriority AS st FROM orders)
GROUP BY ROLLUP (status, st)"""

_STATS = "SELECT lang AS locus, avg(length(text)) AS mean, coalesce(stddev_samp(length(text)), 0) AS stdev, min(length(text)) AS lo, max(length(text)) AS hi, count(*) AS total FROM documents GROUP BY lang"
ORACLE_SQL["length_stats"] = f"SELECT locus, round(mean, 6) AS mean, round(stdev, 6) AS stdev, CAST(lo AS BIGINT) AS min_length, CAST(hi AS BIGINT) AS max_length, total FROM ({_STATS})"
ORACLE_SQL["length_mode"] = """
SELECT locus, mode, n FROM (
  SELECT lang AS locus, CAST(length(text) AS BIGINT) AS mode, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, min(doc_id)) AS r FROM documents GROUP BY lang, length(text))
WHERE r = 1"""
ORACLE_SQL["length_histogram"] = "SELECT lang AS locus, CAST(length(text) AS BIGINT) AS len, count(*) AS n FROM documents GROUP BY ALL"
ORACLE_SQL["length_thresholds"] = f"""
SELECT locus, CAST(floor(m - m * CAST(0.2 AS DOUBLE)) AS BIGINT) AS min_len, CAST(ceil(m + m * CAST(0.2 AS DOUBLE)) AS BIGINT) AS max_len, CAST(floor(m - m * stdev) AS BIGINT) AS sd_min, CAST(ceil(m + m * stdev) AS BIGINT) AS sd_max
FROM (SELECT locus, CAST(floor(mean) AS BIGINT) AS m, stdev FROM ({_STATS}))"""
ORACLE_SQL["duplicate_groups"] = "SELECT lang AS locus, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY CAST(doc_id AS VARCHAR)) AS ids FROM documents GROUP BY lang, text HAVING count(*) > 1"
ORACLE_SQL["subset_pairs"] = """
SELECT DISTINCT a.lang AS locus, CAST(a.doc_id AS VARCHAR) AS container, CAST(b.doc_id AS VARCHAR) AS contained
FROM documents a JOIN documents b ON a.lang = b.lang AND length(b.text) > 0 AND length(b.text) < length(a.text) AND contains(a.text, b.text)"""
ORACLE_SQL["schema_filter"] = f"""WITH {_SEQS},
gone AS (
  SELECT b.doc_id FROM a JOIN a b ON a.locus = b.locus AND length(b.seq) > 0 AND length(b.seq) < length(a.seq) AND contains(a.seq, b.seq)
  UNION SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY locus, seq ORDER BY CAST(doc_id AS VARCHAR)) AS r FROM a) WHERE r > 1)
SELECT locus, CAST(doc_id AS VARCHAR) AS allele_id FROM a WHERE doc_id NOT IN (SELECT doc_id FROM gone)"""
ORACLE_SQL["schema_info"] = f"{_SEQ_ALL} SELECT locus, CAST(doc_id AS VARCHAR) AS allele_id, {_QUALITY} AS quality, {_direction('seq')} AS direction, CASE WHEN {_CODING} = '-' THEN 'No' ELSE 'Yes' END AS coding FROM s"
ORACLE_SQL["schema_summary"] = f"""{_SEQ_ALL},
p AS (SELECT locus, length(seq) AS len, {_CODING} AS p FROM s),
m AS (SELECT locus, len AS mode FROM (SELECT locus, length(seq) AS len, row_number() OVER (PARTITION BY locus ORDER BY count(*) DESC, min(doc_id)) AS r FROM a GROUP BY locus, length(seq)) WHERE r = 1)
SELECT p.locus, CAST(any_value(mode) AS BIGINT) AS mode, round(greatest(any_value(mode) - min(len), max(len) - any_value(mode)) / any_value(mode), 6) AS variability,
       round(count(*) FILTER (WHERE p = '-') * 100.0 / count(*), 6) AS non_coding_percent, round(count(DISTINCT CASE WHEN p <> '-' THEN p END) / count(*), 6) AS protein_ratio
FROM p JOIN m ON p.locus = m.locus GROUP BY p.locus"""
ORACLE_SQL["reverse_complement"] = f"WITH {_SEQS} SELECT doc_id, {_rc('seq')} AS rc FROM a"
ORACLE_SQL["seq_direction"] = f"WITH {_SEQS} SELECT doc_id, {_direction('seq')} AS direction FROM a"
ORACLE_SQL["stop_codon"] = f"WITH {_SEQS} SELECT doc_id, CAST({_first_stop('seq')} AS BIGINT) AS first_stop FROM a"
ORACLE_SQL["allele_quality"] = f"{_SEQ_ALL} SELECT doc_id, {_QUALITY} AS quality FROM s"
ORACLE_SQL["coding_filter"] = f"""WITH b AS (SELECT doc_id, lang AS locus, {_DNA} AS seq0 FROM documents),
a AS (SELECT doc_id, locus, coalesce(CASE WHEN doc_id % 2 = 0 THEN 'ATG' || substr(seq0, 1, {_first_stop('seq0')} + 3) ELSE seq0 END, '') AS seq FROM b),
{_ORIENTED}, {_STOPPED} SELECT locus, CAST(doc_id AS VARCHAR) AS allele_id FROM s WHERE {_QUALITY} = 'good_quality'"""
ORACLE_SQL["translate_protein"] = f"WITH {_SEQS} SELECT doc_id, {_protein('seq')} AS protein FROM a"
ORACLE_SQL["cds_check"] = f"{_SEQ_ALL} SELECT doc_id, {_CODING} AS protein FROM s"
ORACLE_SQL["quality_counts"] = (
    f"{_SEQ_ALL}, q AS (SELECT locus, {_QUALITY} AS quality FROM s) SELECT locus, "
    + ", ".join(f"count(*) FILTER (WHERE quality = '{c}') AS {c.replace('bad_quality: ', '')}" for c in QUALITY_CLASSES)
    + ", count(*) AS total FROM q GROUP BY locus"
)


def _class(x: str) -> str:
    whens = " ".join(f"WHEN contains('{rs}', {x}) AND {x} <> '' THEN '{c}'" for c, rs in RESIDUE_CLASSES.items())
    return f"CASE {whens} ELSE 'unknown' END"


ORACLE_SQL["snp_list"] = f"""WITH {_SEQS},
p AS (SELECT doc_id, seq AS x, rpad(lead(seq) OVER (PARTITION BY locus ORDER BY doc_id), CAST(length(seq) AS INTEGER), '-') AS y FROM a),
d AS (SELECT doc_id, x, y, i, i - (i - 1) % 3 AS c FROM (SELECT doc_id, x, y, unnest(range(1, length(x) + 1)) AS i FROM p WHERE y IS NOT NULL) WHERE substr(x, i, 1) <> substr(y, i, 1)),
g AS (SELECT *, substr(x, c, 3) AS cx, substr(y, c, 3) AS cy, min(CASE WHEN contains(substr(y, c, 3), '-') THEN i END) OVER (PARTITION BY doc_id) AS gap FROM d),
r AS (SELECT *, CASE WHEN contains(cy, '-') THEN {_protein('substr(x, c)')} ELSE {_protein('cx')} END AS px, CASE WHEN contains(cy, '-') THEN '-' ELSE {_protein('cy')} END AS py FROM g WHERE gap IS NULL OR i <= gap),
k AS (SELECT *, {_class('substr(px, 1, 1)')} AS kx, {_class('substr(py, 1, 1)')} AS ky FROM r)
SELECT doc_id, CAST(i AS BIGINT) AS position, substr(x, i, 1) || '/' || substr(y, i, 1) AS bases, cx || '/' || cy AS codons, px || '/' || py AS residues,
       CASE WHEN kx = ky THEN 'Synonymous' WHEN py = '*' THEN 'Nonsense' ELSE 'Missense' END AS kind, kx || ' / ' || ky AS classes
FROM k"""

_HITS = """h AS (SELECT l_orderkey AS sample, l_suppkey % 3 AS contig, l_extendedprice AS bitscore, CAST(extract(doy FROM l_shipdate) AS BIGINT) AS hit_start,
  CAST(extract(doy FROM l_shipdate) AS BIGINT) + CAST(l_quantity AS BIGINT) AS hit_end, CAST(l_linenumber AS BIGINT) AS line_no, l_partkey AS part, l_suppkey AS supp, l_shipdate AS ship FROM lineitem)"""
_ORDER = "line_no, part, supp, bitscore, ship"
ORACLE_SQL["best_hit"] = f"WITH {_HITS} SELECT sample, contig, bitscore, line_no FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY bitscore DESC, {_ORDER}) AS r FROM h) WHERE r = 1"
ORACLE_SQL["best_hit_in_band"] = f"WITH {_HITS} SELECT sample, contig, bitscore, line_no FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY bitscore DESC, {_ORDER}) AS r FROM h WHERE hit_end - hit_start BETWEEN 10 AND 30) WHERE r = 1"
ORACLE_SQL["top_k_hits"] = f"""WITH {_HITS},
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample, contig ORDER BY bitscore DESC, {_ORDER}) AS hsp FROM h) WHERE hsp <= 2),
t AS (SELECT sample, contig, row_number() OVER (PARTITION BY sample ORDER BY bitscore DESC, {_ORDER}) AS r FROM k WHERE hsp = 1)
SELECT k.sample, k.contig, k.bitscore, k.line_no FROM k JOIN t ON k.sample = t.sample AND k.contig = t.contig AND t.r <= 2"""
ORACLE_SQL["overlap_dedupe"] = f"""WITH {_HITS},
f AS (SELECT sample, list_reduce(list([{{'contig': contig, 'line_no': line_no, 's': hit_start, 'e': hit_end, 'b': bitscore}}] ORDER BY {_ORDER}),
  lambda k, x: CASE WHEN len(list_filter(k, lambda y: y.contig = x[1].contig AND (x[1].s BETWEEN least(y.s, y.e) AND greatest(y.s, y.e) OR x[1].e BETWEEN least(y.s, y.e) AND greatest(y.s, y.e)))) > 0 THEN k ELSE list_concat(k, x) END) AS kept FROM h GROUP BY sample)
SELECT sample, u.contig AS contig, u.line_no AS line_no, u.s AS hit_start, u.e AS hit_end, u.b AS bitscore FROM (SELECT sample, unnest(kept) AS u FROM f)"""
_FOUND = """p AS (SELECT doc_id, item_id, d.text AS text, b.text AS passage, strpos(d.text, b.text) AS pos_ FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE length(b.text) > 0)"""
ORACLE_SQL["hit_relocate"] = f"WITH {_FOUND} SELECT doc_id, item_id, CAST(pos_ AS BIGINT) AS hit_start, CAST(pos_ + length(passage) - 1 AS BIGINT) AS hit_end FROM p"
ORACLE_SQL["flank_extract"] = f"WITH {_FOUND} SELECT doc_id, item_id, substr(text, greatest(pos_ - 20, 1), least(pos_ + length(passage) - 1 + 20, length(text)) - greatest(pos_ - 20, 1) + 1) AS flanked FROM p"
_EDGE = "(hit_start = 1 OR hit_end = 1 OR hit_start = 365 OR hit_end = 365)"
ORACLE_SQL["contig_edge_calls"] = f"WITH {_HITS} SELECT sample, line_no, part, supp, bitscore, {_EDGE} AS edge, {_EDGE} AND hit_end - hit_start < 25 AS plot FROM h"
ORACLE_SQL["call_decision"] = f"""WITH {_HITS},
f AS (SELECT sample, count(*) FILTER (WHERE contig <> 0) AS n_first, max(CASE WHEN contig = 0 THEN line_no END) AS fb, count(*) FILTER (WHERE contig = 1) AS n_second, max(hit_end) > 380 AS perfect,
  count(*) FILTER (WHERE hit_end - hit_start > 45) AS n_seeds, count(*) FILTER (WHERE hit_end - hit_start > 25) AS n_kept, max(hit_end - hit_start) > 20 AS covered, min(hit_start) < 20 AS on_edge, max(hit_start) AS last, sum(hit_end - hit_start) AS total FROM h GROUP BY sample),
g AS (SELECT *, CASE WHEN fb > 2 THEN fb END AS fallback, on_edge AND last < 100 AS plot, CASE WHEN total % 7 <> 0 THEN total END AS n FROM f)
SELECT sample, CASE WHEN n_first = 0 AND fallback IS NULL THEN 'LNF' WHEN n_first = 0 THEN 'LNF_LOW_ID' WHEN n_second = 0 THEN 'LNF' WHEN perfect AND n_seeds > 1 THEN 'NIPHEM' WHEN perfect AND n_kept > 1 THEN 'NIPH' WHEN perfect THEN 'EXACT'
  WHEN NOT covered AND NOT on_edge THEN 'LNF_LOW_COVERAGE' WHEN n_kept > 1 THEN 'NIPH' WHEN plot THEN 'PLOT' WHEN n IS NULL THEN 'ERROR' WHEN n BETWEEN 30 AND 60 THEN 'INF' WHEN n >= 10 AND n < 30 THEN 'ASM' WHEN n > 60 AND n <= 120 THEN 'ALM' ELSE 'TPR' END AS kind
FROM g"""
ORACLE_SQL["inferred_numbering"] = """
WITH p AS (SELECT p_partkey AS sample, p_brand AS locus, CASE WHEN p_size % 2 = 0 THEN 'INF' ELSE 'ASM' END AS kind, p_type AS s FROM part),
f AS (SELECT locus, kind, s, dense_rank() OVER (PARTITION BY locus, kind ORDER BY min(sample), s) - 1 AS idx FROM p GROUP BY locus, kind, s)
SELECT p.sample, p.locus, p.kind, CAST(f.idx AS BIGINT) AS idx FROM p JOIN f ON p.locus = f.locus AND p.kind = f.kind AND p.s = f.s"""
ORACLE_SQL["new_allele_ids"] = f"""WITH {_SEQS},
n AS (SELECT locus, seq, row_number() OVER (PARTITION BY locus ORDER BY min(doc_id), seq) AS k FROM a WHERE doc_id % 2 = 1 GROUP BY locus, seq),
m AS (SELECT locus, max(doc_id) AS last FROM a WHERE doc_id % 2 = 0 GROUP BY locus)
SELECT n.locus, CAST(m.last + n.k AS VARCHAR) AS allele_id, n.seq FROM n JOIN m ON n.locus = m.locus"""
_TYPES = """
pr AS (SELECT min(p_partkey) AS st, p_brand, p_type FROM part GROUP BY p_brand, p_type),
c AS (SELECT p_partkey AS sample, p_brand, CASE WHEN p_size <> 13 THEN p_type END AS p_type FROM part)"""
ORACLE_SQL["profile_match"] = f"WITH {_TYPES} SELECT c.sample, CAST(min(pr.st) AS VARCHAR) AS st FROM c LEFT JOIN pr ON c.p_brand = pr.p_brand AND c.p_type = pr.p_type GROUP BY c.sample"
ORACLE_SQL["type_assignment"] = f"""WITH {_TYPES},
kn AS (SELECT * FROM pr WHERE st IN (SELECT p_partkey FROM part WHERE p_retailprice < (SELECT avg(p_retailprice) FROM part))),
m AS (SELECT c.*, kn.st FROM c LEFT JOIN kn ON c.p_brand = kn.p_brand AND c.p_type = kn.p_type),
nw AS (SELECT p_brand, p_type, CAST((SELECT count(*) FROM kn) + row_number() OVER (ORDER BY min(sample)) AS VARCHAR) || '_INF' AS st FROM m WHERE st IS NULL AND p_type IS NOT NULL GROUP BY p_brand, p_type)
SELECT m.sample, coalesce(CAST(m.st AS VARCHAR), nw.st, '-') AS st, CASE WHEN m.st IS NOT NULL THEN 'Known' WHEN nw.st IS NOT NULL THEN 'New' ELSE 'Unknown' END AS status
FROM m LEFT JOIN nw ON m.p_brand = nw.p_brand AND m.p_type = nw.p_type"""
_WORDS = f"""
b AS (SELECT source AS locus, CAST(doc_id AS VARCHAR) AS id, doc_id AS ord, {_DNA} AS seq FROM documents),
w AS (SELECT locus, id, ord, seq, list_distinct(list_transform(range(1, greatest(length(seq) - 21 + 2, 1)), lambda i: least(substr(seq, i, 21), {_rc('substr(seq, i, 21)')}))) AS ws FROM b),
pj AS (SELECT x.locus, x.id AS id_1, y.id AS id_2, len(list_intersect(x.ws, y.ws)) AS both_, len(x.ws) AS n1, len(y.ws) AS n2 FROM w x JOIN w y ON x.locus = y.locus),
pd AS (SELECT locus, id_1, id_2, round(CASE WHEN id_1 = id_2 THEN 0.0 WHEN both_ = 0 THEN 1.0 ELSE greatest(0.0, -1.0 / 21 * ln(2 * (both_ / (n1 + n2 - both_)) / (1 + both_ / (n1 + n2 - both_)))) END, 6) AS distance FROM pj)"""
ORACLE_SQL["kmer_distance"] = f"WITH {_WORDS} SELECT locus, id_1, id_2, distance FROM pd"
ORACLE_SQL["sketch_distance"] = f"""WITH {_WORDS},
k AS (SELECT locus, id, list_slice(list_sort(list_distinct(list_transform(ws, lambda x: CAST('0x' || substr(md5(x), 1, 15) AS BIGINT)))), 1, 400) AS sk FROM w),
p AS (SELECT x.locus, x.id AS id_1, y.id AS id_2, x.sk AS a, y.sk AS b, list_slice(list_sort(list_distinct(list_concat(x.sk, y.sk))), 1, 400) AS u FROM k x JOIN k y ON x.locus = y.locus AND x.id <> y.id WHERE list_has_any(x.sk, y.sk)),
j AS (SELECT locus, id_1, id_2, len(list_intersect(list_intersect(u, a), b)) AS s, len(u) AS n FROM p)
SELECT locus, id_1, id_2, round(CASE WHEN s = 0 THEN 1.0 ELSE greatest(0.0, -1.0 / 21 * ln(2 * (s / n) / (1 + s / n))) END, 6) AS distance FROM j"""
ORACLE_SQL["centroid"] = f"""WITH {_SEQS}, {_ORIENTED}, {_STOPPED}, q AS (SELECT CAST(doc_id AS VARCHAR) AS id, {_QUALITY} = 'good_quality' AS good FROM s), {_WORDS},
mn AS (SELECT locus, id_1 AS id, avg(CAST(distance AS DECIMAL(18, 6))) AS mean FROM pd GROUP BY locus, id_1)
SELECT locus, allele_id, good FROM (SELECT mn.locus, mn.id AS allele_id, q.good, row_number() OVER (PARTITION BY mn.locus ORDER BY q.good DESC, round(mean, 10), CAST(mn.id AS BIGINT) DESC) AS r FROM mn JOIN q ON mn.id = q.id) WHERE r = 1"""
ORACLE_SQL["unrepresented"] = f"WITH {_WORDS} SELECT locus, id AS allele_id FROM b WHERE id NOT IN (SELECT id_2 FROM pd WHERE distance < 0.1 AND id_1 < id_2)"

_SCORED = "SELECT l_orderkey AS sample, CAST(l_linenumber AS BIGINT) AS line_no, CAST(round(100 - l_discount * 100, 2) AS DOUBLE) AS pident, CAST(round(l_tax / 10, 4) AS DOUBLE) AS evalue, CAST(l_quantity AS BIGINT) AS length FROM lineitem"
ORACLE_SQL["significant_hits"] = f"SELECT * FROM ({_SCORED}) WHERE evalue <= CAST(0.005 AS DOUBLE) AND pident >= 95"
ORACLE_SQL["perfect_hits"] = f"SELECT sample, line_no, pident, length, pident = 100 AND length = line_no + 20 AS perfect FROM ({_SCORED})"
ORACLE_SQL["predicted_genes"] = f"""WITH {_HITS},
g AS (SELECT l_orderkey AS sample, l_suppkey % 3 AS contig, CAST(extract(doy FROM l_shipdate) AS BIGINT) AS s, CAST(extract(doy FROM l_shipdate) AS BIGINT) + CAST(l_quantity AS BIGINT) AS e, CAST(l_partkey AS VARCHAR) AS q FROM lineitem WHERE l_returnflag = 'R'),
n AS (SELECT row_number() OVER () AS id, * FROM h),
t AS (SELECT n.id, g.s, g.e, g.q, row_number() OVER (PARTITION BY n.id ORDER BY least(g.e, hit_end) - greatest(g.s, hit_start) DESC, g.s, g.e, g.q DESC) AS r FROM n JOIN g ON n.sample = g.sample AND n.contig = g.contig AND g.s <= hit_end AND g.e >= hit_start)
SELECT sample, contig, line_no, hit_start AS cstart, hit_end AS cend, coalesce(q, 'Sequence not found by the gene predictor') AS predicted_seq, coalesce(CAST(s AS VARCHAR), '-') AS predicted_start, coalesce(CAST(e AS VARCHAR), '-') AS predicted_end
FROM n LEFT JOIN t ON n.id = t.id AND t.r = 1"""
ORACLE_SQL["final_sequence"] = f"""WITH {_SEQS},
w AS (SELECT doc_id, CASE WHEN locus = 'en' THEN substr(seq, length(seq) // 3 + 1) ELSE {_rc('substr(seq, 1, length(seq) // 2 + 1)')} END AS onward FROM a),
z AS (SELECT doc_id, onward, {_first_stop('onward')} AS stop FROM w)
SELECT doc_id, CASE WHEN stop > 0 THEN substr(onward, 1, stop + 3) END AS found FROM z"""
ORACLE_SQL["final_reads"] = f"""WITH {_SEQS},
h AS (SELECT doc_id, seq, length(seq) // 3 + 1 AS low, length(seq) // 2 + 1 AS high, (doc_id // 2) % 2 = 1 AS back, doc_id % 2 = 1 AS turned FROM a),
p AS (SELECT doc_id, seq, turned, CASE WHEN back THEN high ELSE low END AS s, CASE WHEN back THEN low ELSE high END AS e FROM h),
w AS (SELECT doc_id, CASE WHEN turned AND e > s THEN {_rc('substr(seq, 1, e)')} WHEN turned THEN substr(seq, e) WHEN s > e THEN {_rc('substr(seq, 1, s)')} ELSE substr(seq, s) END AS onward FROM p),
z AS (SELECT doc_id, onward, {_first_stop('onward')} AS stop FROM w)
SELECT doc_id, CASE WHEN stop > 0 THEN substr(onward, 1, stop + 3) END AS final_seq, CAST(CASE WHEN stop > 0 THEN stop + 3 END AS BIGINT) AS final_len FROM z"""
ORACLE_SQL["contig_names"] = "SELECT doc_id, CASE WHEN lang = 'en' THEN source || '|' || doc_id ELSE lang || '|' || source END AS contig FROM documents"
ORACLE_SQL["mutation_effect"] = """
SELECT p_partkey, 'Global effect: ' || CASE WHEN p_size < 25 THEN 'DELETION. BLAST sequence length shorter than' WHEN p_size = 25 THEN 'BASE SUBSTITUTION. BLAST sequence length equal to' ELSE 'INSERTION. BLAST sequence length longer than' END
  || ' matching allele sequence length / Net result: ' || CASE WHEN p_retailprice < 1000 THEN 'ASM. Final gene sequence length shorter' ELSE 'ALM. Final gene sequence length longer' END || ' than matching allele sequence length' AS info
FROM part"""
ORACLE_SQL["tag_texts"] = """
SELECT p_partkey, CASE p_size % 12 WHEN 0 THEN 'LNF' WHEN 1 THEN 'LNF_' || p_partkey WHEN 2 THEN 'LNF_' || p_partkey WHEN 3 THEN CAST(p_partkey AS VARCHAR) WHEN 4 THEN 'NIPH' WHEN 5 THEN 'NIPHEM'
  WHEN 6 THEN 'PLOT_' || p_partkey WHEN 7 THEN 'TPR_' || p_partkey WHEN 8 THEN 'ERROR not stop codon'
  ELSE CASE p_size % 12 WHEN 9 THEN 'INF' WHEN 10 THEN 'ASM' ELSE 'ALM' END || '_' || p_brand || '_' || p_partkey || '_' || p_size END AS tag
FROM part"""
