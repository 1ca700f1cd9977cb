"""The queries of this subpackage, one for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import decontamination, filter_audit, fingerprints, line_dedup, lm_scoring, near_dedup, packing, quality_classifier, sharding, simhash, spelling, token_counts, url_filters
from strandline.llm._shared import read_table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leak_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(read_table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(read_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_report(read_table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_report(read_table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_report(read_table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(read_table(spark, sf_dir, "documents"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.url_report(read_table(spark, sf_dir, "pages"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(read_table(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(read_table(spark, sf_dir, "documents"))


_OP1 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, CAST(len(w) - least(10, len(w)) + 2 AS BIGINT))) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, CAST(greatest(len(w) - k, -1) + 2 AS BIGINT))) AS i FROM d, (SELECT DISTINCT k FROM bw) ks)),
hits AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hits)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""

_OP2 = r"""
WITH l AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
k AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
s AS (SELECT l.doc_id, l.i, l.line, k.key IS NOT NULL AND l.doc_id <> k.keeper AS lost FROM l LEFT JOIN k ON l.key = k.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN lost THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM s GROUP BY doc_id
"""

_OP9 = r"""
WITH p AS (
  SELECT page_id, url, regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)), '\.$', '') AS host,
         regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
         DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INTEGER) AS fetched FROM pages),
s AS (SELECT DISTINCT url, fetched, host, path, string_split(host, '.') AS labels, list_filter(string_split(path, '/'), lambda x: x <> '') AS segs FROM p WHERE host <> ''),
k AS (
  SELECT url, fetched, 'domain' AS kind, array_to_string(list_slice(labels, i, len(labels)), '.') AS pattern FROM (SELECT *, unnest(range(1, len(labels) + 1)) AS i FROM s)
  UNION ALL SELECT url, fetched, 'prefix', host || '/' || array_to_string(list_slice(segs, 1, i), '/') FROM (SELECT *, unnest(range(1, len(segs) + 1)) AS i FROM s)
  UNION ALL SELECT url, fetched, 'url', host || path FROM s),
c AS (SELECT *, CAST('0x' || substr(md5(kind || ':' || pattern), 1, 6) AS BIGINT) AS c FROM (SELECT DISTINCT kind, pattern FROM k)),
e AS (SELECT kind, pattern, c, DATE '2024-01-01' + CAST(c % 200 AS INTEGER) AS d FROM c WHERE c % (CASE kind WHEN 'domain' THEN 4 WHEN 'prefix' THEN 5 ELSE 7 END) = 0),
v AS (
  SELECT kind, pattern, d AS lo, CASE WHEN c % 3 <> 0 THEN d + 60 END AS hi FROM e
  UNION ALL SELECT kind, pattern, d + 120, NULL FROM e WHERE c % 3 = 1),
m AS (SELECT DISTINCT k.url, k.fetched, k.kind || ':' || k.pattern AS x FROM k JOIN v ON k.kind = v.kind AND k.pattern = v.pattern AND k.fetched >= v.lo AND (v.hi IS NULL OR k.fetched < v.hi)),
g AS (SELECT url, fetched, count(*) AS n, string_agg(x, ',' ORDER BY x) AS matched FROM m GROUP BY url, fetched)
SELECT p.page_id, p.host, CAST(p.fetched AS VARCHAR) AS fetched_on, CAST(coalesce(n, 0) AS BIGINT) AS n_active, coalesce(matched, '') AS matched, coalesce(n, 0) > 0 AS blocked
FROM p LEFT JOIN g ON p.url = g.url AND p.fetched = g.fetched
"""

_OP11 = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM t),
f AS (
  SELECT part, CAST(len(ws) < 50 AS INTEGER) + 2 * CAST(100 * len(list_distinct(ws)) < 65 * len(ws) AS INTEGER)
         + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS INTEGER) + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
         + 16 * CAST(coalesce(doc_id > least, false) AS INTEGER) AS mask,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
  FROM w),
m AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY part, mask),
l AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(x, b)),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM l a, l b, l c, l d, l e WHERE (a.b | b.b | c.b | d.b | e.b) = 31),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS f, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before FROM (SELECT *, unnest(range(1, 6)) AS step FROM o)),
r AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (WHERE (mask & (before | f)) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE (mask & before) = 0 AND (mask & f) <> 0), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE (mask & before) <> 0 AND (mask & f) <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE mask = f), 0) AS unique_fails,
         coalesce(sum(m.good) FILTER (WHERE (mask & before) = 0 AND (mask & f) <> 0), 0) AS good_lost,
         coalesce(sum(m.toxic) FILTER (WHERE (mask & before) = 0 AND (mask & f) <> 0), 0) AS toxic_lost
  FROM m, s GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_fingerprints": op4_fingerprints,
    "op5_token_counts": op5_token_counts,
    "op6_near_dedup": op6_near_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_sharding": op8_sharding,
    "op9_url_filters": op9_url_filters,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_filter_audit": op11_filter_audit,
    "op12_spelling": op12_spelling,
    "op13_simhash": op13_simhash,
}
ORACLE_SQL: dict[str, str] = {"op1_decontamination": _OP1, "op2_line_dedup": _OP2, "op9_url_filters": _OP9, "op11_filter_audit": _OP11}
