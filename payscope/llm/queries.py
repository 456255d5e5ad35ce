"""The corpus operators' queries: opN_<name>(spark, sf_dir), over whole tables, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from payscope.llm import decontaminate, html_text, language_id, license_scan, mixture, near_dedup, quality_rules, secret_scan, suffix_dedup, toxicity
from payscope.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.digest(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.digest(table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digest(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.digest(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_quality_rules, op3_license_scan, op4_decontaminate, op5_mixture, op6_html_text, op7_language_id, op8_suffix_dedup, op9_near_dedup, op10_toxicity,
)}

#: Words as the contracts spell them; DuckDB's lower() would fold letters beyond A-Z.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP2_SQL = rf"""
WITH r AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (
  SELECT rid, {_SPACED_WORDS.format("t")} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM r),
g AS (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w),
d AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, array_to_string(ws[i:i + 4], ' ')) AS k FROM g),
c AS (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS following FROM d WHERE k > 1),
n AS (SELECT rid, sum(least(5, coalesce(following - i, 5))) AS n FROM c GROUP BY rid),
m AS (
  SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    len(ls) AS n_lines, CAST(coalesce(n.n, 0) AS BIGINT) AS n_repeat_words
  FROM r JOIN w USING (rid) LEFT JOIN n USING (rid)),
b AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
f AS MATERIALIZED (
  SELECT *, base_failed OR 100 * n_symbols > {quality_rules.MAX_SYMBOL_PERCENT} * word_chars OR 100 * n_dup_lines > {quality_rules.MAX_DUP_LINE_PERCENT} * n_lines AS rule_failed FROM b),
h AS (SELECT source, count(*) AS n, sum(CAST(rule_failed AS INT)) AS failed FROM f GROUP BY source),
s AS (SELECT least(greatest(avg(failed / n), 1e-3), 1 - 1e-3) AS m, coalesce(var_samp(failed / n), 0) AS v, avg(1 / n) AS r FROM h),
p AS (SELECT m, least(greatest(m * (1 - m) / greatest(v - m * (1 - m) * r, 1e-6) - 1, 2), 1000) AS size FROM s),
q AS (SELECT source, (failed + m * size) / (n + size) AS rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rate > {quality_rules.MAX_HOST_RATE} AS kept, rule_failed, round(rate, 6) AS host_rate
FROM f JOIN q ON f.source IS NOT DISTINCT FROM q.source"""

OP4_SQL = rf"""
WITH items AS (SELECT item_id, {_PLAIN_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
places AS (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - {decontaminate.WINDOW - 1}) + 1)) AS i FROM items WHERE len(ws) > 0),
windows AS MATERIALIZED (SELECT DISTINCT item_id, least(len(ws), {decontaminate.WINDOW}) AS n, array_to_string(ws[i:i + {decontaminate.WINDOW - 1}], ' ') AS win FROM places),
docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_PLAIN_WORDS} AS ws FROM documents),
starts AS (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows)),
hits AS MATERIALIZED (SELECT rid, i, windows.n, item_id FROM (SELECT rid, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win FROM starts) s JOIN windows USING (n, win)),
words AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS k FROM hits) GROUP BY rid),
found AS (SELECT rid, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN words USING (rid) LEFT JOIN found USING (rid)"""

OP9_SQL = rf"""
WITH RECURSIVE docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_SPACED_WORDS.format(_LOWER)} AS ws FROM documents),
places AS (SELECT rid, ws, unnest(range(1, greatest(1, len(ws) - {near_dedup.SHINGLE - 1}) + 1)) AS i FROM docs WHERE len(ws) > 0),
shingles AS MATERIALIZED (SELECT DISTINCT rid, hash(array_to_string(ws[i:i + {near_dedup.SHINGLE - 1}], ' ')) AS s FROM places),
sizes AS MATERIALIZED (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
shared AS (SELECT a.rid AS a, b.rid AS b, count(*) AS k FROM shingles a JOIN shingles b USING (s) WHERE a.rid <> b.rid GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM shared JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b WHERE 100 * k >= {near_dedup.PERCENT} * (x.n + y.n - k)),
reach(a, b) AS (SELECT rid, rid FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_id AS (SELECT a AS rid, min(doc_id) AS component_id FROM reach JOIN docs ON docs.rid = reach.b GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept
FROM docs LEFT JOIN sizes USING (rid) JOIN least_id USING (rid)"""

#: The other operators learn, draw by hash, parse HTML, match with errors, or compare strings at every byte.
ORACLES: dict[str, str] = {"op2_quality_rules": OP2_SQL, "op4_decontaminate": OP4_SQL, "op9_near_dedup": OP9_SQL}
