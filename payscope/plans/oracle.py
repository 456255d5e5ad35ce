"""DuckDB SQL that says what the record queries return, as chains of common table expressions."""

from __future__ import annotations


def rounded(x: str, places: int) -> str:
    """Exact half-even rounding of a double column, as in functions.scalars."""
    s = f"{10**places}.0::DOUBLE"
    h = f"({x}*134217729.0::DOUBLE-({x}*134217729.0::DOUBLE-{x}))"
    lo = f"({x}-{h})"
    p = f"({h}*{s}+{lo}*{s})"
    e = f"(({h}*{s}-{p})+{lo}*{s})"
    return f"((CASE WHEN {p}-floor({p})<0.5 THEN floor({p}) WHEN {p}-floor({p})>0.5 THEN floor({p})+1 WHEN {e}<0 THEN floor({p}) WHEN {e}>0 THEN floor({p})+1 WHEN floor({p})::BIGINT%2=0 THEN floor({p}) ELSE floor({p})+1 END)/{s})"


def mean(x: str) -> str:
    """The mean of non-negative doubles, as in operators.metrics."""
    return f"(sum(floor({x}*1048576.0::DOUBLE)::HUGEINT)::DOUBLE/(count({x})*1048576.0::DOUBLE)+sum(floor(({x}*1048576.0::DOUBLE-floor({x}*1048576.0::DOUBLE))*1099511627776.0::DOUBLE)::HUGEINT)::DOUBLE/(count({x})*1152921504606846976.0::DOUBLE))"


RAW = """raw AS (
  SELECT event_id k, 'tx-' || CASE WHEN event_id % 101 = 5 THEN event_id - 4 ELSE event_id END id,
    CASE WHEN event_id % 97 = 0 THEN '' ELSE 'PSP_' || event_id % 6 END psp, c_mktsegment bank, lower(n_name) country,
    (event_type IN ('error', 'view') OR (event_id % 6 = 5 AND c_mktsegment = 'MACHINERY')) failed, event_type,
    CASE WHEN event_id % 89 = 0 THEN '300000' ELSE (value * 8)::VARCHAR END latency, CASE WHEN event_id % 83 = 0 THEN '-5' ELSE value::VARCHAR END amount,
    CASE WHEN event_id % 79 = 0 THEN 'not a time' WHEN event_id % 71 = 0 THEN '' ELSE CASE event_id % 8
      WHEN 0 THEN strftime(ts, '%m/%d/%Y, %H:%M:%S.%f') WHEN 1 THEN strftime(ts, '%Y/%m/%d %H:%M:%S') WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
      WHEN 4 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 5 THEN strftime(ts, '%Y-%m-%d %H:%M:%S,%f') WHEN 6 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') END END t,
    'part_' || event_id % 4 || '.log' source_file, (['azure_withdrawal_csv', 'freetext_numbered', 'json_lines', 'csv_generic'])[(event_id % 4 + 1)::INT] source_format
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

RECORDS = f"""r1 AS (
  SELECT *, CASE WHEN k % 50 = 0 THEN 'WEIRD' WHEN failed THEN 'FAILED' WHEN event_type = 'signup' THEN 'OK' ELSE 'SUCCESS' END s,
    CASE WHEN failed THEN (['NETWORK_ERROR', 'TIMEOUT', 'DECLINED', 'INSUFFICIENT_FUNDS'])[((k // 6) % 4 + 1)::INT] ELSE '' END err,
    latency::DOUBLE lat, amount::DOUBLE vol,
    strftime(coalesce(try_strptime(t, '%m/%d/%Y, %H:%M:%S.%f'), try_strptime(t, '%Y/%m/%d %H:%M:%S'), try_strptime(t, '%Y-%m-%dT%H:%M:%S.%fZ'), try_strptime(t, '%Y-%m-%dT%H:%M:%SZ'),
      try_strptime(t, '%Y-%m-%dT%H:%M:%S'), try_strptime(t, '%Y-%m-%d %H:%M:%S,%f'), try_strptime(t, '%Y-%m-%d %H:%M:%S'), try_strptime(t, '%d/%b/%Y:%H:%M:%S')), '%Y-%m-%dT%H:%M:%S') iso FROM raw),
r2 AS (
  SELECT *, CASE WHEN s = 'FAILED' AND err = 'DECLINED' THEN 'DECLINED' WHEN s = 'WEIRD' THEN 'UNKNOWN' WHEN s = 'OK' THEN 'SUCCESS' ELSE s END status,
    CASE WHEN lat > 0 AND lat < 300000 THEN lat END latency_ms, CASE WHEN vol > 0 AND vol < 1000000 THEN vol END volume FROM r1),
r3 AS (
  SELECT *, concat_ws('|', CASE WHEN s = 'WEIRD' THEN 'INVALID_STATUS:WEIRD' END, CASE WHEN latency_ms IS NULL THEN 'LATENCY_OUT_OF_RANGE:' || lat END, CASE WHEN volume IS NULL THEN 'VOLUME_OUT_OF_RANGE:' || vol END,
      CASE WHEN t <> '' AND iso IS NULL THEN 'UNPARSEABLE_TIMESTAMP' END, CASE WHEN psp = '' THEN 'MISSING_PSP' END, CASE WHEN t = '' THEN 'MISSING_TIMESTAMP' END) flags,
    ((psp <> '')::INT + 1 + 1 + (status <> 'UNKNOWN')::INT + (volume IS NOT NULL)::INT + (latency_ms IS NOT NULL)::INT) / 6.0::DOUBLE * 1.0::DOUBLE
      * (CASE source_format WHEN 'azure_withdrawal_csv' THEN 1.0 WHEN 'freetext_numbered' THEN 1.0 WHEN 'json_lines' THEN 0.95 ELSE 0.85 END)::DOUBLE raw_conf,
    row_number() OVER (PARTITION BY source_file, id ORDER BY k) n FROM r2),
records AS (
  SELECT k, id, coalesce(iso, t) "timestamp", latency_ms, volume, psp, bank, upper(country) country, status, err error, 'request' event_type, source_file, source_format,
    flags || CASE WHEN n > 1 THEN CASE WHEN flags = '' THEN '' ELSE '|' END || 'DUPLICATE_ID' ELSE '' END validation_flags, flags NOT LIKE '%MISSING%' AND n = 1 is_valid,
    {rounded("raw_conf", 3)} confidence,
    CASE err WHEN 'NETWORK_ERROR' THEN 'CRITICAL' WHEN 'TIMEOUT' THEN 'HIGH' WHEN 'DECLINED' THEN 'MEDIUM' WHEN 'INSUFFICIENT_FUNDS' THEN 'LOW'
      ELSE CASE status WHEN 'SUCCESS' THEN 'INFO' WHEN 'FAILED' THEN 'HIGH' WHEN 'DECLINED' THEN 'MEDIUM' ELSE 'HIGH' END END severity FROM r3),
valid AS (SELECT * FROM records WHERE is_valid)"""

FIGURES = f"""count(*) total_ops, count(*) FILTER (status = 'SUCCESS') success_ops, count(*) FILTER (status <> 'SUCCESS' OR status IS NULL) failed_ops, count(*) FILTER (error = 'DECLINED') decline_ops,
    count(*) FILTER (status <> 'SUCCESS' AND error IN ('NETWORK_ERROR', 'TIMEOUT', 'INSUFFICIENT_FUNDS')) error_count, count(*) FILTER (error = 'TIMEOUT') timeouts,
    {mean('latency_ms')} mean, list_sort(list(latency_ms) FILTER (latency_ms IS NOT NULL)) ls, max(latency_ms) top, sum(volume::DECIMAL(28,10))::DOUBLE vs"""

_RATES = "success_ops::DOUBLE / total_ops * 100 sr, decline_ops::DOUBLE / total_ops * 100 dr, error_count::DOUBLE / total_ops * 100 er, (total_ops - timeouts)::DOUBLE / total_ops * 100 jr, ls[greatest(0, len(ls) * 50 // 100 - 1) + 1] q50, ls[greatest(0, len(ls) * 95 // 100 - 1) + 1] q95"


def metrics(name: str, keys: str, group: str, source: str = "valid") -> str:
    """A metrics table of a grouping; keys select psp, bank and country."""
    return f"""{name}_g AS (SELECT {keys}, {FIGURES} FROM {source} GROUP BY {group}), {name}_r AS (SELECT *, {_RATES} FROM {name}_g),
{name} AS (SELECT psp, bank, country, total_ops, success_ops, failed_ops, decline_ops, error_count, {rounded("sr", 2)} "success_rate_%", {rounded("dr", 2)} "decline_rate_%", {rounded("er", 2)} "error_rate_%",
  {rounded("sr", 2)} "conversion_rate_%", total_ops total_withdrawals_checked, total_ops job_starts, total_ops - timeouts job_finishes, {rounded("jr", 2)} "job_completion_rate_%",
  coalesce({rounded("mean", 2)}, 0) avg_latency_ms, coalesce({rounded("q50", 2)}, 0) p50_latency_ms, coalesce({rounded("q95", 2)}, 0) p95_latency_ms, coalesce({rounded("top", 2)}, 0) max_latency_ms,
  coalesce({rounded("vs", 2)}, 0) transaction_total_volume FROM {name}_r)"""


GROUPS = metrics("m", "psp, bank, country", "psp, bank, country")
PSPS = metrics("p", "psp, 'ALL' bank, 'ALL' country", "psp")

ANOMALIES = f"""hits AS (
  SELECT 'ZERO_SUCCESS' detector, 'CRITICAL' severity, psp, bank, country, 'success_ops' metric, 0.0::DOUBLE "value", 5.0::DOUBLE threshold, concat(psp, '/', bank, '/', country, ': 0 successful transactions out of ', total_ops, ' ops') message
    FROM m WHERE total_ops >= 5 AND success_ops = 0
  UNION ALL SELECT CASE WHEN "error_rate_%" > 40 THEN 'FAILURE_SPIKE' ELSE 'HIGH_ERROR_RATE' END, 'HIGH', psp, bank, country, 'error_rate_%', "error_rate_%", CASE WHEN "error_rate_%" > 40 THEN 40.0 ELSE 25.0 END,
    concat(psp, '/', bank, '/', country, ': error rate ', printf('%.1f', {rounded('"error_rate_%"', 1)}), '% exceeds ', CASE WHEN "error_rate_%" > 40 THEN '40.0%' ELSE '25.0%' END) FROM m WHERE "error_rate_%" > 25
  UNION ALL SELECT 'HIGH_DECLINE_RATE', 'MEDIUM', psp, bank, country, 'decline_rate_%', "decline_rate_%", 30.0,
    concat(psp, '/', bank, '/', country, ': decline rate ', printf('%.1f', {rounded('"decline_rate_%"', 1)}), '% exceeds 30.0%') FROM m WHERE "decline_rate_%" > 30
  UNION ALL SELECT 'LATENCY_DEGRADATION', 'MEDIUM', psp, bank, country, 'p95_latency_ms', p95_latency_ms, 900.0,
    concat(psp, '/', bank, '/', country, ': p95 latency ', {rounded("p95_latency_ms", 0)}::BIGINT, 'ms exceeds 900ms') FROM m WHERE p95_latency_ms > 900),
anomalies AS (SELECT *, severity IN ('CRITICAL', 'HIGH') requires_approval FROM hits)"""


def query(body: str, *parts: str) -> str:
    return "WITH " + ",\n".join([RAW, RECORDS, *parts]) + "\n" + body
