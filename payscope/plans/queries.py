"""Queries over the records, and the SQL each is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.functions.scalars import exact_round, number, parsed_time
from payscope.operators import anomalies as A
from payscope.operators import metrics as M
from payscope.operators import summaries as U
from payscope.plans import adapter as D
from payscope.plans import normalize as N
from payscope.plans import oracle as O
from payscope.plans import report
from payscope.plans import schema as S
from payscope.sources import logs

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def records(spark: SparkSession, sf_dir: str, confidence: float = 1.0) -> DataFrame:
    return N.mark_duplicates(N.normalize(D.raw_events(spark, sf_dir), confidence))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).where("is_valid")


@query(O.query("SELECT * FROM m", O.GROUPS))
def metrics_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.by_group(valid(spark, sf_dir))


@query(O.query("SELECT * FROM p", O.PSPS))
def metrics_by_psp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.by_psp(valid(spark, sf_dir))


@query(O.query("SELECT * FROM m UNION ALL SELECT * FROM p", O.GROUPS, O.PSPS))
def metrics_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.both(valid(spark, sf_dir))


@query("WITH g AS (SELECT event_type, list_sort(list(value)) v FROM events GROUP BY event_type) SELECT event_type, v[greatest(0, len(v) * 50 // 100 - 1) + 1] p50, v[greatest(0, len(v) * 95 // 100 - 1) + 1] p95 FROM g")
def latency_lower_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.lower_rank(D.table(spark, sf_dir, "events"), ["event_type"], "value", (50, 95))


@query(f"WITH t AS (SELECT l_orderkey, l_linenumber, l_extendedprice * l_discount / 7 x FROM lineitem) SELECT l_orderkey, l_linenumber, {O.rounded('x', 1)} r1, {O.rounded('x', 2)} r2, {O.rounded('x', 3)} r3 FROM t")
def exact_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = D.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * F.col("l_discount") / 7).alias("x"))
    return t.select("l_orderkey", "l_linenumber", *[exact_round(F.col("x"), n).alias(f"r{n}") for n in (1, 2, 3)])


@query(O.query("SELECT id, '' guid, 'POST /withdrawals/process' request, '' request_body, \"timestamp\", '' response, latency_ms, volume, psp, bank, country, status, error, event_type, source_file, source_format, validation_flags, is_valid, confidence, severity FROM records"))
def normalize_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select(*S.RECORD)


@query("""WITH t AS (SELECT event_id, upper(trim((['success', ' TRUE ', 'ok', '200', 'completed', 'failed', 'False', 'error', 'fail', 'ko', '500', '4xx', 'decline', 'DECLINED', 'unknown', 'odd', '', NULL])[(event_id % 18 + 1)::INT])) s FROM events)
SELECT event_id, CASE WHEN s IN ('SUCCESS', 'TRUE', 'OK', '200', 'COMPLETED') THEN 'SUCCESS' WHEN s IN ('FAILED', 'FALSE', 'ERROR', 'FAIL', 'KO', '500', '4XX') THEN 'FAILED' WHEN s IN ('DECLINE', 'DECLINED') THEN 'DECLINED' ELSE 'UNKNOWN' END status,
  CASE WHEN s = 'ODD' THEN 'INVALID_STATUS:ODD' END flag FROM t""")
def status_normalization(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = F.array(*[F.lit(x) for x in ("success", " TRUE ", "ok", "200", "completed", "failed", "False", "error", "fail", "ko", "500", "4xx", "decline", "DECLINED", "unknown", "odd", "", None)])
    t = D.table(spark, sf_dir, "events").select("event_id", F.element_at(states, (F.col("event_id") % 18 + 1).cast("int")).alias("s"))
    return t.select("event_id", N.status_of(F.col("s")).alias("status"), N.status_flag(F.col("s")).alias("flag"))


@query(O.query("SELECT status, error, count(*) n FROM records GROUP BY status, error"))
def declined_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).groupBy("status", "error").agg(F.count("*").alias("n"))


@query(O.query("SELECT k, iso FROM r1"))
def timestamp_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.raw_events(spark, sf_dir).select(F.col("_ord").alias("k"), F.date_format(parsed_time(F.col("timestamp")), "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))


@query("""WITH t AS (SELECT o_orderkey, (o_orderkey % 1200 - 100)::DOUBLE * 300 lat, o_totalprice * 3 vol FROM orders)
SELECT o_orderkey, CASE WHEN lat > 0 AND lat < 300000 THEN lat END latency_ms, CASE WHEN vol > 0 AND vol < 1000000 THEN vol END volume, NOT (lat > 0 AND lat < 300000) latency_flag, NOT (vol > 0 AND vol < 1000000) volume_flag FROM t""")
def range_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = D.table(spark, sf_dir, "orders").select("o_orderkey", number(((F.col("o_orderkey") % 1200 - 100).cast("double") * 300).cast("string")).alias("lat"), (F.col("o_totalprice") * 3).alias("vol"))
    return t.select("o_orderkey", N.in_range(F.col("lat"), S.LATENCY_BELOW).alias("latency_ms"), N.in_range(F.col("vol"), S.VOLUME_BELOW).alias("volume"),
                    N.range_flag(F.col("lat"), S.LATENCY_BELOW, "LATENCY").isNotNull().alias("latency_flag"), N.range_flag(F.col("vol"), S.VOLUME_BELOW, "VOLUME").isNotNull().alias("volume_flag"))


@query(O.query("SELECT validation_flags, is_valid, count(*) n FROM records GROUP BY validation_flags, is_valid"))
def validation_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).groupBy("validation_flags", "is_valid").agg(F.count("*").alias("n"))


@query(O.query("SELECT k, confidence FROM records"))
def confidence_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select(F.col("_ord").alias("k"), "confidence")


@query(O.query(f"SELECT high, medium, low, critical, {O.rounded('mean', 3)} avg_confidence FROM b", "b AS (SELECT count(*) FILTER (confidence >= 0.85) high, count(*) FILTER (confidence >= 0.7 AND confidence < 0.85) medium, count(*) FILTER (confidence >= 0.5 AND confidence < 0.7) low, count(*) FILTER (confidence < 0.5) critical, sum(confidence::DECIMAL(28,10))::DOUBLE / count(*) mean FROM valid)"))
def confidence_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.confidence_bands(valid(spark, sf_dir))


@query(O.query("SELECT k, severity FROM records"))
def severity_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select(F.col("_ord").alias("k"), "severity")


_RATE = "coalesce(n, 0)::DOUBLE / (SELECT count(*) FROM valid) * 100 x"


@query(O.query(f"SELECT severity, n, {O.rounded('x', 1)} rate FROM h", f"h AS (SELECT severity, coalesce(n, 0) n, {_RATE} FROM (VALUES ('CRITICAL'), ('HIGH'), ('MEDIUM'), ('LOW'), ('INFO')) s(severity) LEFT JOIN (SELECT severity, count(*) n FROM valid GROUP BY severity) USING (severity))"))
def severity_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.severity_histogram(valid(spark, sf_dir))


@query(O.query(f"SELECT error, n, {O.rounded('x', 1)} rate FROM h", f"h AS (SELECT error, n, {_RATE} FROM (SELECT error, count(*) n FROM valid WHERE error <> '' GROUP BY error))"))
def error_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.error_histogram(valid(spark, sf_dir))


@query(O.query(f"SELECT total, success, failed, declined, {O.rounded('a', 1)} success_pct, {O.rounded('b', 1)} failed_pct, {O.rounded('c', 1)} declined_pct, {O.rounded('mean', 1)} avg_latency, {O.rounded('vol', 2)} total_volume FROM t",
    "t0 AS (SELECT count(*) total, count(*) FILTER (status = 'SUCCESS') success, count(*) FILTER (status = 'FAILED') failed, count(*) FILTER (status = 'DECLINED') declined, " + O.mean("latency_ms") + " mean, sum(volume::DECIMAL(28,10))::DOUBLE vol FROM valid)",
    "t AS (SELECT *, success::DOUBLE / total * 100 a, failed::DOUBLE / total * 100 b, declined::DOUBLE / total * 100 c FROM t0)"))
def executive_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.totals(valid(spark, sf_dir))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid(spark, sf_dir)
    return A.detect(M.by_group(rows), rows)


@query(O.query("SELECT * FROM anomalies", O.GROUPS, O.ANOMALIES))
def anomalies_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(spark, sf_dir)


def _rule(name: str, detector: str) -> None:
    def one(spark: SparkSession, sf_dir: str) -> DataFrame:
        return A.detect(M.by_group(valid(spark, sf_dir))).where(F.col("detector") == detector)

    one.__name__ = name
    query(O.query(f"SELECT * FROM anomalies WHERE detector = '{detector}'", O.GROUPS, O.ANOMALIES))(one)


for _name, _detector in (("rule_zero_success", "ZERO_SUCCESS"), ("rule_failure_spike", "FAILURE_SPIKE"), ("rule_high_error_rate", "HIGH_ERROR_RATE"), ("rule_high_decline_rate", "HIGH_DECLINE_RATE"), ("rule_latency_degradation", "LATENCY_DEGRADATION")):
    _rule(_name, _detector)


_MEAN = O.rounded("mean", 3)


@query(O.query(
    f"SELECT 'CONFIDENCE_DROP' detector, 'HIGH' severity, 'ALL' psp, 'ALL' bank, 'ALL' country, 'avg_confidence' metric, {_MEAN} \"value\", 0.7::DOUBLE threshold, concat('Average record confidence ', printf('%.3f', {_MEAN}), ' < threshold 0.7 — review parsing quality') message, true requires_approval FROM c WHERE mean < 0.7",
    "c2 AS (SELECT ((psp <> '')::INT + 2 + (status <> 'UNKNOWN')::INT + (volume IS NOT NULL)::INT + (latency_ms IS NOT NULL)::INT) present, (CASE source_format WHEN 'azure_withdrawal_csv' THEN 1.0 WHEN 'freetext_numbered' THEN 1.0 WHEN 'json_lines' THEN 0.95 ELSE 0.85 END)::DOUBLE quality, flags NOT LIKE '%MISSING%' AND n = 1 is_valid FROM r3)",
    f"c1 AS (SELECT {O.rounded('y', 3)} conf FROM (SELECT CASE WHEN x > 1 THEN 1.0 ELSE x END y, is_valid FROM (SELECT present / 6.0::DOUBLE * 0.3::DOUBLE * quality x, is_valid FROM c2)) WHERE is_valid)",
    "c AS (SELECT sum(conf::DECIMAL(28,10))::DOUBLE / count(*) mean FROM c1)"))
def rule_confidence_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a format that was told with a confidence of 0.3."""
    rows = records(spark, sf_dir, 0.3).where("is_valid")
    return A.confidence_drop(rows).withColumn("requires_approval", F.lit(True)).select(*A.COLUMNS)


@query(O.query("SELECT bool_or(requires_approval) needs_approval, count(*) FILTER (requires_approval) n_to_approve FROM anomalies", O.GROUPS, O.ANOMALIES))
def approval_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.needs_approval(found(spark, sf_dir))


@query(O.query("SELECT k, id, source_file, validation_flags FROM (SELECT records.*, r3.n FROM records JOIN r3 USING (k)) WHERE n > 1"))
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).where(F.col("validation_flags").contains("DUPLICATE_ID")).select(F.col("_ord").alias("k"), "id", "source_file", "validation_flags")


@query(O.query("SELECT k, id, validation_flags rejection_reason FROM records WHERE NOT is_valid"))
def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.split_valid(records(spark, sf_dir))[1].select(F.col("_ord").alias("k"), "id", "rejection_reason")


@query(O.query(f"SELECT source_file, total, rejected, {O.rounded('x', 3)} rate, x > 0.2 alert FROM t", "t AS (SELECT source_file, count(*) total, count(*) FILTER (NOT is_valid) rejected, count(*) FILTER (NOT is_valid)::DOUBLE / count(*) x FROM records GROUP BY source_file)"))
def rejection_rate_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.rejection_rates(records(spark, sf_dir))


@query("""WITH t AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'GET /Payout/1' WHEN 1 THEN 'POST /orders' ELSE '' END request, CASE WHEN event_id % 7 = 2 THEN 'Adyen' ELSE '' END provider,
  CASE WHEN event_id % 7 = 3 THEN 'PAYOUT_INITIATED' ELSE event_type END kind, CASE WHEN event_id % 7 = 4 THEN 'a Remittance note' ELSE props END note FROM events)
SELECT event_id FROM t WHERE lower(request) LIKE '%/payout%' OR provider <> '' OR lower(kind) = 'payout_initiated' OR lower(note) LIKE '%remittance%'""")
def withdrawal_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 7
    t = D.table(spark, sf_dir, "events").select(
        "event_id", F.when(k == 0, "GET /Payout/1").when(k == 1, "POST /orders").otherwise("").alias("request"), F.when(k == 2, "Adyen").otherwise("").alias("provider"),
        F.when(k == 3, "PAYOUT_INITIATED").otherwise(F.col("event_type")).alias("kind"), F.when(k == 4, "a Remittance note").otherwise(F.col("props")).alias("note"))
    every = F.concat_ws(" ", "request", "provider", "kind", "note")
    return t.where(N.is_withdrawal(F.col("request"), F.col("provider"), F.col("kind"), every)).select("event_id")


@query(O.query(f"SELECT source_file, total_ops, {O.rounded('sr', 2)} success_rate_pct, {O.rounded('mean', 2)} avg_latency_ms, {O.rounded('vol', 2)} total_volume, high, medium, low, critical FROM t",
    "t AS (SELECT source_file, count(*) total_ops, count(*) FILTER (status = 'SUCCESS')::DOUBLE / count(*) * 100 sr, " + O.mean("latency_ms") + " mean, sum(volume::DECIMAL(28,10))::DOUBLE vol, count(*) FILTER (confidence >= 0.85) high, count(*) FILTER (confidence >= 0.7 AND confidence < 0.85) medium, count(*) FILTER (confidence >= 0.5 AND confidence < 0.7) low, count(*) FILTER (confidence < 0.5) critical FROM valid GROUP BY source_file)"))
def audit_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.file_snapshot(valid(spark, sf_dir))


@query(O.query("SELECT source_file, a.detector, a.severity, psp, a.bank, a.country, a.metric, a.\"value\", a.threshold, a.message, a.requires_approval FROM anomalies a JOIN (SELECT DISTINCT source_file, psp FROM valid) USING (psp)", O.GROUPS, O.ANOMALIES))
def anomalies_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid(spark, sf_dir)
    return U.anomalies_per_file(rows, A.detect(M.by_group(rows), rows))


@query(O.query(f"""SELECT source_file, 'made' run_id, total_ops records_processed, 1::BIGINT records_skipped, 'rules_based' parsing_method, 'a->b,c->d' field_mappings_applied,
  high || '/' || medium || '/' || low || '/' || critical confidence_distribution, 'none' errors, total_ops snapshot_ops, {O.rounded('sr', 2)} snapshot_success, 'OK,' || source_file human_approval_flags,
  (SELECT count(*) FROM anomalies a WHERE a.psp IN (SELECT psp FROM valid v WHERE v.source_file = t.source_file)) n_anomalies FROM t""", O.GROUPS, O.ANOMALIES,
    "t AS (SELECT source_file, count(*) total_ops, count(*) FILTER (status = 'SUCCESS')::DOUBLE / count(*) * 100 sr, count(*) FILTER (confidence >= 0.85) high, count(*) FILTER (confidence >= 0.7 AND confidence < 0.85) medium, count(*) FILTER (confidence >= 0.5 AND confidence < 0.7) low, count(*) FILTER (confidence < 0.5) critical FROM valid GROUP BY source_file)"))
def audit_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit trail's JSON, taken apart again."""
    rows = valid(spark, sf_dir)
    files = rows.groupBy("source_file").agg(F.count("*").alias("processed")).select(
        "source_file", F.lit("json_lines").alias("format"), F.lit(0.95).alias("confidence"), "processed", F.lit(1).cast("long").alias("rejected"), F.lit("rules_based").alias("method"),
        F.array(F.lit("a->b"), F.lit("c->d")).alias("mappings"), F.array(F.lit("none")).alias("errors"), F.array(F.lit("OK"), "source_file").alias("flags"))
    trail = report.audit(rows, A.detect(M.by_group(rows), rows), files, "made")
    bands = ", ".join(f"{b}: bigint" for b, _ in S.BANDS)
    e = F.from_json("value", "file_name string, run_id string, records_processed bigint, records_skipped bigint, parsing_method string, field_mappings_applied array<string>, "
        f"confidence_distribution struct<{bands}>, errors array<string>, metrics_snapshot struct<total_ops: bigint, `success_rate_%`: double>, human_approval_flags array<string>, anomalies_detected array<struct<detector: string>>").alias("e")  # fmt: skip
    joined = lambda c: F.array_join(f"e.{c}", ",").alias(c)
    return trail.select(e).select(
        F.col("e.file_name").alias("source_file"), "e.run_id", "e.records_processed", "e.records_skipped", "e.parsing_method", joined("field_mappings_applied"),
        F.concat_ws("/", *[F.col(f"e.confidence_distribution.{b}") for b, _ in S.BANDS]).alias("confidence_distribution"), joined("errors"), F.col("e.metrics_snapshot.total_ops").alias("snapshot_ops"),
        F.col("e.metrics_snapshot.`success_rate_%`").alias("snapshot_success"), joined("human_approval_flags"), F.size("e.anomalies_detected").cast("long").alias("n_anomalies"))


@query(O.query("SELECT severity, count(*) n FROM anomalies GROUP BY severity", O.GROUPS, O.ANOMALIES))
def anomaly_severities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.severity_counts(found(spark, sf_dir))


@query(O.query("SELECT * FROM m ORDER BY psp, bank, country LIMIT 25", O.GROUPS))
def top25_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.top_metrics(M.by_group(valid(spark, sf_dir)))


@query("SELECT * FROM (SELECT event_id AS id, 'event' AS kind, value AS amount FROM events UNION ALL SELECT o_orderkey, 'order', o_totalprice FROM orders)")
def file_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = D.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.lit("event").alias("kind"), F.col("value").alias("amount"))
    orders = D.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("order").alias("kind"), F.col("o_totalprice").alias("amount"))
    return logs.together([events, orders])
