"""The Markdown report and the audit trail of a run, from small aggregated frames."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.operators import metrics as M
from payscope.operators import summaries as U
from payscope.plans import schema as S

TABLE = "psp bank country total_ops success_rate_% decline_rate_% error_rate_% job_completion_rate_% avg_latency_ms p95_latency_ms transaction_total_volume".split()


def grid(head: list[str], rows: list) -> list[str]:
    line = lambda cells: "| " + " | ".join(map(str, cells)) + " |"
    return [line(head), "|" + "---|" * len(head), *map(line, rows)]


def badge(confidence: float) -> str:
    name = next(n for n, least in S.BANDS if least is None or confidence >= least)
    return f"`{confidence:.2f}` {name}"


def markdown(records: DataFrame, metrics: DataFrame, by_psp: DataFrame, anomalies: DataFrame, files: list[dict], run_id: str, elapsed: float) -> str:
    """All sections of the report. What reaches the driver: histograms, one row for each provider, anomalies, 25 metric rows."""
    t = U.totals(records).first()
    errors, bands, severities = U.error_histogram(records).collect(), U.confidence_bands(records).first(), U.severity_histogram(records).collect()
    found, psps, n_metrics = anomalies.collect(), by_psp.orderBy("psp").collect(), metrics.count()
    to_approve = sum(a["requires_approval"] for a in found)
    shown = lambda x: "N/A" if x is None else x
    out = ["# Withdrawal Log Analysis Report", ""]
    out += grid(["Field", "Value"], [
        ("**Run ID**", f"`{run_id}`"), ("**Generated**", datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S UTC")), ("**Elapsed**", f"{elapsed:.2f}s"), ("**Total Records**", t["total"]), ("**Files Processed**", len(files))])
    out += ["", "---", "\n## File Inventory", ""]
    out += grid(["File", "Format", "Confidence", "Records", "Status"], [(f"`{f['file']}`", f"`{f['format']}`", badge(f["confidence"]), f["records"], f["status"]) for f in files])
    out += ["", "\n## Executive Summary", ""]
    out += grid(["Metric", "Value"], [
        ("Total Transactions", f"**{t['total']}**"), *[(name, f"{t[c]} ({t[c + '_pct']:.1f}%)") for name, c in (("Successful", "success"), ("Failed", "failed"), ("Declined", "declined"))],
        ("Avg Latency", f"{shown(t['avg_latency'])} ms"), ("Total Volume", shown(t["total_volume"]))])
    out += ["", "\n## Anomalies & Alerts", ""]
    if found:
        out += grid(["Severity", "Detector", "PSP", "Bank", "Country", "Metric", "Value", "Threshold"], [(a["severity"], f"`{a['detector']}`", a["psp"], a["bank"], a["country"], f"`{a['metric']}`", a["value"], a["threshold"]) for a in found])
        out += ["", f"> **{to_approve} anomaly(ies) require human approval** before results are considered final."] * (to_approve > 0)
    else:
        out += ["> No anomalies detected."]
    out += ["", "\n## PSP Performance Summary", ""]
    out += grid(["PSP", "Ops", "Success%", "Decline%", "Error%", "Avg Lat (ms)", "P95 Lat (ms)", "Volume"], [
        (f"**{p['psp']}**", p["total_ops"], f"{p['success_rate_%']}%", f"{p['decline_rate_%']}%", f"{p['error_rate_%']}%", p["avg_latency_ms"], p["p95_latency_ms"], p["transaction_total_volume"]) for p in psps])
    out += ["", "\n## Error & Decline Breakdown", ""]
    out += grid(["Error Code", "Count", "Rate"], [(f"`{e['error']}`", e["n"], f"{e['rate']:.1f}%") for e in errors]) if errors else ["> No errors recorded."]
    out += ["", f"\n## Metrics Table (top {min(25, n_metrics)} of {n_metrics} rows)", ""]
    out += grid(TABLE, [[m[c] for c in TABLE] for m in U.top_metrics(metrics).collect()])
    out += ["", "\n## Confidence Distribution", ""]
    what = ("Auto-processed, no review needed", "Auto-processed, flagged", "Requires human review", "Rejected, written to rejected CSV")
    ranges = ("(>=0.85)", "(0.70-0.84)", "(0.50-0.69)", "(<0.50)")
    out += grid(["Band", "Count", "Description"], [(f"{b} {r}", bands[b.lower()], w) for (b, _), r, w in zip(S.BANDS, ranges, what, strict=True)])
    out += ["", f"> **Average confidence: {bands['avg_confidence'] or 0:.3f}**", "", "\n## Severity Breakdown", ""]
    out += grid(["Severity", "Count", "Rate"], [(s["severity"], s["n"], f"{s['rate']:.1f}%") for s in severities])
    return "\n".join([*out, "", "---", "", f"*Report generated by Withdrawal Log Analysis Pipeline — Run `{run_id}`*"])


ENTRY = (
    "source_file string, format string, confidence double, processed long, rejected long, method string, mappings array<string>, errors array<string>, flags array<string>")


def entries(spark: SparkSession, stats: list[dict]) -> DataFrame:
    """What a run tells of each file, as audit() takes it."""
    rows = [(f["file"], f["format"], f["confidence"], f["records"], f["rejected"], f["method"], f["mappings"], f["errors"], f["flags"]) for f in stats]
    return spark.createDataFrame(rows, ENTRY)


def audit(records: DataFrame, anomalies: DataFrame, files: DataFrame, run_id: str, trigger: str = "manual") -> DataFrame:
    """One JSON entry (value) for each file (ENTRY): how it was read, counts, confidence bands, metrics, anomalies of its providers."""
    each = U.anomalies_per_file(records, anomalies).groupBy("source_file").agg(F.collect_list(F.struct("detector", "severity", "message")).alias("anomalies_detected"))
    now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = files.join(U.file_snapshot(records), "source_file", "left").join(each, "source_file", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c.upper())
    none = F.array().cast("array<struct<detector:string,severity:string,message:string>>")
    return rows.select(F.to_json(F.struct(
        F.lit(now).alias("timestamp"), F.lit(run_id).alias("run_id"), F.lit(trigger).alias("trigger_type"), F.col("source_file").alias("file_name"), "format", F.round("confidence", 3).alias("format_confidence"),
        F.col("processed").alias("records_processed"), F.col("rejected").alias("records_skipped"), F.col("rejected").alias("records_rejected"),
        F.col("method").alias("parsing_method"), F.col("mappings").alias("field_mappings_applied"),
        F.struct(*[zero(b.lower()) for b, _ in S.BANDS]).alias("confidence_distribution"), "errors",
        F.struct("total_ops", F.col("success_rate_pct").alias("success_rate_%"), "avg_latency_ms", "total_volume").alias("metrics_snapshot"),
        F.col("flags").alias("human_approval_flags"), F.coalesce("anomalies_detected", none).alias("anomalies_detected"),
    )).alias("value"))


def error_entry(run_id: str, context: str, error: str) -> str:
    now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    return json.dumps({"timestamp": now, "run_id": run_id, "event": "PIPELINE_ERROR", "context": context, "error": error})


def summary_entry(run_id: str, records: int, files: int, elapsed: float) -> str:
    now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    return json.dumps({"timestamp": now, "run_id": run_id, "event": "RUN_COMPLETE", "total_records": records, "total_files": files, "elapsed_sec": round(elapsed, 3)})
