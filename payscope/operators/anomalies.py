"""Threshold rules over metric rows, and the drop of the mean confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.functions.scalars import exact_round, fixed
from payscope.operators.metrics import exact_sum
from payscope.plans import schema as S

COLUMNS = "detector severity psp bank country metric value threshold message requires_approval".split()


def _hit(rule: int, when: Column, detector: str, severity: str, metric: str, value: Column, threshold: float, message: Column) -> Column:
    return F.when(when, F.struct(
        F.lit(rule).alias("rule"), F.lit(detector).alias("detector"), F.lit(severity).alias("severity"), F.lit(metric).alias("metric"),
        value.cast("double").alias("value"), F.lit(float(threshold)).alias("threshold"), message.alias("message")))


def rule_hits(metrics: DataFrame) -> DataFrame:
    """One row for each rule that a metric row breaks, with its number."""
    errors, declines, p95 = F.col("`error_rate_%`"), F.col("`decline_rate_%`"), F.col("p95_latency_ms")
    who = F.concat_ws("/", "psp", "bank", "country")

    def says(what: str, value: Column, unit: str, limit: str) -> Column:
        return F.concat(who, F.lit(f": {what} "), value, F.lit(f"{unit} exceeds {limit}{unit}"))

    hits = F.array_compact(F.array(
        _hit(1, (F.col("total_ops") >= S.MIN_OPS) & (F.col("success_ops") == 0), "ZERO_SUCCESS", "CRITICAL", "success_ops", F.lit(0), S.MIN_OPS,
             F.concat(who, F.lit(": 0 successful transactions out of "), F.col("total_ops").cast("string"), F.lit(" ops"))),
        _hit(2, errors > S.FAILURE_SPIKE, "FAILURE_SPIKE", "HIGH", "error_rate_%", errors, S.FAILURE_SPIKE, says("error rate", fixed(errors, 1), "%", str(S.FAILURE_SPIKE))),
        _hit(3, (errors > S.HIGH_ERROR) & (errors <= S.FAILURE_SPIKE), "HIGH_ERROR_RATE", "HIGH", "error_rate_%", errors, S.HIGH_ERROR, says("error rate", fixed(errors, 1), "%", str(S.HIGH_ERROR))),
        _hit(4, declines > S.HIGH_DECLINE, "HIGH_DECLINE_RATE", "MEDIUM", "decline_rate_%", declines, S.HIGH_DECLINE, says("decline rate", fixed(declines, 1), "%", str(S.HIGH_DECLINE))),
        _hit(5, p95 > S.LATENCY_WARN, "LATENCY_DEGRADATION", "MEDIUM", "p95_latency_ms", p95, S.LATENCY_WARN, says("p95 latency", fixed(p95, 0), "ms", f"{S.LATENCY_WARN:.0f}")),
    ))
    return metrics.select("psp", "bank", "country", F.explode(hits).alias("h")).select("psp", "bank", "country", "h.*")


def confidence_drop(records: DataFrame) -> DataFrame:
    """One row if the mean confidence of the records is under the threshold, else none."""
    mean = records.agg(exact_sum(F.col("confidence")).alias("s"), F.count("confidence").alias("n")).select((F.col("s") / F.when(F.col("n") > 0, F.col("n"))).alias("mean"))
    message = F.concat(F.lit("Average record confidence "), fixed(F.col("mean"), 3), F.lit(f" < threshold {S.CONFIDENCE_WARN} — review parsing quality"))
    all_ = F.lit("ALL")
    return mean.where(F.col("mean") < S.CONFIDENCE_WARN).select(
        all_.alias("psp"), all_.alias("bank"), all_.alias("country"), F.lit(6).alias("rule"), F.lit("CONFIDENCE_DROP").alias("detector"), F.lit("HIGH").alias("severity"),
        F.lit("avg_confidence").alias("metric"), exact_round(F.col("mean"), 3).alias("value"), F.lit(S.CONFIDENCE_WARN).alias("threshold"), message.alias("message"))


def detect(metrics: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """All anomalies (COLUMNS), the gravest first, then in the order of groups and rules."""
    found = rule_hits(metrics)
    if records is not None:
        found = found.unionByName(confidence_drop(records))
    rank = F.array_position(F.array(*map(F.lit, S.SEVERITIES)), F.col("severity"))
    found = found.withColumn("requires_approval", F.col("severity").isin("CRITICAL", "HIGH"))
    return found.orderBy(rank, F.col("rule") == 6, "psp", "bank", "country", "rule").select(*COLUMNS)


def needs_approval(anomalies: DataFrame) -> DataFrame:
    return anomalies.agg(F.coalesce(F.bool_or("requires_approval"), F.lit(False)).alias("needs_approval"), F.count_if("requires_approval").alias("n_to_approve"))


def severity_counts(anomalies: DataFrame) -> DataFrame:
    """(severity, n) of the anomalies found, as a run tells them."""
    return anomalies.groupBy("severity").agg(F.count("*").alias("n"))
