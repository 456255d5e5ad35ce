"""Overviews of a run: totals, histograms, bands, per-file snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.functions.scalars import exact_round, percent
from payscope.operators.metrics import exact_mean, exact_sum
from payscope.plans import schema as S
from payscope.plans.normalize import band_of


def totals(records: DataFrame) -> DataFrame:
    """One row: numbers by status with their shares, mean latency, volume; null where there is nothing to average."""
    row = records.agg(
        F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("SUCCESS", "FAILED", "DECLINED")],
        exact_mean(F.col("latency_ms")).alias("latency"), exact_sum(F.col("volume")).alias("volume"))
    shares = [percent(F.col(c), F.col("total"), 1).alias(f"{c}_pct") for c in ("success", "failed", "declined")]
    return row.select("total", "success", "failed", "declined", *shares, exact_round(F.col("latency"), 1).alias("avg_latency"), exact_round(F.col("volume"), 2).alias("total_volume"))


def error_histogram(records: DataFrame, order: str = "_ord") -> DataFrame:
    """(error, n, rate), the most frequent first, then in the order of first appearance."""
    n = records.count()
    counts = records.where("error <> ''").groupBy("error").agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    return counts.orderBy(F.desc("n"), "_first").select("error", "n", percent(F.col("n"), F.lit(n), 1).alias("rate"))


def confidence_bands(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Numbers of records in each confidence band, and the mean, of all records or for each of the groups."""
    band = band_of(F.col("confidence"))
    mean = exact_round(exact_sum(F.col("confidence")) / F.when(F.count("confidence") > 0, F.count("confidence")), 3)
    return records.groupBy(*(by or [])).agg(*[F.count_if(band == b).alias(b.lower()) for b, _ in S.BANDS], mean.alias("avg_confidence"))


def severity_histogram(records: DataFrame) -> DataFrame:
    """(severity, n, rate) of all five severities, also those without records."""
    spark = records.sparkSession
    names = spark.createDataFrame([(i, s) for i, s in enumerate(S.SEVERITIES)], "rank int, severity string")
    counts = records.groupBy("severity").agg(F.count("*").alias("n"))
    n = records.count()
    out = names.join(counts, "severity", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.orderBy("rank").select("severity", "n", percent(F.col("n"), F.lit(n), 1).alias("rate"))


def file_snapshot(records: DataFrame) -> DataFrame:
    """For each file: number, success rate, mean latency and volume, and its confidence bands."""
    ok = F.count_if(F.col("status") == "SUCCESS")
    bands = [F.count_if(band_of(F.col("confidence")) == b).alias(b.lower()) for b, _ in S.BANDS]
    return records.groupBy("source_file").agg(
        F.count("*").alias("total_ops"), percent(ok, F.count("*")).alias("success_rate_pct"), exact_round(exact_mean(F.col("latency_ms")), 2).alias("avg_latency_ms"),
        exact_round(exact_sum(F.col("volume")), 2).alias("total_volume"), *bands)


def rejection_rates(records: DataFrame) -> DataFrame:
    """For each file: records, rejected ones, their share, and whether it calls for an alert."""
    rejected = F.count_if(~F.col("is_valid"))
    return records.groupBy("source_file").agg(F.count("*").alias("total"), rejected.alias("rejected")).select(
        "source_file", "total", "rejected", exact_round(F.col("rejected") / F.col("total"), 3).alias("rate"), (F.col("rejected") / F.col("total") > S.REJECTION_ALERT).alias("alert"))


def anomalies_per_file(records: DataFrame, anomalies: DataFrame) -> DataFrame:
    """(source_file, anomaly columns): anomalies of the providers that a file holds, and those of all providers."""
    held = records.select("source_file", "psp").distinct()
    own = held.join(anomalies, "psp").select("source_file", *anomalies.columns)
    # the rules for all providers give a few rows at most: an array that each file takes
    of_all = anomalies.where("psp = 'ALL'").agg(F.collect_list(F.struct(*anomalies.columns))).scalar()
    each = records.select("source_file").distinct().select("source_file", F.explode(of_all).alias("a"))
    return own.where("psp <> 'ALL'").unionByName(each.select("source_file", "a.*"))


def top_metrics(metrics: DataFrame, n: int = 25) -> DataFrame:
    """The first n metric rows in the order of their groups: a report's table."""
    return metrics.orderBy("psp", "bank", "country").limit(n)
