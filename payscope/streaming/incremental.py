"""New log files as they come, with Structured Streaming: an extension of the batch run.

The file source tells files by path, so a file that changes under its path isn't read again; the processed-file
registry, which compares contents, is the exact way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.operators.metrics import exact_sum
from payscope.plans.normalize import normalize
from payscope.sources.logs import freetext


def stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    m = "_metadata."
    return spark.readStream.text(folder).select(
        F.col(m + "file_path").alias("path"), F.col(m + "file_name").alias("source_file"),
        F.struct(F.col(m + "file_path").alias("p"), F.col(m + "file_block_start").alias("b")).alias("_ord"), "value")


def stream_records(spark: SparkSession, folder: str) -> DataFrame:
    """Normalised records of numbered free text; duplicates aren't marked, as a file's lines may span batches."""
    return normalize(freetext(stream_lines(spark, folder)))


def minute_figures(records: DataFrame, delay: str = "10 minutes", width: str = "1 minute") -> DataFrame:
    """Operations, successes and mean latency of each provider and minute; records later than delay are dropped."""
    timed = records.where("is_valid").withColumn("at", F.try_to_timestamp("timestamp")).withWatermark("at", delay)
    return timed.groupBy(F.window("at", width), "psp").agg(F.count("*").alias("ops"), F.count_if(F.col("status") == "SUCCESS").alias("ok"), exact_sum(F.col("latency_ms")).alias("latency_sum"), F.count("latency_ms").alias("latency_n"))


def run_available(df: DataFrame, out: str, checkpoint: str) -> None:
    """Handles what is there, then stops; a later call goes on from the checkpoint."""
    df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
