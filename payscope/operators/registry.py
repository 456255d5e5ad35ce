"""Registries of processed files and of learned formats, as small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.plans import schema as S

PROCESSED = "file_name string, sha256 string, mtime string, format string, records_total int, records_extracted int, records_skipped int, status string, run_id string, attempt int, processed_at string"
FORMATS = (
    "fingerprint string, format_name string, structural_type string, detected_at string, last_seen string, times_seen int, file_examples array<string>, "
    "field_mapping map<string,string>, extraction_hint string, learned_confidence double, raw_columns array<string>, sample_values map<string,array<string>>, approved boolean")  # fmt: skip


def exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Entries in the order they were added (_seq); lines that aren't JSON are left out. No registry: no entries."""
    seq = "struct<t:timestamp,p:string,b:bigint,i:bigint>"
    if not exists(spark, path):
        return spark.createDataFrame([], f"{PROCESSED}, _seq {seq}")
    m = "_metadata."
    order = F.struct(F.col(m + "file_modification_time").alias("t"), F.col(m + "file_path").alias("p"), F.col(m + "file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    return spark.read.text(path).select("value", order.alias("_seq")).select(F.from_json("value", PROCESSED).alias("e"), "_seq").where("e.file_name IS NOT NULL").select("e.*", "_seq")


def latest(entries: DataFrame, seq: str = "_seq") -> DataFrame:
    """The latest entry of each file; of equal times the one appended last. Entries are compared before they are dealt by file."""
    columns = [c for c in entries.columns if c not in ("file_name", "_at")]
    newest = entries.withColumn("_at", F.struct(F.coalesce("processed_at", F.lit("")).alias("t"), F.col(seq).alias("s")))
    return newest.groupBy("file_name").agg(F.max_by(F.struct(*columns), "_at").alias("e")).select("file_name", "e.*")


def needs_processing(files: DataFrame, entries: DataFrame, seq: str = "_seq") -> DataFrame:
    """files (file_name, sha256) with process and attempt.

    New and changed files: attempt 1. Done files, and those tried often enough: no. Others: the next attempt."""
    last = latest(entries, seq).select("file_name", F.col("sha256").alias("_sha"), "status", "attempt")
    fresh = F.col("_sha").isNull() | (F.col("_sha") != F.col("sha256"))
    tried = F.coalesce("attempt", F.lit(1))
    go = fresh | ((F.col("status") != "SUCCESS") & (tried < S.MAX_ATTEMPTS))
    out = files.join(last, "file_name", "left")
    return out.select(*files.columns, F.coalesce(go, F.lit(False)).alias("process"), F.when(fresh, 1).when(F.coalesce(go, F.lit(False)), tried + 1).otherwise(0).alias("attempt"))


def append(entries: DataFrame, path: str) -> None:
    """Adds entries as JSON lines."""
    entries.select(F.to_json(F.struct(*entries.columns)).alias("value")).write.mode("append").text(path)


def read_formats(spark: SparkSession, path: str) -> DataFrame:
    """The learned formats; none where there is no registry."""
    if not exists(spark, path):
        return spark.createDataFrame([], FORMATS)
    return spark.read.text(path).select(F.from_json("value", FORMATS).alias("e")).where("e.fingerprint IS NOT NULL").select("e.*")


def save_formats(formats: DataFrame, path: str) -> None:
    """Replaces the registry. Its rows, one for each layout that a person was asked about, pass through the driver, as the
    folder that they are read from is written anew."""
    rows = [tuple(r) for r in formats.select(F.to_json(F.struct(*formats.columns))).collect()]
    formats.sparkSession.createDataFrame(rows, "value string").coalesce(1).write.mode("overwrite").text(path)


def entry(formats: DataFrame, fingerprint: str) -> DataFrame:
    """The format of this fingerprint, approved or not."""
    return formats.where(F.col("fingerprint") == fingerprint)


def seen(formats: DataFrame, fingerprints: list[str]) -> DataFrame:
    """The registry after formats have been used: one more sighting of each."""
    return formats.withColumn("times_seen", F.coalesce("times_seen", F.lit(0)) + F.when(F.col("fingerprint").isin(fingerprints), 1).otherwise(0))


def fingerprint(keys: Column) -> Column:
    """Of an array of names: the MD5 of the sorted, trimmed, lower-cased names."""
    return F.md5(F.array_join(F.array_sort(F.transform(keys, lambda k: F.lower(F.trim(k)))), "|"))


def approved(formats: DataFrame, files: DataFrame) -> DataFrame:
    """files (file_name, fingerprint) with the mapping of their approved format."""
    return files.join(formats.where("approved").select("fingerprint", "format_name", "extraction_hint", "field_mapping"), "fingerprint")


def pending(formats: DataFrame) -> DataFrame:
    return formats.where("NOT coalesce(approved, false)")


def merged(formats: DataFrame, learned: DataFrame, now: str) -> DataFrame:
    """The format registry after an upsert: a known format keeps its first date and approval, counts one more sighting
    and gains the file among its examples; what was learned anew replaces the rest."""
    a, b = formats.alias("a"), learned.alias("b")
    either = lambda c: F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c)
    seen = F.col("b.fingerprint").isNotNull()
    none = F.array().cast("array<string>")
    return a.join(b, F.col("a.fingerprint") == F.col("b.fingerprint"), "full").select(
        either("fingerprint"), either("format_name"), either("structural_type"), F.coalesce(F.col("a.detected_at"), F.lit(now)).alias("detected_at"),
        F.when(seen, F.lit(now)).otherwise(F.col("a.last_seen")).alias("last_seen"), (F.coalesce(F.col("a.times_seen"), F.lit(0)) + seen.cast("int")).alias("times_seen"),
        F.array_distinct(F.concat(F.coalesce(F.col("a.file_examples"), none), F.coalesce(F.col("b.file_examples"), none))).alias("file_examples"),
        either("field_mapping"), either("extraction_hint"), either("learned_confidence"), either("raw_columns"), either("sample_values"),
        F.coalesce(F.col("a.approved"), F.lit(False)).alias("approved"))


def approve(formats: DataFrame, fingerprint: str) -> DataFrame:
    return formats.withColumn("approved", F.col("approved") | (F.col("fingerprint") == fingerprint))


def unmapped(formats: DataFrame) -> DataFrame:
    return formats.select("fingerprint", F.array_except("raw_columns", F.map_keys("field_mapping")).alias("unmapped"))
