"""The corpus pipeline: language ID, near-duplicates, benchmark decontamination, secrets, and mixing by source.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. Stages 1 to 3 drop documents,
the fourth changes texts, the last says how many words of each document the mix takes. Null texts go in stage 1, as no
language can be told. Every other column stays as it is, whatever its name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.llm import decontaminate, language_id, mixture, near_dedup, secret_scan
from payscope.llm.common import flagged, kept, materialize, release, skewed, table

#: Cosine below which a text is taken for no language that the prototypes know.
MIN_LANGUAGE_SCORE = 0.05


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _packed(docs: DataFrame) -> DataFrame:
    """The whole row in one column, so that nothing an operator adds can clash with its columns."""
    return docs.select(F.struct(*_columns(docs)).alias("_row"), F.col("text").alias("_text"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prototypes = language_id.learn(docs.where(~language_id.held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang"))
    told = language_id.predict(_packed(docs), prototypes, "_text", keep=("_row",))
    return told.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row with the least doc_id stays, rows without one last; of rows equal in doc_id and text one.

    Rows are told apart by a hash of both. Those that surely stay aren't moved."""
    marked = docs.select(F.struct(*_columns(docs)).alias("_row"), "doc_id", "text", F.xxhash64("doc_id", "text").alias("_mark"))
    told = near_dedup.find(marked.select("doc_id", "text", "_mark"), mark="_mark")
    found = told.where("head IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark"))
    least = kept(found.groupBy("head").agg(first.alias("r"), F.count("*").alias("n")).where("n > 1"))
    sure = skewed(found.select("head", "doc_id", "mark"), least, ["head"], "n", found.count())
    sure = sure.withColumn("stays", (F.col("mark") == F.col("r.mark")) & F.col("doc_id").eqNullSafe(F.col("r.doc_id")))
    # rows of a group of several, but the one that stays; that one too if it stands more than once
    doubt = sure.groupBy("mark").agg(F.max("stays").alias("stays"), F.count("*").alias("times")).where("NOT stays OR times > 1")
    doubt = materialize(doubt.select(F.col("mark").alias("_mark"), "stays"))
    release(told)
    release(least)
    rows, n = marked.select("_row", "_mark"), doubt.count()
    met = flagged(rows, doubt, "_mark", n).join(doubt.hint("shuffle_hash"), "_mark", "left")
    parts = [flagged(rows, doubt, "_mark", n, keep=False), met.where("stays IS NULL").select("_row", "_mark"), met.where("stays").select("_row", "_mark").dropDuplicates(["_mark"])]
    return reduce(DataFrame.unionByName, parts).select("_row.*")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(_packed(docs), table(spark, sf_dir, "benchmark"), text="_text", carry="_row")
    return found.where("n_hit = 0").select("_row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(docs)
    return (clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean).select(*_columns(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.mix(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("secrets", secrets), ("mix", mix)]

#: SQL can express neither the learned stages nor the mix's draws; tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
