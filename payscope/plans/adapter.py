"""Raw payment fields made from the event tables, with the cases that validation tells apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMS = ("MM/dd/yyyy, HH:mm:ss.SSSSSS", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss,SSSSSS", "yyyy-MM-dd HH:mm:ss", "dd/MMM/yyyy:HH:mm:ss")
FORMATS = ("azure_withdrawal_csv", "freetext_numbered", "json_lines", "csv_generic")
SPREAD = ("events", "lineitem")
ERRORS = ("NETWORK_ERROR", "TIMEOUT", "DECLINED", "INSUFFICIENT_FUNDS")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one of fewer splits than there are cores is spread over them, as one task would else do all of its rows' work."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name in SPREAD and df.rdd.getNumPartitions() < cores else df


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw record for each event, its customer's segment as bank and nation as country; _ord is the event.

    Nations are broadcast: there are 25 of them at any size."""
    events, customer, nation = (table(spark, sf_dir, t) for t in ("events", "customer", "nation"))
    people = customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_mktsegment", "n_name")
    e = events.join(people, F.col("user_id") == F.col("c_custkey"))
    k = F.col("event_id")
    psp = F.concat(F.lit("PSP_"), k % 6)
    failed = F.col("event_type").isin("error", "view") | ((psp == "PSP_5") & (F.col("c_mktsegment") == "MACHINERY"))
    time = F.col("ts").cast("string")
    for i, form in enumerate(FORMS):
        time = F.when(k % 8 == i, F.date_format("ts", form)).otherwise(time)
    return e.select(
        k.alias("_ord"),
        F.concat(F.lit("tx-"), F.when(k % 101 == 5, k - 4).otherwise(k)).alias("id"),
        F.when(k % 97 == 0, "").otherwise(psp).alias("psp"), F.col("c_mktsegment").alias("bank"), F.lower("n_name").alias("country"),
        F.when(k % 50 == 0, "weird").when(failed, "failed").when(F.col("event_type") == "signup", " ok ").otherwise("SUCCESS").alias("status"),
        F.when(failed, F.element_at(F.array(*map(F.lit, ERRORS)), (F.floor(k / 6) % 4 + 1).cast("int"))).alias("error"),
        F.when(k % 89 == 0, "300000").otherwise((F.col("value") * 8).cast("string")).alias("latency_ms"),
        F.when(k % 83 == 0, "-5").otherwise(F.col("value").cast("string")).alias("amount"),
        F.when(k % 79 == 0, "not a time").when(k % 71 == 0, "").otherwise(time).alias("timestamp"),
        F.concat(F.lit("part_"), k % 4, F.lit(".log")).alias("source_file"), F.element_at(F.array(*map(F.lit, FORMATS)), (k % 4 + 1).cast("int")).alias("source_format"),
    )
