"""Key figures of groups of records, and lower nearest-rank percentiles that no task has to hold a group for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payscope.functions.scalars import rounded_column, stripped
from payscope.plans import schema as S


def label(c: Column) -> Column:
    """Trimmed text, UNKNOWN where there is none. Never null for the planner either: joins on it add no filters."""
    t = stripped(c)
    return F.coalesce(F.when(t != "", t), F.lit("UNKNOWN"))


def exact_sum(c: Column) -> Column:
    """A sum that doesn't depend on the order of rows."""
    return F.sum(c.cast("decimal(28,10)")).cast("double")


def exact_mean(c: Column) -> Column:
    """A mean of non-negative numbers from whole parts of 2**-20 and of 2**-60: the order of rows doesn't matter, and
    what doubles hold of the values isn't lost. Null where there are none."""
    scaled = c * F.lit(1048576.0)
    high = F.floor(scaled).cast("decimal(18,0)")
    low = F.floor((scaled - F.floor(scaled).cast("double")) * F.lit(1099511627776.0)).cast("decimal(18,0)")
    n = F.when(F.count(c) > 0, F.count(c)).cast("double")
    return F.sum(high).cast("double") / (n * F.lit(1048576.0)) + F.sum(low).cast("double") / (n * F.lit(1152921504606846976.0))


def figures() -> list[Column]:
    """Aggregates of one group, shared by all groupings."""
    error = F.upper(F.coalesce("error", F.lit("")))
    starts = F.count_if(F.lower(label(F.col("event_type"))).isin("request", "job_start"))
    return [
        F.count("*").alias("total_ops"),
        F.count_if(F.col("status") == "SUCCESS").alias("success_ops"),
        F.count_if(error == "DECLINED").alias("decline_ops"),
        F.count_if((F.col("status") != "SUCCESS") & error.isin(*S.TECHNICAL_ERRORS)).alias("error_count"),
        starts.alias("starts"),
        F.count_if(error == "TIMEOUT").alias("timeouts"),
        exact_mean(F.col("latency_ms")).alias("latency_mean"),
        F.max("latency_ms").alias("latency_max"),
        exact_sum(F.col("volume")).alias("volume_sum"),
    ]


def finished(df: DataFrame) -> DataFrame:
    """Columns METRIC from figures() and p50/p95."""
    df = df.withColumn("job_starts", F.when(F.col("starts") == 0, F.col("total_ops")).otherwise(F.col("starts"))).withColumn("job_finishes", F.col("job_starts") - F.col("timeouts"))
    share = lambda part, whole: (F.col(part).cast("double") / F.when(F.col(whole) != 0, F.col(whole)).cast("double") * 100.0)
    df = df.select(
        "*", share("success_ops", "total_ops").alias("_success"), share("decline_ops", "total_ops").alias("_decline"), share("error_count", "total_ops").alias("_error"), share("job_finishes", "job_starts").alias("_done"))
    # rounded once and named here: nothing above repeats the expressions
    numbers = {"_success": "success_rate_%", "_decline": "decline_rate_%", "_error": "error_rate_%", "_done": "job_completion_rate_%", "latency_mean": "avg_latency_ms", "p50": "p50_latency_ms", "p95": "p95_latency_ms", "latency_max": "max_latency_ms", "volume_sum": "transaction_total_volume"}
    df = df.select(
        "psp", "bank", "country", "total_ops", "success_ops", (F.col("total_ops") - F.col("success_ops")).alias("failed_ops"), "decline_ops", "error_count",
        F.col("total_ops").alias("total_withdrawals_checked"), "job_starts", "job_finishes", *[F.coalesce(rounded_column(c, 2), F.lit(0.0)).alias(n) for c, n in numbers.items()])
    return df.withColumn("conversion_rate_%", F.col("`success_rate_%`")).select(*[F.col(f"`{c}`") for c in S.METRIC])


def lower_rank(df: DataFrame, keys: list[str], value: str, percents: tuple[int, ...]) -> DataFrame:
    """(keys, p50, ...): the value at place max(0, n * p / 100 - 1), from 0, of each group in ascending order.

    Equal values are counted before they move. A group's values are cut into ranges one wide; ranges are summed over,
    and only the range that holds a place is ranked, so a hot group is spread over as many tasks as it has ranges.
    Nulls are left out; groups without values don't appear. Values must be finite. The counts are read twice; as their
    keys can't be null, both readers plan the same exchange and it is made once."""
    present = df.where(F.col(value).isNotNull()).select(*keys, F.coalesce(F.floor(value), F.lit(0)).alias("_range"), F.coalesce(F.col(value), F.lit(0)).alias("_value"))
    counts = present.groupBy(*keys, "_range", "_value").agg(F.count("*").alias("_n"))
    by_key = Window.partitionBy(*keys)
    ranges = counts.groupBy(*keys, "_range").agg(F.sum("_n").alias("_in"))
    ranges = ranges.withColumn("_before", F.sum("_in").over(by_key.orderBy("_range")) - F.col("_in")).withColumn("_all", F.sum("_in").over(by_key))
    wanted = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.greatest(F.lit(0), F.floor(F.col("_all") * p / 100) - 1).alias("place")) for p in percents]))
    places = ranges.withColumn("_w", wanted).where("_w.place >= _before AND _w.place < _before + _in").select(*keys, "_range", "_w.p", (F.col("_w.place") - F.col("_before")).alias("_place"))
    inside = counts.join(places, [*keys, "_range"])
    upto = F.sum("_n").over(Window.partitionBy(*keys, "p").orderBy("_value"))
    found = inside.withColumn("_upto", upto).where("_upto > _place AND _upto - _n <= _place")
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("p") == p, F.col("_value"))).alias(f"p{p}") for p in percents])


def labelled(records: DataFrame) -> DataFrame:
    return records.select(*[label(F.col(c)).alias(c) for c in ("psp", "bank", "country", "status")], "error", "event_type", "latency_ms", "volume")


def by_group(records: DataFrame) -> DataFrame:
    """Metrics of each (psp, bank, country)."""
    keys = ["psp", "bank", "country"]
    rows = labelled(records)
    return finished(rows.groupBy(*keys).agg(*figures()).join(lower_rank(rows, keys, "latency_ms", (50, 95)), keys, "left"))


def by_psp(records: DataFrame) -> DataFrame:
    """Metrics of each psp, with ALL for bank and country."""
    rows = labelled(records)
    all_ = F.lit("ALL")
    return finished(rows.groupBy("psp").agg(*figures()).join(lower_rank(rows, ["psp"], "latency_ms", (50, 95)), "psp", "left").withColumns({"bank": all_, "country": all_}))


def both(records: DataFrame) -> DataFrame:
    """by_group() and by_psp() rows in one pass over the records: each row counts for its group and for its psp."""
    rows = labelled(records).withColumn("_level", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = rows.withColumns({c: F.when(F.col("_level") == 1, "ALL").otherwise(F.col(c)) for c in ("bank", "country")})
    keys = ["_level", "psp", "bank", "country"]
    done = rows.groupBy(*keys).agg(*figures()).join(lower_rank(rows, keys, "latency_ms", (50, 95)), keys, "left")
    return finished(done)
