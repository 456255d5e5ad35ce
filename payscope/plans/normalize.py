"""From raw fields to records: cleaning, validation flags, confidence, severity, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payscope.functions.scalars import exact_round, filled, first_filled, number, number_text, parsed_time, stripped
from payscope.plans import schema as S


def status_of(raw: Column) -> Column:
    s = F.coalesce(stripped(F.upper(raw)), F.lit(""))
    out = F.lit("UNKNOWN")
    for name, states in S.STATUSES.items():
        out = F.when(s.isin(*states), name).otherwise(out)
    return out


def status_flag(raw: Column) -> Column:
    s = stripped(F.upper(raw))
    known = [x for states in S.STATUSES.values() for x in states]
    return F.when((s != "") & ~s.isin(*known), F.concat(F.lit("INVALID_STATUS:"), s))


def refined_status(status: Column, error: Column) -> Column:
    """A failure by decline is a decline."""
    return F.when((status == "FAILED") & (error == "DECLINED"), "DECLINED").otherwise(status)


def in_range(x: Column, below: float) -> Column:
    return F.when((x > 0) & (x < below), x)


def range_flag(x: Column, below: float, name: str) -> Column:
    return F.when(x.isNotNull() & ~((x > 0) & (x < below)), F.concat(F.lit(f"{name}_OUT_OF_RANGE:"), number_text(x)))


def _looked_up(key: Column, values: dict) -> Column:
    out = F.lit(None)
    for k, v in values.items():
        out = F.when(key == k, v).otherwise(out)
    return out


def severity_of(status: Column, error: Column) -> Column:
    return F.coalesce(_looked_up(error, S.ERROR_SEVERITY), _looked_up(status, S.STATUS_SEVERITY), F.lit("INFO"))


def confidence_of(filled_core: Column, source_format: Column, format_confidence: Column) -> Column:
    """Share of the six core fields, times the format's confidence, times the source's quality; 0 to 1, 3 decimals."""
    quality = F.coalesce(_looked_up(source_format, S.FORMAT_QUALITY), F.lit(S.OTHER_QUALITY))
    return exact_round(F.least(F.greatest(filled_core / F.lit(6.0) * format_confidence * quality, F.lit(0.0)), F.lit(1.0)), 3)


def band_of(confidence: Column) -> Column:
    out = F.lit(S.BANDS[-1][0])
    for name, least in reversed(S.BANDS[:-1]):
        out = F.when(confidence >= least, name).otherwise(out)
    return out


def _present(c: Column, kind: str) -> Column:
    there = c.isNotNull() if kind == "double" else c.isNotNull() & ~c.isin(*S.NO_VALUE)
    return F.when(there, 1).otherwise(0)


def normalize(raw: DataFrame, format_confidence: Column | float = 1.0) -> DataFrame:
    """Records (columns RECORD) with raw's other columns that begin with `_` kept.

    raw: any of the columns RAW, as text that is null where the value counts as absent. Duplicates are told apart by
    mark_duplicates(); here is_valid only says that nothing required is missing."""
    conf = format_confidence if isinstance(format_confidence, Column) else F.lit(float(format_confidence))
    have = set(raw.columns)

    def get(*names: str) -> Column:
        found = [F.col(f"`{n}`").cast("string") for n in names if n in have]
        return first_filled(*found) if found else F.lit(None).cast("string")

    def text(*names: str) -> Column:
        return F.coalesce(get(*names), F.lit(""))

    step = raw.select(
        *[F.col(f"`{c}`") for c in raw.columns if c.startswith("_")],
        text("id", "tx_id", "transaction_id").alias("id"), text("guid", "correlation_id").alias("guid"),
        F.coalesce(get("request"), F.lit(S.DEFAULT_REQUEST)).alias("request"), text("request_body").alias("request_body"),
        text("response", "response_body").alias("response"),
        stripped(text("psp")).alias("psp"), stripped(text("bank")).alias("bank"), F.upper(stripped(text("country"))).alias("country"),
        stripped(F.upper(text("error"))).alias("error"), F.lower(F.coalesce(get("event_type"), F.lit("request"))).alias("event_type"),
        text("source_file").alias("source_file"), text("source_format").alias("source_format"),
        get("status").alias("raw_status"), number(get("latency_ms", "latency", "duration_ms")).alias("raw_latency"),
        number(get("amount", "volume", "transaction_amount")).alias("raw_volume"), stripped(get("timestamp", "time", "@timestamp")).alias("raw_time"),
        conf.alias("format_confidence"),
    )
    step = step.withColumns({
        "time": F.date_format(parsed_time(F.col("raw_time")), "yyyy-MM-dd'T'HH:mm:ss"),
        "status": refined_status(status_of(F.col("raw_status")), F.col("error")),
        "latency_ms": in_range(F.col("raw_latency"), S.LATENCY_BELOW),
        "volume": in_range(F.col("raw_volume"), S.VOLUME_BELOW),
    })
    flags = F.array_compact(F.array(
        status_flag(F.col("raw_status")),
        range_flag(F.col("raw_latency"), S.LATENCY_BELOW, "LATENCY"),
        range_flag(F.col("raw_volume"), S.VOLUME_BELOW, "VOLUME"),
        F.when(F.col("raw_time").isNotNull() & F.col("time").isNull(), "UNPARSEABLE_TIMESTAMP"),
        F.when(F.col("psp") == "", "MISSING_PSP"),
        F.when(F.coalesce("time", filled(F.col("raw_time"))).isNull(), "MISSING_TIMESTAMP"),
    ))
    step = step.withColumn("timestamp", F.coalesce("time", "raw_time", F.lit(""))).withColumn("flags", flags)
    core = sum([_present(F.col(c), "double" if c in ("volume", "latency_ms") else "string") for c in ("psp", "bank", "country", "status", "volume", "latency_ms")][1:], _present(F.col("psp"), "string"))
    step = step.withColumns({
        "validation_flags": F.array_join("flags", "|"),
        "is_valid": ~F.exists("flags", lambda f: f.contains("MISSING")),
        "confidence": confidence_of(core, F.col("source_format"), F.col("format_confidence")),
        "severity": severity_of(F.col("status"), F.col("error")),
    })
    return step.select(*[F.col(f"`{c}`") for c in raw.columns if c.startswith("_")], *S.RECORD)


def mark_duplicates(records: DataFrame, order: str = "_ord") -> DataFrame:
    """Within a file, the first record of an id stands, whether or not it is valid; later ones are marked and invalid.

    Records without an id are never duplicates."""
    # rows without an id would meet in one task: they are dealt out by their place
    apart = F.when(F.col("id") == "", F.pmod(F.xxhash64(order), F.lit(4096))).otherwise(F.lit(0))
    place = F.row_number().over(Window.partitionBy("source_file", "id", "_apart").orderBy(order))
    again = (F.col("id") != "") & (F.col("_place") > 1)
    out = records.withColumn("_apart", apart).withColumn("_place", place)
    flags = F.when(again, F.concat_ws("|", filled(F.col("validation_flags")), F.lit("DUPLICATE_ID"))).otherwise(F.col("validation_flags"))
    return out.withColumn("validation_flags", flags).withColumn("is_valid", F.col("is_valid") & ~again).drop("_place", "_apart")


def split_valid(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); rejected records carry rejection_reason."""
    return records.where("is_valid"), records.where("NOT is_valid").withColumn("rejection_reason", F.col("validation_flags"))


def is_withdrawal(request: Column, provider: Column, event_type: Column, everything: Column) -> Column:
    """By the request's path, a provider, the kind of event, or a word in any value."""
    path = "|".join(S.WITHDRAWAL_PATHS)
    words = "|".join(S.WITHDRAWAL_WORDS)
    no = F.lit(False)
    return (
        F.coalesce(F.lower(request).rlike(path), no) | filled(provider).isNotNull()
        | F.coalesce(F.lower(event_type).isin(*S.WITHDRAWAL_EVENTS), no) | F.coalesce(F.lower(everything).rlike(words), no)
    )
