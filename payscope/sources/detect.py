"""Format of each file from its suffix and its first lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.functions.scalars import exact_round, stripped
from payscope.sources.logs import fields, per_file

SAMPLE = 25
#: Line patterns of the formats.
JSON_OBJECT = r"^\s*\{.*\}\s*$"
AZURE = r'(?i)^"[^"]{10,30}",\s*\w+-\d+,\s*"[^"]+",.*\{.*(?:""psp""|"psp")'
NUMBERED = r"(?i)^\s*\d+\.\s+\d{4}/\d{2}/\d{2}\s+\d{2}:\d{2}:\d{2}\s+-\s+withdrawal"


def told(file_name: Column, sample: Column) -> Column:
    """struct(format, confidence) from a file's name and an array of its first lines."""
    suffix = F.lower(F.regexp_extract(file_name, r"(\.[^.]*)$", 1))
    full = F.filter(sample, lambda x: stripped(x) != "")
    n = F.size(full)
    share = lambda p: F.size(F.filter(full, lambda x: x.rlike(p))) / n
    scaled = lambda base, s: exact_round(F.least(F.lit(base) + s * F.lit(1.0 - base), F.lit(1.0)), 3)
    is_ = lambda name, c: F.struct(F.lit(name).alias("format"), (c if isinstance(c, Column) else F.lit(c)).alias("confidence"))
    first = F.get(full, F.lit(0))
    header = fields(first)
    return (
        F.when(suffix == ".xlsx", is_("xlsx", 1.0)).when(suffix == ".jsonl", is_("json_lines", 0.95)).when(n == 0, is_("unknown", 0.0))
        .when(first.rlike(r"^\s*\["), is_("json_array", 0.95))
        .when(share(JSON_OBJECT) >= 0.80, is_("json_lines", scaled(0.70, share(JSON_OBJECT))))
        .when(share(AZURE) >= 0.60, is_("azure_withdrawal_csv", scaled(0.70, share(AZURE))))
        .when(share(NUMBERED) >= 0.40, is_("freetext_numbered", scaled(0.60, share(NUMBERED))))
        .when((F.size(header) >= 3) & F.forall(header, lambda c: F.length(c) < 60), is_("csv_generic", 0.70))
        .otherwise(is_("unknown", 0.30))
    )


def first_lines(lines: DataFrame, n: int = SAMPLE) -> DataFrame:
    """(path, source_file, sample): up to n first lines of each file, without gathering the rest.

    Within a partition only lines that can be among the first n of a block are kept, by their place in it."""
    first = lines.groupBy("path").agg(F.min("_ord").alias("_first"))
    near = per_file(lines, first).where((F.col("_ord.b") == F.col("_first.b")) & (F.col("_ord.i") < F.col("_first.i") + n))
    return near.groupBy("path", "source_file").agg(F.transform(F.array_sort(F.collect_list(F.struct("_ord", "value"))), lambda x: x["value"]).alias("sample"))


def detect(lines: DataFrame) -> DataFrame:
    """(path, source_file, format, confidence) of files of lines (sources.logs.lines)."""
    return first_lines(lines).select("path", "source_file", told(F.col("source_file"), F.col("sample")).alias("t")).select("path", "source_file", "t.*")
