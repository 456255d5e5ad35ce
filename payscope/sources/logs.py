"""Log files of several layouts as raw records: columns of plans.schema.RAW as text, and _ord, the place in the file.
A number that is zero is null there, as it counts as absent; the column zeros tells its name.

All layouts but spreadsheets are read line by line with Spark's text source, so a file of any size is split. Line order
comes from the block a line is in and its place in the block's partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from payscope.functions.scalars import filled, let, number, number_text, stripped
from payscope.plans import schema as S
from payscope.plans.normalize import is_withdrawal

#: One delimited field, quoted or not.
FIELD = r'(?:"(?:[^"]++|"")*+"|[^,]*+)'
#: Files up to which what is known of each is broadcast to its lines.
FILES = 50_000
#: Bytes up to which the first lines of files are broadcast: one can be all of its file's text.
BYTES = 8 << 20
#: Characters of a row that quotes hold together over several lines; a longer one is taken for lines with a stray quote.
ROW_CHARS = 131_072


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, source_file, _ord, value) of every line."""
    m = "_metadata."
    return spark.read.text(paths).select(
        F.col(m + "file_path").alias("path"), F.col(m + "file_name").alias("source_file"),
        F.struct(F.col(m + "file_path").alias("p"), F.col(m + "file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("_ord"), "value")


def few(table: DataFrame, wide: bool = False) -> list | None:
    """The rows of a table of at most FILES rows, else None. wide: rows can be of any length, and are asked for only if all hold at most BYTES."""
    if not wide:
        rows = table.take(FILES + 1)
        return rows if len(rows) <= FILES else None
    held = table.persist(StorageLevel.DISK_ONLY)
    try:
        n, size = held.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long")), F.lit(0))).first()
        return held.collect() if n <= FILES and size <= BYTES else None
    finally:
        held.unpersist()


def dealt(table: DataFrame, rows: list | None) -> DataFrame:
    """A table as values that are broadcast, without its lineage, if few() gave its rows; else to be dealt by its key."""
    return table.hint("merge") if rows is None else F.broadcast(table.sparkSession.createDataFrame(rows, table.schema))


def small(table: DataFrame, wide: bool = False) -> DataFrame:
    return dealt(table, few(table, wide))


def per_file(raw: DataFrame, table: DataFrame, wide: bool = False) -> DataFrame:
    """raw joined on path with a table of one row for each file: broadcast up to FILES rows, so one large file isn't one task's."""
    return raw.join(small(table, wide), "path")


def logical(raw: DataFrame) -> DataFrame:
    """Rows whose quoted fields span lines, put together; the lines of files without an odd number of quotes in one stay as they are.

    Whether a line begins inside quotes follows from the quotes before it, summed within the file's blocks and then
    over the blocks, so no task gets a whole file."""
    odd = (F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))) % 2
    files = raw.where(odd == 1).select("path").distinct()
    if files.isEmpty():
        return raw
    files = small(files)
    within, earlier = Window.partitionBy("path", "_b").orderBy("_ord"), Window.partitionBy("path").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    held = raw.join(files, "path").withColumns({"_b": F.col("_ord.b"), "_odd": odd.cast("long")})
    held = held.withColumn("_own", F.coalesce(F.sum("_odd").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # where a block's last row begins, if the block itself begins outside quotes and if inside
    last = lambda k: F.max(F.when((F.col("_own") + k) % 2 == 0, F.col("_ord")))
    blocks = held.groupBy("path", "_b").agg(F.sum("_odd").alias("_sum"), last(0).alias("_last0"), last(1).alias("_last1"))
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    blocks = blocks.withColumn("_carried", F.max(F.when(F.col("_before") % 2 == 0, F.col("_last0")).otherwise(F.col("_last1"))).over(earlier))
    held = held.join(small(blocks.select("path", "_b", "_before", "_carried")), ["path", "_b"])
    start = F.when((F.col("_before") + F.col("_own")) % 2 == 0, F.col("_ord"))
    held = held.withColumn("_row", F.coalesce(F.max(start).over(within.rowsBetween(Window.unboundedPreceding, 0)), "_carried"))
    # a quote that nothing closes doesn't gather the rest of the file
    chars = F.sum(F.length("value").cast("long")).over(Window.partitionBy("path", "_row"))
    held = held.withColumn("_chars", chars).withColumn("_row", F.when(F.col("_chars") <= ROW_CHARS, F.col("_row")).otherwise(F.col("_ord")))
    rows = held.groupBy("path", "source_file", "_row").agg(F.array_sort(F.collect_list(F.struct("_ord", "value"))).alias("ls"))
    rows = rows.select("path", "source_file", F.col("_row").alias("_ord"), F.array_join(F.transform("ls", lambda x: x["value"]), "\n").alias("value"))
    return raw.join(files, "path", "left_anti").select(rows.columns).unionByName(rows)


def together(parts: list[DataFrame]) -> DataFrame:
    """The records of several layouts as one table; a layout's missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def unquoted(field: Column) -> Column:
    q = F.when(field.startswith('"'), F.regexp_replace(F.regexp_replace(field, r'^"|"$', ""), '""', '"')).otherwise(field)
    return q


def fields(line: Column) -> Column:
    """The fields of a delimited line, quotes taken off."""
    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]++|"")*+"|[^,]*+)'), F.lit(1)), unquoted)


def zeros(zero: dict[str, Column]) -> Column:
    """The names of the numbers that are zero: they count as absent, as null does, but were given."""
    return F.array_compact(F.array(*[F.when(z, n) for n, z in zero.items()])).cast("array<string>").alias("zeros")


def is_zero(v: Column) -> Column:
    """Whether a variant is a number that is zero; a text isn't."""
    return F.schema_of_variant(v).rlike("^(BIGINT|DECIMAL|DOUBLE)") & (F.try_variant_get(v, "$", "double") == 0)


def truthy(v: Column) -> Column:
    """A variant as text; null where it is null, false, zero, empty or a nested value without content."""
    return let(v, _truthy)


def _truthy(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    size = F.try_variant_get(v, "$", "double")
    numeric = F.regexp_replace(number_text(size), r"\.0$", "")
    return (
        F.when(v.isNull() | kind.isin("VOID"), F.lit(None)).when(kind == "BOOLEAN", F.when(text == "true", "True"))
        .when(kind == "STRING", filled(text)).when(kind == "BIGINT", F.when(text != "0", text))
        .when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), F.when(size != 0, F.when(kind == "DOUBLE", number_text(size)).otherwise(numeric))).otherwise(F.when(~text.isin("{}", "[]"), text))
    )


def _parsed(text: Column) -> Column:
    return F.try_parse_json(text)


# Delimited lines with a JSON body -----------------------------------------------------------------------------------


def azure(raw: DataFrame) -> DataFrame:
    """Ten fields, then a JSON body whose quotes are doubled and whose commas may have split it. Quoted fields may span lines."""
    row = logical(raw).where("value <> ''")
    at = lambda i: F.trim(F.coalesce(F.get("f", F.lit(i)), F.lit("")))
    body = F.trim(F.regexp_extract("value", rf"(?s)^(?:{FIELD},){{10}}(.*)$", 1))
    outer = F.when(body.rlike('^".*"$'), F.regexp_replace(F.regexp_replace(body, '^"|"$', ""), '""', '"'))
    kept = F.coalesce(F.when(_parsed(outer).isNotNull(), outer), F.when(_parsed(body).isNotNull(), body), F.regexp_replace(body, '""', '"'))
    row = row.withColumns({"f": fields(F.col("value")), "body": kept}).withColumn("v", _parsed(F.col("body")))
    row = row.withColumn("v", F.when(F.schema_of_variant("v").startswith("OBJECT"), F.col("v")))
    part = lambda k: truthy(F.try_variant_get("v", f"$.{k}", "variant"))
    out = row.select(
        "path", "_ord", "source_file", F.lit("azure_withdrawal_csv").alias("source_format"), filled(at(0)).alias("timestamp"), filled(at(1)).alias("id"), filled(at(2)).alias("request"), filled(at(3)).alias("guid"),
        F.when(number(at(7)) != 0, at(7)).alias("latency_ms"), filled(at(9)).alias("event_type"), *[part(k).alias(k) for k in ("psp", "bank", "country", "status", "amount", "error")],
        F.when(F.col("v").isNotNull(), F.col("body")).alias("request_body"),
        zeros({"latency_ms": number(at(7)) == 0, "amount": is_zero(F.try_variant_get("v", "$.amount", "variant"))}))
    return _withdrawals(out)


def _withdrawals(df: DataFrame) -> DataFrame:
    every = F.concat_ws(" ", *[F.col(f"`{c}`") for c in df.columns if not c.startswith("_") and c not in ("path", "zeros")])
    none = F.lit(None).cast("string")
    has = lambda c: F.col(c) if c in df.columns else none
    return df.where(is_withdrawal(has("request"), has("psp"), has("event_type"), every))


# Numbered free text ------------------------------------------------------------------------------------------------

#: The layout of a numbered line, and of a name and value anywhere in a line.
NUMBERED = (
    r"(?i)^\s*(\d+)\.\s+(\d{4}/\d{2}/\d{2}\s+\d{2}:\d{2}:\d{2})\s+-\s+Withdrawal\s+(?:processed|failed)\s+-\s+PSP:\s*([^,]+),\s*Bank:\s*([^,]+),\s*Country:\s*([^,]+)"
    r",\s*Status:\s*([^,]+),\s*Amount:\s*([\d.]+),\s*Latency:\s*([\d.]+)\s*ms(?:,\s*Reason:\s*(\S+))?")  # fmt: skip
NAMED = {"psp": r"PSP[:\s]+([^\s,]+)", "bank": r"Bank[:\s]+([^\s,]+)", "country": r"Country[:\s]+([^\s,]+)", "status": r"Status[:\s]+([A-Z]+)", "amount": r"Amount[:\s]+([\d.]+)", "latency_ms": r"Latency[:\s]+([\d.]+)", "error": r"Reason[:\s]+([^\s,]+)"}


def freetext(raw: DataFrame) -> DataFrame:
    """Numbered lines, or else the last value of each name in lines that speak of a withdrawal."""
    line = F.col("line")
    row = raw.withColumn("line", stripped(F.col("value"))).where("line <> ''").withColumn("full", line.rlike(NUMBERED))
    row = row.where(F.col("full") | line.rlike(r"(?i)\bwithdrawal\b"))
    every = "(?i)" + "|".join(NAMED.values())
    group = lambda i: filled(stripped(F.regexp_extract(line, NUMBERED, i)))
    last = lambda i: F.element_at(F.filter(F.regexp_extract_all(line, F.lit(every), F.lit(i)), lambda x: x != ""), -1)
    names = list(NAMED)
    order = {"psp": 3, "bank": 4, "country": 5, "status": 6, "amount": 7, "latency_ms": 8, "error": 9}
    values = {n: F.when(F.col("full"), group(order[n])).otherwise(F.when(F.size(F.filter(F.regexp_extract_all(line, F.lit(every), F.lit(i + 1)), lambda x: x != "")) > 0, last(i + 1))) for i, n in enumerate(names)}
    row = row.withColumns(values).where(F.col("full") | F.coalesce(*names).isNotNull())
    zero = lambda c: F.when(number(F.col(c)) != 0, F.col(c))
    return row.select(
        "path", "_ord", "source_file", F.lit("freetext_numbered").alias("source_format"), F.when(F.col("full"), group(2)).alias("timestamp"),
        F.when(F.col("full"), F.concat(F.lit("line-"), group(1))).alias("id"), F.lit(S.DEFAULT_REQUEST).alias("request"), F.lit("request").alias("event_type"),
        "psp", "bank", "country", F.upper("status").alias("status"), zero("amount").alias("amount"), zero("latency_ms").alias("latency_ms"), F.upper("error").alias("error"),
        zeros({c: number(F.col(c)) == 0 for c in ("amount", "latency_ms")}))


# JSON --------------------------------------------------------------------------------------------------------------


def canonical(name: Column) -> Column:
    """A key's canonical name: lower-cased, trimmed, other names replaced."""
    key = stripped(F.lower(name))
    table = F.create_map(*[F.lit(x) for pair in S.ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), key)


def json_objects(raw: DataFrame, text: str = "value", source_format: str = "json_lines", loose_: bool = False) -> DataFrame:
    """Raw records from objects, one for each row of raw: one level of nesting hoisted, keys made canonical; of equal
    names the last counts (the keys of a nested object come in alphabetical order). loose_: no request is taken for granted."""
    entries = "array<struct<key:string,value:variant>>"
    row = raw.where(stripped(F.col(text)).startswith("{")).withColumn("m", F.map_entries(F.from_json(text, "map<string,variant>"))).where("m IS NOT NULL")
    inner = lambda v: F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    flat = F.flatten(F.transform("m", lambda e: F.when(F.schema_of_variant(e["value"]).startswith("OBJECT"), F.coalesce(inner(e["value"]), F.array().cast(entries))).otherwise(F.array(e))))
    named = F.transform(flat, lambda e: F.struct(canonical(e["key"]).alias("key"), e["value"].alias("value")))
    row = row.withColumn("e", named)
    held = lambda k: F.try_element_at(F.filter("e", lambda x: x["key"] == k), F.lit(-1))["value"]
    value = lambda k: truthy(held(k))
    given = F.exists("e", lambda x: x["key"] == "request")
    every = F.array_join(F.transform("e", lambda x: F.coalesce(F.try_variant_get(x["value"], "$", "string"), F.lit("None"))), " ")
    names = [n for n in S.RAW if n not in ("source_file", "source_format")]
    row = row.select("path", "_ord", "source_file", F.coalesce(value("source_format"), F.lit(source_format)).alias("source_format"), *[value(n).alias(n) for n in names], zeros({n: is_zero(held(n)) for n in S.NUMBERS}), given.alias("_given"), every.alias("_every"), F.coalesce(value("provider"), value("psp_name")).alias("_provider"))
    request = F.when(F.col("_given") | F.lit(loose_), F.coalesce("request", F.lit(""))).otherwise(F.lit(S.DEFAULT_REQUEST))
    return row.where(is_withdrawal(request, F.coalesce("psp", "_provider"), F.col("event_type"), F.concat_ws(" ", "_every", "source_file", "source_format"))).drop("_given", "_every", "_provider")


def whole_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, source_file, value): each file's whole text in one row."""
    m = "_metadata."
    return spark.read.text(paths, wholetext=True).select(F.col(m + "file_path").alias("path"), F.col(m + "file_name").alias("source_file"), "value")


def elements(whole: DataFrame) -> DataFrame:
    """The elements of files that are one array, as lines of JSON; an invalid file gives nothing."""
    each = whole.select("path", "source_file", F.posexplode(F.from_json("value", "array<variant>")).alias("i", "v"))
    return each.select("path", "source_file", F.struct(F.col("path").alias("p"), F.lit(0).cast("bigint").alias("b"), F.col("i").cast("bigint").alias("i")).alias("_ord"), F.to_json("v").alias("value"))


def json_array(whole: DataFrame) -> DataFrame:
    """Whole files (path, source_file, value) that are one array of objects; what isn't an object is left out."""
    return json_objects(elements(whole), source_format="json_array")


# Delimited files with a header ------------------------------------------------------------------------------------


def headers(raw: DataFrame) -> DataFrame:
    """(path, names): the fields of each file's first line."""
    return raw.groupBy("path").agg(F.min_by("value", "_ord").alias("h"), F.min("_ord").alias("_first")).select("path", fields(F.col("h")).alias("names"), "_first")


def _cells(raw: DataFrame) -> DataFrame:
    """Rows under a header: names and cells, an array of the row's fields; blank lines are no rows."""
    raw = logical(raw)
    return per_file(raw, headers(raw), wide=True).where("_ord <> _first AND value <> ''").withColumn("cells", fields(F.col("value")))


def csv(raw: DataFrame, source_format: str = "csv_generic", loose_: bool = False) -> DataFrame:
    """Rows under a header: names made canonical, of equal names the last counts; fields beyond the header are dropped.

    loose_: as the loose reading has it, with what stands in the file only: no request is taken for granted, and
    values aren't trimmed."""
    rows = _cells(raw)
    rows = rows.withColumn("e", F.arrays_zip(F.transform("names", canonical).alias("n"), F.slice("cells", F.lit(1), F.size("names")).alias("v")))
    text = (lambda c: c) if loose_ else stripped
    value = lambda k: filled(text(F.try_element_at(F.filter("e", lambda x: x["n"] == k), F.lit(-1))["v"]))
    zero = lambda k: F.when(number(value(k)) != 0, value(k))
    names = [n for n in S.RAW if n not in ("source_file", "source_format", "latency_ms", "amount")]
    numbers = [value(c).alias(c) if loose_ else zero(c).alias(c) for c in ("latency_ms", "amount")]
    none = zeros({} if loose_ else {c: number(value(c)) == 0 for c in ("latency_ms", "amount")})
    out = rows.select("path", "_ord", "source_file", F.lit(source_format).alias("source_format"), *[value(n).alias(n) for n in names], *numbers, none, F.exists("e", lambda x: x["n"] == "request").alias("_given"), F.array_join("e.v", " ").alias("_every"))
    request = F.when(F.col("_given") | F.lit(loose_), F.coalesce("request", F.lit(""))).otherwise(F.lit(S.DEFAULT_REQUEST))
    return out.where(is_withdrawal(request, F.col("psp"), F.col("event_type"), F.concat_ws(" ", "_every", "source_file", "source_format"))).drop("_given", "_every")


# Unknown text -----------------------------------------------------------------------------------------------------

#: Names and values as they stand in text of no known layout.
LOOSE = {
    "psp": r'(?i)\bpsp\b["\s:=]+([A-Za-z0-9_\-]+)', "bank": r'(?i)\bbank\b["\s:=]+([A-Za-z0-9_\-]+)', "country": r'(?i)\bcountry\b["\s:=]+([A-Za-z]{2,3})',
    "status": r'(?i)\bstatus\b["\s:=]+"?([A-Z_]+)"?', "amount": r'(?i)\bamount\b["\s:=]+([\d.]+)',
    "latency_ms": r'(?i)\b(?:latency(?:_ms)?|duration(?:_ms)?|elapsed|response_time)\b["\s:=]+([\d.]+)',
    "error": r'(?i)\b(?:error|reason|failure_reason|decline_reason)\b["\s:=]+"?([A-Z_]+)"?',
    "timestamp": r"(\d{4}[/\-]\d{2}[/\-]\d{2}[\sT]\d{2}:\d{2}:\d{2})", "id": r'(?i)\b(?:id|tx_id|transaction_id)\b["\s:=]+"?([^\s",]+)"?',
}
#: The share of objects among a file's lines, and the names of a header, from which a file is read as such.
HALF, LEAST_NAMES = 0.50, 3
SPEAKS = r"(?i)\b(?:withdrawal|withdraw|/withdrawals/|payout|disbursement|remittance)\b"


def coverage(core: list[Column]) -> Column:
    from payscope.functions.scalars import exact_round

    return exact_round(sum([F.when(c.isNotNull() & ~c.isin(*S.NO_VALUE), 1).otherwise(0) for c in core[1:]], F.when(core[0].isNotNull() & ~core[0].isin(*S.NO_VALUE), 1).otherwise(0)) / F.lit(6.0), 3)


def loose(raw: DataFrame) -> DataFrame:
    """First value of each name, from lines that speak of a withdrawal and give one of the six core fields."""
    row = raw.where(F.col("value").rlike(SPEAKS)).withColumns({n: filled(F.regexp_extract("value", p, 1)) for n, p in LOOSE.items()})
    row = row.withColumn("field_coverage", coverage([F.col(c) for c in ("psp", "bank", "country", "status", "amount", "latency_ms")])).where("field_coverage > 0")
    return row.select("path", "_ord", "source_file", F.lit("adaptive_unknown").alias("source_format"), *LOOSE, "field_coverage")


def _covered(df: DataFrame) -> DataFrame:
    """With field_coverage; a number that is zero was given."""
    given = lambda c: F.when(F.array_contains("zeros", c), "0").otherwise(F.col(c)) if "zeros" in df.columns else F.col(c)
    return df.withColumn("field_coverage", coverage([given(c) for c in ("psp", "bank", "country", "status", "amount", "latency_ms")]))


def adaptive(raw: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """Files of unknown layout, each read by the first of these that gives records: an array of objects (of `whole`, files as
    whole_files() has them), lines of which at least half are objects, rows under a header of three names or more, and
    the first value of each name in lines that speak of a withdrawal. All files are read in one go; one row for each is
    what decides. With field_coverage. No names that a file doesn't hold are taken for granted."""
    text = stripped(F.col("value"))
    object_ = text.startswith("{") & F.schema_of_variant(_parsed(text)).startswith("OBJECT")
    told = raw.groupBy("path").agg(F.count_if(text != "").alias("n"), F.count_if(F.coalesce(object_, F.lit(False))).alias("objects"))
    array = F.lit(False)
    if whole is not None:
        first = F.get(F.from_json("value", "array<variant>"), F.lit(0))
        arrays = whole.where(stripped(F.col("value")).startswith("[")).select("path", F.schema_of_variant(first).startswith("OBJECT").alias("array"))
        told = told.join(arrays, "path", "left")
        array = F.coalesce("array", F.lit(False))
    told = told.select("path", F.when(array, 1).when((F.col("objects") > 0) & (F.col("objects") / F.col("n") >= HALF), 2).alias("_tier"))
    rows = few(told)
    if rows is None or any(r["_tier"] is None for r in rows):
        # headers are asked of the other files only: the first line of an array can be all of it
        told = dealt(told, rows)
        cells = _cells(raw.join(told.where("_tier IS NULL").drop("_tier"), "path"))
        # a row longer than its header has no name for what is left over, so the file isn't read this way
        widths = cells.groupBy("path").agg(F.max(F.size("cells") - F.size("names")).alias("over"), F.min(F.size(F.array_distinct("names"))).alias("width"))
        table = F.when((F.col("width") >= LEAST_NAMES) & (F.col("over") <= 0), 3).otherwise(4)
        told = told.join(widths, "path", "left").select("path", F.coalesce("_tier", table).alias("_tier"))
        rows = few(told)
    told = dealt(told, rows)
    of = lambda df, k: df.join(told, "path").where(F.col("_tier") == k).drop("_tier")
    name = "adaptive_unknown"
    readers = {
        1: lambda: _covered(json_objects(elements(of(whole, 1)), source_format=name, loose_=True)), 2: lambda: _covered(json_objects(of(raw, 2), source_format=name, loose_=True)),
        3: lambda: _covered(csv(of(raw, 3), name, loose_=True)), 4: lambda: loose(of(raw, 4))}
    wanted = {r["_tier"] for r in rows} if rows is not None else set(readers) - {1} | ({1} if whole is not None else set())
    parts = [readers[k]() for k in sorted(wanted | {4})]
    return together(parts)


def remapped(entries: Column, mapping: Column) -> Column:
    """Entries (key, value) with keys renamed by a learned mapping; keys it doesn't know stay."""
    return F.transform(entries, lambda e: F.struct(F.coalesce(F.try_element_at(mapping, e["key"]), e["key"]).alias("key"), e["value"].alias("value")))


def _mapping(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]) if mapping else F.create_map().cast("map<string,string>")


def _named(rows: DataFrame, value, zero: dict[str, Column] | None = None) -> DataFrame:
    """What entries `e` hold of each raw field; a learned format's records carry no file and no format."""
    names = [n for n in S.RAW if n not in ("source_file", "source_format")]
    out = rows.select("path", "_ord", F.lit("").alias("source_file"), F.lit("").alias("source_format"), *[value(n).alias(n) for n in names], zeros(zero or {}), F.array_join(F.transform("e", lambda x: F.coalesce(x["value"].cast("string"), F.lit("None"))), " ").alias("_every"))
    return out.where(is_withdrawal(F.col("request"), F.col("psp"), F.col("event_type"), F.col("_every"))).drop("_every")


def learned_csv(raw: DataFrame, mapping: dict[str, str], format_name: str = "") -> DataFrame:
    """Rows under a header whose names an approved learned format maps."""
    pairs = F.arrays_zip(F.col("names").alias("key"), F.slice("cells", F.lit(1), F.size("names")).alias("value"))
    rows = _cells(raw).withColumn("e", remapped(pairs, _mapping(mapping)))
    return _named(rows, lambda k: filled(F.try_element_at(F.filter("e", lambda x: x["key"] == k), F.lit(-1))["value"]))


def learned_json(raw: DataFrame, mapping: dict[str, str], format_name: str = "") -> DataFrame:
    """Objects, one for each line that begins with a brace, whose outer keys an approved learned format maps.

    For a file that is one array, raw is what elements() makes of it."""
    rows = raw.where(stripped(F.col("value")).startswith("{")).withColumn("m", F.map_entries(F.from_json("value", "map<string,variant>"))).where("m IS NOT NULL")
    rows = rows.withColumn("v", remapped(F.col("m"), _mapping(mapping)))
    texts = F.transform("v", lambda x: F.struct(x["key"].alias("key"), F.try_variant_get(x["value"], "$", "string").alias("value")))
    held = lambda k: F.try_element_at(F.filter("v", lambda x: x["key"] == k), F.lit(-1))["value"]
    return _named(rows.withColumn("e", texts), lambda k: truthy(held(k)), {n: is_zero(held(n)) for n in S.NUMBERS})


def learned_text(raw: DataFrame, mapping: dict[str, str], format_name: str) -> DataFrame:
    """Like loose(), each name renamed by an approved learned format; a core field renamed to another is no longer one."""
    row = raw.where(F.col("value").rlike(SPEAKS)).withColumns({f"_{n}": filled(F.regexp_extract("value", p, 1)) for n, p in LOOSE.items()})
    sources = {k: [f"_{n}" for n in reversed(LOOSE) if mapping.get(n, n) == k] for k in (n for n in S.RAW if n not in ("source_file", "source_format"))}
    none = F.lit(None).cast("string")
    row = _covered(row.withColumns({k: F.coalesce(*v) if v else none for k, v in sources.items()})).where("field_coverage > 0")
    return row.select("path", "_ord", "source_file", F.lit(format_name).alias("source_format"), *sources, "field_coverage")
