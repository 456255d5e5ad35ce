"""Round trips: events rendered in each log layout, parsed back, and held against the events themselves."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.functions.scalars import number
from payscope.operators import learn as L
from payscope.operators import metrics as M
from payscope.operators import registry as R
from payscope.plans import adapter as D
from payscope.plans import normalize as N

from payscope.plans import queries as P
from payscope.plans import report
from payscope.plans.queries import query
from payscope.sources import detect, logs, xlsx

_FIELDS = "'tx-' || event_id id, 'PSP_' || event_id % 6 psp, (['ING', 'UniCredit', 'Santander'])[(event_id % 3 + 1)::INT] bank, (['DE', 'FR', 'IT', 'ES'])[(event_id % 4 + 1)::INT] country, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END status, round(value, 2) amount, round(value * 3, 2) latency, CASE WHEN event_type = 'error' THEN 'TIMEOUT' END error"
_REST = f"psp, bank, country, status, amount, latency, error FROM (SELECT event_id, event_type, value, {_FIELDS} FROM events)"
_BACK = f"SELECT id, psp, bank, country, status, amount, latency, error FROM (SELECT {_FIELDS} FROM events)"


def cents(x) -> Column:
    """To two decimals as the SQL has it: the scaled double is rounded, so 1.005, which is 100.49999999999999 cents, gives 1.0."""
    return F.round(x * 100) / 100


def plain(x) -> Column:
    """A number as lines of text hold it, without an exponent; null where it has no such text."""
    return x.try_cast("decimal(38,2)").cast("string")


def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, k = D.table(spark, sf_dir, "events"), F.col("event_id")
    pick = lambda *v: F.element_at(F.array(*map(F.lit, v)), (k % len(v) + 1).cast("int"))
    bad = F.col("event_type") == "error"
    return e.select(
        k, F.col("ts"), F.concat(F.lit("tx-"), k).alias("id"), F.concat(F.lit("PSP_"), k % 6).alias("psp"), pick("ING", "UniCredit", "Santander").alias("bank"), pick("DE", "FR", "IT", "ES").alias("country"),
        F.when(bad, "FAILED").otherwise("SUCCESS").alias("status"), cents(F.col("value")).alias("amount"), F.col("value").alias("raw_value"), cents(F.col("value") * 3).alias("latency"), F.when(bad, "TIMEOUT").alias("error"))


def as_lines(df: DataFrame, value, path: str = "made") -> DataFrame:
    """Lines as sources.logs.lines gives them, from a text for each event."""
    return df.select(F.lit(path).alias("path"), F.lit(path).alias("source_file"), F.struct(F.lit(path).alias("p"), F.lit(0).cast("bigint").alias("b"), F.col("event_id").alias("i")).alias("_ord"), value.alias("value"))


def with_header(df: DataFrame, header: str, value, path: str = "made") -> DataFrame:
    first = df.sparkSession.range(1).select(F.lit(path).alias("path"), F.lit(path).alias("source_file"), F.struct(F.lit(path).alias("p"), F.lit(0).cast("bigint").alias("b"), F.lit(-1).cast("bigint").alias("i")).alias("_ord"), F.lit(header).alias("value"))
    return as_lines(df, value, path).unionByName(first)


def back(raw: DataFrame, id_=None, more: tuple[str, ...] = ()) -> DataFrame:
    value = lambda c: F.when(F.array_contains("zeros", c), 0.0).otherwise(number(F.col(c))) if "zeros" in raw.columns else number(F.col(c))
    return raw.select((F.col("id") if id_ is None else id_).alias("id"), "psp", "bank", "country", "status", value("amount").alias("amount"), value("latency_ms").alias("latency"), "error", *more)


def _json(names: dict[str, str], nested: bool = False):
    plain = [F.col(c).alias(n) for c, n in names.items() if not (nested and c in ("amount", "latency"))]
    inner = [F.struct(*[F.col(c).alias(names[c]) for c in ("amount", "latency")]).alias("detail")] if nested else []
    return F.to_json(F.struct(*plain, *inner))


@query(_BACK)
def azure_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rendered(spark, sf_dir)
    body = F.regexp_replace(_json({c: c for c in ("psp", "bank", "country", "status", "amount", "error")}), '"', '""')
    line = F.concat(F.lit('"'), F.date_format("ts", "MM/dd/yyyy, HH:mm:ss.SSSSSS"), F.lit('",'), "id", F.lit(',"POST /withdrawals/process",,True,,,'), F.col("latency").cast("string"), F.lit(",5sec-10sec,request,"), body)
    return back(logs.azure(as_lines(df, line)))


@query(f"SELECT 'line-' || event_id id, {_REST}")
def freetext_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rendered(spark, sf_dir)
    line = F.concat(F.col("event_id").cast("string"), F.lit(". "), F.date_format("ts", "yyyy/MM/dd HH:mm:ss"), F.when(F.col("error").isNull(), " - Withdrawal processed").otherwise(" - Withdrawal failed"),
                    F.format_string(" - PSP: %s, Bank: %s, Country: %s, Status: %s, Amount: %s, Latency: %sms", "psp", "bank", "country", "status", F.col("amount").cast("string"), F.col("latency").cast("string")),
                    F.coalesce(F.concat(F.lit(", Reason: "), "error"), F.lit("")))
    return back(logs.freetext(as_lines(df, line)))


@query(f"SELECT NULL::VARCHAR id, {_REST}")
def kv_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rendered(spark, sf_dir)
    given = lambda n, v: F.coalesce(F.concat(F.lit(f" {n}: "), v), F.lit(""))
    line = F.concat(F.lit("note: withdrawal psp: old PSP: "), "psp", F.lit(" bank: "), "bank", F.lit(" country: "), "country", F.lit(" status: "), F.lower("status"), given("amount", plain(F.col("amount"))), given("latency", plain(F.col("latency"))), given("reason", F.lower("error")))
    return back(logs.freetext(as_lines(df, line)))


_OTHER = {"id": "tx_id", "psp": "Provider", "bank": "bank_name", "country": "country_code", "status": "status", "amount": "transaction_amount", "latency": "response_time", "error": "error_code"}


@query(_BACK)
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return back(logs.json_objects(as_lines(rendered(spark, sf_dir), _json(_OTHER, nested=True))))


@query(_BACK)
def json_array_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of up to a thousand objects, each one array."""
    return back(logs.json_array(arrays(rendered(spark, sf_dir), _json(_OTHER))))


def arrays(df: DataFrame, objects) -> DataFrame:
    """Whole files as sources.logs.whole_files gives them: the events' objects, a thousand to an array."""
    f = F.concat(F.lit("made"), (F.col("event_id") / 1000).cast("bigint").cast("string"))
    return df.groupBy(f.alias("path")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(objects), ", "), F.lit("]")).alias("value")).select("path", F.col("path").alias("source_file"), "value")


@query(_BACK)
def csv_alias_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat_ws(",", "id", "psp", F.concat(F.lit('"'), "bank", F.lit('"')), "country", "status", F.col("amount").cast("string"), F.col("latency").cast("string"), F.coalesce("error", F.lit("")))
    return back(logs.csv(with_header(rendered(spark, sf_dir), "TX_ID, processor,issuer,region,status,value,elapsed,failure_reason", line)))


@query(f"SELECT id, 1.0::DOUBLE field_coverage, {_REST}")
def adaptive_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.format_string("payout tx_id=%s psp=%s bank=%s country=%s status=%s amount=%s latency_ms=%s%s", "id", "psp", "bank", "country", "status", F.col("amount").cast("string"), F.col("latency").cast("string"), F.coalesce(F.concat(F.lit(" reason="), "error"), F.lit("")))
    raw = logs.loose(as_lines(rendered(spark, sf_dir), line))
    return back(raw).join(raw.select("id", "field_coverage"), "id")


_NAMES = dict(zip(["ref", "acq", "fin", "land", "state", "sum", "took", "why"], ["id", "psp", "bank", "country", "status", "amount", "latency_ms", "error"], strict=True))
_VALUES = ["id", "psp", "bank", "country", "status", "amount", "latency", "error"]


@query(_BACK)
def tier0_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _VALUES])
    return back(logs.learned_csv(with_header(rendered(spark, sf_dir), ",".join(_NAMES), row), _NAMES))


@query(_BACK)
def tier0_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A learned format over lines of objects, and over files that are one array."""
    df, names = rendered(spark, sf_dir), dict(zip(_VALUES, _NAMES, strict=True))
    lines = as_lines(df.where("event_id % 2 = 0"), _json(names))
    return back(logs.learned_json(lines.unionByName(logs.elements(arrays(df.where("event_id % 2 = 1"), _json(names))).select(lines.columns)), _NAMES))


@query(f"SELECT NULL::VARCHAR id, id request, psp, bank, country, status, amount, latency, error FROM (SELECT {_FIELDS} FROM events)")
def tier0_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A learned format of free text that takes the field `id` for the request and leaves the others as they are."""
    line = F.format_string("payout id=%s psp=%s bank=%s country=%s status=%s amount=%s elapsed=%s%s", "id", "psp", "bank", "country", "status", F.col("amount").cast("string"), F.col("latency").cast("string"), F.coalesce(F.concat(F.lit(" reason="), "error"), F.lit("")))
    raw = logs.learned_text(as_lines(rendered(spark, sf_dir), line), {"id": "request"}, "learned")
    return raw.select("id", "request", "psp", "bank", "country", "status", number(F.col("amount")).alias("amount"), number(F.col("latency_ms")).alias("latency"), "error")


def _files(df: DataFrame, value) -> DataFrame:
    """Events dealt to ten files of unknown layout."""
    f = F.concat(F.lit("odd"), (F.col("event_id") % 10).cast("string"))
    return df.select(f.alias("path"), f.alias("source_file"), F.struct(f.alias("p"), F.lit(0).cast("bigint").alias("b"), F.col("event_id").alias("i")).alias("_ord"), value.alias("value"))


_COVERED = f"SELECT id, 1.0::DOUBLE field_coverage, {_REST}"


def _adapted(raw: DataFrame) -> DataFrame:
    return back(raw, more=("field_coverage",))


@query(f"{_COVERED} WHERE event_id % 10 < 5 OR event_id % 20 < 10")
def adaptive_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five files of objects only, and five of which every other line is one: half are enough."""
    noise = (F.col("event_id") % 10 >= 5) & (F.col("event_id") % 20 >= 10)
    return _adapted(logs.adaptive(_files(rendered(spark, sf_dir), F.when(noise, "no object, {broken").otherwise(_json(_OTHER, nested=True)))))


@query(_COVERED)
def adaptive_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = arrays(rendered(spark, sf_dir), _json(_OTHER))
    lines = whole.select("path", "source_file", F.struct(F.col("path").alias("p"), F.lit(0).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("i")).alias("_ord"), "value")
    return _adapted(logs.adaptive(lines, whole))


@query(_COVERED)
def adaptive_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten files of rows under a header, a quoted field over two lines in each row."""
    df = rendered(spark, sf_dir)
    heads = _files(df.select((F.col("event_id") % 10).alias("event_id")).distinct(), F.lit("TX_ID,processor,issuer,region,status,value,elapsed,failure_reason,note"))
    heads = heads.withColumn("_ord", F.col("_ord").withField("i", F.lit(-1).cast("bigint")))
    row = F.concat_ws(",", "id", "psp", "bank", "country", "status", F.col("amount").cast("string"), F.col("latency").cast("string"), F.coalesce("error", F.lit("")))
    first, second = (_files(df, v).withColumn("_ord", F.col("_ord").withField("i", F.col("_ord.i") * 2 + k)) for k, v in enumerate((F.concat(row, F.lit(',"first')), F.lit('second, third"'))))
    return _adapted(logs.adaptive(logs.together([heads, first, second])))


_KINDS = ("json_lines", "azure_withdrawal_csv", "freetext_numbered", "csv_generic", "unknown", "json_array")


@query("""SELECT event_id % 60 f, (['json_lines', 'azure_withdrawal_csv', 'freetext_numbered', 'csv_generic', 'unknown', 'json_array'])[(event_id % 6 + 1)::INT] format, ([1.0, 1.0, 1.0, 0.7, 0.3, 0.95])[(event_id % 6 + 1)::INT]::DOUBLE confidence FROM events GROUP BY ALL""")
def format_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixty files, ten of each layout."""
    df = rendered(spark, sf_dir)
    k = F.col("event_id")
    line = (
        F.when(k % 6 == 0, _json({"id": "id", "psp": "psp"})).when(k % 6 == 1, F.concat(F.lit('"04/16/2026, 05:06:02.000000",tx-'), k.cast("string"), F.lit(',"POST /w",,True,,,1.5,x,request,{""psp"": ""A""}')))
        .when(k % 6 == 2, F.concat(k.cast("string"), F.lit(". 2026/04/16 13:20:05 - Withdrawal processed - x"))).when(k % 6 == 3, F.lit("a,b,c")).when(k % 6 == 4, F.lit("no layout")).otherwise(F.lit("[1]"))
    )
    f = (k % 60).cast("string")
    lines = df.select(f.alias("path"), F.concat(f, F.lit(".log")).alias("source_file"), F.struct(f.alias("p"), F.lit(0).cast("bigint").alias("b"), F.floor(k / 60).alias("i")).alias("_ord"), line.alias("value"))
    return detect.detect(lines).select(F.col("path").cast("bigint").alias("f"), "format", "confidence")


@query("""SELECT event_id, md5(array_to_string(list_sort([lower(trim(x)) FOR x IN [event_type, ' Psp', 'k' || event_id % 3]]), '|')) fingerprint FROM events""")
def fingerprint_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = D.table(spark, sf_dir, "events")
    return e.select("event_id", R.fingerprint(F.array(F.col("event_type"), F.lit(" Psp"), F.concat(F.lit("k"), F.col("event_id") % 3))).alias("fingerprint"))


@query("""SELECT event_id, raw, canonical FROM events, (VALUES (0, 'processor', 'psp'), (0, 'issuer', 'bank'), (0, 'amount_usd', 'amount'), (1, 'Region ', 'country'), (1, 'outcome', 'status'), (1, 'total_amount', 'amount')) t(m, raw, canonical) WHERE event_id % 2 = m""")
def field_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event has a header; a field that an earlier column has taken isn't given again."""
    k = F.col("event_id")
    names = lambda *v: F.array(*map(F.lit, v))
    header = F.when(k % 2 == 0, names("processor", "psp_id", "issuer", "amount_usd", "volume")).otherwise(names("Region ", "outcome", "total_amount", "k3"))
    return D.table(spark, sf_dir, "events").select("event_id", F.explode(L.mapping_of(header)).alias("raw", "canonical"))


@query("""WITH f AS (SELECT 'file_' || event_id file_name, CASE WHEN event_id % 5 = 0 THEN 'new' ELSE 'sha_' || event_id END sha256, event_id k FROM events)
SELECT file_name, sha256, k % 3 > 0 OR k % 5 = 0 OR k % 6 = 3 process, CASE WHEN k % 3 > 0 OR k % 5 = 0 THEN 1 WHEN k % 6 = 3 THEN 2 ELSE 0 END attempt FROM f""")
def registry_needs_processing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files 0 of 3 are known, done if 0 of 6, else tried once after two older entries; of each 5th the content is new."""
    e = D.table(spark, sf_dir, "events").select(F.col("event_id").alias("k"))
    name, sha = F.concat(F.lit("file_"), "k"), F.concat(F.lit("sha_"), "k")
    files = e.select(name.alias("file_name"), F.when(F.col("k") % 5 == 0, "new").otherwise(sha).alias("sha256"))
    old = e.where("k % 3 = 0").withColumn("t", F.explode(F.array(F.lit(1), F.lit(2))))
    entries = old.select(name.alias("file_name"), F.when(F.col("t") == 2, sha).otherwise("older").alias("sha256"), F.when((F.col("k") % 6 == 0) & (F.col("t") == 2), "SUCCESS").otherwise("PARTIAL").alias("status"), F.lit(1).alias("attempt"), F.lit("2026-01-01").alias("processed_at"), F.col("t").alias("_seq"))
    return R.needs_processing(files, entries)


@query("""WITH t AS (SELECT event_id % 10 f, CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END psp, CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END bank, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END amount FROM events)
SELECT f, field, hits::DOUBLE / n share FROM (SELECT f, 'psp' field, sum(psp) hits, count(*) n FROM t GROUP BY f UNION ALL SELECT f, 'bank', sum(bank), count(*) FROM t GROUP BY f UNION ALL SELECT f, 'amount', sum(amount), count(*) FROM t GROUP BY f) WHERE hits::DOUBLE / n >= 0.1""")
def learner_field_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    line = F.concat(F.lit("x "), F.when(k % 4 == 0, "psp=A ").otherwise(""), F.when(k % 11 == 0, "bank: B ").otherwise(""), F.when(k % 2 == 0, "amount=1.5").otherwise(""))
    return L.field_hits(D.table(spark, sf_dir, "events").select((k % 10).alias("f"), line.alias("value")), "f")


@query("SELECT 'f' || event_id fingerprint, CASE WHEN event_id % 2 = 0 THEN 'k' || event_id % 5 ELSE 'k' || event_id % 5 || ',issuer' END unmapped FROM events")
def unmapped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    odd = F.concat(F.lit("k"), k % 5)
    formats = D.table(spark, sf_dir, "events").select(F.concat(F.lit("f"), k).alias("fingerprint"), F.array(odd, F.lit("psp"), F.lit("issuer")).alias("raw_columns"),
        F.when(k % 2 == 0, F.create_map(F.lit("psp"), F.lit("psp"), F.lit("issuer"), F.lit("bank"))).otherwise(F.create_map(F.lit("psp"), F.lit("psp"))).alias("field_mapping"))
    return R.unmapped(formats).select("fingerprint", F.array_join("unmapped", ",").alias("unmapped"))


def workbook(rows: list[list]) -> bytes:
    """A minimal workbook of one sheet with inline texts and numbers."""
    cell = lambda v: f"<c><v>{v}</v></c>" if isinstance(v, (int, float)) else f'<c t="inlineStr"><is><t>{v}</t></is></c>'
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="a" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>" + "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in rows) + "</sheetData></worksheet>")
    return out.getvalue()


@query("SELECT 'tx-' || event_id id, 'PSP_' || event_id % 6 psp, round(abs(value) + 1, 2) volume, '2026-04-16T10:00:00' AS \"timestamp\", CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END status, true is_valid FROM events")
def xlsx_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in workbooks of up to a thousand rows, read back."""
    df = rendered(spark, sf_dir).withColumn("value", F.round(F.abs(F.col("raw_value")) + 1, 2)).withColumn("file", (F.col("event_id") / 1000).cast("bigint"))

    def written(group: pa.Table) -> pa.Table:
        rows = [["ID", "PSP", "bank", "country", "amount", "timestamp", "status"]]
        rows += [[r["id"], r["psp"], r["bank"], r["country"], r["value"], "2026-04-16 10:00:00", r["status"]] for r in group.to_pylist()]
        return pa.table({"path": [f"made{group['file'][0].as_py()}.xlsx"], "content": pa.array([workbook(rows)], pa.binary())})

    files = df.select("file", "id", "psp", "bank", "country", "value", "status").groupBy("file").applyInArrow(written, "path string, content binary")
    return N.normalize(xlsx.records(files)).select("id", "psp", "volume", "timestamp", "status", "is_valid")


@query("""WITH h AS (SELECT event_id k, CASE event_id % 3 WHEN 0 THEN 'k' || event_id || ',psp' WHEN 1 THEN 'psp,k' || event_id ELSE 'bank,country,k' || event_id END header FROM events)
SELECT k, md5(array_to_string(list_sort(string_split(header, ',')), '|')) fingerprint, CASE WHEN k % 3 = 2 THEN 0.333 ELSE 0.167 END::DOUBLE confidence, 'fmt' || k format_name, CASE WHEN k % 3 = 2 THEN 'bank' ELSE 'psp' END mapped FROM h WHERE k % 2 = 0""")
def approved_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files told by their headers' fingerprints, met with the formats learned from the same columns in any order; every other is approved."""
    k = F.col("event_id")
    odd = F.concat(F.lit("k"), k)
    e = D.table(spark, sf_dir, "events").select("event_id", F.when(k % 3 == 0, F.array(odd, F.lit("psp"))).when(k % 3 == 1, F.array(F.lit("psp"), odd)).otherwise(F.array(F.lit("bank"), F.lit("country"), odd)).alias("columns"))
    files = e.select(F.concat(F.lit("file"), "event_id").alias("file_name"), R.fingerprint(F.col("columns")).alias("fingerprint"))
    formats = e.select(
        R.fingerprint(F.reverse("columns")).alias("fingerprint"), F.concat(F.lit("fmt"), "event_id").alias("format_name"), F.lit("csv_headers").alias("extraction_hint"), L.mapping_of(F.col("columns")).alias("field_mapping"), (k % 2 == 0).alias("approved"))
    found = R.approved(formats, files)
    return found.select(F.substring("file_name", 5, 20).cast("bigint").alias("k"), "fingerprint", L.confidence_of(F.col("field_mapping")).alias("confidence"), "format_name", F.get(F.array_sort(F.map_values("field_mapping")), F.lit(0)).alias("mapped"))


@query("""SELECT 'f' || event_id fingerprint, CASE WHEN event_id % 2 = 0 THEN 't1' ELSE 't2' END detected_at, CASE WHEN event_id % 3 = 0 THEN 't1' ELSE 't2' END last_seen,
  CASE WHEN event_id % 2 = 0 AND event_id % 3 > 0 THEN 2 ELSE 1 END times_seen, CASE WHEN event_id % 2 = 0 AND event_id % 3 > 0 THEN 'old,new' WHEN event_id % 2 = 0 THEN 'old' ELSE 'new' END examples, event_id % 4 = 0 approved
FROM events WHERE event_id % 2 = 0 OR event_id % 3 > 0""")
def format_registry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats of every other event are known, those of two in three are learned (again)."""
    k = F.col("event_id")
    e = D.table(spark, sf_dir, "events")
    none = F.lit(None).cast("string")

    def entry(time, example, approved):
        return [F.concat(F.lit("f"), k).alias("fingerprint"), F.lit("n").alias("format_name"), F.lit("tabular").alias("structural_type"), time.alias("detected_at"), time.alias("last_seen"), F.lit(1).alias("times_seen"), F.array(F.lit(example)).alias("file_examples"),
                F.create_map(F.lit("a"), F.lit("psp")).alias("field_mapping"), F.lit("csv_headers").alias("extraction_hint"), F.lit(0.167).alias("learned_confidence"), F.array(F.lit("a")).alias("raw_columns"), F.create_map(F.lit("a"), F.array(F.lit("x"))).alias("sample_values"), approved.alias("approved")]

    merged = R.merged(e.where(k % 2 == 0).select(*entry(F.lit("t1"), "old", k % 4 == 0)), e.where(k % 3 > 0).select(*entry(none, "new", F.lit(False))), "t2")
    return merged.select("fingerprint", "detected_at", "last_seen", "times_seen", F.array_join("file_examples", ",").alias("examples"), "approved")


@query()
def report_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    from payscope.operators import anomalies as A

    rows = P.valid(spark, sf_dir).persist()
    metrics = M.by_group(rows)
    text = report.markdown(rows, metrics, M.by_psp(rows), A.detect(metrics, rows), [{"file": "events", "format": "csv_generic", "confidence": 0.7, "records": rows.count(), "status": "OK"}], "made", 0.0)
    rows.unpersist()
    return spark.createDataFrame([(i, x) for i, x in enumerate(text.split("\n")) if "Generated" not in x], "line int, text string")


