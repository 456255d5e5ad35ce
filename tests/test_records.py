"""Rules of single records, the layouts of log files, and a whole run."""

import json
import statistics

import duckdb
import pytest
from pyspark.sql import functions as F

from payscope.functions.scalars import exact_round, number, number_text, parsed_time
from payscope.operators import anomalies as A
from payscope.operators import learn as L
from payscope.operators import metrics as M
from payscope.operators import registry as R
from payscope.plans import normalize as N
from payscope.plans import pipeline
from payscope.sources import detect, logs, xlsx
from payscope.sources.queries import workbook

SF = "/root/testdata/sf0.001"


def test_exact_round_is_half_even_on_the_binary_value(spark):
    values = [i / 1000 for i in range(-500, 4000)] + [2.675, 1.005, 396.795, 0.125, 0.375, 1e6 + 0.005, 31.25]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", *[exact_round(F.col("x"), n).alias(f"r{n}") for n in (1, 2, 3)]).collect()
    assert all(r[f"r{n}"] == round(r["x"], n) for r in rows for n in (1, 2, 3))


def test_numbers(spark):
    texts = ["1_000", "12d", " 5 ", "nan", "-inf", "1e3", ".5", "5.", "", "x", "1__0", "+7"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(number(F.col("t"))).collect()]
    for t, g in zip(texts, got, strict=True):
        try:
            want = float(t)
        except ValueError:
            want = None
        assert (g is None) == (want is None) and (want is None or g == want or g != g and want != want)


def test_number_text(spark):
    values = [300000.0, 1e7, 12345678.9, 1e16, 1.5e20, -0.0005, 1e-5, 0.0, float("nan"), float("inf"), 123.25]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(number_text(F.col("x"))).collect()]
    assert got == [repr(v) for v in values]


def test_time_formats(spark):
    texts = ["04/16/2026, 05:06:02.000000", "2026/04/16 05:06:02", "2026-04-16T05:06:02.123Z", "2026-04-16T05:06:02Z", "2026-04-16T05:06:02", "2026-04-16 05:06:02,123", "2026-04-16 05:06:02", "16/Apr/2026:05:06:02", "soon"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.date_format(parsed_time(F.col("t")), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2026-04-16 05:06:02"] * 8 + [None]


def records(spark, rows):
    names = ["_ord", "id", "psp", "status", "error", "latency_ms", "amount", "timestamp", "source_file", "source_format"]
    return N.normalize(spark.createDataFrame(rows, ", ".join(f"{n} {'int' if n == '_ord' else 'string'}" for n in names)))


def test_flags_and_duplicates(spark):
    ok = ("2026-04-16 00:00:00", "f", "json_lines")
    rows = [
        (1, "a", "", "ok", None, "10", "5", *ok), (2, "a", "P", "ok", None, "10", "5", *ok), (3, None, "P", "missing", None, "300000", "1000000", *ok),
        (4, None, "P", "failed", "declined ", "0", None, "soon", "f", "x"), (5, None, "P", None, None, "nan", "1", None, "f", "x"), (6, "a", "P", "ok", None, "10", "5", ok[0], "g", ok[2]),
    ]
    got = {r["_ord"]: r for r in N.mark_duplicates(records(spark, rows)).collect()}
    assert got[1]["validation_flags"] == "MISSING_PSP" and not got[1]["is_valid"]
    assert got[2]["validation_flags"] == "DUPLICATE_ID" and not got[2]["is_valid"]
    assert got[3]["validation_flags"] == "INVALID_STATUS:MISSING|LATENCY_OUT_OF_RANGE:300000.0|VOLUME_OUT_OF_RANGE:1000000.0" and not got[3]["is_valid"]
    assert got[4]["status"] == "DECLINED" and got[4]["is_valid"] and got[4]["timestamp"] == "soon" and got[4]["validation_flags"] == "LATENCY_OUT_OF_RANGE:0.0|UNPARSEABLE_TIMESTAMP"
    assert got[5]["validation_flags"] == "LATENCY_OUT_OF_RANGE:nan|MISSING_TIMESTAMP" and got[6]["is_valid"]
    assert got[2]["confidence"] == round(4 / 6 * 0.95, 3) and got[4]["severity"] == "MEDIUM"


@pytest.mark.parametrize("n", [1, 2, 3, 19, 20, 21, 100])
def test_lower_rank_and_mean(spark, n):
    values = [((i * 7919) % 997) / 4 for i in range(n)]
    df = spark.createDataFrame([("k", v) for v in values] + [("k", None)], "k string, v double")
    row = M.lower_rank(df, ["k"], "v", (50, 95)).first()
    assert [row["p50"], row["p95"]] == [sorted(values)[max(0, int(n * p / 100) - 1)] for p in (50, 95)]
    assert df.agg(M.exact_mean(F.col("v"))).first()[0] == pytest.approx(statistics.mean(values), rel=1e-15)


def test_no_records(spark):
    rows = records(spark, [(1, "a", "P", "ok", None, "1", "1", "2026-04-16 00:00:00", "f", "x")]).where("false")
    metrics = M.by_group(rows)
    assert metrics.count() == 0 and A.detect(metrics, rows).count() == 0 and A.needs_approval(A.detect(metrics, rows)).first()["needs_approval"] is False


def test_json_types_and_collisions(spark, tmp_path):
    objects = [
        {"id": 1, "psp": "P", "status": False, "amount": 0, "latency": "0"}, {"ID": "2", "Provider": "Q", "status": "False", "d": {"amount": 2.5, "processor": "R"}},
        {"request": None, "note": "nothing"}, {"request": "GET /payout/1", "psp": None}, ["not an object"],
    ]
    (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, objects)) + "\n{broken\n\n")
    (tmp_path / "b.json").write_text(json.dumps(objects))
    lines = logs.json_objects(logs.lines(spark, str(tmp_path / "a.jsonl")))
    for df in (lines, logs.json_array(logs.whole_files(spark, str(tmp_path / "b.json")))):
        got = df.orderBy("_ord").collect()
        assert [(r["id"], r["psp"], r["status"], r["amount"], r["latency_ms"]) for r in got] == [("1", "P", None, None, "0"), ("2", "R", "False", "2.5", None), (None, None, None, None, None)]


def zeros_back(spark, folder, name):
    """A round-trip query over twenty events, half of them of value zero, against its SQL."""
    from payscope.queries import ORACLES, QUERIES

    con = duckdb.connect()
    con.execute(f"COPY (SELECT * REPLACE (CASE WHEN event_id % 4 < 2 THEN 0.0 ELSE value END AS value) FROM '{SF}/events.parquet' WHERE event_id < 20) TO '{folder}/events.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    got = [tuple(r[n] for n in names) for r in QUERIES[name](spark, str(folder)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, cur.fetchall())) and any(0.0 in r for r in got)


@pytest.mark.parametrize("name", ["adaptive_json_array", "adaptive_json_lines", "azure_roundtrip", "csv_alias_roundtrip", "freetext_roundtrip", "json_array_roundtrip", "jsonl_roundtrip", "kv_fallback", "tier0_json"])
def test_zeros_come_back(spark, tmp_path, name):
    zeros_back(spark, tmp_path, name)


def against_sql(spark, folder, name, events):
    """A query over events made from the smallest ones, of which _e is the table, against its SQL."""
    from payscope.queries import ORACLES, QUERIES

    con = duckdb.connect()
    con.execute(f"COPY (WITH _e AS (SELECT * FROM '{SF}/events.parquet' WHERE event_id < 40) {events}) TO '{folder}/events.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    got = [tuple(r[n] for n in names) for r in QUERIES[name](spark, str(folder)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, cur.fetchall()))


def test_rounding_is_that_of_the_sql(spark, tmp_path):
    against_sql(spark, tmp_path, "json_array_roundtrip", "SELECT * REPLACE ([1.005, 2.675, 0.125, 1.115, 8.345, 0.335, 33.3333333, 1e7 + 0.005][event_id % 8 + 1] AS value) FROM _e")


def test_missing_and_large_numbers_in_text(spark, tmp_path):
    against_sql(spark, tmp_path, "kv_fallback", "SELECT * REPLACE ([NULL, 1e7, 12345678.91, 4e6, 1e20, 0.004, 0.01, 1000][event_id % 8 + 1] AS value) FROM _e")


def test_events_given_twice_are_two_records(spark, tmp_path):
    against_sql(spark, tmp_path, "adaptive_json_lines", "SELECT * FROM _e UNION ALL SELECT * FROM _e WHERE event_id < 4")


def test_zeros_are_named_and_count_as_absent(spark, tmp_path):
    objects = [{"psp": "P", "amount": 0.0, "volume": 5, "latency": "0"}, {"psp": "P", "amount": "0", "volume": -0.0, "latency": 0}, {"psp": "P", "amount": None, "latency": False}]
    (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, objects)))
    raw = logs.json_objects(logs.lines(spark, str(tmp_path / "a.jsonl")))
    assert [(r["amount"], r["volume"], r["latency_ms"], sorted(r["zeros"])) for r in raw.orderBy("_ord").collect()] == [
        (None, "5", "0", ["amount"]), ("0", None, None, ["latency_ms", "volume"]), (None, None, None, [])]
    flags = [(r["volume"], r["validation_flags"]) for r in N.normalize(raw).orderBy("_ord").collect()]
    assert flags == [(5.0, "LATENCY_OUT_OF_RANGE:0.0|MISSING_TIMESTAMP"), (None, "VOLUME_OUT_OF_RANGE:0.0|MISSING_TIMESTAMP"), (None, "MISSING_TIMESTAMP")]


def test_run_over_a_folder(spark, tmp_path):
    logs_ = tmp_path / "in"
    logs_.mkdir()
    body = lambda i: json.dumps({"psp": "A", "bank": "B", "country": "de", "status": "SUCCESS" if i % 3 else "FAILED", "amount": 1.25 * i, "error": "TIMEOUT"} if i else {}).replace('"', '""')
    (logs_ / "azure.txt").write_text("\n".join(f'"04/16/2026, 05:06:{i:02}.000000",tx-{i},"POST /withdrawals/process",,True,,,{100 + i},x,request,{body(i)}' for i in range(30)))
    (logs_ / "free.log").write_text("\n\n".join(f"{i}. 2026/04/16 13:20:05 - Withdrawal processed - PSP: A, Bank: C, Country: fr, Status: Success, Amount: {i + 1}.5, Latency: 9{i}0ms" for i in range(9)))
    (logs_ / "odd.log").write_text("no layout at all\npayout psp=A amount=3\n")
    (logs_ / "skipped.bin").write_text("x")
    (logs_ / "book.xlsx").write_bytes(workbook([["id", "psp", "timestamp", ""], ["x1", "A", "2026-04-16 00:00:00", "y"], ["x2", "", "2026-04-16 00:00:00", "y"]]))
    asked = []

    def decide(path, offer):
        asked.append(offer)
        return "A"

    out = pipeline.run(spark, str(logs_), str(tmp_path / "out"), decide=decide)
    by_file = {f["file"]: f for f in out["files"]}
    assert {f: (x["format"], x["records"], x["rejected"], x["status"]) for f, x in by_file.items()} == {
        "azure.txt": ("azure_withdrawal_csv", 29, 1, "OK"), "free.log": ("freetext_numbered", 9, 0, "OK"), "odd.log": ("unknown", 0, 1, "OK"), "book.xlsx": ("xlsx", 1, 1, "OK")}
    assert len(asked) == 1 and asked[0]["file"] == "odd.log" and asked[0]["sample_lines"].startswith("no layout") and "0.30 < threshold 0.70" in asked[0]["reason"]
    assert by_file["odd.log"]["method"] == "adaptive_approved" and by_file["book.xlsx"]["flags"][0] == "HIGH_REJECTION_RATE:50.0%"
    assert out["valid"].count() == 39 and "## Executive Summary" in out["report"]
    assert {p.name.rsplit("_", 2)[0] for p in (tmp_path / "out").glob("*/*")} == {"withdrawals", "rejected", "metrics", "report", "run", "processed", "formats"}
    entries = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "out" / "audit" / "*")).collect()]
    told = {e["file_name"]: e for e in entries if "file_name" in e}
    assert told["azure.txt"]["parsing_method"] == "rules_based" and "body.psp->psp" in told["azure.txt"]["field_mappings_applied"] and told["odd.log"]["human_approval_flags"][0] == "USER_APPROVED_LOW_CONFIDENCE"
    assert [e["total_files"] for e in entries if e.get("event") == "RUN_COMPLETE"] == [4]
    # what is done is left out; the file without a valid record is tried again
    again = pipeline.run(spark, str(logs_), str(tmp_path / "out"), decide=decide)
    assert [(f["file"], f["attempt"]) for f in again["files"]] == [("odd.log", 2)]
    assert len(pipeline.run(spark, str(logs_), str(tmp_path / "out"), decide=decide, everything=True)["files"]) == 4


def test_a_broken_file_leaves_the_others(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    line = "1. 2026/04/16 13:20:05 - Withdrawal processed - PSP: A, Bank: C, Country: fr, Status: Success, Amount: 1.5, Latency: 90ms"
    for name in ("good.log", "bad.log"):
        (tmp_path / "in" / name).write_text(line)
    (tmp_path / "in" / "book.xlsx").write_bytes(b"no workbook")
    read = pipeline.READERS["freetext_numbered"]
    monkeypatch.setitem(pipeline.READERS, "freetext_numbered", lambda raw: read(raw).withColumn("psp", F.when(F.col("path").endswith("bad.log"), F.raise_error(F.lit("a bad block"))).otherwise(F.col("psp"))))
    out = pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert {f["file"]: (f["status"], f["records"]) for f in out["files"]} == {"good.log": ("OK", 1), "bad.log": ("ERROR", 0), "book.xlsx": ("NO_RECORDS", 0)}
    assert "XLSX_ERROR: BadZipFile" in next(f for f in out["files"] if f["file"] == "book.xlsx")["errors"][0]
    entries = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "out" / "audit" / "*")).collect()]
    assert [e["context"] for e in entries if e.get("event") == "PIPELINE_ERROR"] == ["bad.log"] and "a bad block" in str(entries)
    processed = {r["file_name"]: r["status"] for r in R.read_processed(spark, str(tmp_path / "out" / "registry" / "processed")).collect()}
    assert processed == {"good.log": "SUCCESS", "bad.log": "ERROR", "book.xlsx": "PARTIAL"}


def test_learned_formats_are_kept_and_used(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"who": "A", "transfer": "payout", "bank": "B", "sum": i + 1, "at": "2026-04-16 10:00:00"} for i in range(6)]
    (tmp_path / "in" / "half.log").write_text("# noise\n" * 5 + "\n".join(map(json.dumps, rows)))
    (tmp_path / "in" / "left.log").write_text("payout psp=A\n")
    out, state = pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out")), str(tmp_path / "out" / "registry" / "formats")
    assert {f["file"]: (f["status"], f["flags"]) for f in out["files"]} == {n: ("SKIPPED_BY_USER", ["USER_REJECTED_LOW_CONFIDENCE"]) for n in ("half.log", "left.log")}
    formats = R.read_formats(spark, state)
    entry = R.pending(formats).first()
    assert formats.count() == 1 and entry["format_name"].startswith("learned_json_lines_") and entry["field_mapping"] == {"bank": "bank", "sum": "amount"} and entry["file_examples"] == ["half.log"]
    assert R.entry(formats, entry["fingerprint"]).count() == 1 and "Mapped fields (2):" in L.summary(entry.asDict())
    mapped = formats.withColumn("field_mapping", F.map_concat("field_mapping", F.create_map(F.lit("who"), F.lit("psp"), F.lit("at"), F.lit("timestamp"))))
    R.save_formats(R.approve(mapped, entry["fingerprint"]), state)
    out = pipeline.run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert {f["file"]: f["records"] for f in out["files"]} == {"half.log": 6, "left.log": 0} and [r["psp"] for r in out["valid"].collect()] == ["A"] * 6
    assert R.read_formats(spark, state).first()["times_seen"] == 2 and [o["file"] for o in out["offers"].values()] == ["left.log"]


def test_adaptive_cascade(spark, tmp_path):
    texts = {
        "array": json.dumps([{"id": 1, "provider": "P", "d": {"value": 2}}, {"note": "payout"}, {"note": "other"}]), "lines": '{"id": 2, "psp": "Q"}\nx', "few": '{"id": 3, "psp": "Q"}\npayout psp=R id=4\ny',
        "csv": 'id,psp,note\n5,S,"a payout\nover two lines"\n6,,other\n', "over": "id,psp,note\n7,T,x,y payout psp=U\n", "two": "id,psp\n8,V\n", "empty": "",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.log").write_text(text)
    got = logs.adaptive(logs.lines(spark, str(tmp_path)), logs.whole_files(spark, str(tmp_path))).collect()
    # an object says nothing of withdrawals unless it names a provider or the word: no request is taken for granted
    assert sorted((r["source_file"][:-4], r["id"], r["psp"], r["field_coverage"]) for r in got if r["id"]) == [("array", "1", "P", 0.333), ("csv", "5", "S", 0.167), ("few", "4", "R", 0.167), ("lines", "2", "Q", 0.167)]
    assert sorted((r["source_file"][:-4], r["psp"]) for r in got if not r["id"]) == [("array", None), ("over", "U")]


@pytest.mark.parametrize("layout", ["array", "csv", "text"])
def test_first_lines_stay_on_the_executors(spark, tmp_path, monkeypatch, layout):
    """A file's first line can be all of its text: it isn't sent to the driver, and all records come."""
    note = "".join(chr(97 + i * i % 23) for i in range(20_000))
    text = {"array": json.dumps([{"id": str(i), "psp": "A", "note": note} for i in range(3)]), "csv": f"id,psp,{note}\n" + "".join(f"{i},A,x\n" for i in range(3)), "text": f"{note}\n" + "".join(f"payout id={i} psp=A\n" for i in range(3))}[layout]
    for k in range(4):
        (tmp_path / f"{k}.log").write_text(text)
    monkeypatch.setattr(logs, "BYTES", 10_000, raising=False)
    frame, sent = type(spark.range(0)), []
    monkeypatch.setattr(frame, "collect", lambda self, f=frame.collect: sent.append(f(self)) or sent[-1])
    raw = logs.adaptive(logs.lines(spark, str(tmp_path)), logs.whole_files(spark, str(tmp_path)))
    assert sent and len(str(sent)) < 10_000
    assert sorted((r["source_file"], r["id"], r["psp"]) for r in raw.collect()) == [(f"{k}.log", str(i), "A") for k in range(4) for i in range(3)]


def test_rows_over_several_lines(spark, tmp_path):
    import csv
    import io

    text = 'id,psp,note\n1,A,"one\ntwo ""quoted""\n\nthree"\n2,B,plain\n3,"C\nD",x\n'
    (tmp_path / "a.csv").write_text(text)
    got = logs.csv(logs.lines(spark, str(tmp_path / "a.csv"))).orderBy("_ord").select("id", "psp").collect()
    assert [tuple(r) for r in got] == [(r["id"], r["psp"]) for r in csv.DictReader(io.StringIO(text))]
    # blocks: a row that begins in one block ends in another
    parts = [(f"{b}", b, i, v) for b, i, v in ((0, 0, "id,psp,note"), (0, 1, '1,A,"x'), (64, 2, "y"), (128, 3, 'z",w'), (128, 4, "2,B,c"))]
    raw = spark.createDataFrame(parts, "k string, b long, i long, value string").select(F.lit("f").alias("path"), F.lit("f").alias("source_file"), F.struct(F.lit("f").alias("p"), "b", "i").alias("_ord"), "value")
    assert sorted(r["value"] for r in logs.logical(raw).collect()) == ['1,A,"x\ny\nz",w', "2,B,c", "id,psp,note"]
    torn = raw.withColumn("value", F.when(F.col("_ord.i") == 3, "no end").when(F.col("_ord.i") == 2, F.repeat(F.lit("y"), logs.ROW_CHARS)).otherwise(F.col("value")))
    assert logs.logical(torn).count() == 5


def test_detection(spark, tmp_path):
    for name, text in {"a.csv": "a,b,c\n1,2,3", "b.log": "", "c.txt": "[1]", "d.txt": '{"a":1}\n' * 4 + "x\n", "e.jsonl": "x", "f.txt": "one line"}.items():
        (tmp_path / name).write_text(text)
    got = {r["source_file"]: (r["format"], r["confidence"]) for r in detect.detect(logs.lines(spark, str(tmp_path))).collect()}
    assert got == {"a.csv": ("csv_generic", 0.7), "c.txt": ("json_array", 0.95), "d.txt": ("json_lines", 0.94), "e.jsonl": ("json_lines", 0.95), "f.txt": ("unknown", 0.3)}


def test_learning_and_registry(spark):
    entry = L.learn("x.csv", "processor,issuer,region,result,value,resp_time,decline_code\nA,B,DE,OK,1,2,")
    assert entry["learned_confidence"] == 1.0 and entry["fingerprint"] == L.file_fingerprint("processor,issuer,region,result,value,resp_time,decline_code\n") and L.learn("x", "") is None
    objects = "\n".join('{"b": %d, "psp": "x"}' % i for i in range(8))
    found = L.learn("x.log", objects + "\n" + "noise\n" * 12)
    assert found["format_name"].startswith("learned_json_lines_") and found["raw_columns"] == ["b", "psp"] and found["sample_values"]["b"] == ["0", "1", "2"]
    assert L.learn("x.log", objects, n_lines=21) is None or L.learn("x.log", objects, n_lines=21)["extraction_hint"] != "json_keys"
    assert L.learn("x.csv", "one,two\n1,2")["format_name"].startswith("learned_csv_") and L.learn("x.csv", "one,two\n1,2")["field_mapping"] == {} and L.learn("x.json", '[{"z": 1, "a": 2}]')["raw_columns"] == ["a", "z"]
    assert L.learn("x.txt", "psp: A bank: B\npsp: C bank: D")["field_mapping"] == {"psp": "regex:psp", "bank": "regex:bank"}
    empty = spark.createDataFrame([], R.FORMATS)
    row = {**entry, "detected_at": None, "last_seen": None, "times_seen": None, "approved": None}
    learned = spark.createDataFrame([row], R.FORMATS)
    once = R.merged(empty, learned, "t1")
    twice = R.merged(R.approve(once, entry["fingerprint"]), learned, "t2").first()
    assert (twice["times_seen"], twice["detected_at"], twice["last_seen"], twice["approved"], twice["file_examples"]) == (2, "t1", "t2", True, ["x.csv"])


def test_broken_workbook_is_reported(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(b"not a workbook")
    assert "BadZipFile" in xlsx.read(spark, str(tmp_path / "a.xlsx")).first()["_error"]


def test_stream(spark, tmp_path):
    from payscope.streaming import incremental as I

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("1. 2026/04/16 13:20:05 - Withdrawal processed - PSP: A, Bank: C, Country: fr, Status: Success, Amount: 1.5, Latency: 90ms\n")
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}2.log").write_text(f"2. 2026/04/16 13:20:05 - Withdrawal failed - PSP: {name}, Bank: C, Country: fr, Status: Failed, Amount: 1.5, Latency: 90ms, Reason: TIMEOUT\n")
        I.run_available(I.stream_records(spark, str(tmp_path / "in")).drop("_ord"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r["psp"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["A", "a", "b"]


@pytest.mark.parametrize("name", ["metrics_grouping_sets", "anomalies_all", "normalize_records", "azure_roundtrip", "format_detection", "registry_needs_processing"])
def test_queries_match_their_sql(spark, name):
    import os

    from payscope.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for f in os.listdir(SF):
        path = f"{SF}/{f}" + ("/*.parquet" if os.path.isdir(f"{SF}/{f}") else "")
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(str, (tuple(r[n] for n in names) for r in df.collect()))) == sorted(map(str, cur.fetchall()))
