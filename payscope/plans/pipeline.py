"""A run over a folder of log files: detect, parse, normalise, aggregate, find anomalies, write results and registries."""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.operators import anomalies as A
from payscope.operators import learn as L
from payscope.operators import metrics as M
from payscope.operators import registry as R
from payscope.plans import normalize as N
from payscope.plans import report
from payscope.plans import schema as S
from payscope.sources import detect as D
from payscope.sources import logs, xlsx

#: Where the fields of each layout come from, as the audit trail tells it.
_JSON = ["json_keys->alias_table->unified_schema"]
MAPPINGS = {
    "azure_withdrawal_csv": [
        "col[0]->timestamp", "col[1]->id", "col[2]->request", "col[7]->latency_ms", "body.psp->psp", "body.bank->bank", "body.country->country", "body.status->status",
        "body.amount->volume", "body.error->error"],
    "freetext_numbered": ["regex(PSP)->psp", "regex(Bank)->bank", "regex(Country)->country", "regex(Status)->status", "regex(Amount)->volume", "regex(Latency)->latency_ms", "regex(Reason)->error"],
    "json_lines": _JSON, "json_array": _JSON, "csv_generic": ["header_names->alias_table->unified_schema"],
}
OTHER_MAPPING = ["adaptive->regex_scan->unified_schema"]
OPTIONS = {"A": "take the loose reading of the file", "R": "leave the file out", "M": "leave it out now, to be read with a mapping of one's own"}
#: Bytes up to which a file's content is read for its hash; a larger one is told by path, size and time.
HASHED = 1 << 30
PREVIEW = 10


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """(path, file_name, sha256, mtime) of the folder's files of a known suffix; subfolders aren't looked into."""
    files = spark.read.format("binaryFile").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    known = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).isin(*S.SUFFIXES)
    told = lambda hashed: ("path", name.alias("file_name"), F.sha2(hashed, 256).alias("sha256"), F.col("modificationTime").cast("string").alias("mtime"))
    large = F.concat_ws("|", "path", "length", "modificationTime")
    return files.where(known & (F.col("length") <= HASHED)).select(*told(F.col("content"))).unionByName(files.where(known & (F.col("length") > HASHED)).select(*told(large)))


READERS = {"azure_withdrawal_csv": logs.azure, "freetext_numbered": logs.freetext, "json_lines": logs.json_objects, "csv_generic": logs.csv}
LEARNED = {"csv_headers": logs.learned_csv, "json_keys": logs.learned_json, "regex_kv": logs.learned_text}


def _bare(path: str) -> str:
    return path.split(":", 1)[-1].lstrip("/")


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def parse(spark: SparkSession, paths: dict[str, list[str]], learned: dict[str, dict] | None = None) -> DataFrame:
    """Raw records of files, by format -> paths. Each format's files are read once.

    Files of `unknown` layout are read with their learned format (path -> entry), if they have one, else loosely."""
    learned = learned or {}
    parts = [read(logs.lines(spark, paths[name])) for name, read in READERS.items() if paths.get(name)]
    if paths.get("json_array"):
        parts.append(logs.json_array(logs.whole_files(spark, paths["json_array"])))
    if paths.get("xlsx"):
        parts.append(xlsx.read(spark, paths["xlsx"]).where("_error IS NULL"))
    by_format: dict[str, list[str]] = {}
    for path in paths.get("unknown", ()):
        by_format.setdefault(learned[path]["fingerprint"] if path in learned else "", []).append(path)
    for fingerprint, own in by_format.items():
        if fingerprint:
            parts.append(_learned(spark, own, next(learned[p] for p in own)))
        else:
            parts.append(logs.adaptive(logs.lines(spark, own), _arrays(spark, own)).drop("field_coverage"))
    if not parts:
        none = ", ".join(f"`{c}` string" for c in ["path", *S.RAW])
        return spark.createDataFrame([], none).withColumn("_ord", F.struct(F.lit("").alias("p"), F.lit(0).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("i")))
    return logs.together(parts)


def _arrays(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Whole texts of the files that begin like an array; the others needn't be read in one piece."""
    heads = D.first_lines(logs.lines(spark, paths), 1).where(F.get("sample", F.lit(0)).rlike(r"^\s*\[")).select("path").collect()
    own = {_bare(r["path"]) for r in heads}
    found = [p for p in paths if _bare(p) in own]
    return logs.whole_files(spark, found) if found else None


def _learned(spark: SparkSession, paths: list[str], entry: dict) -> DataFrame:
    lines = logs.lines(spark, paths)
    if entry["extraction_hint"] == "json_keys" and (whole := _arrays(spark, paths)) is not None:
        is_array = F.coalesce(F.from_json("value", "array<variant>").isNotNull(), F.lit(False))
        arrays = whole.where(is_array).select("path")
        lines = lines.join(F.broadcast(arrays), "path", "left_anti").select(lines.columns).unionByName(logs.elements(whole.where(is_array)).select(lines.columns))
    return LEARNED[entry["extraction_hint"]](lines, entry["field_mapping"], entry["format_name"]).drop("field_coverage")


class Files:
    """What a run knows of each file, by path: format, confidence, what is told in the report and in the audit trail."""

    def __init__(self, listed: list[dict], told: dict[str, tuple[str, float]]):
        self.of = {
            f["path"]: {
                "file": f["file_name"], "format": told[f["path"]][0], "confidence": told[f["path"]][1], "records": 0, "rejected": 0, "status": "OK", "alert": False,
                "method": "adaptive" if told[f["path"]][0] == "unknown" else "adaptive_xlsx" if told[f["path"]][0] == "xlsx" else "rules_based",
                "mappings": [], "errors": [], "flags": [], "sha256": f["sha256"], "mtime": f["mtime"], "attempt": f["attempt"]}
            for f in sorted(listed, key=lambda f: f["path"])}
        self.learned: dict[str, dict] = {}
        self.trouble: list[tuple[str, str]] = []

    def paths(self) -> dict[str, list[str]]:
        """Format -> paths of the files that are to be read."""
        out: dict[str, list[str]] = {}
        for path, f in self.of.items():
            if f["status"] == "OK":
                out.setdefault(f["format"], []).append(path)
        return out

    def failed(self, path: str, error: Exception) -> None:
        self.of[path] |= {"status": "ERROR", "method": "error", "errors": [str(error)], "mappings": [], "flags": []}
        self.trouble.append((self.of[path]["file"], "".join(traceback.format_exception(error))))


def offers(spark: SparkSession, files: Files, formats: list[dict]) -> dict[str, dict]:
    """Path -> offer, for the files of unknown layout that no approved format reads; files.learned gets those that one does.

    The first lines of all such files, which a person is to decide on, are taken in one job."""
    unknown = files.paths().get("unknown", [])
    if not unknown:
        return {}
    lines = logs.lines(spark, unknown)
    filled = {_bare(r["path"]): r["n"] for r in lines.where(F.trim("value") != "").groupBy("path").agg(F.count("*").alias("n")).collect()}
    heads = {_bare(r["path"]): "\n".join(r["sample"]) for r in D.first_lines(lines, L.LINES).collect()}
    approved = {f["fingerprint"]: f for f in formats if f["approved"]}
    files.learned = {p: approved[k] for p in unknown if (k := L.file_fingerprint(heads.get(_bare(p), ""))) in approved}
    if files.learned:
        held = {_bare(r["path"]) for r in parse(spark, {"unknown": list(files.learned)}, files.learned).select("path").distinct().collect()}
        files.learned = {p: f for p, f in files.learned.items() if _bare(p) in held}
    out = {}
    for path in unknown:
        if path in files.learned:
            continue
        f, head = files.of[path], heads.get(_bare(path), "")
        entry = L.learn(f["file"], head, filled.get(_bare(path), 0))
        out[path] = {
            "file": f["file"], "format_confidence": f["confidence"], "reason": f"Format confidence {f['confidence']:.2f} < threshold {S.GATE:.2f}. No approved registry entry found.",
            "sample_lines": "\n".join(head.splitlines()[:PREVIEW]), "mapping_proposal": entry or {}, "mapping_summary": L.summary(entry) if entry else "", "options": OPTIONS}
    return out


def settle(files: Files, path: str, choice: str) -> None:
    """What a decision on an offer means for the file."""
    f = files.of[path]
    if choice == "A":
        f["method"] = "adaptive_approved"
        f["flags"].append("USER_APPROVED_LOW_CONFIDENCE")
    elif choice == "M":
        f |= {"method": "adaptive_modified", "status": "NO_RECORDS"}
        f["flags"].append("USER_MODIFIED_MAPPING")
    else:
        f["status"] = "SKIPPED_BY_USER"
        f["flags"].append("USER_REJECTED_LOW_CONFIDENCE")


def records_of(spark: SparkSession, files: Files, paths: dict[str, list[str]]) -> DataFrame:
    raw = parse(spark, paths, files.learned)
    scores = spark.createDataFrame([(_bare(p), float(f["confidence"])) for p, f in files.of.items()] or [("", 1.0)], "_path string, _conf double")
    name = F.regexp_replace(F.regexp_replace("path", "^[^:/]*:", ""), "^/+", "")
    # a row for each file that the driver has listed
    scores = F.broadcast(scores) if len(files.of) <= logs.FILES else scores.hint("merge")
    raw = raw.withColumn("_path", name).join(scores, "_path", "left")
    return N.mark_duplicates(N.normalize(raw, F.coalesce("_conf", F.lit(1.0))))


def counted(spark: SparkSession, files: Files) -> DataFrame:
    """The records, kept, with each file's numbers in files. A file that can't be read is an error of its own: the others go on."""

    def attempt(paths: dict[str, list[str]]) -> tuple[DataFrame, dict]:
        records = records_of(spark, files, paths).persist()
        rows = records.groupBy("_path").agg(F.count_if("is_valid").alias("ok"), F.count_if(~F.col("is_valid")).alias("bad")).collect()
        return records, {r["_path"]: r for r in rows}

    try:
        records, counts = attempt(files.paths())
    except Exception:  # noqa: BLE001  which file it was is found by reading each alone
        for name, own in files.paths().items():
            for path in own:
                try:
                    attempt({name: [path]})[0].unpersist()
                except Exception as e:  # noqa: BLE001
                    files.failed(path, e)
        records, counts = attempt(files.paths())
    for path, f in files.of.items():
        if f["status"] != "OK":
            continue
        ok, bad = (counts[_bare(path)]["ok"], counts[_bare(path)]["bad"]) if _bare(path) in counts else (0, 0)
        if not ok + bad:
            f["status"] = "NO_RECORDS"
            continue
        f |= {"records": ok, "rejected": bad, "alert": bad / (ok + bad) > S.REJECTION_ALERT, "mappings": MAPPINGS.get(f["format"], OTHER_MAPPING)}
        if f["alert"]:
            f["flags"].append(f"HIGH_REJECTION_RATE:{bad / (ok + bad):.1%}")
    return records


def write_csv(df: DataFrame, path: str, files: int | None = 1) -> None:
    """CSV with a header in one file, or in as many as there are partitions (files=None); without rows the text `(no data)`."""
    if df.isEmpty():
        df.sparkSession.createDataFrame([("(no data)",)], "value string").coalesce(1).write.text(path)
    else:
        (df.coalesce(files) if files else df).write.csv(path, header=True, emptyValue="", nullValue="")


def _processed(spark: SparkSession, files: Files, run_id: str) -> DataFrame:
    now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    status = lambda f: f["status"] if f["status"] == "ERROR" else "SUCCESS" if f["records"] else "PARTIAL"
    rows = [(f["file"], f["sha256"], f["mtime"], f["format"], f["records"] + f["rejected"], f["records"], f["rejected"], status(f), run_id, f["attempt"], now) for f in files.of.values()]
    return spark.createDataFrame(rows, R.PROCESSED).coalesce(1)


def _state(spark: SparkSession, state: str, files: Files, asked: dict[str, dict], run_id: str) -> None:
    """Both registries after the run: its files, the offers made, the formats used."""
    if files.of:
        R.append(_processed(spark, files, run_id), f"{state}/processed")
    learned = {o["mapping_proposal"]["fingerprint"]: o["mapping_proposal"] for o in asked.values() if o["mapping_proposal"]}
    used = sorted({f["fingerprint"] for f in files.learned.values()})
    if not learned and not used:
        return
    names: dict[str, list[str]] = {}
    for o in asked.values():
        if o["mapping_proposal"]:
            names.setdefault(o["mapping_proposal"]["fingerprint"], []).append(o["file"])
    rows = [e | {"file_examples": names[k], "detected_at": None, "last_seen": None, "times_seen": len(names[k]), "approved": False} for k, e in learned.items()]
    now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    R.save_formats(R.seen(R.merged(R.read_formats(spark, f"{state}/formats"), spark.createDataFrame(rows, R.FORMATS), now), used), f"{state}/formats")


def run(spark: SparkSession, folder: str, out: str, decide: Callable[[str, dict], str] = lambda path, offer: "R", approve: Callable[[DataFrame], bool] = lambda found: True, everything: bool = False, state: str | None = None, trigger: str = "manual", csv_files: int | None = 1) -> dict:
    """Runs all stages and writes normalised and rejected records, metrics, the report and the audit trail under out, in
    folders named by the run. Returns what was written and the frames.

    state holds the registries of processed files and of learned formats (out/registry if not given): files that are
    done are left out, unless everything is asked for. decide(path, offer) says, of a file of unknown layout, A (take the
    loose reading), R (leave it out) or M (leave it out, its mapping being changed). approve(found) False writes no
    results. A file that can't be read is reported, the others go on. Lists of files, offers and what is told of each file
    pass through the driver: a row for each file, 200 lines for each of unknown layout."""
    began, run_id = time.time(), datetime.now(UTC).strftime("%Y%m%d_%H%M%S")
    state = state or f"{out}/registry"
    found = inventory(spark, folder)
    if everything:
        found = found.withColumn("attempt", F.lit(1))
    else:
        found = R.needs_processing(found, R.read_processed(spark, f"{state}/processed")).where("process").drop("process")
    listed = [r.asDict() for r in found.collect()]
    texts = [f["path"] for f in listed if not f["path"].lower().endswith(".xlsx")]
    told = {f["path"]: ("xlsx", 1.0) for f in listed}
    if texts:
        known = {_bare(r["path"]): (r["format"], r["confidence"]) for r in D.detect(logs.lines(spark, texts)).collect()}
        told |= {p: known.get(_bare(p), ("unknown", 0.0)) for p in texts}
    files = Files(listed, told)
    asked = offers(spark, files, [r.asDict() for r in R.read_formats(spark, f"{state}/formats").where("approved").collect()])
    for path, offer in asked.items():
        settle(files, path, decide(path, offer | {"run_id": run_id}))
    if books := files.paths().get("xlsx"):
        for r in xlsx.read(spark, books).where("_error IS NOT NULL").select("path", "_error").collect():
            next(f for p, f in files.of.items() if _bare(p) == _bare(r["path"]))["errors"].append(f"XLSX_ERROR: {r['_error']}")
    records = counted(spark, files)
    stats = list(files.of.values())
    _state(spark, state, files, asked, run_id)
    valid, rejected = N.split_valid(records)
    metrics, by_psp = M.by_group(valid), M.by_psp(valid)
    anomalies = A.detect(metrics, valid)
    result = {"run_id": run_id, "records": records, "valid": valid, "rejected": rejected, "metrics": metrics, "by_psp": by_psp, "anomalies": anomalies, "severities": A.severity_counts(anomalies), "files": stats, "offers": asked}
    trouble = spark.createDataFrame([(report.error_entry(run_id, name, text),) for name, text in files.trouble], "value string")

    def close(trail: DataFrame) -> None:
        end = spark.createDataFrame([(report.summary_entry(run_id, sum(f["records"] for f in stats), len(stats), time.time() - began),)], "value string")
        reduce(DataFrame.unionByName, [trouble, trail, end]).coalesce(1).write.mode("append").text(f"{out}/audit/run_{run_id}")

    if not any(f["records"] for f in stats):
        close(trouble.limit(0))
        return result
    if A.needs_approval(anomalies).first()["needs_approval"]:
        if not approve(anomalies):
            close(trouble.limit(0))
            return result
        for f in stats:
            f["flags"].append("ANOMALY_APPROVED_BY_USER")
    columns = [c for c in S.RECORD]
    write_csv(valid.select(*columns), f"{out}/normalized/withdrawals_{run_id}", csv_files)
    write_csv(rejected.select(*columns, "rejection_reason"), f"{out}/normalized/rejected_{run_id}", csv_files)
    write_csv(metrics.orderBy("psp", "bank", "country"), f"{out}/results/metrics_{run_id}")
    text = report.markdown(valid, metrics, by_psp, anomalies, stats, run_id, time.time() - began)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{out}/results/report_{run_id}")
    close(report.audit(valid, anomalies, report.entries(spark, stats), run_id, trigger))
    return result | {"report": text}
