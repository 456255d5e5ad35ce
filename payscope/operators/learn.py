"""Layouts learned from a bounded sample of an unknown file: structure, field mapping, fingerprint.

An offer is made for a person to decide on, so its sample of one file's first lines is looked at on the driver; what
counts over many files is a DataFrame operation."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.functions.scalars import exact_round

CORE = ("psp", "bank", "country", "status", "amount", "latency_ms")
#: Names by which a canonical field is known, the most telling first.
SIMILAR = [
    (r"\bpsp(?:_name|_id|_code)?\b", "psp"), (r"\b(?:provider|processor|acquirer)\b", "psp"),
    (r"\bbank(?:_name|_code|_id)?\b", "bank"), (r"\b(?:issuer|institution|fin_inst)\b", "bank"),
    (r"\bcountry(?:_code|_iso)?\b", "country"), (r"\b(?:region|iso_country|nation)\b", "country"),
    (r"\bstatus(?:_code|_flag)?\b", "status"), (r"\b(?:result|outcome|state)\b", "status"),
    (r"\bamount(?:_usd|_eur|_gbp)?\b", "amount"), (r"\b(?:transaction_amount|value|sum|total_amount)\b", "amount"), (r"\b(?:volume|amt)\b", "amount"),
    (r"\b(?:latency(?:_ms)?|duration(?:_ms)?|elapsed|response_time|resp_time)\b", "latency_ms"),
    (r"\b(?:error(?:_code)?|failure_reason|decline_reason|reason)\b", "error"),
    (r"\b(?:tx_id|transaction_id|ref(?:erence)?_id|txn_id)\b", "id"), (r"\b(?:guid|correlation_id|trace_id|request_id)\b", "guid"),
    (r"\b(?:timestamp|ts|time|datetime|created_at|@timestamp)\b", "timestamp"), (r"\b(?:event_type|event|type|action)\b", "event_type"),
    (r"\b(?:request|req|endpoint|path|url)\b", "request"),
]
#: Names and values in free text.
IN_TEXT = {
    "psp": r"\bpsp[:\s=]+([A-Za-z0-9_\-]+)", "bank": r"\bbank[:\s=]+([A-Za-z0-9_\-]+)", "country": r"\bcountry[:\s=]+([A-Za-z]{2,3})", "status": r'\bstatus[:\s=]+"?([A-Z_]+)"?',
    "amount": r"\bamount[:\s=]+([\d.]+)", "latency_ms": r"\b(?:latency|duration|elapsed)[:\s=]+([\d.]+)", "error": r'\b(?:error|reason)[:\s=]+"?([A-Z_]+)"?',
    "timestamp": r"(\d{4}[/\-]\d{2}[/\-]\d{2}[\sT]\d{2}:\d{2}:\d{2})",
}
LINES, HEAD, RECORDS, SAMPLES, VALUES = 200, 50, 20, 5, 3
#: Shares of lines that are objects, or hold a field, from which a layout is taken as such.
LEAST_OBJECTS, LEAST_SHARE = 0.40, 0.10


def map_fields(columns: list[str]) -> dict[str, str]:
    """Each column's canonical field by the first rule that fits and isn't taken by an earlier column."""
    out: dict[str, str] = {}
    for column in columns:
        free = (f for p, f in SIMILAR if f not in out.values() and re.search(p, column.strip().lower()))
        if field := next(free, None):
            out[column] = field
    return out


def mapping_of(columns: Column) -> Column:
    """map_fields() of an array of names, as a map, for any number of headers."""
    fits = F.transform(columns, lambda c: F.struct(c.alias("key"), F.array_compact(F.array(*[F.when(F.lower(F.trim(c)).rlike(p), f) for p, f in SIMILAR])).alias("fields")))

    def claim(taken: Column, x: Column) -> Column:
        free = F.filter(x["fields"], lambda f: ~F.exists(taken, lambda t: t["value"] == f))
        return F.when(F.size(free) > 0, F.concat(taken, F.array(F.struct(x["key"].alias("key"), F.get(free, F.lit(0)).alias("value"))))).otherwise(taken)

    return F.map_from_entries(F.aggregate(fits, F.array().cast("array<struct<key:string,value:string>>"), claim))


def confidence_of(mapping: Column) -> Column:
    """confidence() of a map column."""
    return exact_round(F.size(F.filter(F.map_values(mapping), lambda f: f.isin(*CORE))).cast("double") / len(CORE), 3)


def confidence(mapping: dict[str, str]) -> float:
    return round(sum(f in CORE for f in mapping.values()) / len(CORE), 3)


def key_fingerprint(keys: list[str]) -> str:
    return hashlib.md5("|".join(sorted(k.strip().lower() for k in keys)).encode()).hexdigest()


def _object(text: str) -> dict | None:
    try:
        value = json.loads(text)
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def _array(content: str) -> list | None:
    try:
        value = json.loads(content)
    except ValueError:
        return None
    return value if isinstance(value, list) and value and isinstance(value[0], dict) else None


def file_fingerprint(content: str) -> str:
    """Of the keys of the first object, or of the header's names, or else of the first line."""
    lines = [x.strip() for x in content.splitlines() if x.strip()]
    if not lines:
        return ""
    if (rows := _array(content)) is not None:
        return key_fingerprint(list(rows[0]))
    for line in lines[:10]:
        if line.startswith("{") and (row := _object(line)) is not None:
            return key_fingerprint(list(row))
    columns = next(csv.reader(io.StringIO(lines[0])), [])
    return key_fingerprint(columns) if len(columns) >= 2 else hashlib.md5(lines[0][:100].lower().encode()).hexdigest()


def _entry(file_name: str, kind: str, hint: str, label: str, columns: list[str], mapping: dict[str, str], samples: dict[str, list[str]], fingerprint: str) -> dict:
    return {
        "fingerprint": fingerprint, "format_name": f"learned_{label}_{fingerprint[:6]}", "structural_type": kind, "field_mapping": mapping, "extraction_hint": hint,
        "learned_confidence": confidence(mapping), "raw_columns": columns, "sample_values": samples, "file_examples": [file_name],
    }


def _samples(records: list[dict], keys: list[str]) -> dict[str, list[str]]:
    return {k: [str(r[k]) for r in records[:SAMPLES] if r.get(k) not in (None, "", "null")][:VALUES] for k in keys}


def _from_objects(file_name: str, label: str, objects: list[dict]) -> dict:
    keys = list(dict.fromkeys(k for r in objects[:RECORDS] for k in r))
    return _entry(file_name, "document", "json_keys", label, sorted(keys), map_fields(keys), _samples(objects, keys), key_fingerprint(keys))


def learn(file_name: str, content: str, n_lines: int | None = None) -> dict | None:
    """A format registry entry, not approved, from a file's text or its first LINES lines; null if it is empty or shows
    no structure. n_lines: the filled lines of the whole file, where content is only its head."""
    lines = [x for x in content.splitlines() if x.strip()]
    if not lines:
        return None
    if (rows := _array(content)) is not None:
        return _from_objects(file_name, "json_array", [r for r in rows if isinstance(r, dict)])
    objects = [o for o in (_object(x) for x in lines[:HEAD] if x.strip().startswith("{")) if o is not None]
    if objects and len(objects) / max(n_lines or 0, len(lines)) >= LEAST_OBJECTS:
        return _from_objects(file_name, "json_lines", objects)
    return _from_table(file_name, lines[:LINES]) or _from_text(file_name, lines[:LINES])


def _from_table(file_name: str, lines: list[str]) -> dict | None:
    try:
        rows = list(csv.DictReader(io.StringIO("\n".join(lines))))
    except csv.Error:
        return None
    keys = [k for k in rows[0] if k] if rows and len(rows[0]) >= 2 else []
    if not keys:
        return None
    return _entry(file_name, "tabular", "csv_headers", "csv", keys, map_fields(keys), _samples(rows, keys), key_fingerprint(keys))


def _from_text(file_name: str, lines: list[str]) -> dict | None:
    values = {f: [m[1].strip() for x in lines if (m := re.search(p, x, re.I))] for f, p in IN_TEXT.items()}
    seen = sorted(f for f, v in values.items() if len(v) / len(lines) >= LEAST_SHARE)
    if len(seen) < 2:
        return None
    fingerprint = hashlib.md5("|".join(seen).encode()).hexdigest()
    return _entry(file_name, "freetext", "regex_kv", "freetext", seen, {f: f"regex:{f}" for f in IN_TEXT if f in seen}, {f: v[:VALUES] for f, v in values.items() if v}, fingerprint)


def field_hits(lines: DataFrame, by: str = "path") -> DataFrame:
    """(by, field, share): the fields that at least LEAST_SHARE of a file's lines (by, value) hold, for any number of files."""
    counts = lines.groupBy(by).agg(F.count("*").alias("_n"), *[F.count_if(F.col("value").rlike(f"(?i){p}")).alias(f) for f, p in IN_TEXT.items()])
    long = counts.unpivot([by, "_n"], list(IN_TEXT), "field", "_hits").withColumn("share", F.col("_hits") / F.col("_n"))
    return long.where(F.col("share") >= LEAST_SHARE).select(by, "field", "share")


def summary(entry: dict) -> str:
    """A learned format in a few lines, as it is shown with an offer."""
    left = [c for c in entry["raw_columns"] if c not in entry["field_mapping"]]
    facts = {"Format": entry["format_name"], "Type": entry["structural_type"], "Hint": entry["extraction_hint"], "Confidence": f"{entry['learned_confidence']:.3f}", "Fingerprint": f"{entry['fingerprint'][:16]}..."}
    out = [f"{k:<11}: {v}" for k, v in facts.items()] + [f"Mapped fields ({len(entry['field_mapping'])}):"]
    out += [f"  {k!r:30s} -> {v!r}" for k, v in entry["field_mapping"].items()]
    return "\n".join(out + [f"Unmapped   : {left}"] * bool(left))
