"""Spreadsheets: the active sheet of each workbook, read with the standard library."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.functions.scalars import filled
from payscope.plans import schema as S

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def column_number(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(content: bytes) -> list[list[str | None]]:
    """Cell texts of the active sheet; null for empty cells and for what counts as absent (zero, false)."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter(f"{MAIN}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")]
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        view = book.find(f".//{MAIN}workbookView")
        active = int(view.get("activeTab", 0)) if view is not None else 0
        wanted = book.findall(f".//{MAIN}sheet")[active].get(RELATION)
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = targets[wanted].lstrip("/")
        sheet = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
    rows = []
    for r in sheet.iter(f"{MAIN}row"):
        row: list[str | None] = []
        for i, c in enumerate(r.iter(f"{MAIN}c")):
            at = column_number(c.get("r")) if c.get("r") else i
            row += [None] * (at + 1 - len(row))
            kind, value = c.get("t"), c.find(f"{MAIN}v")
            text = value.text if value is not None else None
            if kind == "s" and text is not None:
                text = shared[int(text)]
            elif kind == "inlineStr":
                text = "".join(t.text or "" for t in c.iter(f"{MAIN}t"))
            elif kind == "b":
                text = "True" if text == "1" else None
            elif kind is None and text is not None and float(text) == 0:
                text = None
            row[at] = text
        rows.append(row)
    return rows


def read(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return records(spark.read.format("binaryFile").load(paths).select("path", "content"))


def records(files: DataFrame) -> DataFrame:
    """Raw records of workbooks (path, content): header lower-cased and trimmed, `col_i` where it is empty, no other names, no filter.

    A workbook that can't be read gives one row with its `_error`. Files carry no source_file or format, as they
    carry none in the record rules."""
    types = {"path": pa.string(), "i": pa.int64(), "cells": pa.map_(pa.string(), pa.string()), "_error": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    head, *rows = sheet_rows(content.as_py()) or [[]]
                    names = [(h or "").strip().lower() or f"col_{i}" for i, h in enumerate(head)]
                    out = [(path, i, list(dict(zip(names, r + [None] * len(names), strict=False)).items()), None) for i, r in enumerate(rows)]
                except Exception as e:  # noqa: BLE001  a broken file is reported, the others go on
                    out = [(path, 0, [], f"{type(e).__name__}: {e}")]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types.values(), strict=True)], list(types))

    cells = files.mapInArrow(run, "path string, i bigint, cells map<string,string>, _error string")
    order = F.struct(F.col("path").alias("p"), F.lit(0).cast("bigint").alias("b"), "i")
    return cells.select("path", order.alias("_ord"), "_error", *[filled(F.try_element_at("cells", F.lit(n))).alias(n) for n in S.RAW])
