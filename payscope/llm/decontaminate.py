"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows, texts scanned once.

The automaton's letters are words: each word of the benchmark has a number, a document is the sequence of its words'
numbers, and every occurrence of a window is reported, overlapping ones too.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payscope.llm.common import materialize, release
from payscope.llm.license_scan import NORMAL

WINDOW = 10
#: Windows of one automaton, and bytes of them and their items. A larger benchmark is cut by hash into blocks of about
#: this size, each scanned in turn, PASSES of them in one stage.
MAX_WINDOWS = 200_000
MAX_BYTES = 1 << 26
PASSES = 4

Block = list[tuple[tuple[bytes, ...], tuple[int, ...]]]


def windows(raw: bytes | None, window: int = WINDOW) -> set[tuple[bytes, ...]]:
    """The distinct windows of an item's words; a shorter item is one window, an empty one none."""
    words = (raw or b"").translate(NORMAL).split()
    return {tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1) if words else 0)}


class Scanner:
    def __init__(self, block: Block):
        self.number: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for words, ids in block:
            self.automaton.add_word(tuple(self.number.setdefault(w, len(self.number) + 1) for w in words), (len(words), ids))
        self.shortest = min((len(w) for w, _ in block), default=1)
        if block:
            self.automaton.make_automaton()

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged word ranges [first, end) inside any window, and the items hit."""
        get = self.number.get
        ranges: list[list[int]] = []
        items: set[int] = set()
        if not self.number or len(words) < self.shortest:
            return [], items
        codes = [get(w, 0) for w in words]
        # only runs of benchmark words can hold a window
        i, n = 0, len(codes)
        while i < n:
            if not codes[i]:
                i += 1
                continue
            try:
                j = codes.index(0, i)
            except ValueError:
                j = n
            if j - i >= self.shortest:
                for end, (k, ids) in self.automaton.iter(tuple(codes[i:j])):
                    a, b = i + end - k + 1, i + end + 1
                    items.update(ids)
                    while ranges and a <= ranges[-1][1] and a < ranges[-1][0]:
                        ranges.pop()
                    if ranges and a <= ranges[-1][1]:
                        ranges[-1][1] = max(ranges[-1][1], b)
                    else:
                        ranges.append([a, b])
            i = j
        return [tuple(r) for r in ranges], items


def offsets(text: str) -> list[tuple[int, int]]:
    """Code point ranges of the words in the original text."""
    return [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def windows_of(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(win, ids): the benchmark's distinct windows, words one space apart, and the items that hold each, in the shared
    folder. Made on the executors; rows with a null id are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = [b" ".join(w) for w in windows(raw.as_py(), window)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array([item] * len(found), pa.int64())], ["win", "item"])

    rows = benchmark.select(F.col(f"`{item_id}`").cast("bigint").alias("item"), F.col(f"`{text}`").cast("string").cast("binary").alias("t")).where("item IS NOT NULL")
    return materialize(rows.mapInArrow(run, "win binary, item bigint").groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("ids")))


#: Automata of a worker, kept from task to task: token -> Scanner. The latest PASSES stay.
_SCANNERS: dict[str, Scanner] = {}


def _scanner(token: str, block) -> Scanner:
    if token not in _SCANNERS:
        while len(_SCANNERS) >= PASSES:
            del _SCANNERS[next(iter(_SCANNERS))]
        _SCANNERS[token] = Scanner(block.value)
    return _SCANNERS[token]


def scan(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS, carry: str | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit, item_ids (sorted as strings), spans in the original text.

    spans: array<struct<start, end>> in code points, from the first to the last word of each run of hit words. Null
    and empty texts have no words; texts are read whole, however long. Repeated rows each count; an empty benchmark hits
    nothing, an empty table gives no rows; other columns, of whatever name, aren't read. The benchmark is a stated query
    set: each block of about max_windows windows is broadcast and scanned against all rows, without a shuffle. carry names a column, such as a struct of the whole row, that stands in the
    result in place of doc_id."""
    first = F.col(f"`{carry}`") if carry else F.col(f"`{doc_id}`").cast("bigint").alias("doc_id")
    df = docs.select(first, F.col(f"`{text}`").cast("string").cast("binary").alias("_t"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("_r"), F.expr("cast(array() as array<bigint>)").alias("_i"))
    held = windows_of(benchmark, item_id, item_text, window)
    n, size = held.select(F.count("*"), F.coalesce(F.sum(F.length("win") + 8 * F.size("ids")), F.lit(0))).first()
    n_blocks = max(1, -(-n // max_windows), -(-size // MAX_BYTES))
    sent = []
    for k in range(n_blocks):
        part = held.where(F.pmod(F.xxhash64("win"), F.lit(n_blocks)) == k) if n_blocks > 1 else held
        block = docs.sparkSession.sparkContext.broadcast([(tuple(bytes(r["win"]).split(b" ")), tuple(r["ids"])) for r in part.toLocalIterator()])
        df = _pass(df, block, uuid.uuid4().hex, last=k == n_blocks - 1)
        sent.append(block)
        if len(sent) == PASSES and k < n_blocks - 1:
            # the driver and the executors hold PASSES blocks at most
            df = materialize(df)
            while sent:
                sent.pop().unpersist()
    release(held)
    return df


def _pass(df: DataFrame, block, token: str, last: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(token, block)
        for batch in batches:
            old_r, old_i = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            n_words, n_hit, items, spans = [], [], [], []
            for raw, r, i in zip(batch.column(1), old_r, old_i, strict=True):
                raw = raw.as_py() or b""
                words = raw.translate(NORMAL).split()
                ranges, ids = scanner.hits(words)
                if r or i:
                    ranges = merged(ranges + [(x["start"], x["end"]) for x in r])
                    ids |= set(i)
                n_words.append(len(words))
                n_hit.append(sum(b - a for a, b in ranges))
                items.append(ids)
                if last and ranges:
                    at = offsets(raw.decode("utf-8", "replace"))
                    spans.append([{"start": at[a][0], "end": at[b - 1][1]} for a, b in ranges])
                else:
                    spans.append([{"start": a, "end": b} for a, b in ranges])
            first = batch.schema.names[0]
            if last:
                names = [sorted(map(str, x)) for x in items]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(spans, SPANS)], [first, "n_words", "n_hit", "item_ids", "spans"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, SPANS), pa.array([sorted(x) for x in items], pa.list_(pa.int64()))], [first, "_t", "_r", "_i"])

    schema = df.schema
    if last:
        schema = T.StructType([schema.fields[0], *T._parse_datatype_string("n_words bigint, n_hit bigint, item_ids array<string>, spans array<struct<start:bigint,end:bigint>>").fields])
    return df.mapInArrow(run, schema)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns of op4."""
    found = scan(docs, benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
