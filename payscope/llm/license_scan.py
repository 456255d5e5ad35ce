"""License scans: short notices found with a bounded number of errors.

A notice of at most K errors split into K + 1 pieces holds one piece without error (pigeonhole), so exact search for
the pieces finds all candidates; the regex library's bounded-error matching then verifies the place and its span.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Phrases whose words name a license where they stand consecutively.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Short notices, as normalised words, with the label each gives.
NOTICES = {
    "licensed under the apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "this work is licensed under the gnu general public license version": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version": "mpl",
    "eclipse public license": "epl",
    "licensed under cc by": "cc-by",
    "creative commons attribution": "cc-by",
    "dedicated to the public domain": "public-domain",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "boost software license version": "bsl",
    "all rights reserved": "proprietary",
}
#: One error for each so many characters of a notice, 3 at most.
CHARS_PER_ERROR = 12
MAX_ERRORS = 3

#: Bytes: A-Z lower-cased, what isn't a digit, a letter or above ASCII made a space.
NORMAL = bytes(i if i >= 0x80 or 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A else i + 32 if 0x41 <= i <= 0x5A else 0x20 for i in range(256))


class Notices:
    """Compiled notices: seeds, patterns, labels."""

    def __init__(self, notices: dict[str, str], phrases: dict[str, str]):
        self.phrases = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]
        self.notices = []
        for text, label in notices.items():
            k = min(MAX_ERRORS, len(text) // CHARS_PER_ERROR)
            cuts = [round(i * len(text) / (k + 1)) for i in range(k + 2)]
            seeds = [(text[a:b].encode(), a) for a, b in zip(cuts, cuts[1:], strict=False)]
            pattern = regex.compile(b"(?b)(?:" + regex.escape(text.encode(), special_only=True, literal_spaces=True) + b"){e<=%d}" % k)
            self.notices.append((seeds, k, len(text), pattern, label))
        self.seeds = sorted({s for x in self.notices for s, _ in x[0]})

    def fuzzy(self, flat: bytes) -> Iterator[tuple[int, int, str, float]]:
        """(start, end, label, score) of every verified notice in normalised text, in bytes of it."""
        hits = {seed: places(flat, seed) for seed in self.seeds if seed in flat}
        if not hits:
            return
        for seeds, k, n, pattern, label in self.notices:
            found: dict[tuple[int, int], int] = {}
            # each candidate in a window of its own: a best match isn't looked for beyond it
            for begin in sorted({p - a for s, a in seeds for p in hits.get(s, ())}):
                if m := pattern.search(flat, max(0, begin - k), begin + n + k):
                    found[m.span()] = sum(m.fuzzy_counts)
            # of overlapping matches the one with the fewest errors stays, then the first
            taken: list[tuple[int, int]] = []
            for (a, b), errors in sorted(found.items(), key=lambda x: (x[1], x[0])):
                at = bisect.bisect_left(taken, (a, b))
                if (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or b <= taken[at][0]):
                    taken.insert(at, (a, b))
                    yield a, b, label, 1 - errors / n


def places(flat: bytes, seed: bytes) -> list[int]:
    """Where a seed stands, overlapping places too."""
    out, at = [], flat.find(seed)
    while at >= 0:
        out.append(at)
        at = flat.find(seed, at + 1)
    return out


def flatten(raw: bytes) -> tuple[bytes, int]:
    """Normalised words with one space around each, and their number."""
    words = raw.translate(NORMAL).split()
    return b" " + b" ".join(words) + b" ", len(words)


def judge(flat: bytes, notices: Notices) -> tuple:
    """(n_base, first_word, last_word, base_labels, labels, score, spans) of normalised text."""
    starts: list[int] = []
    base: set[str] = set()
    for phrase, label in notices.phrases:
        at = flat.find(phrase)
        while at >= 0:
            starts.append(at)
            base.add(label)
            at = flat.find(phrase, at + 1)
    spans = [(a, b, label, s) for a, b, label, s in notices.fuzzy(flat)]
    labels = base | {x[2] for x in spans}
    score = max([1.0] * bool(base) + [x[3] for x in spans], default=0.0)
    word = lambda at: flat.count(b" ", 0, at + 1) - 1
    first, last = (word(min(starts)), word(max(starts))) if starts else (None, None)
    where = [{"first_word": max(0, flat.count(b" ", 0, a + 1) - 1), "last_word": max(0, flat.count(b" ", 0, b) - 1), "label": label, "score": s} for a, b, label, s in sorted(spans)]
    return len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, where


SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, spans array<struct<first_word:bigint,last_word:bigint,label:string,score:double>>"
)
ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
    ("score", pa.float64()), ("spans", pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("label", pa.string()), ("score", pa.float64())]))),
])


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", notices: dict[str, str] | None = None) -> DataFrame:
    """One row for each row of docs, of SCHEMA. Null and empty texts have no words, no labels and score 0.

    Of overlapping matches of a notice the one with the fewest errors stays, then the first. Repeated rows give repeated
    results, empty tables none; other columns, of whatever name, aren't read. The whole text is searched, however long."""
    notices = NOTICES if notices is None else notices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Notices(notices, PHRASES)
        for batch in batches:
            ids, out = batch.column(0), []
            for raw in batch.column(1):
                flat, n = flatten((raw.as_py() or b""))
                out.append((n, *judge(flat, compiled)))
            columns = list(zip(*out, strict=True)) if out else [[] for _ in range(8)]
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), *[pa.array(c, t) for c, t in zip(columns, ARROW.types[1:], strict=True)]], schema=ARROW)

    return docs.select(F.col(f"`{doc_id}`").cast("bigint"), F.col(f"`{text}`").cast("string").cast("binary").alias("_t")).mapInArrow(run, SCHEMA)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of op3."""
    return scan(docs).drop("spans")
