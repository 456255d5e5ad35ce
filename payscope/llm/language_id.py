"""Language identification with hyperdimensional profiles.

Each letter has a random vector of signs. A trigram is the product of its letters' vectors, permuted by place; a
document is the sum of its trigrams, a language the sum of its documents, and documents go to the nearest by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 512
SEED = 20011
#: Expected number of documents of each language that its prototype is learned from, a hashed sample; all of a language with fewer.
TRAIN_DOCS = 4000
UNKNOWN = "und"
#: Symbols: 0 what isn't a letter, 1-26 a-z, others by a hash of their code point.
SYMBOLS = 64


def symbol_table() -> np.ndarray:
    points = np.arange(0x110000, dtype=np.uint64)
    table = (27 + (points * 2654435761 % 2**32 >> 16) % (SYMBOLS - 27)).astype(np.uint8)
    letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    table[~letters] = 0
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return table


class Encoder:
    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        letters = (np.random.default_rng(seed).integers(0, 2, (SYMBOLS, dimensions), dtype=np.int8) * 2 - 1).astype(np.int8)
        self.by_place = [np.roll(letters, k, axis=1) for k in (2, 1, 0)]
        self.table = symbol_table()
        self.dimensions = dimensions

    def __call__(self, text: str | None) -> np.ndarray | None:
        """The document's vector; None if it has no letter."""
        codes = self.table[np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)]
        if not codes.any():
            return None
        codes = np.concatenate(([0], codes, [0]))
        codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))].astype(np.int64)
        grams, counts = np.unique(codes[:-2] << 12 | codes[1:-1] << 6 | codes[2:], return_counts=True)
        out = np.zeros(self.dimensions, np.float32)
        for i in range(0, len(grams), 4096):
            g = grams[i : i + 4096]
            bound = self.by_place[0][g >> 12] * self.by_place[1][g >> 6 & 63] * self.by_place[2][g & 63]
            out += counts[i : i + 4096].astype(np.float32) @ bound.astype(np.float32)
        return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def sampled(key: Column, salt: str, fraction: float) -> Column:
    """Whether a row is in a sample of about this fraction, by a hash of its key."""
    return F.lit(True) if fraction >= 1 else F.shiftrightunsigned(F.xxhash64(key, F.lit(salt)), 11) < F.lit(int(fraction * (1 << 53)))


def learn(labelled: DataFrame, train_docs: int = TRAIN_DOCS) -> dict[str, np.ndarray]:
    """Prototypes from (doc_id, text, lang). Rows with a null text or lang are skipped.

    Repeated rows are all taken or all left; an empty table gives no prototypes. Reads all rows to count each language's, learns from about train_docs of each language, so that none is lost among
    many rows of others; what reaches the driver is a count and, from each of 8 tasks, a vector for each language."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sums = Encoder(), {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (v := encode(text)) is not None:
                    sums[lang] = sums.get(lang, 0) + v / np.linalg.norm(v)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.astype("<f8").tobytes() for v in sums.values()], pa.binary())], ["lang", "v"])

    chosen = F.lit(True)
    often = {lang: n for lang, n in counts.items() if n > train_docs}
    if often:
        limits = F.create_map(*[F.lit(x) for lang, n in often.items() for x in (lang, int(train_docs / n * (1 << 53)))])
        # a language with few documents has no limit
        chosen = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("language")), 11) < F.coalesce(F.try_element_at(limits, F.col("lang")), F.lit(1 << 53))
    sample = rows.where(chosen).select("text", "lang").repartition(8)
    out: dict[str, np.ndarray] = {}
    for lang, v in sorted((r["lang"], bytes(r["v"])) for r in sample.mapInArrow(run, "lang string, v binary").collect()):
        out[lang] = out.get(lang, 0) + np.frombuffer(v, "<f8")
    return {k: v / np.linalg.norm(v) for k, v in out.items() if np.linalg.norm(v) > 0}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of docs, with lang_pred and score (the cosine, 0 at least).

    Null and empty texts, texts without a letter, and all texts where nothing was learned give `und` and 0. Every row
    stays, repeated ones too. Ties go to the first language in code point order. Texts are read whole, however long;
    empty tables give no rows; no column of docs but `keep` and the text is read, and none of `keep` may have a result's name."""
    names = sorted(prototypes)
    matrix = np.array([prototypes[k] for k in names], np.float32)
    chosen = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_text_read"))
    schema = docs.select(*[F.col(f"`{c}`") for c in keep], F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder()
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(len(keep)):
                v = encode(text.as_py()) if names else None
                if v is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosine = matrix @ v / max(float(np.linalg.norm(v)), 1e-9)
                k = int(np.argmax(cosine))
                langs.append(names[k])
                scores.append(min(1.0, max(0.0, float(cosine[k]))))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*keep, "lang_pred", "score"])

    return chosen.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of op7."""
    prototypes = learn(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang"))
    return predict(docs, prototypes).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
