"""The corpus pipeline's stages against plain versions of each, on a small table, an empty one, and the stages' contract."""

import collections
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from payscope.llm import language_id, secret_scan
from tests.llm.test_operators import GERMAN, LONG, PASSAGE, ROWS, SCHEMA, TEXTS, components_of, plain_words, prose, quality

COPY = prose(70)
MORE = [
    (5000, COPY, "en", "s1", 1, "x", "x", "x"), (5000, COPY, "en", "s1", 1, "x", "x", "x"), (5001, COPY.upper(), "en", "s2", 1, "x", "x", "x"), (None, COPY, "en", "s2", 1, "x", "x", "x"),
    (5002, COPY + " end", "en", "s0", 1, "x", "x", "x"), (5002, prose(50), "en", "s0", 1, "x", "x", "x"), (None, PASSAGE[:300], None, "s0", 1, "x", "x", "x"), (None, PASSAGE[:300], None, "s0", 1, "y", "x", "x"),
    *[(6000 + i, prose(40, GERMAN), "de", "s3", 1, "x", "x", "x") for i in range(20)],
]


def plain_language(rows, spark):
    """Prototypes of all labelled texts that aren't held out, cosine one by one."""
    encode, sums = language_id.Encoder(), {}
    held = {r[0]: r[1] for r in spark.createDataFrame([(r[0],) for r in rows], "i long").select("i", language_id.held_out(F.col("i"))).collect()}
    for i, t, lang, *_ in rows:
        if i is not None and not held[i] and lang is not None and (v := encode(t)) is not None:
            sums[lang] = sums.get(lang, 0) + v / np.linalg.norm(v)
    out = []
    for r in rows:
        if (v := encode(r[1])) is not None and max(float(p @ v) / np.linalg.norm(p) / np.linalg.norm(v) for p in sums.values()) >= P.MIN_LANGUAGE_SCORE:
            out.append(r)
    return out


def plain_near_duplicates(rows):
    """Of each component of the whole relation one row: the least id, rows without one last."""
    numbered = components_of([(k, r[1]) for k, r in enumerate(rows)])
    groups = collections.defaultdict(list)
    for (k, n, root, _), r in zip(numbered, rows, strict=True):
        groups[root if n else ("empty", k)].append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def plain_benchmark(rows, items):
    windows = {tuple(w[k : k + 10]) for w in map(plain_words, items) for k in range(max(1, len(w) - 9) if w else 0)}
    sizes = {len(w) for w in windows}
    return [r for r in rows if not any(tuple(w[k : k + n]) in windows for w in [plain_words(r[1])] for n in sizes for k in range(len(w) - n + 1))]


def same_rows(got, want, columns=(0, 1)):
    pick = lambda rows: sorted(str([r[c] for c in columns]) for r in rows)
    assert pick(got) == pick(want)


def test_stages(spark, tmp_path):
    items = [TEXTS[13], "two words"]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows, seen = ROWS + MORE, {}
    extra = {"a.b": 1, "_row": 2, "_mark": 3, "_secrets": 4}
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(v) for c, v in extra.items()}).repartition(3)
    columns = docs.columns
    for name, stage in P.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "mix":
            assert docs.columns == columns
        seen[name] = [tuple(r) for r in docs.collect()]
        docs = spark.createDataFrame(seen[name], docs.schema)
    same_rows(seen["language"], plain_language(rows, spark))
    # which of the equal texts without an id stays isn't told
    same_rows(seen["near_duplicates"], plain_near_duplicates(seen["language"]))
    same_rows(seen["benchmark"], plain_benchmark(seen["near_duplicates"], items))
    model = secret_scan.train(secret_scan.default_samples(spark))
    spans = {r["text"]: r["secrets"] for r in secret_scan.scan(spark.createDataFrame([(r[1],) for r in seen["benchmark"]], "text string"), model=model).collect()}
    want = []
    for r in seen["benchmark"]:
        out, at = "", 0
        for a, b in sorted((s["start"], s["end"]) for s in spans[r[1]]):
            out, at = (out + r[1][at:a] + "<SECRET>", b) if a >= at else (out, max(at, b))
        text = out + r[1][at:]
        want.append((r[0], text, *r[2:4], len(text)))
    same_rows(seen["secrets"], want, (0, 1, 2, 3, 4))
    assert all(r[5:] == ("clash", "clash", "clash", 1, 2, 3, 4) or r[5] in "xy" for r in seen["secrets"])
    mixed = docs.columns
    same_rows([(r[mixed.index("doc_id")], r[mixed.index("size")]) for r in seen["mix"]], [(r[0], quality(r[1])[0]) for r in seen["secrets"]])
    taken, target = collections.Counter(), {}
    for r in seen["mix"]:
        taken[r[mixed.index("source")]] += r[mixed.index("taken")]
        target[r[mixed.index("source")]] = r[mixed.index("target")]
        assert r[mixed.index("taken")] <= 3 * r[mixed.index("size")]
    assert all(abs(taken[s] - t) <= 192 for s, t in target.items())
    text = {r[0]: r[1] for r in seen["secrets"]}
    assert "AKIA" not in text[14] and text[6] == LONG and not re.search("AKIA", text[14])


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
