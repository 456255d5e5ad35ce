"""Toxicity: a linear-chain conditional random field tags toxic words; marginals add up to document scores.

Two states, clean and toxic. A word's features are itself and its prefixes. Documents are long and nearly all their
words have no known feature, so forward and backward messages cross runs of such words by powers of one matrix.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm.language_id import held_out, sampled

#: Expected number of toxic documents that the model is learned from, and of clean ones for each of them.
TRAIN_DOCS = 1500
CLEAN_PER_TOXIC = 3
PREFIXES = (4, 5, 6)
#: A feature marks toxic words if it is this many times likelier in toxic documents and a likelihood-ratio test of that
#: reaches MIN_TEST, which a feature hardly does by chance among a million.
MIN_LIFT = 12.0
MIN_TEST = 24.0
EPOCHS = 5
#: Windows that one epoch looks at.
WINDOWS = 5000
RATE = 0.3
DECAY = 1e-4
MAX_CACHE = 400_000
STRIP = " \t\r\n.,;:!?\"'`()[]{}<>*#$%&|/\\-_=+~^@…«»“”‘’"


def features(word: str) -> list[str]:
    w = word.lower().strip(STRIP)
    return ([w] if len(w) > 1 else []) + [f"{w[:k]}*" for k in PREFIXES if len(w) > k]


class Chain:
    """Weights of features, of the toxic state itself, and of transitions."""

    def __init__(self, weights: dict[str, float], bias: float, transition: np.ndarray, head: tuple[float, float, float]):
        self.weights, self.bias, self.transition, self.head = weights, bias, transition, head
        self._prepare()

    def _prepare(self) -> None:
        self.cache: dict[str, float] = {}
        t = np.exp(self.transition)
        # a step over a word without features: messages m -> m @ step, in forward and in backward direction
        step = t * np.exp([0.0, self.bias])[None, :]
        self.steps = [step]
        for _ in range(24):
            step = step @ step
            step = step / step.max()
            self.steps.append(step)
        self.t = t

    def emission(self, word: str) -> float | None:
        """The sum of a word's weights; None if it has no known feature."""
        found = [self.weights[f] for f in features(word) if f in self.weights]
        return sum(found) + self.bias if found else None

    def active(self, words: list[str]) -> list[tuple[int, float]]:
        cache, out = self.cache, []
        if len(cache) > MAX_CACHE:
            cache.clear()
        for i, w in enumerate(words):
            try:
                e = cache[w]
            except KeyError:
                e = cache[w] = self.emission(w)
            if e is not None:
                out.append((i, e))
        return out

    def _cross(self, m: np.ndarray, n: int, forward: bool) -> np.ndarray:
        k = 0
        while n and k < len(self.steps):
            if n & 1:
                m = m @ self.steps[k] if forward else self.steps[k] @ m
                m = m / m.sum()
            n >>= 1
            k += 1
        return m

    def marginals(self, n: int, active: list[tuple[int, float]]) -> list[float]:
        """P(toxic) of each active word, by forward-backward over all n words."""
        forward, m, at = [], np.array([1.0, 1.0]), -1
        for i, e in active:
            if at < 0 and i:  # the text's first word has no word before it
                m = self._cross(np.array([1.0, math.exp(self.bias)]), i - 1, True)
            elif i:
                m = self._cross(m, i - at - 1, True)
            m = (m @ self.t if i else m) * np.array([1.0, math.exp(min(e, 50.0))])
            m = m / m.sum()
            forward.append(m)
            at = i
        out, m, at = [], np.array([1.0, 1.0]), n
        for (i, e), f in zip(reversed(active), reversed(forward), strict=True):
            m = self._cross(m, at - i - 1, False)
            p = f * m
            out.append(float(p[1] / p.sum()))
            m = self.t @ (np.array([1.0, math.exp(min(e, 50.0))]) * m)
            m = m / m.sum()
            at = i
        return out[::-1]

    def score(self, text: str | None) -> tuple[float, list[tuple[int, float]]]:
        """The document's score, and (word number, marginal) of its active words."""
        words = (text or "").split()
        active = self.active(words)
        marginals = self.marginals(len(words), active) if active else []
        a, b, c = self.head
        x, y = summary(marginals)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y)))), list(zip((i for i, _ in active), marginals, strict=True))

    def __getstate__(self):
        return self.weights, self.bias, self.transition, self.head

    def __setstate__(self, state):
        self.__init__(*state)


def summary(marginals: list[float]) -> tuple[float, float]:
    """The chance that any word is toxic, and the logarithm of one plus the expected number of toxic words."""
    clean = 1.0
    for p in marginals:
        clean *= 1 - p
    return 1 - clean, math.log1p(sum(marginals))


def fit(rows: list[tuple[str | None, int]]) -> Chain:
    """From (text, 0/1): which features mark toxic words, labelled words from them, the chain, and the document score.

    With one label only, or no rows, every score is near that label's share."""
    docs = [((text or "").split(), int(label)) for text, label in rows]
    n = Counter(label for _, label in docs)
    groups: tuple[dict[int, set[str]], dict[int, set[str]]] = ({}, {})
    for words, label in docs:
        # near copies count once: they mostly share the least hash of their shingles
        group = min((zlib.crc32(" ".join(words[i : i + 4]).encode()) for i in range(max(1, len(words) - 3))), default=0)
        groups[label].setdefault(group, set()).update(f for w in set(words) for f in features(w))
    df = tuple(Counter(f for fs in g.values() for f in fs) for g in groups)
    share = len(groups[1]) / max(1, len(groups[0]) + len(groups[1]))
    lift = {f: (k + 0.1) / (len(groups[1]) + 1) * (len(groups[0]) + 1) / (df[0][f] + 0.1) for f, k in df[1].items() if tested(k, df[0][f], share) >= MIN_TEST}
    marks = {f for f, x in lift.items() if x >= MIN_LIFT}
    known = {f for f, x in lift.items() if x > 1}
    chain = Chain(dict.fromkeys(known, 0.0), -4.0, np.zeros((2, 2)), (0.0, 0.0, 0.0))
    if n[0] and n[1] and marks:
        _train(chain, docs, marks)
    _calibrate(chain, docs)
    return chain


def tested(toxic: int, clean: int, share: float) -> float:
    """Twice the log-likelihood ratio of seeing a feature in these numbers of documents, against this share of toxic ones."""
    n = toxic + clean
    return 2 * sum(k * math.log(k / (n * q)) for k, q in ((toxic, share), (clean, 1 - share)) if k and q)


def _train(chain: Chain, docs: list, marks: set[str]) -> None:
    """Stochastic gradient ascent of the likelihood of labelled words, over windows around words with features."""
    windows = []
    for words, label in docs:
        active = [(i, [f for f in features(w) if f in chain.weights]) for i, w in enumerate(words)]
        active = [(i, fs) for i, fs in active if fs]
        for i, _ in active:
            lo, hi = max(0, i - 3), min(len(words), i + 4)
            inside = {j - lo: fs for j, fs in active if lo <= j < hi}
            gold = [int(label == 1 and any(f in marks for f in inside.get(j, ()))) for j in range(hi - lo)]
            windows.append((hi - lo, inside, gold))
    order = np.random.default_rng(7)
    w, t, bias = chain.weights, chain.transition, chain.bias
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch)
        for k in order.permutation(len(windows))[:WINDOWS]:
            n, inside, gold = windows[k]
            e = np.array([bias + sum(w[f] for f in inside.get(j, ())) for j in range(n)])
            p, pair = _window(e, t)
            for j in range(n):
                g = gold[j] - p[j]
                for f in inside.get(j, ()):
                    w[f] += rate * (g - DECAY * w[f])
                bias += rate * 0.05 * g
            for j in range(1, n):
                g = -pair[j - 1]
                g[gold[j - 1], gold[j]] += 1
                t = t + rate * 0.05 * g
    chain.bias, chain.transition = float(bias), np.clip(t, -6, 6)
    chain._prepare()


def _window(e: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the words and of pairs of neighbours."""
    n, x = len(e), np.exp(t)
    emit = np.stack([np.ones(n), np.exp(np.clip(e, -50, 50))], 1)
    f, b = np.empty((n, 2)), np.ones((n, 2))
    f[0] = emit[0] / emit[0].sum()
    for i in range(1, n):
        f[i] = f[i - 1] @ x * emit[i]
        f[i] /= f[i].sum()
    for i in range(n - 2, -1, -1):
        b[i] = x @ (emit[i + 1] * b[i + 1])
        b[i] /= b[i].sum()
    p = f * b
    p /= p.sum(1, keepdims=True)
    pair = f[:-1, :, None] * x[None] * (emit[1:] * b[1:])[:, None, :]
    pair /= pair.sum((1, 2), keepdims=True)
    return p[:, 1], pair


def _calibrate(chain: Chain, docs: list) -> None:
    """Logistic regression of the labels on the summaries, by Newton steps with a small ridge."""
    xs, ys = [], []
    for words, label in docs:
        active = chain.active(words)
        xs.append((1.0, *summary(chain.marginals(len(words), active) if active else [])))
        ys.append(label)
    if not xs:
        return
    x, y, w = np.array(xs), np.array(ys, float), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        w = w + np.linalg.solve(h, x.T @ (y - p) - 0.1 * w)
    chain.head = tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> bytes:
    """A pickled Chain from documents (doc_id, text) and labels (doc_id, toxic), fitted in one task.

    Labels are sampled by a hash, to about train_docs toxic ones and CLEAN_PER_TOXIC times as many clean ones, before
    they meet the texts, so what is broadcast and what the task holds is bounded. Rows with a null id or label are skipped;
    a document with both labels counts with each; rows that repeat a doc_id are all read. Without labels or documents
    every score is that of no evidence."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.where("toxic IN (0, 1)").groupBy("toxic").count().collect()}
    keep = F.lit(False)
    for label, n in counts.items():
        keep = keep | ((F.col("toxic") == label) & sampled(F.col("doc_id"), f"toxicity {label}", train_docs * (1 if label else CLEAN_PER_TOXIC) / n))
    sample = known.where(keep).dropDuplicates(["doc_id", "toxic"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(t, y) for b in batches for _, t, y in sorted(zip(*(c.to_pylist() for c in b.columns), strict=True), key=lambda r: (r[0], r[2]))]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows).__getstate__())], pa.binary())], ["model"])

    joined = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic")
    blobs = joined.repartition(1).sortWithinPartitions("doc_id").mapInArrow(run, "model binary").collect()
    return bytes(blobs[0]["model"]) if blobs else pickle.dumps(fit([]).__getstate__())


def score(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, score, spans.

    spans: array<struct<start, end, score>> in code points, of words whose marginal reaches one half. Null and empty
    texts have no words and the score of a text without marks. Repeated rows give repeated results, empty tables none;
    a score of exactly one half is toxic. Other columns, of whatever name, aren't read; texts are read whole, however long."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(*pickle.loads(model))
        for batch in batches:
            scores, spans = [], []
            for text in batch.column(1):
                text = text.as_py()
                s, words = chain.score(text)
                scores.append(s)
                spans.append(offsets(text, [x for x in words if x[1] >= 0.5]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, spans_type)], ["doc_id", "score", "spans"])

    chosen = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("_t"))
    return chosen.mapInArrow(run, "doc_id bigint, score double, spans array<struct<start:bigint,end:bigint,score:double>>")


def offsets(text: str | None, words: list[tuple[int, float]]) -> list[dict]:
    """Where the words with these numbers stand in the text."""
    out, at, wanted = [], 0, dict(words)
    if not wanted:
        return out
    for i, w in enumerate(text.split()):
        at = text.index(w, at)
        if i in wanted:
            out.append({"start": at, "end": at + len(w), "score": wanted[i]})
        at += len(w)
    return out


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns of op10."""
    model = learn(docs, labels.where(~held_out(F.col("doc_id"))).select("doc_id", "toxic"))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_spans"))
