"""Repeated passages: sampled suffix sorting over a content-defined cover.

A difference cover makes any two positions meet, after an equal step, at two sampled ones. Here the sample follows the
text: of each window of GRAMS starts the least hashed GRAM-byte string is sampled, so two equal LENGTH-byte strings
hold a sampled place at the same step. Sampled suffixes get names (the hash of their first GRAM bytes); names that
stand once drop out. The starts that remain are sorted by their step to the sample, its name and their LENGTH-byte
prefix, and adjacent ones are compared. Prefixes longer than LENGTH don't matter, so names aren't refined further.

A cover modulo 3 would sort two of three byte positions of all texts; this one keeps about 2 / GRAMS of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import BROADCAST_ROWS, flagged, kept, lookup, materialize, release, skewed

LENGTH = 400
GRAM = 64
GRAMS = LENGTH - GRAM + 1
#: Bytes before a sampled place that a string through it can begin.
REACH = LENGTH - GRAM
#: Contexts of one name from which they are dealt to tasks by what stands beside the sample, too.
MANY = 256
HALF = REACH // 2
#: Contexts that one task compares; the strings of more are counted by task, step and hash, so no task gathers them.
CROWD = 4096
#: Contexts that are compared in one go, and strings of theirs that are named at a time.
SHARE = 1024
CELLS = 500_000
#: Places that one array of sort keys covers.
STRETCH = 1 << 21
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
BASE = 0xD1342543DE82EF95


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of BASE and of its inverse modulo 2**64, and a random number for each byte."""

    def __init__(self):
        self.bytes = mixed(np.arange(1, 257, dtype=np.uint64) * MIX[0])
        self.up = self.down = np.ones(1, np.uint64)
        self.inverse = pow(BASE, -1, 1 << 64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, BASE, np.uint64))), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, self.inverse, np.uint64))), dtype=np.uint64)

    def strings(self, text: np.ndarray, length: int) -> np.ndarray:
        """A 64-bit hash of the string of this length at each place, along the last axis."""
        n = text.shape[-1]
        self.need(n)
        sums = np.cumsum(self.bytes[text] * self.up[:n], axis=-1, dtype=np.uint64)
        sums = np.concatenate((np.zeros((*text.shape[:-1], 1), np.uint64), sums), axis=-1)
        return mixed((sums[..., length:] - sums[..., :-length]) * self.down[: n - length + 1])


POWERS = Powers()


def window_least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours, from running minima of blocks in both directions."""
    n = len(x)
    full = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = x
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def sample(raw: bytes, powers: Powers) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(places, names, runs) of the sampled places of a text, in order. Texts under LENGTH bytes have none.

    Equal grams in a window: the last one is sampled. In a run that repeats itself every GRAM bytes or less that makes
    many places. A string that isn't inside the run holds one of its ends, so the first and last such gram of a run
    stand for the others. A string inside the run also begins within its first period, or begins there in any other
    text that holds it inside such a run, so the places sampled for those starts stay. Runs of LENGTH bytes and a
    period hold each of their strings twice: they are returned as (begin, end) and need no comparison."""
    text = np.frombuffer(raw, np.uint8)
    if len(text) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64), []
    names = powers.strings(text, GRAM)
    low = np.uint64(2 * STRETCH - 1)
    found = []
    for a in range(0, max(1, len(names) - GRAMS + 1), STRETCH):
        part = names[a : a + STRETCH + GRAMS - 1]
        keys = (part & ~low) | (low - np.arange(len(part), dtype=np.uint64))
        found.append(a + (low - (np.unique(window_least(keys, GRAMS)) & low)).astype(np.int64))
    places = np.unique(np.concatenate(found))
    step = np.diff(places)
    tied = (names[places[1:]] == names[places[:-1]]) & (step <= GRAM)
    runs: list[tuple[int, int]] = []
    if tied.any():
        places, runs = _thin(text, places, tied, step)
    return places, names[places], runs


def _thin(text: np.ndarray, places: np.ndarray, tied: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    in_run = np.concatenate((tied, [False])) | np.concatenate(([False], tied))
    keep, runs = [places[~in_run]], []
    for period in np.unique(step[tied]):
        differ = np.flatnonzero(text[:-period] != text[period:])
        starts = np.unique(np.concatenate((places[:-1][tied & (step == period)], places[1:][tied & (step == period)])))
        at = np.searchsorted(differ, starts)
        for k in np.unique(at):
            begin = differ[k - 1] + 1 if k else 0
            end = (differ[k] if k < len(differ) else len(text) - period) + period
            mine = starts[at == k]
            # the first and the last place of each phase of the run
            phase = (mine - begin) % period
            first = begin + np.unique(phase)
            last = first + (end - GRAM - first) // period * period
            keep += [first, last]
            if end - begin >= LENGTH:
                keep.append(mine[np.abs(mine - begin - REACH) <= 2 * period])
            if end - begin >= LENGTH + period:
                runs.append((int(begin), int(end)))
    out = np.unique(np.concatenate(keep))
    return out[(out >= 0) & (out <= len(text) - GRAM)], runs


def context(raw: bytes, place: int) -> tuple[bytes, int]:
    left = min(place, REACH)
    return raw[place - left : place + LENGTH], left


def repeated(contexts: list[tuple[bytes, int, int, int, int]], tasks: list[int]) -> list[tuple[int, int] | None]:
    """For each (bytes, bytes before the sample, times it stands, low, high): the range, from the sample, of the bytes in
    strings that begin low to high bytes before it and stand in another context of its task too, or twice in this one;
    None if there are none. Contexts of many tasks are compared in one go: a string's name holds its task's number."""
    n = len(contexts)
    table = np.zeros((n, REACH + LENGTH), np.uint8)
    for row, (raw, left, *_) in zip(table, contexts, strict=True):
        row[REACH - left : REACH - left + len(raw)] = np.frombuffer(raw, np.uint8)
    left, times, low, high = (np.array(c, np.int64) for c in list(zip(*contexts, strict=True))[1:])
    size = np.array([len(c[0]) for c in contexts])
    begin, end = np.maximum(REACH - left, REACH - high), np.minimum(REACH - left + size - LENGTH, REACH - low)
    own = mixed(np.array(tasks, np.uint64) * MIX[0])[:, None]
    twice = times > 1
    least, most = np.full(n, REACH + 1), np.full(n, -1)
    # starts before the sample, some at a time so that memory is bounded
    cut = max(1, CELLS // n)
    for first in range(0, REACH + 1, cut):
        at = np.arange(first, min(first + cut, REACH + 1))
        there = (begin[:, None] <= at) & (end[:, None] >= at)
        if not there.any():
            continue
        names = POWERS.strings(table[:, at[0] : at[-1] + LENGTH], LENGTH) ^ own
        # what isn't there gets a name of its own
        names[~there] = mixed(np.flatnonzero(~there).astype(np.uint64) * MIX[0] + MIX[2])
        order = np.argsort(names, axis=0)
        ranked = np.take_along_axis(names, order, 0)
        same = ranked[1:] == ranked[:-1]
        edge = np.zeros((1, len(at)), bool)
        hit = np.empty_like(there)
        np.put_along_axis(hit, order, np.concatenate((same, edge)) | np.concatenate((edge, same)), 0)
        hit = (hit | twice[:, None]) & there
        rows = np.flatnonzero(hit.any(1))
        least[rows] = np.minimum(least[rows], at[hit[rows].argmax(1)])
        most[rows] = at[len(at) - 1 - hit[rows, ::-1].argmax(1)]
    return [(int(a) - REACH, int(z) - REACH + LENGTH) if z >= 0 else None for a, z in zip(least, most, strict=True)]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _batch(columns: list, types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], list(types))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    spans: array<struct<start, end>> of the removed bytes. Null and empty texts have no bytes. A text of LENGTH bytes
    or more that stands twice is removed whole, repeated rows included. Grams and strings are told by 64-bit hashes,
    strings only among those of one gram. A text that no row with an id holds is compared with equal texts only. Empty
    tables give no rows; other columns, of whatever name, aren't read; texts are read whole, however long."""
    source = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").cast("binary").alias("_t"))
    rows = materialize(source.mapInArrow(_sampled, "doc_id bigint, n_bytes bigint, sha binary, names array<bigint>"))
    # texts that stand once or first; the others are removed whole
    classes = kept(rows.where(f"n_bytes >= {LENGTH}").groupBy("sha").agg(F.count("*").alias("copies"), F.min("doc_id").alias("doc_id")))
    heads = kept(rows.join(classes.where("doc_id IS NOT NULL").select("sha", "doc_id").hint("merge"), ["sha", "doc_id"]).select("sha", "doc_id", F.explode("names").alias("name")))
    names = kept(heads.groupBy("name").agg(F.count("*").alias("n")).where("n > 1"))
    wanted = kept(skewed(heads, names, ["name"], "n", heads.count()).groupBy("sha", "doc_id").agg(F.collect_set("name").alias("names")))
    # texts that hold a name that stands twice, with the places of such names; the other texts stay where they are
    # the small side of each join with texts is hashed, so that texts needn't be sorted
    held = wanted.hint("shuffle_hash").join(flagged(source, wanted, "doc_id", wanted.count()), "doc_id").mapInArrow(_placed, "sha binary, _t binary, name array<bigint>, ctx array<bigint>, place array<bigint>, left array<int>, size array<int>, runs array<struct<start:bigint,end:bigint>>")
    held = materialize(held)
    places = held.select("sha", F.explode(F.arrays_zip("name", "ctx", "place", "left", "size")).alias("p")).select("sha", "p.*")
    by_context = kept(places.groupBy("name", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("sha", "place")).alias("w")))
    several = kept(by_context.groupBy("name").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    n_contexts, n_places = by_context.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    asked = skewed(by_context, several, ["name"], "kinds", n_contexts).select("w.sha", F.struct("name", "ctx", "n", "kinds", "w.place").alias("q")).groupBy("sha").agg(F.collect_list("q").alias("qs"))
    bytes_of = asked.hint("shuffle_hash").join(held.select("sha", "_t"), "sha").mapInArrow(_contexts, "task binary, low int, high int, name bigint, ctx bigint, n bigint, left int, bytes binary")
    bytes_of = materialize(bytes_of)
    crowded = bytes_of.groupBy("task").count().where(F.col("count") > crowd).select("task")
    n_crowded = crowded.count()
    few = bytes_of
    if n_crowded:
        crowded = F.broadcast(crowded) if n_crowded <= BROADCAST_ROWS else crowded.hint("merge")
        few = bytes_of.join(crowded, "task", "left_anti").select(bytes_of.columns)
    answers = few.repartition("task").sortWithinPartitions("task").mapInArrow(_compared, "name bigint, ctx bigint, low int, high int")
    if n_crowded:
        answers = answers.unionByName(_counted(bytes_of.join(crowded, "task", "left_semi").select(bytes_of.columns)))
    answers = answers.groupBy("name", "ctx").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    known = kept(by_context.select("name", "ctx", "n").join(answers.hint("merge"), ["name", "ctx"], "left"))
    found = skewed(places, known, ["name", "ctx"], "n", n_places)
    whole = (F.col("n") > 1) & (F.col("size") >= LENGTH)
    start = F.when(whole, F.col("place") - F.col("left")).otherwise(F.col("place") + F.col("low"))
    end = F.when(whole, F.col("place") - F.col("left") + F.col("size")).otherwise(F.col("place") + F.col("high"))
    found = found.select("sha", F.struct(start.alias("start"), end.alias("end")).alias("r")).where("r.start IS NOT NULL").unionByName(held.select("sha", F.explode("runs").alias("r"))).groupBy("sha").agg(F.collect_set("r").alias("rs"))
    single = found.join(classes.where("copies = 1").select("sha").hint("merge"), "sha")
    cut = single.hint("shuffle_hash").join(held.select("sha", "_t"), "sha").mapInArrow(_removed, "sha binary, n_removed bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>")
    copied = classes.where("copies > 1").select("sha", "copies", F.lit(True).alias("copied"))
    out = skewed(rows.select("doc_id", "n_bytes", "sha"), copied, ["sha"], "copies", rows.count(), "left").join(cut.hint("merge"), "sha", "left")
    gone = F.coalesce("copied", F.lit(False)) & (F.col("n_bytes") >= LENGTH)
    spans = F.when(gone, F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("end")))).otherwise(F.coalesce("spans", F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")))
    out = materialize(out.select(
        "doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"), F.size(spans).cast("long").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"), spans.alias("spans"),
    ))
    for used in (rows, classes, heads, names, wanted, held, by_context, several, bytes_of, known):
        release(used)
    return out


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    types = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "sha": pa.binary(), "names": pa.list_(pa.int64())}
    for batch in batches:
        sizes, shas, names = [], [], []
        for raw in batch.column(1):
            raw = raw.as_py() or b""
            sizes.append(len(raw))
            shas.append(hashlib.sha256(raw).digest())
            names.append(sample(raw, powers)[1].view(np.int64))
        yield _batch([batch.column(0).to_pylist(), sizes, shas, names], types)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers, integers = Powers(), pa.list_(pa.int32())
    types = {"sha": pa.binary(), "_t": pa.binary(), "name": pa.list_(pa.int64()), "ctx": pa.list_(pa.int64()), "place": pa.list_(pa.int64()), "left": integers, "size": integers, "runs": RANGES}
    for batch in batches:
        for sha, wanted, raw in zip(batch["sha"], batch["names"], batch["_t"], strict=True):
            sha, raw = sha.as_py(), raw.as_py() or b""
            if hashlib.sha256(raw).digest() != sha:  # another row of the same doc_id
                continue
            places, names, runs = sample(raw, powers)
            on = np.isin(names.view(np.int64), wanted.values.to_numpy())
            around = [context(raw, int(p)) for p in places[on]]
            digests = [int.from_bytes(hashlib.blake2b(b, digest_size=8, salt=left.to_bytes(2, "big")).digest(), "big", signed=True) for b, left in around]
            yield _batch([[sha], [raw], [names[on].view(np.int64)], [digests], [places[on]], [[left for _, left in around]], [[len(b) for b, _ in around]], [[{"start": a, "end": b} for a, b in runs]]], types)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"task": pa.binary(), "low": pa.int32(), "high": pa.int32(), "name": pa.int64(), "ctx": pa.int64(), "n": pa.int64(), "left": pa.int32(), "bytes": pa.binary()}
    for batch in batches:
        for asked, raw in zip(batch["qs"], batch["_t"], strict=True):
            raw, out = raw.as_py(), []
            for q in asked.as_py():
                b, left = context(raw, q["place"])
                name = q["name"].to_bytes(8, "big", signed=True)
                rest = (q["name"], q["ctx"], q["n"], left, b)
                if q["kinds"] <= MANY:
                    out.append((name, 0, REACH, *rest))
                    continue
                # many contexts: a string that begins HALF bytes before the sample or more holds these bytes, any other those after it
                if left >= HALF:
                    out.append((name + b"l" + hashlib.blake2b(b[left - HALF : left], digest_size=8).digest(), HALF, REACH, *rest))
                if len(b) - left >= LENGTH - HALF + 1:
                    out.append((name + b"r" + hashlib.blake2b(b[left : left + LENGTH - HALF + 1], digest_size=8).digest(), 0, HALF - 1, *rest))
            if out:
                yield _batch([list(c) for c in zip(*out, strict=True)], types)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From contexts sorted by task: whole tasks are taken together until there are SHARE contexts or more."""
    types = {"name": pa.int64(), "ctx": pa.int64(), "low": pa.int32(), "high": pa.int32()}
    ids: list[tuple[int, int]] = []
    contexts: list[tuple] = []
    tasks: list[int] = []
    last = None

    def answer() -> pa.RecordBatch:
        ranges = repeated(contexts, tasks)
        return _batch([[i[0] for i in ids], [i[1] for i in ids], [r[0] if r else None for r in ranges], [r[1] if r else None for r in ranges]], types)

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("task", "name", "ctx", "bytes", "left", "n", "low", "high"))
        for task, name, ctx, *context_ in zip(*columns, strict=True):
            if task != last:
                if len(ids) >= SHARE:
                    yield answer()
                    ids, contexts, tasks = [], [], []
                last, number = task, len(ids)
            ids.append((name, ctx))
            contexts.append(tuple(context_))
            tasks.append(number)
    if ids:
        yield answer()


def _counted(contexts: DataFrame) -> DataFrame:
    """(name, ctx, low, high) like _compared, from counts of the strings of each task and step."""
    starts = contexts.mapInArrow(_strings, "name bigint, ctx bigint, n bigint, step int, key binary")
    twice = materialize(starts.groupBy("key").agg(F.sum("n").alias("times")).where("times > 1"))
    found = lookup(starts, twice, "key", twice.count()).where("times IS NOT NULL")
    return materialize(found.groupBy("name", "ctx").agg((-F.max("step")).cast("int").alias("low"), (F.lit(LENGTH) - F.min("step")).cast("int").alias("high")))


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"name": pa.int64(), "ctx": pa.int64(), "n": pa.int64(), "step": pa.int32(), "key": pa.binary()}
    for batch in batches:
        for r in batch.to_pylist():
            raw, left = np.frombuffer(r["bytes"], np.uint8), r["left"]
            # a string that begins step bytes before the sample
            steps = np.arange(max(r["low"], left + LENGTH - len(raw)), min(r["high"], left) + 1)
            if len(raw) < LENGTH or not len(steps):
                continue
            names = POWERS.strings(raw, LENGTH)[left - steps]
            keys = [r["task"] + int(k).to_bytes(2, "big") + x.tobytes() for k, x in zip(steps, names, strict=True)]
            yield _batch([[r["name"]] * len(keys), [r["ctx"]] * len(keys), [r["n"]] * len(keys), steps, keys], types)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"sha": pa.binary(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "spans": RANGES}
    for batch in batches:
        out = []
        for sha, ranges, raw in zip(batch["sha"], batch["rs"], batch["_t"], strict=True):
            raw = raw.as_py()
            spans = merged([(r["start"], r["end"]) for r in ranges.as_py()])
            kept, at = hashlib.sha256(), 0
            for a, b in spans:
                kept.update(raw[at:a])
                at = b
            kept.update(raw[at:])
            out.append((sha.as_py(), sum(b - a for a, b in spans), kept.hexdigest(), [{"start": a, "end": b} for a, b in spans]))
        if out:
            yield _batch([list(c) for c in zip(*out, strict=True)], types)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of op8."""
    return find(docs).drop("spans")
