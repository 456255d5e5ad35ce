"""Near-duplicate documents from bottom-k sketches.

One hash function orders all shingles; a document's sketch is its K least. Documents with equal sets are one class.
Inverted lists of retained values bring together the classes that share enough of their sketches; within such a
gathering the sketch of a pair's union estimates their similarity, and what may reach the threshold is verified on full sets.

No link is lost but by chance of the hash: at the threshold, two sketches share fewer than LEAST values with a
probability near 2e-6, and the estimate drops a link with one near 1e-7. A class enters the lists of its K - LEAST + 1 rarest values only, so one of
any LEAST shared values is among them on both sides; values of boilerplate are the last to be used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import BROADCAST_ROWS, flagged, kept, materialize, release, skewed
from payscope.llm.components import components

K = 24
LEAST = 10
SHINGLE = 4
PERCENT = 80
#: The estimate drops pairs that both hold fewer than LEAST - SLACK of the K least values of their union.
SLACK = 2
#: Shingles of one gathering that a task takes; larger ones are cut into blocks.
MAX_SHINGLES = 4_000_000
#: Words whose hashes a worker remembers.
MAX_CACHE = 250_000
FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


class Shingler:
    """Sets of shingles as sorted arrays of 64-bit hashes; words are lower-cased in A-Z."""

    def __init__(self, width: int = SHINGLE):
        self.width, self.cache = width, {}

    def __call__(self, raw: bytes | None) -> np.ndarray:
        words = (raw or b"").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.cache) > MAX_CACHE:
            self.cache.clear()
        get, put, digest = self.cache.get, self.cache.__setitem__, xxhash.xxh3_64_intdigest
        codes = []
        for w in words:
            h = get(w)
            if h is None:
                h = digest(w)
                put(w, h)
            codes.append(h)
        a = np.array(codes, np.uint64)
        k = min(self.width, len(a))
        n = len(a) - k + 1
        total = np.full(n, k, np.uint64)
        for i in range(k):
            total = (total ^ (total >> np.uint64(29))) * FACTORS[(i + 4) % 8] + a[i : i + n] * FACTORS[i % 8]
        total = (total ^ (total >> np.uint64(32))) * FACTORS[0]
        return np.unique(total ^ (total >> np.uint64(29)))


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, doc_id: str, text: str, width: int, k: int, mark: str | None = None) -> DataFrame:
    """(doc_id, mark, n_shingles, key, sketch) of each row; key is null for an empty set."""
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            n, keys, lists = [], [], []
            for raw in batch.column(2):
                s = shingler(raw.as_py())
                n.append(len(s))
                keys.append(set_key(s) if len(s) else None)
                lists.append(s[:k].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x, t) for x, t in zip((n, keys, lists), kinds, strict=True)]], ["doc_id", "mark", "n_shingles", "key", "sketch"])

    own = F.col(f"`{mark}`") if mark else F.lit(None)
    chosen = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), own.cast("bigint").alias("mark"), F.col(f"`{text}`").cast("string").cast("binary").alias("_t"))
    return chosen.mapInArrow(run, "doc_id bigint, mark bigint, n_shingles bigint, key binary, sketch array<bigint>")


def needed(n: int, k: int, least: int, percent: int) -> int:
    """Values that the sketches of a set of n and of any linked set share, one at least.

    All of a small set is in its sketch, but a linked set of m > k values may hold m - k of the shared ones outside its own."""
    if n > k:
        return min(least, -(-n * percent // 100))
    linked = range(-(-n * percent // 100), n * 100 // percent + 1)
    return max(1, min(-(-percent * (n + m) // (100 + percent)) - max(0, m - k) for m in linked))


def gatherings(classes: DataFrame, k: int, least: int, percent: int) -> DataFrame:
    """(node, root) of classes that share a list. Few, as a list needs one of a class's rarest values."""
    values = classes.select("key", "n_shingles", F.explode("sketch").alias("v"))
    counts = kept(values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1"))
    known = skewed(values, counts, ["v"], "df", k * classes.count())
    small = F.array(*[F.lit(needed(n, k, least, percent)) for n in range(1, k + 1)])
    need = F.when(F.col("n_shingles") > k, F.least(F.lit(least), F.ceil(F.col("n_shingles") * percent / 100))).otherwise(F.get(small, (F.col("n_shingles") - 1).cast("int")))
    # what is left of the prefix once values of a single class, the rarest, have taken their places in it
    by_class = known.groupBy("key", "n_shingles").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"))
    # sketch - need + 1 places, less the (sketch - known) single values: known - need + 1
    room = F.size("vs") - need + 1
    rare = by_class.where(room > 0).select("key", F.explode(F.slice("vs", F.lit(1), room.cast("int"))).alias("e")).select("key", "e.v")
    rare = kept(rare)
    hubs = kept(rare.groupBy("v").agg(F.min("key").alias("b"), F.count("*").alias("n")))
    found = components(skewed(rare, hubs, ["v"], "n", rare.count()).select(F.col("key").alias("a"), "b"))
    for used in (counts, rare, hubs):
        release(used)
    return found


def union_overlap(sketch: np.ndarray, others: np.ndarray, k: int) -> np.ndarray:
    """How many of the k least values of the union of two sets both hold, for one full sketch and each row of others.

    Over k this is the bottom-k estimate of the Jaccard similarity: the sketch of a union is in the union of sketches."""
    both = np.sort(np.concatenate((others, np.broadcast_to(sketch, others.shape)), axis=1), axis=1)
    twice = both[:, 1:] == both[:, :-1]
    rank = np.cumsum(~twice, axis=1)
    return (twice & (rank < k)).sum(axis=1)


def link(sets: list[np.ndarray], k: int, least: int, percent: int, joined: list[bool] | None = None, only: int | None = None) -> np.ndarray:
    """Labels of the components of the link relation among these sets; every pair across components is looked at.

    The set whose values are the most shared goes first: near copies of one text mostly link to it, and only sets
    outside its component have to be compared with all others. joined: sets known to be in one component, which are only
    compared with others. only: the one set that is compared with all."""
    n = len(sets)
    label = np.arange(n)
    inside = np.zeros(n, bool) if joined is None else np.array(joined, bool)
    if inside.any():
        label[inside] = np.flatnonzero(inside)[0]
    sizes = np.array([len(s) for s in sets])
    every = _Lists(sets)
    short = _Lists([s[:k] for s in sets])
    weight = np.array([short.shared(i).sum() for i in range(n)])
    todo = [only] if only is not None else list(np.argsort(-(weight + (weight.max() + 1) * inside), kind="stable"))
    hub = todo[0]
    for i in todo:
        # two sets that are both in the hub's component need no look; any other pair has one set that gets here
        if (i != hub or inside[i]) and label[i] == label[hub]:
            continue
        near = short.shared(i) >= needed(int(sizes[i]), k, least, percent)
        near &= (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])) & (label != label[i])
        at = np.flatnonzero(near)
        # the estimate from the union's sketch; sets that are their own sketch go to the exact check
        full = at[sizes[at] > k] if sizes[i] > k else at[:0]
        if len(full):
            near[full] = union_overlap(sets[i][:k], np.stack([sets[j][:k] for j in full]), k) >= least - SLACK
            at = np.flatnonzero(near)
        if len(at) > 32:
            shared = every.shared(int(i))[at]
        else:
            shared = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in at], np.int64)
        linked = at[100 * shared >= percent * (sizes[i] + sizes[at] - shared)]
        if len(linked):
            old = np.unique(np.append(label[linked], label[i]))
            label[np.isin(label, old)] = old[0]
    return label


class _Lists:
    """Inverted lists of values over a few sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(self.n), [len(s) for s in sets])
        _, code = np.unique(values, return_inverse=True)
        order = np.argsort(code, kind="stable")
        self.owner = owner[order]
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(code, minlength=0))))
        often = np.diff(self.starts)[code] > 1 if len(code) else np.empty(0, bool)
        cuts = np.cumsum([len(s) for s in sets])[:-1]
        self.codes = [c[o] for c, o in zip(np.split(code, cuts), np.split(often, cuts), strict=True)] if sets else []

    def shared(self, i: int) -> np.ndarray:
        """How many values set i shares with each set, counting only those that more than one set holds."""
        parts = [self.owner[self.starts[c] : self.starts[c + 1]] for c in self.codes[i]]
        return np.bincount(np.concatenate(parts), minlength=self.n) if parts else np.zeros(self.n, np.int64)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT, k: int = K, least: int = LEAST, max_shingles: int = MAX_SHINGLES, mark: str | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept; with mark, the name of a column of whole
    numbers, also its value as `mark` and the component as `head`, which rows without an id have too (null: no shingles).

    component_id is the least doc_id of the component, kept tells whether it is the row's own. Null and empty texts
    have no shingles and are linked with nothing. Rows with equal sets are linked, rows of one doc_id included (a
    repeated row has the same component; both copies are kept). Null ids are never the least; a text that no row with an
    id holds is linked with equal sets only. Shingles are told by 64-bit hashes. Texts are read whole, however long.
    Empty tables give no rows; other columns, of whatever name, aren't read."""
    rows = materialize(sketches(docs, doc_id, text, width, k, mark))
    classes = materialize(rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")))
    gathered = gatherings(classes, k, least, percent)
    members = classes.select("key", "rep", "n_shingles").join(gathered.withColumnRenamed("node", "key").hint("merge"), "key")
    members = materialize(members)
    sizes = kept(members.groupBy("root").agg(F.sum("n_shingles").alias("total"), F.count("*").alias("_n")))
    blocks = F.when(F.col("total") <= max_shingles, F.lit(1)).otherwise(F.ceil(F.col("total") / (max_shingles / 2))).cast("int")
    dealt = skewed(members, sizes, ["root"], "_n", members.count()).withColumn("blocks", blocks)
    plain = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("rep"), F.col(f"`{text}`").cast("string").cast("binary").alias("_t"))

    def linked_in(tasks: DataFrame) -> DataFrame:
        """(a, b): heads of the components within each task. tasks: task, key, rep, joined, centre."""
        # few texts are asked for: the others stay where they are
        asked = tasks.where("rep IS NOT NULL").select("rep").distinct()
        texts = tasks.where("rep IS NOT NULL").hint("shuffle_hash").join(flagged(plain, asked, "rep", asked.count()), "rep")

        def run(group: pa.Table) -> pa.Table:
            shingler, sets, keys, reps, joined, only = Shingler(width), [], [], [], [], None
            seen: set[bytes] = set()
            columns = (group[c].to_pylist() for c in ("key", "rep", "joined", "centre"))
            for key, rep, inside, centre, raw in zip(*columns, group["_t"], strict=True):
                s = shingler(raw.as_py())
                # another row of the same doc_id may have another text
                if key not in seen and len(s) and set_key(s) == key:
                    only = len(sets) if centre else only
                    seen.add(key)
                    sets.append(s)
                    keys.append(key)
                    reps.append(rep)
                    joined.append(inside)
            first: dict[int, tuple[int, bytes]] = {}
            labels = link(sets, k, least, percent, joined, only) if sets else []
            for c, rep, key in zip(labels, reps, keys, strict=True):
                first[c] = min(first.get(c, (rep, key)), (rep, key))
            return pa.table({"a": pa.array(keys, pa.binary()), "b": pa.array([first[c][1] for c in labels], pa.binary())})

        return materialize(texts.select("task", "key", "rep", "joined", "centre", "_t").groupBy("task").applyInArrow(run, "a binary, b binary").where("a <> b"))

    no = F.lit(False)
    linked = linked_in(dealt.where("blocks = 1").select(F.hex("root").alias("task"), "key", "rep", no.alias("joined"), no.alias("centre")))
    label = linked.select(F.col("a").alias("key"), F.col("b").alias("head"))
    large = kept(dealt.where("blocks > 1"))
    if not large.isEmpty():
        parts = _large(large, classes, max_shingles, linked_in)
        label = label.unionByName(components(parts).select(F.col("node").alias("key"), F.col("root").alias("head")).where("key <> head"))
    named = materialize(classes.select("key", "rep", "copies").join(label.hint("merge"), "key", "left").withColumn("head", F.coalesce("head", "key")))
    least_id = kept(named.groupBy("head").agg(F.min("rep").alias("component"), F.count("*").alias("_n")))
    total = rows.count()
    by_key = kept(skewed(named, least_id, ["head"], "_n", total).select("key", "component", "head", "copies"))
    found = rows.select("doc_id", "mark", "n_shingles", "key")
    out = skewed(found.where("key IS NOT NULL"), by_key, ["key"], "copies", total).select("doc_id", "mark", "n_shingles", "component", "head")
    out = out.unionByName(found.where("key IS NULL").select("doc_id", "mark", "n_shingles", F.lit(None).cast("bigint").alias("component"), F.lit(None).cast("binary").alias("head")))
    component = F.coalesce("component", "doc_id")
    out = materialize(out.select("doc_id", *["mark", "head"] * bool(mark), "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")))
    for used in (rows, classes, members, sizes, large, linked, named, least_id, by_key):
        release(used)
    return out


def _large(members: DataFrame, classes: DataFrame, max_shingles: int, linked_in) -> DataFrame:
    """(a, b): links that connect the components of gatherings too large for a task.

    Each gathering's centre, the class whose values are the most shared, is first compared with all of it. Near copies of
    one text mostly link to it; only classes that don't are then compared with all others, block by block."""
    yes, no = F.lit(True), F.lit(False)
    values = members.select("root", "key").join(classes.select("key", F.explode("sketch").alias("v")).hint("shuffle_hash"), "key")
    shared = kept(values.groupBy("root", "v").agg(F.count("*").alias("n")))
    weight = skewed(values, shared, ["root", "v"], "n", values.count()).groupBy("root", "key").agg(F.sum("n").alias("weight"))
    centres = weight.groupBy("root").agg(F.max(F.struct("weight", "key"))["key"].alias("key"))
    own = F.pmod(F.xxhash64("key", F.lit("block")), F.col("blocks")).cast("int")
    rows = members.select("root", "key", "rep", "n_shingles", "blocks", own.alias("own"))
    hub = centres.join(rows, ["root", "key"]).select("root", "key", "rep", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own"))
    first = rows.select("root", "key", "rep", "own", no.alias("centre")).unionByName(hub.withColumn("centre", yes))
    first = linked_in(first.select(F.concat_ws(":", F.hex("root"), "own").alias("task"), "key", "rep", no.alias("joined"), "centre"))
    inside = first.select(F.col("a").alias("key")).unionByName(first.select(F.col("b").alias("key"))).distinct().withColumn("joined", yes)
    rows = kept(rows.join(inside.hint("shuffle_hash"), "key", "left").withColumn("joined", F.coalesce("joined", no)))
    rest = rows.where("NOT joined").groupBy("root").agg(F.ceil(F.sum("n_shingles") / (max_shingles / 2)).cast("int").alias("rest"))
    rows = rows.join(F.broadcast(rest) if rest.count() <= BROADCAST_ROWS else rest.hint("merge"), "root")
    # every block against each block of the classes that didn't link
    all_of = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("rest") - 1))).withColumn("j", F.col("own"))
    those = rows.where("NOT joined").withColumn("i", F.pmod(F.xxhash64("key", F.lit("rest")), F.col("rest")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = all_of.unionByName(those).select(F.concat_ws(":", F.hex("root"), "i", "j").alias("task"), "key", "rep", "joined", no.alias("centre"))
    out = first.unionByName(linked_in(tasks))
    release(shared)
    return out


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of op9."""
    return find(docs)
