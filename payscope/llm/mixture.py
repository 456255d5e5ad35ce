"""Mixing sources to target weights: fixed-length blocks of words, drawn by source for each output shard.

Main path: SQL expressions only. A source's documents are dealt by hash to parts of about PART_ROWS; the words of a
part, in hashed order, are cut into blocks of BLOCK words, numbered through all parts of the source. Output shards draw
how many slots each source gets; a source's slots run through a pseudorandom permutation of its block indices, again
and again, and blocks are joined to slots by index. The output is one row for each filled slot with the words of its
block; what each document gives is counted from those rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payscope.llm.common import BROADCAST_ROWS, co_partitioned, global_running, kept, key_of, let, lookup, materialize, release

BLOCK = 64
#: Slots of an output shard for each source, and the least number of slots of a shard.
SLOTS_PER_SOURCE = 64
MIN_SLOTS = 1024
MAX_TIMES = 3
WEIGHTS = (1, 2, 3)
#: Expected documents of a part; a task packs a part at a time.
PART_ROWS = 512
#: Slots that one row and one task expand to, and block numbers that one row of the index of parts covers.
CHUNK = 4096
TASK_SLOTS = 1 << 16
REACH = 4096
#: Steps of the cycle walk. The permuted domain exceeds n by less than sqrt(n) + 1, so for n >= 100 a walk this long
#: has a chance below 1e-60, and for smaller n it visits every index outside.
WALK = 64


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none. Without regular expressions, which take most of the time."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    for space in "\t\n\x0b\f\r":
        t = F.replace(t, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(t, " ", -1), "")


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def targets(sources: DataFrame, n: int) -> DataFrame:
    """(source, source_size) -> with n_source, weight, target: shares by weight, capped at MAX_TIMES, the rest reshared.

    The resharing ends where the rest share in proportion to weight and no cap is passed: sources in the order of
    cap / weight take their cap as long as the remaining share would pass it. One row for each of the n sources."""
    df = global_running(sources, [F.col("source").asc_nulls_last()], {"n_source": F.lit(1).cast("long")}, n)
    df = df.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("n_source") % len(WEIGHTS) + 1).cast("int")).cast("double"))
    df = df.withColumn("cap", F.lit(MAX_TIMES) * F.col("source_size").cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    df = global_running(df, [F.col("ratio"), F.col("n_source")], {"cap_before": F.col("cap"), "weight_before": F.col("weight")}, n)
    size, weight = df.select(F.sum("source_size").cast("double"), F.sum("weight")).first()
    df = df.withColumn("level", (F.lit(size or 0.0) - F.col("cap_before")) / (F.lit(weight or 0.0) - F.col("weight_before")))
    df = df.withColumn("capped", F.col("level") * F.col("weight") > F.col("cap"))
    # the first source that isn't capped sets the level of all that come after it
    at, level = df.select(F.min(F.when(~F.col("capped"), F.struct("ratio", "n_source", "level"))).alias("x")).select("x.ratio", "x.level").first()
    below = F.col("capped") & (F.col("ratio") <= F.lit(float("inf") if at is None else at))
    df = df.withColumn("target", F.when(below, F.col("cap")).otherwise(F.lit(level or 0.0) * F.col("weight")))
    return df.select("source", "source_size", "n_rows", "n_source", "weight", "target")


def permuted(df: DataFrame, out: str, index: Column, n: Column, seed: Column) -> DataFrame:
    """df with out, a pseudorandom permutation of index in 0 .. n-1: a Feistel network over two mixed-radix digits, with a cycle walk."""

    def half(digit: str, other: str, base: str, k: int) -> Column:
        return F.pmod(F.col(digit) + F.pmod(F.xxhash64(F.col(other), seed, F.lit(k)), F.col(base)), F.col(base))

    rows, cols = F.col("_rows"), F.col("_cols")

    def upper(k: int):
        return lambda v: F.pmod(F.floor(v / cols) + F.pmod(F.xxhash64(v % cols, seed, F.lit(k)), rows), rows) * cols + v % cols

    def lower(k: int):
        return lambda v: v - v % cols + F.pmod(v % cols + F.pmod(F.xxhash64(F.floor(v / cols), seed, F.lit(k)), cols), cols)

    def again(x: Column) -> Column:
        """The network once more, as one expression."""
        return let(let(let(let(x, upper(0)), lower(1)), upper(2)), lower(3))

    df = df.withColumns({"_n": n.cast("long"), "_x": index.cast("long")}).withColumn("_rows", F.ceil(F.sqrt(F.col("_n").cast("double"))).cast("long"))
    df = df.withColumn("_cols", F.ceil(F.col("_n") / F.col("_rows"))).withColumns({"_a": F.floor(F.col("_x") / F.col("_cols")), "_b": F.col("_x") % F.col("_cols")})
    for k in (0, 1):
        df = df.withColumn("_a", half("_a", "_b", "_rows", 2 * k)).withColumn("_b", half("_b", "_a", "_cols", 2 * k + 1))
    df = df.withColumn("_x", F.col("_a") * F.col("_cols") + F.col("_b"))
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.col("_x"), lambda x, _: F.when(x < F.col("_n"), x).otherwise(again(x)))
    return df.withColumn(out, F.when(F.col("_x") < F.col("_n"), F.col("_x")).otherwise(walked)).drop("_n", "_x", "_rows", "_cols", "_a", "_b")


def plan(sources: DataFrame, parts: DataFrame, n: int) -> tuple[DataFrame, DataFrame, int, int]:
    """targets() with n_blocks and the range lower .. upper of each source's slots among all; the parts with n_source,
    blocks and base, their first block's number in the source; slots in all, slots of a shard."""
    known = materialize(targets(sources, n))
    parts = parts.withColumn("key", key_of("source")).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("long"))
    # numbered through all parts, then from the first of each source on: no task gets a source's parts
    listed = materialize(lookup(parts, known.select(key_of("source").alias("key"), "n_source"), "key", n).select("key", "n_source", "part", "blocks"))
    numbered = materialize(global_running(listed, [F.col("n_source"), F.col("part")], {"at": F.col("blocks")}, listed.count()))
    first = numbered.groupBy("n_source").agg(F.min("at").alias("first"))
    parts = materialize(lookup(numbered, first, "n_source", n).select("key", "n_source", "part", "blocks", (F.col("at") - F.col("first")).alias("base")))
    blocks = parts.groupBy("n_source").agg(F.sum("blocks").alias("n_blocks"))
    df = known.join(blocks.hint("merge"), "n_source")
    # parts end in a short block: a source's slots number as many as its mean block needs to reach the target
    wanted = F.when(F.col("source_size") > 0, F.col("target") * F.col("n_blocks") / F.col("source_size")).otherwise(0.0)
    df = df.withColumn("slots", F.least(F.round(wanted).cast("long"), MAX_TIMES * F.col("n_blocks")))
    df = materialize(global_running(df, [F.col("n_source")], {"lower": F.col("slots")}, n).withColumn("upper", F.col("lower") + F.col("slots")))
    n_slots = df.select(F.coalesce(F.max("upper"), F.lit(0))).first()[0]
    for used in (known, listed, numbered):
        release(used)
    return df, parts, n_slots, max(MIN_SLOTS, SLOTS_PER_SOURCE * n)


def slots(sources: DataFrame, n_slots: int, per_shard: int) -> DataFrame:
    """(n_source, shard, slot, block, epoch): one row for each slot that is filled.

    All slots, source by source, are permuted and dealt to shards of per_shard: a shard's counts are drawn without
    replacement, which is a multinomial draw given that the sources' totals meet their targets. Slot k of a source,
    over all shards, reads block permuted(k mod blocks) of it. No window, no shuffle but that of the rows to expand."""
    length = F.col("upper") - F.col("lower")
    chunks = sources.where(length > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((length - 1) / CHUNK))))
    chunks = chunks.select("n_source", "n_blocks", "lower", length.alias("length"), "chunk").repartition(max(1, -(-n_slots // TASK_SLOTS)), "n_source", "chunk")
    df = chunks.withColumn("k", F.explode(F.sequence(F.col("chunk") * CHUNK, F.least((F.col("chunk") + 1) * CHUNK, F.col("length")) - 1)))
    df = permuted(df, "place", F.col("lower") + F.col("k"), F.lit(max(1, n_slots)), F.lit("shards"))
    df = permuted(df, "block", F.col("k") % F.col("n_blocks"), F.col("n_blocks"), F.col("n_source")).withColumn("epoch", F.floor(F.col("k") / F.col("n_blocks")))
    return df.select("n_source", F.floor(F.col("place") / per_shard).alias("shard"), (F.col("place") % per_shard).alias("slot"), "block", "epoch")


def _in_parts(drawn: DataFrame, parts: DataFrame) -> DataFrame:
    """drawn with key, part and local, the block's number within its part: blocks are found by ranges of REACH numbers."""
    ends = parts.where("blocks > 0").withColumn("reach", F.explode(F.sequence(F.floor(F.col("base") / REACH), F.floor((F.col("base") + F.col("blocks") - 1) / REACH))))
    ends = ends.select(F.col("n_source").alias("_source"), "reach", "key", "part", "base", "blocks")
    small = ends.count() <= BROADCAST_ROWS
    inside = (F.col("_source") == F.col("n_source")) & (F.col("reach") == F.floor(F.col("block") / REACH)) & (F.col("block") >= F.col("base")) & (F.col("block") < F.col("base") + F.col("blocks"))
    found = drawn.join(F.broadcast(ends) if small else ends.hint("merge"), inside)
    return found.select(*drawn.columns, "key", "part", (F.col("block") - F.col("base")).alias("local"))


def packed(rows: DataFrame) -> DataFrame:
    """(key, part, local, ps): the pieces of documents in each block, in order. rows: key, part, hash, doc_id, size, text.

    One exchange by part carries the texts; offsets, pieces and blocks are made where they land."""
    order = Window.partitionBy("key", "part").orderBy("hash", "doc_id", "size")
    rows = rows.withColumns({"row": F.row_number().over(order), "offset": F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})

    # no filter on size, which would be pushed down and split the texts once more
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("offset") / BLOCK), F.floor((F.col("offset") + F.col("size") - 1) / BLOCK)))
    # the words are split once for each document, and each block's are cut out of them outside of lambdas, which would copy all
    rows = rows.withColumn("words", words_of(F.col("text"))).select("key", "part", "row", "doc_id", "offset", "size", "words", F.explode(blocks).alias("local"))
    first = F.greatest(F.col("local") * BLOCK, F.col("offset"))
    n = F.least((F.col("local") + 1) * BLOCK, F.col("offset") + F.col("size")) - first
    text = F.array_join(F.slice("words", (first - F.col("offset") + 1).cast("int"), n.cast("int")), " ")
    pieces = rows.select("key", "part", "local", F.struct("row", "doc_id", n.alias("words"), text.alias("text")).alias("p"))
    # a block has BLOCK words at most, so no more pieces
    return pieces.groupBy("key", "part", "local").agg(F.sort_array(F.collect_list("p")).alias("ps"))


def _mixed(docs: DataFrame, doc_id: str, text: str, source: str) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """The rows of docs with their places in their parts; the rows of the mix, written to the shared folder; steps to be released."""
    t = F.col(f"`{text}`").cast("string")
    read = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), n_words(t).alias("size"), F.shiftrightunsigned(F.xxhash64(F.col(f"`{doc_id}`"), t), 2).alias("hash"), t.alias("text"))
    read = read.withColumn("key", key_of("source"))
    whole = narrow = kept(read.drop("text"))
    sources = materialize(narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows")))
    n = sources.count()
    # all other sources are one part each
    large = sources.where(F.col("n_rows") > PART_ROWS).select(key_of("source").alias("key"), F.ceil(F.col("n_rows") / PART_ROWS).alias("n_parts"))
    n_large = large.count()

    def with_part(df: DataFrame) -> DataFrame:
        return lookup(df, large, "key", n_large).withColumn("part", F.pmod("hash", F.coalesce("n_parts", F.lit(1).cast("long")))).drop("n_parts")

    narrow = with_part(narrow)
    planned, parts, n_slots, per_shard = plan(sources, narrow.groupBy("source", "part").agg(F.sum("size").alias("size")), n)
    drawn = lookup(_in_parts(slots(planned, n_slots, per_shard), parts), planned.select("n_source", "source"), "n_source", n)
    with co_partitioned(docs.sparkSession):
        # the texts stay where their exchange by part put them; the slots go there
        out = packed(with_part(read).select("key", "part", "hash", "doc_id", "size", "text")).hint("merge").join(drawn, ["key", "part", "local"])
        out = out.select("shard", "slot", "source", "block", "epoch", F.array_join(F.col("ps.text"), " ").alias("text"), "key", "part", F.transform("ps", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["row"].alias("row"), p["words"].alias("words"))).alias("pieces"))
        out = materialize(out)
    row = F.row_number().over(Window.partitionBy("key", "part").orderBy("hash", "doc_id", "size"))
    placed = lookup(narrow.withColumn("row", row), planned.select(key_of("source").alias("key"), "source_size", "target"), "key", n)
    return placed, out, [whole, sources, parts, planned]


def output(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix, one row for each filled slot: shard, slot, source, block, epoch, text, pieces.

    text is the block's words, one space apart (white space between words isn't kept); pieces tells, in order, the
    doc_id and the count of words of each document in it. A part's last block may be short."""
    _, out, steps = _mixed(docs, doc_id, text, source)
    for used in steps:
        release(used)
    return out.select("shard", "slot", "source", "block", "epoch", "text", F.transform("pieces", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["words"].alias("words"))).alias("pieces"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row for each row of docs: doc_id, source, size, source_size, target, taken, counted from the rows of output().

    Null and empty texts have size 0 and take none. Null sources form one source, the last. Repeated rows are rows of
    their own; rows equal in doc_id, source and text can trade places, so reruns agree as sets of rows. Rows that share
    only a doc_id are told apart by their text. Texts are read whole, however long, twice: docs must give the same rows
    each time. Empty tables give no rows; other columns, of whatever name, aren't read."""
    placed, mixed, steps = _mixed(docs, doc_id, text, source)
    taken = mixed.select("key", "part", F.explode("pieces").alias("p")).groupBy("key", "part", "p.row").agg(F.sum("p.words").alias("taken"))
    out = placed.join(taken.hint("merge"), ["key", "part", "row"], "left")
    out = materialize(out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))
    for used in (mixed, *steps):
        release(used)
    return out


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of op5."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
