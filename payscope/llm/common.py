"""Helpers shared by the corpus operators: tables, shared-folder materialisation, column helpers, prefix sums."""

from __future__ import annotations

import contextlib
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space and letters as the contracts of the queries spell them (Java regular expressions).
SPACE = r"[\x20\x09-\x0D]+"
SALTS = 32
#: Rows up to which a lookup table may be broadcast; beyond it a salted shuffle join is used.
BROADCAST_ROWS = 50_000
#: Rows of one key that a task may take; keys of more are hot.
HOT_ROWS = 1000
#: 64-bit words of a filter of flags that may be broadcast: 2 MB of flags, some 20 MB as rows.
MAX_WORDS = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or else a folder of the warehouse, which is shared too."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return found or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/payscope-steps"


def materialize(df: DataFrame) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: lineage is cut, lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/payscope-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._payscope_path = path
    return out


def kept(df: DataFrame) -> DataFrame:
    """df, computed once and kept on the executors' disks: for narrow tables of a few steps' lineage, recomputed where an executor is lost."""
    return df.persist(StorageLevel.DISK_ONLY)


def release(df: DataFrame | None) -> None:
    """Deletes what materialize() wrote or lets go of what kept() holds, once nothing reads it any more."""
    path = getattr(df, "_payscope_path", None)
    if df is not None and not path:
        df.unpersist()
    if path:
        spark = df.sparkSession
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def let(value: Column, body) -> Column:
    """body(value) with value computed once per row, also where body uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def plus(a: Column, b: Column) -> Column:
    return a + b


def larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


def chunked(values: Column, block: int = 256) -> Column:
    """An array cut into arrays of `block` elements: a lambda that slices copies the whole array, so long ones are cut first."""
    cut = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / block).cast("int")), lambda b: F.slice(values, b * block + 1, block))
    return F.when(F.size(values) <= block, F.array(values)).otherwise(cut)


def prefix_folds(values: Column, fold, zero: Column, block: int = 256) -> Column:
    """Exclusive running folds of an array of longs, by blocks so that long arrays stay far from quadratic."""

    def total(x: Column) -> Column:
        return F.aggregate(x, zero, fold)

    def inner(chunks: Column, totals: Column) -> Column:
        def of(c: Column, b: Column) -> Column:
            return let(total(F.slice(totals, F.lit(1), b)), lambda base: F.transform(c, lambda _, i: fold(base, total(F.slice(c, F.lit(1), i)))))

        return F.flatten(F.transform(chunks, of))

    return let(values, lambda a: let(chunked(a, block), lambda chunks: let(F.transform(chunks, total), lambda totals: inner(chunks, totals))))


def prefix_sums(lengths: Column, block: int = 256) -> Column:
    """Exclusive running sums of an array of longs."""
    return prefix_folds(lengths, plus, F.lit(0).cast("long"), block)


def key_of(column: str) -> Column:
    """A non-null join key: a null and an empty string stay apart."""
    c = F.col(column).cast("string")
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), c))


def lookup(big: DataFrame, small: DataFrame, key: str, rows: int) -> DataFrame:
    """big left join small on key, where one key may hold most of big. small has `rows` rows, one for each key.

    A small table of checked size is broadcast. A larger one is copied to SALTS salts, and big's rows are dealt to
    the salts by a hash of their content, so a hot key meets SALTS tasks."""
    if rows <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), key, "left")
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.lit(SALTS)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def skewed(big: DataFrame, small: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """big joined with small on keys, where weight tells how many rows of big a key of small has, of `total` in all.

    Keys of over HOT_ROWS rows are joined by broadcast and so stay spread. A key is only hot if it also has more than
    one in BROADCAST_ROWS of all rows, so no more than BROADCAST_ROWS keys are; the others are shuffled."""
    hot = small.where(F.col(weight) > max(HOT_ROWS, total // BROADCAST_ROWS))
    if hot.isEmpty():
        return big.join(small.hint("merge"), keys, how)
    rest = big.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    cold = small.where(F.col(weight) <= max(HOT_ROWS, total // BROADCAST_ROWS))
    return big.join(F.broadcast(hot), keys).unionByName(rest.join(cold.hint("merge"), keys, how))


def flagged(big: DataFrame, wanted: DataFrame, key: str, n: int, keep: bool = True) -> DataFrame:
    """Rows of big whose key may be among the n keys of wanted: a filter of one hash before an exchange, not a join.
    keep=False: the others, whose key surely isn't.

    8 bits for each wanted key, broadcast as 64-bit words, MAX_WORDS of them at most. Beyond, every row is let through."""
    words = 1 << max(10, (n // 8).bit_length())
    if words > MAX_WORDS:
        return big if keep else big.limit(0)
    bit = F.pmod(F.xxhash64(key), F.lit(64 * words))
    place, mask = F.shiftright(bit, 6), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{key}`), 64) as int))")
    flags = wanted.select(place.alias("_place"), mask.alias("_mask")).groupBy("_place").agg(F.bit_or("_mask").alias("_flags"))
    held = big.withColumns({"_place": place, "_mask": mask}).join(F.broadcast(flags), "_place", "left")
    on = F.coalesce(F.col("_flags").bitwiseAND(F.col("_mask")) != 0, F.lit(False))
    return held.where(on if keep else ~on).drop("_place", "_mask", "_flags")


def global_running(df: DataFrame, order: list[Column], sums: dict[str, Column], rows: int) -> DataFrame:
    """df with exclusive running sums along a total order of all its rows: out -> summand.

    A table of at most BROADCAST_ROWS rows is summed in one task. A larger one is cut by ranges of the order, each of
    about that many rows and summed by itself; the ranges' totals, one row each, are summed and broadcast."""

    def running(d: DataFrame, window) -> DataFrame:
        within = window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return d.withColumns({c: F.coalesce(F.sum(v).over(within), v * 0) for c, v in sums.items()})

    if rows <= BROADCAST_ROWS:
        return running(df, Window.partitionBy())
    n = -(-rows // BROADCAST_ROWS)
    cut = materialize(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))
    totals = cut.groupBy("_range").agg(*[F.sum(v).alias(f"_{c}") for c, v in sums.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_range", *[F.coalesce(F.sum(f"_{c}").over(before), F.col(f"_{c}") * 0).alias(f"_{c}") for c in sums])
    out = running(cut, Window.partitionBy("_range")).join(F.broadcast(totals), "_range")
    return out.withColumns({c: F.col(c) + F.col(f"_{c}") for c in sums}).drop("_range", *[f"_{c}" for c in sums])


@contextlib.contextmanager
def co_partitioned(spark: SparkSession):
    """Plans made inside join a side that is dealt by some of the join's keys where it lies, and deal the other alike."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    old = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, old)
