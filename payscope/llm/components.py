"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import kept, materialize, release, skewed

MAX_ROUNDS = 40


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): the least node reachable, for every node of an edge. Any orderable type of node.

    Each step writes its edges to the shared folder. A star with many leaves is met by a join on its centre, which is
    broadcast if hot; no group is gathered in a task. Null ends are dropped, loops and repeats harmless."""
    pair = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    now = materialize(edges.where("a IS NOT NULL AND b IS NOT NULL").select(*pair).where("a <> b").distinct())
    stamp = _stamp(now)
    for _ in range(MAX_ROUNDS):
        if not stamp[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        starred, centres = _star(both, F.least(F.min("b"), F.col("a")), 2 * stamp[0])
        large = kept(starred.where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        starred, others = _star(large, F.min("b"), 2 * stamp[0])
        pairs = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        following = materialize(starred.select(pairs.alias("e")).select("e.*").where("a <> b").distinct())
        new = _stamp(following)
        for used in (now, large, centres, others):
            release(used)
        now, old, stamp = following, stamp, new
        if new == old:
            break
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct().join(roots.select("node"), "node", "left_anti"))


def _star(edges: DataFrame, least: Column, total: int) -> tuple[DataFrame, DataFrame]:
    """edges with m, the least node of the star around a, and the centres; centres of many leaves don't gather them in a task."""
    centres = kept(edges.groupBy("a").agg(least.alias("m"), F.count("*").alias("_leaves")))
    return skewed(edges, centres, ["a"], "_leaves", total), centres


def _stamp(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))).first())
