"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    low = low.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return (both.filter(F.col("b") > F.col("a")).join(low, F.col("a") == F.col("u"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(e: DataFrame) -> DataFrame:
    """Rows hold a > b."""
    low = e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    rest = e.join(low, F.col("a") == F.col("u")).filter(F.col("b") != F.col("m"))
    return (rest.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))))


def components(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``a``, ``b``); root is
    the smallest node that can be reached.  Loops and repeated edges are allowed."""
    e = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = written(e.distinct(), "cc")
    seen = None
    for _ in range(max_steps):
        e = written(_small_star(_large_star(e)).distinct(), "cc")
        # Equal count and equal sums of hashes: the step changed nothing.
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
