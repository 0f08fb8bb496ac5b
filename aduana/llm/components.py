"""Connected components of links, by stars that are handed on until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.llm.common import written


def components(spark: SparkSession, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link: root is the smallest node it can reach.

    Every round hangs the larger neighbours of a node, and then the smaller ones, onto the smallest of them
    (alternating stars). Their number grows with the logarithm of the longest path. A round works on distinct
    links in a table of its own, so neither a node with very many links nor a large component meets in one task:
    minima are taken in the map tasks first, and the join that follows may be split by Spark.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = written(spark, edges, "links")
    while True:
        large = _star(_both(edges), larger=True)
        after = written(spark, _star(large, larger=False), "links")
        if _same(edges, after):
            return after.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
                after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        edges = after


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Neighbours v of u onto the smallest of u and its neighbours; (u, v) has u > v on return."""
    best = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = edges.join(best, "u")
    if larger:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            best.select("u", F.col("m").alias("v"))
        )
    return moved.filter("u <> v").distinct()


def _same(before: DataFrame, after: DataFrame) -> bool:
    def mark(df: DataFrame):
        h = F.xxhash64("u", "v")
        return df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first()

    return mark(before) == mark(after)
