"""Connected components by alternating star contractions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadglass.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it knows."""
    both = edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return (
        both.join(least, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = (
        edges.join(least, "a")
        .where("b > least")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
    )
    return moved.unionByName(least.withColumnRenamed("least", "b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge (a, b); the component is its
    smallest node. Self-loops are ignored.

    Each round is a few equi-joins over the edges, and their number falls. A node with
    many neighbours is never gathered: its minimum is aggregated and joined back. Only
    a count and a checksum reach the driver.
    """
    edges = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "components",
    )
    mark = _mark(edges)
    while mark[0]:
        edges = written(_small_star(_large_star(edges)), "components")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(roots.distinct())
