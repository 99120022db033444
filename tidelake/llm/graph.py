"""Connected components of a graph of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidelake.llm.tables import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its greater neighbours to the least of its neighbourhood.

    The minima are written, so that the join has a shuffle of its own, which Spark can
    split at a node with very many neighbours.
    """
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    least = written(least, "least")
    return both.filter(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("w")).select("v", "m").toDF("a", "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours go to the least of them."""
    edges = written(edges, "large")
    least = written(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    own = least.select("a", F.col("m").alias("b"))
    others = (
        edges.join(least.withColumnRenamed("a", "w"), F.col("a") == F.col("w"))
        .filter(F.col("b") != F.col("m"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    return own.union(others).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node leads to one other at most, and none that is led to leads on."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("leads"), F.lit(0).alias("led")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    seen = ends.groupBy("node").agg(F.sum("leads").alias("leads"), F.max("led").alias("led"))
    return seen.filter("leads > 1 or leads = 1 and led = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node and component (the least node it is connected with) of the two columns of ``edges``.

    Nodes without an edge to another node, and least nodes themselves, have a row only if
    they are in an edge. Alternates large and small stars, which need some log(nodes)
    rounds; minima are combined before shuffles, so that hot nodes do no harm.
    """
    a, b = edges.columns
    named = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    current = written(named, "edges")
    while not _are_stars(current):
        current = written(_small_star(_large_star(current)), "edges")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
