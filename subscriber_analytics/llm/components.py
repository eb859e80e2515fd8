"""Distributed connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscriber_analytics.llm.arrow import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def _stars(edges: DataFrame) -> DataFrame:
    """One round: larger neighbours move to the smallest neighbour, then smaller ones do.

    The minima are stored: a join with a stored table is one that Spark can split where a hub is hot.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select("b", "a"))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    large = stored(large, "large")
    lowest = stored(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
    small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionAll(lowest.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); the component is its smallest node.

    Each round is joins and grouped minima, so a hub with a third of all edges is pre-aggregated before
    the shuffle. Rounds go through the shared folder and end when the edges no longer change; they
    number in the logarithm of the longest path. Edges with a null end and loops join nothing.
    """
    edges = stored(edges.toDF("a", "b").where("a <> b").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = stored(_stars(edges), "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
