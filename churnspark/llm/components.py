"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.runtime import materialize


def _least(pairs: DataFrame) -> DataFrame:
    """The least of each node ``a`` and its neighbours ``b``; stored, so that the join below
    has two plain exchanges and a node with very many neighbours is split at run time."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return materialize(least, "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(
        F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")
    ).select("e.a", "e.b")
    joined = both.join(_least(both), "a").where(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    moved = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple[int, int]:
    """Count and hash sum of the edges."""
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    row = edges.agg(F.count("*").alias("n"), F.sum(hashed).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) of every node with an edge to another node; the component is its least node.

    Nulls and edges of a node to itself are left out; repeated edges count once; an empty table
    gives an empty one. Edges are written after every round (a few rounds: the number grows with
    the logarithm of the nodes), nothing but two numbers goes to the driver.
    """
    current = edges.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("a"), F.least(left, right).alias("b")
    )
    current = materialize(current.distinct(), "edges")
    state = _state(current)
    while state[0]:
        stars = materialize(_large_star(current).distinct(), "edges")
        current = materialize(_small_star(stars).distinct(), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)
