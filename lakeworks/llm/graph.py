"""Connected components of a distributed edge list, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import discard, stored

MAX_ROUNDS = 60


def _to_least_of_larger(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours. Rows may repeat, but are no more than the edges."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def _to_least_of_smaller(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the least of those neighbours."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether distinct edges from a larger ``u`` to a smaller ``v`` tie every node to the least of its component: once, and to one not tied itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    met = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return met.where("up > 1 OR up = 1 AND down = 1").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its least node.

    The two star steps are repeated until the edges are stars around least nodes, which takes a
    logarithmic number of rounds, and none for edges that are such stars already. Minima are
    aggregated before they are shuffled, and the joins can be split by the adaptive planner, so
    a node with a third of all edges stays spread. Each round is a table in the shared scratch
    folder. Edges with a null end and loops are left out; repeated and reversed edges do no harm.
    """
    proper = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a != b")
    e = stored(proper.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _are_stars(e):
            break
        after = stored(_to_least_of_smaller(_to_least_of_larger(e)), "edges")
        discard(e)
        e = after
    else:
        raise RuntimeError("components did not settle")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
