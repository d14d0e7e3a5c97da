"""Connected components of a graph in edge tables, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.scratch import Scratch


def _orient(edges: DataFrame) -> DataFrame:
    """Distinct edges without loops, the larger end first."""
    return edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct()


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(vid, component) of every node with an edge to another node; a component is named by its least node.

    ``edges`` has long columns src and dst. Each round is a written table; the rounds end when the edges no longer change,
    which takes a number of rounds logarithmic in the graph's size. Minima are combined before the shuffle, so that a
    node with very many edges costs no more than one row a task.
    """
    now = scratch.save(_orient(edges), f"{name}-0")
    digest = lambda df: tuple(df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
    seen, k = digest(now), 0
    while seen[0]:
        k += 1
        then = scratch.save(small_star(large_star(now)), f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
        now, last, seen = then, seen, digest(then)
        if seen == last:
            break
    leaves = now.select(F.col("u").alias("vid"), F.col("v").alias("component"))
    return leaves.unionByName(now.select(F.col("v").alias("vid"), F.col("v").alias("component")).distinct())
