"""Connected components over a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    all_ways = _both_ways(edges)
    least = all_ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (all_ways.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, are linked to the smallest neighbour."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of `edges` (u, v: long) with the smallest node of its component.

    Large and small stars alternate until nothing moves, which takes a number of rounds logarithmic in the longest path
    in practice. Each round is written to the shared folder. Rows with a null end and links of a node to itself are left out.
    """
    edges = materialize(edges.where("u is not null and v is not null and u != v").select("u", "v").distinct(), "links")
    seen = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        seen = state
