"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisect.llm.tables import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable, itself included.

    Every round points nodes to smaller ones until only stars are left; the number of rounds grows with the logarithm
    of the longest chain, and links that are stars already take none. Rounds are written to the shared folder. Minima are
    taken before rows are joined to them.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while not _only_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node has either one smaller neighbour and no larger one, or none that is smaller. Links are distinct."""
    both = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionAll(edges.select("b", F.lit(0)))
    nodes = both.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return not nodes.agg(F.count_if(F.expr("ups > 1 OR (ups = 1 AND least = 0)"))).first()[0]


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to its smallest neighbour; a link may come more than once."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
    return both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return smallest.select("a", F.col("m").alias("b")).unionAll(others).distinct()
