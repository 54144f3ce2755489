"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clinicpulse.operators.staging import stage


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Link every neighbour (only smaller ones if ``small``) of a node to the smallest node around it."""
    if small:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    # Written, so that the join below has two plain sides and a hub's rows can be split.
    least = stage(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    met = near.join(least, "u")
    if small:
        moved = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    else:
        moved = met.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one root that hangs on nothing."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return counted.filter("up > 1 OR (up = 1 AND down > 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Only aggregates and joins on nodes, so no group is ever gathered; each round is written to the shared folder.
    A few rounds do, none if the links are stars already: the rounds halve the depth of the trees. Self links and
    nulls are ignored.
    """
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stage(down.filter("a <> b").distinct(), "edges")
    while not _are_stars(edges):
        edges = stage(_stars(_stars(edges, small=False), small=True), "stars")
    inner = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return inner.unionByName(roots)
