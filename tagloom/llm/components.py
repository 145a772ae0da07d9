"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.scale import settle


def _linked_to_least(edges: DataFrame, large: bool) -> DataFrame:
    """Join every neighbour of u to the least of u's neighbourhood: larger neighbours, or u and its smaller ones."""
    if large:
        edges = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = edges.join(least, "u")
    if large:
        rows = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        pairs = F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        rows = joined.select(pairs.alias("e")).select("e.u", "e.v")
    return rows.filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long). One row (node, root) per node that is not its component's least node.

    A node with very many edges is no group of its own in any task: minima combine on the map side, and the joins are split by
    Spark where they are skewed. Each round is written to shared storage, so the plan does not grow.
    """
    turned = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, last = settle(turned.filter("u <> v").distinct()), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges, last = settle(_linked_to_least(_linked_to_least(edges, True), False)), state
