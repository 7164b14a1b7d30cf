"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.workspace import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(id, component_id)`` for every end of an edge ``(a, b)``; the smallest id of a
    component names it. Large and small stars in turn, each round written, until every
    vertex points at the smallest; only a count and a checksum reach the driver."""
    directed = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = materialize(directed.filter("u != v").distinct(), "edges")
    before = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            root = F.col("v").alias("component_id")
            roots = current.select(F.col("v").alias("id"), root).distinct()
            return current.select(F.col("u").alias("id"), root).unionByName(roots)
        before = state
        current = materialize(_small_star(_large_star(current)), "edges")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.filter("v > u").join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").filter("v != m")
    turned = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return turned.union(least.select("u", F.col("m").alias("v"))).distinct()
