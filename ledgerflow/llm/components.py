"""Connected components of a table of links, by alternating large and small stars.

Every node hooks its larger neighbours to the smallest node of its star, then its
smaller ones, until each component is a star around its smallest node: a number
of rounds that grows with the logarithm of the links. Minima combine before the
shuffle and no neighbourhood is ever gathered in one row. Every round ends in a
written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v), u > v, after a large or small star round."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        hooked = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        hooked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return hooked.where("u <> v").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """id and label, the smallest id of its component, of every node of ``links`` (x, y)."""
    edges = saved(links.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "edges")
    mark = None
    while True:
        before, edges = edges, saved(_star(_star(edges, True), False), "edges")
        discard(before)
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
    roots = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("label"))
    return edges.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "id").unionByName(roots)
