"""Connected components of an edge table by alternating large-star and small-star steps.

Every step points nodes at the smallest node of their neighbourhood with a map-side combined
minimum and a join; a hub is a key of those, never a list in one task.  Each round is written
to the shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Distinct (u, v), v < u.  Large: larger neighbours of u go to its smallest; small: the smaller ones, and u itself."""
    if large:
        around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = around.join(least, "u")
    if large:
        out = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of an edge (u, v) reaches, roots left out."""
    current = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                          .where(F.col("u") != F.col("v")).distinct(), "edges")

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(current)
    while before[0]:
        current = materialize(_star(_star(current, large=True), large=False), "edges")
        after = state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
