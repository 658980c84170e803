"""Connected components of an edge table, wholly in Spark.

Alternating large-star and small-star steps: every step replaces a node's
neighbours by the least one, so a component of any shape ends as a star around
its least node after a logarithmic number of rounds.  A step is one ``min`` per
node (partial aggregation, so a hot node costs one row per task) and one join;
no neighbour list is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import checkpointed


EDGES_PER_PART = 200_000


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def _settled(e: DataFrame) -> bool:
    """Each node points at one root and no root points further."""
    both = e.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("inner"))\
        .unionAll(e.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("inner")))
    per = both.groupBy("x").agg(F.sum("out").alias("out"), F.max("inner").alias("inner"))
    return not per.where("out > 1 or (out = 1 and inner = 1)").take(1)


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of any orderable type -> ``(node, root)``: one row for each
    node that has an edge to another node; ``root`` is the component's least
    node.  Self-loops, null ends and repeated edges are ignored.  Partitions
    follow the number of edges, which no step increases."""
    e = checkpointed(edges.where("u is not null and v is not null and u <> v")
                     .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    parts = 4 + e.count() // EDGES_PER_PART
    e = e.coalesce(parts)
    while not _settled(e):
        e = checkpointed(_small_star(_large_star(e)).coalesce(parts))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
