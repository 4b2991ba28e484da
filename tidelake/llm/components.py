"""Connected components by alternating stars, as joins and grouped minima; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut

#: Tasks that the edges of one node are dealt to.
SALTS = 16


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every neighbour above u is tied to the least of u and its neighbours. Small
    star: the neighbours below u, and u, are tied to the least of them."""
    near = _both_ways(edges).filter("u <> v").withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    if not large:
        near = near.filter("v < u")
    # the edges of one node go to SALTS tasks, and its least neighbour to those that have some
    least = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.collect_set("salt").alias("salts"))
    tied = near.join(least.select("u", "m", F.explode("salts").alias("salt")), ["u", "salt"])
    out = tied.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def _unfinished(edges: DataFrame) -> bool:
    """Whether some node is tied to several others, or to one that is itself tied: edges are no
    stars yet. Counted from one row for each node and task."""
    tied = edges.select(F.col("u").alias("node"), F.col("v").alias("to"), F.lit(False).alias("centre"))
    centres = edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("to"), F.lit(True).alias("centre"))
    nodes = tied.unionByName(centres).groupBy("node").agg(F.min("to").alias("a"), F.max("to").alias("b"), F.max("centre").alias("centre"))
    return nodes.filter(F.col("a").isNotNull() & ((F.col("a") < F.col("b")) | F.col("centre"))).agg(F.count(F.lit(1))).first()[0] > 0


def components(edges: DataFrame) -> DataFrame:
    """node, class (its component's least node) of every node of edges (u, v), which are read several
    times and should be written before. The number of rounds grows with the logarithm of the longest
    path; each round ends in the shared folder. Edges that are stars already need none."""
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    while _unfinished(now):
        now = cut(_star(_star(now, True), False), "stars")
    return now.select(F.col("u").alias("node"), F.col("v").alias("class")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("class"))).distinct()
