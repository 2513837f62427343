"""Connected components of an edge table, by alternating large-star and small-star
steps.  Every step is a grouped minimum (combined on the map side) and a join that
Spark may split; edges are cut from their lineage by tables in the checkpoint
folder, and nothing but one count and one checksum reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import freeze


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` run from the larger to the smaller end."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node that has an edge; the root is the smallest node
    of its component.  ``edges`` has bigint columns ``u`` and ``v``; loops, repeats
    and either direction are fine.  Converges in a number of rounds that grows with
    the logarithm of the longest path; ``rounds`` only guards against a defect."""
    now = freeze(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .filter("u <> v").distinct(), "edges")
    state = _state(now)
    if state[0]:
        for _ in range(rounds):
            now = freeze(_small_star(_large_star(now)), "edges")
            after = _state(now)
            if after == state:
                break
            state = after
        else:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
