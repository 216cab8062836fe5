"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasture.llm.scratch import stored


def _with_least(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) with m, the least neighbour of u.  The minimum is pre-aggregated before the shuffle, and
    the join back is a plain equi-join whose hot side Spark may split."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _with_least(both).withColumn("m", F.least("u", "m"))
    return near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    near = _with_least(edges)
    kept = near.select("u", F.col("m").alias("v"))
    moved = near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.union(moved).distinct()


def _signature(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: any one orderable type); component: its least node.

    Null ends and loops are ignored; an empty table gives an empty result.  Each round is written to the shared
    folder, so the plan stays short and a lost executor repeats one round at most.
    """
    e = edges.where("u is not null and v is not null and u != v")
    e = stored(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (now := _signature(e)) != before and now[0]:
        before = now
        e = stored(_small_star(_large_star(e)), "edges")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
