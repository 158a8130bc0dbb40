"""Distributed connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node hands its least neighbour to its larger (large) or smaller (not large) neighbours."""
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        pairs = pairs.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    met = pairs.join(least, "u")
    out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its least node) for every node of an edge. Nulls and loops are left out.

    Each round is written to the shared folder and replaces the one before; a round costs two joins that AQE can split at a
    hot node. Rounds go on until nothing changes: each hands some node a lesser neighbour, and the steps settle after about
    the squared logarithm of the number of nodes.
    """
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    e = stage(e.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
    before = None
    while True:
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a", "b").cast("decimal(38,0)"))).head())
        if now == before or not now[0]:
            break
        before, last = now, e
        e = stage(_star(_star(e, True), False))
        drop(last)
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
