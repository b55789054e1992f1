"""Connected components of an edge table, by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.runtime import materialize


def _nearest(edges: DataFrame) -> DataFrame:
    return materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "nearest")


def connected_components(edges: DataFrame) -> DataFrame:
    """``u`` and ``m``, the smallest node of its component, for every node but the smallest.

    Alternates two steps until nothing changes: every node hangs its larger neighbours on its
    smallest one, then its smaller neighbours. Rounds grow with the logarithm of the component
    size. Every round is a table in the shared folder. Edges are pairs ``u``, ``v`` in any order.
    """
    turn = lambda e: e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    edges = materialize(turn(edges), "edges")
    before = None
    while True:
        figures = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if figures == before or not figures["n"]:
            return edges.select("u", F.col("v").alias("m"))
        before = figures
        both = materialize(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        near = _nearest(both).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(turn(large), "large-star")
        small = edges.join(_nearest(edges), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(turn(small.unionByName(edges.groupBy("u").agg(F.min("v").alias("v")))), "small-star")
