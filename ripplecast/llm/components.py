"""Connected components of a distributed edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplecast.llm.tables import materialise


def _least_neighbour(sym: DataFrame) -> DataFrame:
    # min() combines before the exchange, and AQE may split the join on a hub.
    least = sym.groupBy("u").agg(F.min("v").alias("m"))
    return sym.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component): every node of `edges` (u, v) with the least node it reaches.

    Large-star links the larger neighbours of a node to its least neighbour,
    small-star the smaller ones; the edge list never grows and the rounds are
    logarithmic. Every round is written to the shared folder.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialise(e, f"{label}-cc")
    before = _state(e)
    while True:
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(sym).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _least_neighbour(large)  # every row has u > v
        small = small.select("u", F.col("m").alias("v")).unionByName(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        e = materialise(small.distinct(), f"{label}-cc")
        after = _state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
