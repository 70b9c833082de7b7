"""Connected components by alternating star steps, all in joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import stage_table


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node that is in a link.

    A large-star step hangs each node's larger neighbours on the smallest
    node it sees, a small-star step its smaller ones; both shrink the graph
    to stars in a few rounds.  A node with very many neighbours is reduced by
    partial minima before it is shuffled, and its edges join as a plain
    sort-merge join, which adaptive execution can split.  Every round is
    written out, so a lost executor costs a part of a round.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges = stage_table(edges, "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage_table(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
