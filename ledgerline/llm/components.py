"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _state(edges: DataFrame) -> tuple:
    """One row to the driver: number of edges and an order-free checksum."""
    row = edges.select(F.count(F.lit(1)).alias("n"),
                       F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (node, component): component is the smallest node reachable.

    Only linked nodes appear; links to itself and with a null end are ignored,
    repeated links count once. Every round is joins and aggregations over all
    edges (a hot node is combined before its shuffle, and its join partition
    can be split); nothing but a count and a checksum reaches the driver.
    """
    edges = cut(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = cut(both.join(low, "a").where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(
                F.struct(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")),
                F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = cut(small.where("a <> b").distinct(), "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))
