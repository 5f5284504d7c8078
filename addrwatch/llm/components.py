"""Connected components of undirected links, by rounds of large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from addrwatch.llm import tables


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b); a component is its least node.

    Every step replaces links by links to least neighbours and keeps what is connected. Steps
    are group minima and joins; each round is stored, and only two totals reach the driver.
    """
    edges = tables.stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = tables.stored(small, "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def extended(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) after further links (a, b), stored; only links between components are worked on.

    Nodes that classes doesn't list are components of their own.
    """
    one = classes.select(F.col("node").alias("a"), F.col("component").alias("_a"))
    two = classes.select(F.col("node").alias("b"), F.col("component").alias("_b"))
    between = links.join(one, "a", "left").join(two, "b", "left").select(
        F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).where("a <> b").distinct()
    merged = tables.stored(connected(between), "merged")
    moved = classes.join(merged.select(F.col("node").alias("component"), F.col("component").alias("_new")), "component", "left").select(
        "node", F.coalesce("_new", "component").alias("component"))
    fresh = merged.join(classes, "node", "left_anti")
    return tables.stored(moved.unionByName(fresh.select("node", "component")), "components")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v") % 1_000_000_007), F.lit(0))).first())
