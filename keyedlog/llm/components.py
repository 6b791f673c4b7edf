"""Connected components by alternating stars, a published method for clusters of machines.

Each round hangs the larger neighbours of every node under its smallest neighbour, and then the
smaller ones; the edges become stars around the smallest member within O(log^2) rounds. Hot nodes
cost no more than others: minima are combined before their shuffle, and are dealt anew before they
are joined back, so that adaptive execution can split the edges of a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import keep

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _towards_minimum(pairs: DataFrame, members) -> DataFrame:
    """Each pair (u, v) as (v, m), m being the smallest of u and its v; and (u, m) where asked."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    least = least.hint("rebalance")
    return members(pairs.join(least, "u"), least)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); the smallest member names its component.

    Loops, repeated edges and nulls are ignored; an empty table gives an empty one.
    """
    current = keep(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    before = _state(current)
    for _ in range(MAX_ROUNDS if before[0] else 0):
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            current.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _towards_minimum(
            both,
            lambda joined, _: joined.where("v > u and v <> m").select(
                F.col("v").alias("a"), F.col("m").alias("b")),
        )
        large = large.distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = _towards_minimum(
            down,
            lambda joined, least: joined.where("v <> m").select(
                F.col("v").alias("a"), F.col("m").alias("b"))
            .unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b"))),
        )
        current = keep(small.distinct(), "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError("components did not settle")
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionAll(current.select(F.col("b").alias("node"), F.col("b").alias("component"))
                          .distinct())
