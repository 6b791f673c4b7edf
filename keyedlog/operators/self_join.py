"""Left outer self joins on a column that is not a key, without forming pairs of rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """All columns renamed, so that ``a.*, b.*`` has no duplicate names and can be written."""
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def with_group_totals(
    df: DataFrame, on: str, totals: Mapping[str, Column], prefix: str = "b_"
) -> DataFrame:
    """``a.*, b.*`` where ``b`` is one row of totals for each value of ``on``.

    The right side is aggregated first (map-side partial sums), so the join adds columns and
    never rows. The totals are dealt anew between their aggregate and the join; that lets adaptive
    execution split the rows of a hot value where the totals are too large to broadcast.
    """
    right = prefixed(df.groupBy(on).agg(*[v.alias(n) for n, v in totals.items()]), prefix)
    right = right.hint("rebalance")
    return df.join(right, df[on] == right[prefix + on], "left")


def self_join_totals(df: DataFrame, on: str, amount: str) -> DataFrame:
    """Per value of ``on``: row count and both sides' sums of ``amount`` of the left self join.

    ``n`` rows with one value join to ``n * n`` rows. Their count and sums follow from ``n`` and
    the plain sum, so each side is grouped first and one row per value is joined. A NULL value
    matches nothing: its rows stay single, with a NULL right side.
    """
    left = df.groupBy(on).agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_sum"))
    right = prefixed(left, "_b")
    joined = left.join(right, left[on] == right["_b" + on], "left")
    return joined.select(
        on,
        (F.col("_n") * F.coalesce("_b_n", F.lit(1))).alias("pairs"),
        (F.col("_sum") * F.coalesce("_b_n", F.lit(1))).alias(f"left_{amount}"),
        (F.col("_b_sum") * F.col("_n")).alias(f"right_{amount}"),
    )
