"""Places in an order over all rows, without a window that one task would have to run alone.

Rows are sorted over all partitions once and numbered where they lie; what a partition needs to know
of the ones before it is a row or two, so only these are brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.paths import written
from .sizing import broadcast_within, measure

#: Bits of ``monotonically_increasing_id`` that number the rows of one partition.
ROW_BITS = 33

#: Rows of each partition that Spark looks at to deal a sort out evenly, its own 100 being too few for four
#: partitions; it never takes more than a million in all.
SAMPLED = 400
_SAMPLED = "spark.sql.execution.rangeExchange.sampleSizePerPartition"


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table does not have; case does not count."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sorted_rows(df: DataFrame, order: Sequence[Column | str], part: str, row: str) -> DataFrame:
    """The rows sorted over all partitions and written, each with its partition and row number.

    Equal rows are told apart by where they come from, so a value that many rows share is dealt to
    as many partitions as its share asks for.
    """
    tie = fresh(df, "_tie")
    at = fresh(df, "_at")
    ranged = df.withColumn(tie, F.monotonically_increasing_id()).orderBy(*order, tie).drop(tie)
    conf = df.sparkSession.conf
    before = conf.get(_SAMPLED, None)
    conf.set(_SAMPLED, str(SAMPLED))
    try:
        placed = written(ranged.withColumn(at, F.monotonically_increasing_id()), "sorted")
    finally:
        conf.unset(_SAMPLED) if before is None else conf.set(_SAMPLED, before)
    return placed.select(
        *[c for c in placed.columns if c != at],
        F.shiftright(at, ROW_BITS).alias(part),
        F.col(at).bitwiseAND((1 << ROW_BITS) - 1).alias(row))


def with_places(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
    place: str = "place", rows: str = "rows",
) -> DataFrame:
    """Every row with its place in its group, from 0 and without gaps, and the group's row count.

    NULL groups are groups; NULLs come first in an order. A group is spread over as many partitions
    as its rows fill. Brought together is one row per partition and group in it, no more than there
    are partitions and groups. New columns replace others of their names.
    """
    df = df.select(*[c for c in df.columns if c.lower() not in (place.lower(), rows.lower())])
    part, row = fresh(df, "_part"), fresh(df, "_row")
    sorted_ = sorted_rows(df, [*group, *order], part, row)
    pieces = sorted_.groupBy(part, *group).agg(
        F.min(row).alias("_first"), F.count("*").alias("_count"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    names = [f"_g{i}" for i in range(len(group))]
    offsets = written(pieces.select(
        F.col(part).alias("_p"), *[F.col(g).alias(n) for g, n in zip(group, names)],
        (F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
        F.sum("_count").over(whole).alias("_total")), "offsets")
    offsets = broadcast_within(offsets, measure(offsets)).alias("_o")
    same = F.col(f"_s.{part}") == F.col("_o._p")
    for g, n in zip(group, names):
        same = same & F.col(f"_s.{g}").eqNullSafe(F.col(f"_o.{n}"))
    return sorted_.alias("_s").join(offsets, same).select(
        *[F.col(f"_s.`{c}`") for c in df.columns],
        (F.col(f"_s.{row}") + F.col("_o._offset")).alias(place),
        F.col("_o._total").alias(rows))
