"""Point-in-range join as one sorted sweep: rules and values in a common order, the last rule carried on.

Numbers may be of any width that compares, such as decimals of 38 digits: nothing is cut into bins, and
neither side is broadcast. Values and rules are dealt to pieces of the number line by approximate
quantiles of both together, so no piece holds much more than its share, and a value that many rows have is
dealt to as many pieces as it has quantiles. Within a piece a running window carries the last rule
on; across pieces one row a piece is carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.paths import written
from .ordered import fresh, sorted_rows
from .rows import column, row_hash

#: Pieces of the number line; also the most rows that a window or a broadcast over pieces has.
PIECES = 256


def _bounds(numbers: DataFrame, pieces: int) -> list:
    """Approximate quantiles of the column ``n``, in order and with repeats."""
    shares = [i / pieces for i in range(1, pieces)]
    found = numbers.agg(F.percentile_approx("n", shares, 10 * pieces).alias("q")).first()["q"]
    return sorted(found or [])


def _count_below(number: str, bounds: list, kind: str, strict: bool) -> Column:
    """How many bounds are below a column's number, or not above it, by halving."""
    def halve(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        bound = f"cast('{bounds[middle]}' as {kind})"
        return (f"case when {number} {'>' if strict else '>='} {bound} then {halve(middle + 1, high)} "
                f"else {halve(low, middle)} end")

    return F.expr(halve(0, len(bounds)))


def sweep_join(
    df: DataFrame, rules: DataFrame, value: Column, start: str = "start_num", end: str = "end_num",
    pieces: int = PIECES,
) -> DataFrame:
    """Every row of ``df`` once, with the columns of the rule whose range holds ``value``.

    Both range ends are inclusive and rules must not overlap. Rows without a rule, or without a
    value, get NULLs. Empty and reversed ranges hold nothing. The rules are read once.
    """
    kind = df.select(value.alias("n")).schema["n"].dataType.simpleString()
    wide = rules.schema[start].dataType.simpleString()
    if kind != wide:
        kind = rules.select(start).unionByName(df.select(value.alias(start))).schema[0].dataType.simpleString()
    held = written(rules.where(column(start) <= column(end)), "rules")
    rule = F.struct(*[column(c) for c in held.columns])
    starts = held.select(column(start).cast(kind).alias("n"))
    bounds = _bounds(starts.unionAll(df.select(value.cast(kind).alias("n"))), pieces)

    first = _count_below("_n", bounds, kind, strict=True)
    last = _count_below("_n", bounds, kind, strict=False)
    # A value on k equal bounds lies in any of the k + 1 pieces they part; a rule in the first of them.
    # Rows and where they come from decide, not their order, so a repeated task deals them alike.
    salt = F.col("_salt")
    spread = F.when(F.col("_n").isNull(), F.pmod(salt, F.lit(len(bounds) + 1))).otherwise(
        first + F.pmod(salt, last - first + 1)).cast("int")
    row = F.struct(*[column(c) for c in df.columns])
    ruled = held.select(column(start).cast(kind).alias("_n"), rule.alias("_rule")).select(
        first.alias("_piece"), "_n", F.lit(0).alias("_kind"), "_rule",
        F.lit(None).cast(df.select(row.alias("r")).schema["r"].dataType).alias("_row"))
    source = F.xxhash64(F.spark_partition_id(), row_hash(df)).alias("_salt")
    valued = df.select(value.cast(kind).alias("_n"), row.alias("_row"), source).select(
        spread.alias("_piece"), "_n", F.lit(1).alias("_kind"),
        F.lit(None).cast(ruled.schema["_rule"].dataType).alias("_rule"), "_row")

    so_far = (Window.partitionBy("_piece").orderBy("_n", "_kind")
              .rowsBetween(Window.unboundedPreceding, 0))
    swept = ruled.unionByName(valued).withColumn("_last", F.last("_rule", ignorenulls=True).over(so_far))

    # The last rule of each piece, at most one row a piece; a piece's carried rule is of those before it.
    before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    lasts = ruled.groupBy("_piece").agg(F.max_by("_rule", "_n").alias("_end"))
    every = df.sparkSession.range(len(bounds) + 1).select(F.col("id").cast("int").alias("_at"))
    carried = every.join(F.broadcast(lasts), F.col("_at") == F.col("_piece"), "left").select(
        "_at", F.last("_end", ignorenulls=True).over(before).alias("_before"))

    found = swept.where("_kind = 1").join(F.broadcast(carried), F.col("_piece") == F.col("_at"))
    found = found.withColumn("_last", F.coalesce("_last", "_before"))
    holds = F.col("_n") <= F.col(f"_last.`{end}`").cast(kind)
    return found.withColumn("_hit", F.when(holds, F.col("_last"))).select(
        *[F.col(f"_row.`{c}`").alias(c) for c in df.columns],
        *[F.col(f"_hit.`{c}`").alias(c) for c in rules.columns])


def with_previous(df: DataFrame, order: str, previous: dict[str, str]) -> DataFrame:
    """Every row with columns of the row before it in an order over all rows, NULL for the first.

    ``previous`` maps new columns to old ones. Rows are sorted over all partitions once; each partition
    is numbered where it lies, and what it needs of the ones before is their last row. Rows of equal
    order follow each other in the order they came.
    """
    part, at = fresh(df, "_part"), fresh(df, "_row")
    placed = sorted_rows(df, [order], part, at)
    before = Window.partitionBy(part).orderBy(at)
    marked = fresh(df, "_before")
    old = F.struct(*[column(o).alias(n) for n, o in previous.items()])
    rows = placed.withColumn(marked, F.lag(old).over(before))
    # One row a partition, the last; carried over partitions that hold nothing.
    ends = placed.groupBy(part).agg(F.max_by(old, at).alias("_end"))
    borders = ends.select(F.col(part).alias("_p"), F.lag("_end").over(Window.orderBy(part)).alias("_border"))
    joined = rows.join(F.broadcast(borders), F.col(part) == F.col("_p"))
    chosen = F.when(F.col(at) == 0, F.col("_border")).otherwise(F.col(marked))
    return joined.withColumn(marked, chosen).select(
        *[column(c) for c in df.columns], *[F.col(f"{marked}.`{n}`").alias(n) for n in previous])
