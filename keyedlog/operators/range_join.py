"""Point-in-range join: at most one rule per value, both range ends inclusive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import column
from .sizing import Size, value_bytes
from .sweep_join import sweep_join, with_previous

#: Width of a bin; all of IPv4 has 65,536 of them, so non-overlapping IPv4 rules give at most
#: 65,536 rows more than there are rules.
BIN_WIDTH = 1 << 16
#: Bins of the widest rule: those of all IPv4 numbers.
MOST_BINS = 1 << 16

_BIN = "_bin"


def bin_of(value: Column, width: int) -> Column:
    """First value of the bin, in whole numbers."""
    return value - F.pmod(value, F.lit(width).cast("bigint"))


def binned_rules(rules: DataFrame, start: str, end: str, width: int = BIN_WIDTH) -> DataFrame:
    """One row per rule and bin it touches; a rule of more than ``MOST_BINS`` bins is refused."""
    low, high = column(start), column(end)
    bins = F.sequence(bin_of(low, width), bin_of(high, width), F.lit(width).cast("bigint"))
    wide = F.concat(F.lit("too many bins for the rule from "), low, F.lit(" to "), high)
    bins = F.when((high - low) / width > MOST_BINS, F.raise_error(wide)).otherwise(bins)
    return rules.where(low <= high).withColumn(_BIN, F.explode(bins))


def overlapping_rules(
    rules: DataFrame, start: str, end: str, width: int = BIN_WIDTH
) -> DataFrame:
    """Rules that share a value with a later-starting rule.

    Two overlapping rules meet in some bin, so looking inside every bin is enough and no task
    sees more than the rules of its bins.
    """
    window = Window.partitionBy(_BIN).orderBy(start, end)
    next_start = F.lead(start).over(window)
    found = binned_rules(rules, start, end, width).withColumn("_next", next_start)
    return found.where(F.col("_next") <= column(end)).select(rules.columns).distinct()


def check_rules(rules: DataFrame, start: str, end: str) -> None:
    """Fail if two rules overlap, since a value in both would have no single answer.

    Rules that follow each other in order without overlap never do, so each is compared with the one
    before it.
    """
    held = rules.where(column(start) <= column(end))
    found = with_previous(held, start, {"_before": end}).where(F.col("_before") >= column(start)).drop(
        "_before").first()
    if found is not None:
        raise ValueError(f"rules overlap, for example {found.asDict()}")


def range_join(
    df: DataFrame,
    rules: DataFrame,
    value: Column,
    start: str = "start_num",
    end: str = "end_num",
    width: int = BIN_WIDTH,
) -> DataFrame:
    """Every row of ``df`` once, with the columns of the rule whose range holds ``value``.

    Rules must not overlap (``check_rules``). Rows without a rule get NULLs. Rules of few enough bins
    are binned and broadcast, and the bin is an equality that Spark hashes. Otherwise rules and
    rows are swept in a common order (``sweep_join``), whatever the width of the numbers.
    """
    low, high = column(start), column(end)
    if rules.schema[start].dataType.simpleString().startswith("decimal"):
        return sweep_join(df, rules, value, start, end)
    size = rules.where(low <= high).agg(
        F.sum(F.ceil((high - low) / width) + 1).alias("rows"),
        F.sum((F.ceil((high - low) / width) + 1) * value_bytes(rules)).alias("bytes")).first()
    size = Size(int(size["rows"] or 0), int(size["bytes"] or 0))
    if not size.broadcastable:
        return sweep_join(df, rules, value, start, end)
    sized = F.broadcast(binned_rules(rules, start, end, width))
    number = df.withColumn("_value", value).withColumn(_BIN, bin_of(F.col("_value"), width))
    left, right = number.alias("_left"), sized.alias("_right")
    condition = (
        (F.col(f"_left.{_BIN}") == F.col(f"_right.{_BIN}"))
        & F.col("_left._value").between(F.col(f"_right.{start}"), F.col(f"_right.{end}"))
    )
    joined = left.join(right, condition, "left")
    return joined.select(
        *[F.col(f"_left.`{c}`") for c in df.columns],
        *[F.col(f"_right.`{c}`") for c in rules.columns],
    )
