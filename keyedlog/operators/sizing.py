"""Broadcast decisions that rest on a measured or recorded size, never on a guess."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import column

#: Largest side that is broadcast, in bytes of its values and in rows. Beyond either limit the
#: join is left to a shuffle, where adaptive execution splits skewed partitions.
BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 2_000_000


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    @property
    def broadcastable(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.bytes <= BROADCAST_BYTES

    def __add__(self, other: "Size") -> "Size":
        return Size(self.rows + other.rows, self.bytes + other.bytes)


def value_bytes(df: DataFrame):
    """Bytes of one row: text length of strings, eight bytes for anything else."""
    total = F.lit(0).cast("bigint")
    for name, dtype in df.dtypes:
        size = F.octet_length(column(name)) if dtype == "string" else F.lit(8)
        total = total + F.coalesce(size, F.lit(0))
    return total


def stored_bytes(df: DataFrame):
    """Bytes of one row's values as they would be stored plainly, whatever their types."""
    total = F.lit(0).cast("bigint")
    for name, dtype in df.dtypes:
        if dtype in ("string", "binary"):
            size = F.octet_length(column(name))
        elif dtype.startswith(("array", "map", "struct", "variant")):
            size = F.octet_length(F.to_json(F.struct(column(name))))
        elif dtype.startswith("decimal"):
            size = F.lit(16)
        else:
            size = F.lit(8)
        total = total + 4 + F.coalesce(size, F.lit(0))
    return total


def rows_within(df: DataFrame, file_bytes: int) -> int:
    """How many rows a file of so many bytes may hold, by the width that 99 of 100 rows do not exceed.

    Measured in one distributed aggregate, before compression, so files come out smaller.
    """
    if file_bytes < 1:
        raise ValueError("a file has at least one byte")
    width = df.agg(F.percentile_approx(stored_bytes(df), 0.99, 1000)).first()[0] or 1
    # What describes a file: statistics with the ends of every column, and names and offsets.
    described = 4 * width + 400 * len(df.columns)
    return max(1, (file_bytes - described) // width)


def measure(df: DataFrame) -> Size:
    """Rows and bytes of ``df``, in one distributed aggregate."""
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(value_bytes(df)).alias("b")).first()
    return Size(found["n"], found["b"] or 0)


def broadcast_within(df: DataFrame, size: Size) -> DataFrame:
    """``df`` marked for broadcast when ``size`` is within the limits, else unchanged."""
    return F.broadcast(df) if size.broadcastable else df
