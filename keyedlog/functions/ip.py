"""IPv4 text as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The pattern of a valid address, and the text that stands for an unknown place.
IPV4_PATTERN = (
    r"([1-9]|[1-9]\d|1\d{2}|2[0-4]\d|25[0-5])"
    r"(\.(\d|[1-9]\d|1\d{2}|2[0-4]\d|25[0-5])){3}"
)
UNKNOWN = "未知"


def ip_to_long(ip: Column) -> Column:
    """Number of a dotted address, each part shifted in as a byte; NULL for other text.

    Dots at the end are ignored, and parts are not checked to be below 256.
    """
    # An escaped dot splits several times faster than "[.]": it needs no regular expression.
    parts = F.transform(
        F.split(F.rtrim(ip, F.lit(".")), r"\."), lambda part: part.try_cast("bigint")
    )
    number = F.aggregate(
        parts, F.lit(0).cast("bigint"), lambda total, part: F.shiftleft(total, 8).bitwiseOR(part)
    )
    return F.when(ip.rlike(r"\A[0-9.]+\z"), number)


def long_to_ip(number: Column) -> Column:
    """Dotted address of a number from 0 to 2^32 - 1."""
    parts = [
        F.shiftright(number, bits).bitwiseAND(255).cast("string") for bits in (24, 16, 8, 0)
    ]
    return F.concat_ws(".", *parts)


def ip_valid(ip: Column) -> Column:
    """Whether the whole text is a valid address; NULL stays NULL."""
    return ip.rlike(rf"\A{IPV4_PATTERN}\z")
