"""Record fields as text that no two records share by accident, and digests of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(value: Column) -> Column:
    """A value as its length in UTF-8 bytes, a colon and itself; ``-`` if it is null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def fields(values: Sequence[Column]) -> Column:
    """Several values one after the other; different lists give different texts."""
    return F.concat(*map(field, values))


def digest(*texts: Column) -> Column:
    """Lowercase hex SHA-256 of texts one after the other."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


#: SQL for crc32, which DuckDB lacks: a table of the 256 bytes' remainders by the reversed polynomial.
CRC_TABLE_SQL = """crc_table as (
  select list(list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), i) order by i) as tab
  from range(256) bytes(i))"""


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of a text, for queries that join ``crc_table``."""
    data = f"regexp_extract_all(hex(encode({text})), '..')"
    step = "xor(a >> 8, tab[(xor(a, b) & 255) + 1])"
    numbers = f"list_transform({data}, lambda x: cast('0x' || x as bigint))"
    return f"xor(list_reduce({numbers}, lambda a, b: {step}, 4294967295), 4294967295)"
