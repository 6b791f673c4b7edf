"""Weighted rendezvous hashing of record keys over shards, in DataFrame functions only.

Every key draws a number u between 0 and 1 for every shard, from 52 bits of an MD5 of key and shard,
and goes to the shard with the largest -weight / ln(u). A shard's expected share is its weight's. A
draw knows nothing of the other shards, so a new shard takes rows only into itself, a removed one
gives away only its own, and a heavier one only gains. The law is ``key``: the key and the shards decide,
neither sizes nor other rows do, so rows with equal texts but different keys part.

Within a shard rows have slots 0, 1, 2 and so on, by an order the caller names, without a window over
a whole shard: rows are sorted over all partitions once and numbered there.

Null keys are a key like others (their rows share a shard, as do rows that repeat a key), an empty
table stays empty, and texts play no part in ``assign``. Rows equal in all of a slot order get slots in
no fixed order among each other. A column that has the name of a new one is replaced, others pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import with_places
from .digests import CRC_TABLE_SQL, crc32_sql, fields

#: Hex digits of a draw, 52 bits: with half a step added they are exact in a double.
DIGITS = 13


def _score(key: Column, shard: int, weight: float) -> Column:
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"#{shard}"))), 1, DIGITS), 16, 10)
    drawn = (bits.cast("double") + 0.5) / float(16 ** DIGITS)
    return F.lit(-float(weight)) / F.log(drawn)


def shard_of(keys: Sequence[Column], weights: Sequence[float]) -> Column:
    """The number of a record's shard; shard i has the i-th weight, and none if that is 0."""
    if not any(w > 0 for w in weights):
        raise ValueError("no shard has a weight")
    if any(w < 0 or not math.isfinite(w) for w in weights):
        raise ValueError(f"weights must be finite and not negative: {list(weights)}")
    key = F.concat(fields(keys), F.lit(""))
    drawn = [F.struct(_score(key, i, w).alias("score"), F.lit(-i).alias("shard"))
             for i, w in enumerate(weights) if w > 0]
    best = F.greatest(*drawn) if len(drawn) > 1 else drawn[0]
    return -best["shard"]


def assign(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float], name: str = "shard"
) -> DataFrame:
    """Every row with the shard of its key columns."""
    return df.withColumn(name, shard_of([F.col(f"`{k}`") for k in keys], weights))


def with_slots(df: DataFrame, order: Sequence[str], shard: str = "shard") -> DataFrame:
    """Every row with its ``slot`` in its shard, gapless from 0, by the given columns."""
    rows = "_shard_rows"
    return with_places(df, [shard], order, "slot", rows).drop(rows)


def write_shards(df: DataFrame, path: str, shard: str = "shard", file_rows: int = 0) -> None:
    """Rows as Parquet in one folder a shard, with at most ``file_rows`` rows a file if given.

    Rows are dealt by shard first, and a shard that fills several partitions is written by as many
    tasks.
    """
    writer = df.hint("rebalance", F.col(shard)).write
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    writer.partitionBy(shard).parquet(path)


#: The query's shards, all of one weight, and one more for ``grown_shard``.
SHARDS = 16


def documents_in_shards(documents: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = documents.select(
        "doc_id", (F.octet_length(data) + 1).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"), F.lit("key").alias("law"))
    rows = assign(rows, ["doc_id"], [1.0] * SHARDS)
    rows = with_slots(rows, ["doc_id", "size", "text_crc32"])
    return assign(rows, ["doc_id"], [1.0] * (SHARDS + 1), "grown_shard")


SQL = f"""
with {CRC_TABLE_SQL},
docs as (
  select doc_id, coalesce(text, '') as t,
    coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') as key,
    row_number() over () as r from documents),
draws as (
  select d.*, s.shard, -1.0 / ln((cast('0x' || substr(md5(key || '#' || s.shard), 1, {DIGITS}) as bigint)
    + 0.5) / {16 ** DIGITS}) as score from docs d, range({SHARDS + 1}) s(shard)),
chosen as (
  select any_value(doc_id) as doc_id, any_value(t) as t,
    arg_max(shard, struct_pack(a := score, b := -shard)) filter (shard < {SHARDS}) as shard,
    arg_max(shard, struct_pack(a := score, b := -shard)) as grown
  from draws group by r),
rows as (
  select doc_id, cast(strlen(t) + 1 as bigint) as size, {crc32_sql("t")} as text_crc32, shard, grown
  from chosen, crc_table)
select doc_id, size, cast(text_crc32 as bigint) as text_crc32, 'key' as law, cast(shard as integer) as shard,
  row_number() over (partition by shard order by doc_id nulls first, size, text_crc32) - 1 as slot,
  cast(grown as integer) as grown_shard
from rows
"""
