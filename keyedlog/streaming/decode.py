"""Decoding of keyed messages. Stateless, and the same for streams and batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_messages(
    df: DataFrame, schema: T.StructType | str, value_format: str = "json",
    options: Mapping[str, str] | None = None, header_bytes: int = 0,
) -> DataFrame:
    """Key as text, and the fields of the value as columns; malformed JSON gives NULLs.

    ``schema`` describes the value and is fixed before a stream starts. For ``value_format``
    ``"avro"`` it is an Avro schema in JSON, and Spark's Avro module must be on the class path;
    a value that does not fit it fails the query unless ``options`` say otherwise.
    ``options`` are those of Spark's reader of the format. ``header_bytes`` are skipped before the
    value, such as the 5 bytes by which schema registries name a schema.
    """
    body = F.col("value")
    if header_bytes:
        body = F.substring(body, header_bytes + 1, 2**31 - 1 - header_bytes)
    if value_format == "json":
        value = F.from_json(body.cast("string"), schema, dict(options or {}))
    elif value_format == "avro":
        from pyspark.sql.avro.functions import from_avro

        value = from_avro(body, schema, dict(options or {}))
    else:
        raise ValueError(f"unknown value format {value_format}")
    return df.select(F.col("key").cast("string").alias("key"), value.alias("value")).select(
        "key", "value.*"
    )
