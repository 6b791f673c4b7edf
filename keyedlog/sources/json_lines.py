"""JSON records as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import infer_json_schema


def read_json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Files with one JSON object per line. Without a schema Spark infers one by reading all."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def json_records(df: DataFrame, text: str, schema: str | None = None) -> DataFrame:
    """The objects in a text column as rows. Without a schema it is inferred from all rows."""
    found = schema or infer_json_schema(df, text)
    return df.select(F.from_json(text, found).alias("_json")).select("_json.*")


def json_strings(spark: SparkSession, lines: Sequence[str], schema: str | None = None) -> DataFrame:
    """A short list of JSON texts as rows."""
    return json_records(spark.createDataFrame([(s,) for s in lines], "value string"), "value", schema)
