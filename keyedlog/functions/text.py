"""Small text predicates and JSON columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.paths import scratch_path


def is_blank(text: Column) -> Column:
    """NULL or empty. Spaces count as content."""
    return text.isNull() | (F.length(text) == 0)


def is_not_blank(text: Column) -> Column:
    return ~is_blank(text)


def parse_json(df: DataFrame, text: str, schema: str | T.StructType) -> DataFrame:
    """The fields of a JSON column beside the other columns; malformed text gives NULLs."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.from_json(text, schema).alias("_json")).select(*others, "_json.*")


def infer_json_schema(df: DataFrame, text: str) -> T.StructType:
    """Schema of the JSON objects in a column, as Spark's reader of JSON files infers it.

    The texts are written once as lines to a shared folder and read by that reader, so a column and
    a file with the same objects have the same types. Malformed text is skipped.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "json")
    line = F.regexp_replace(F.col(text).cast("string"), r"[\r\n]+", " ")
    df.select(line.alias("value")).where("value is not null").write.text(path)
    corrupt = spark.conf.get("spark.sql.columnNameOfCorruptRecord")
    found = spark.read.json(path).schema
    fields = [f for f in found.fields if f.name != corrupt]
    if not fields:
        raise ValueError(f"column {text} holds no JSON objects")
    return T.StructType(fields)
