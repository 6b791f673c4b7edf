"""Row identity, precombine and latest-version operators. Pure DataFrame functions, no I/O."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import (
    COMMIT_TIME, DEFAULT_PARTITION, IDENTITY, META_COLS, OP, PARTITION_PATH, RECORD_KEY,
    TableSpec,
)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col(quoted(name))


def record_key(key: Column) -> Column:
    """The key as a string; a NULL or empty key fails the job."""
    text = key.cast("string")
    return F.when(
        text.isNull() | (text == ""), F.raise_error(F.lit("record key must not be NULL or empty"))
    ).otherwise(text)


def partition_path(partition: Column | None) -> Column:
    """The partition as a string, ``'default'`` where NULL or empty; ``''`` when there is none."""
    if partition is None:
        return F.lit("")
    text = partition.cast("string")
    return F.when(text.isNull() | (text == ""), F.lit(DEFAULT_PARTITION)).otherwise(text)


def with_identity(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the record key and partition path of ``spec`` to every row."""
    partition = None if spec.partition is None else column(spec.partition)
    return df.withColumns(
        {RECORD_KEY: record_key(column(spec.key)), PARTITION_PATH: partition_path(partition)}
    )


def drop_meta(df: DataFrame) -> DataFrame:
    """The user's columns only; bookkeeping columns are matched by exact name."""
    return df.drop(*META_COLS)


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return False


def row_hash(df: DataFrame) -> Column:
    """Hash over all columns: the last tie-break, so equal precombine values stay repeatable."""
    parts = []
    for field in df.schema.fields:
        value = column(field.name)
        if isinstance(field.dataType, T.VariantType) or _has_map(field.dataType):
            value = F.to_json(F.struct(value))
        parts.append(value)
    return F.xxhash64(*parts)


def first_per_identity(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The first row of every identity in the given order.

    ``row_number() = 1`` lets Spark keep one row per identity and task *before* the shuffle
    (partial ``WindowGroupLimit``), so an identity holding a third of the input crosses the
    network as at most one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*IDENTITY).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedupe(df: DataFrame, precombine: str, first: Sequence[Column] = ()) -> DataFrame:
    """One row per identity within one write: the largest precombine value wins.

    ``first`` holds orderings that go before the precombine value. NULL loses against any
    value; ties are broken by a hash of the row.
    """
    order = [*first, column(precombine).desc_nulls_last(), row_hash(df).asc()]
    return first_per_identity(df, order)


def latest(df: DataFrame) -> DataFrame:
    """The newest version of every identity among several commits, tombstones included."""
    return first_per_identity(df, [F.col(COMMIT_TIME).desc()])


def live(df: DataFrame) -> DataFrame:
    """Rows that are not tombstones."""
    return df.where(F.col(OP) == "U").drop(OP)


def reconcile(base: DataFrame, changes: DataFrame, changed_keys: DataFrame) -> DataFrame:
    """Live rows of a base under later changes, both with one row per identity.

    A base row survives unless its identity was changed later. The base is never sorted or grouped: with few changed keys it is only probed against a
    broadcast hash table, however large it is.
    """
    kept = base.join(changed_keys, list(IDENTITY), "left_anti")
    return live(kept.select(base.columns).unionByName(changes.select(base.columns)))


def semi_join(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose identity is among ``keys``, with their columns in place."""
    return rows.join(keys, list(IDENTITY), "left_semi").select(rows.columns)


def key_pairs(df: DataFrame, key: Column, partition: Column | None) -> DataFrame:
    """The (record key, partition path) pair of every row; NULL or empty keys can match no row."""
    text = key.cast("string")
    return df.select(text.alias(RECORD_KEY), partition_path(partition).alias(PARTITION_PATH)).where(
        F.col(RECORD_KEY).isNotNull() & (F.col(RECORD_KEY) != ""))


def distinct_keys(df: DataFrame, key: Column, partition: Column | None) -> DataFrame:
    """Distinct (record key, partition path) pairs; NULL or empty keys can match no row."""
    return key_pairs(df, key, partition).distinct()
