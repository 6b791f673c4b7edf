"""Paths on whatever file system Spark is set up for."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; none if there is no such folder."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition directories ``column=value`` in a folder just written."""
    system, place = _place(spark, path)
    names = [status.getPath().getName() for status in system.listStatus(place)]
    prefix = f"{column}="
    return sorted(unquote(n[len(prefix):]) for n in names if n.startswith(prefix))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name for tables a job writes on the way.

    It lies in the shared folder of ``spark.checkpoint.dir``, or else in the warehouse, which every
    session has.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/keyedlog/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a scratch folder and read from there.

    Its files outlive the executors that made them, and row numbers stay as they were written.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
