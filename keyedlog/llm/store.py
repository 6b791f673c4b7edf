"""Tables that a job keeps on the way, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.paths import scratch_path


#: Spark's setting by which a query's shuffle files go when it ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table once and go on from its files, which outlive the executors that made them.

    What was shuffled for it goes with the write, so disk holds the shuffles of one table at a time.
    """
    conf, path = df.sparkSession.conf, scratch_path(df.sparkSession, name)
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
