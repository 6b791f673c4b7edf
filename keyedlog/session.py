"""Spark settings for a given amount of data."""

from __future__ import annotations

_MB = 1024 * 1024
#: Shuffle data per task before adaptive execution merges or splits partitions.
TASK_BYTES = 128 * _MB


def scale_conf(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for jobs that shuffle up to ``shuffle_bytes`` on ``cores`` cores.

    Adaptive execution merges small partitions and splits skewed ones, but it cannot split the
    input of a window, so the number of partitions to start from must suit the data.
    """
    partitions = max(2 * cores, -(-shuffle_bytes // TASK_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(2 * TASK_BYTES),
        "spark.sql.session.timeZone": "UTC",
    }
