"""Sinks of a message stream. Every stream needs a checkpoint, so it resumes where it stopped."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ..plans.table import KeyedTable
from ..spec import TableSpec

DEFAULT_TRIGGER: Mapping[str, object] = {"processingTime": "6 seconds"}

#: Application name under which a table keeps the last batch of each stream.
STREAM_APP = "_stream"


def _writer(df: DataFrame, checkpoint: str, trigger: Mapping[str, object] | None) -> DataStreamWriter:
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint location")
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or DEFAULT_TRIGGER))


def start_append(
    df: DataFrame, format: str, checkpoint: str, path: str | None = None,
    trigger: Mapping[str, object] | None = None, **options: str,
) -> StreamingQuery:
    """Append a stream to any sink Spark has, such as ``console`` or ``parquet``."""
    return _writer(df, checkpoint, trigger).format(format).options(**options).start(path)


def upsert_batch(df: DataFrame, spec: TableSpec, batch_id: int, stream: str) -> bool:
    """Upsert one micro-batch unless the table already has it; says whether it was written.

    Spark may hand out a batch again after a failure. The batch number is committed together
    with the rows, so a repeated batch is recognised and skipped. Only the last commit record is read,
    and another writer that commits meanwhile makes this one fail.
    """
    table = KeyedTable(df.sparkSession, spec)
    head = table.head()
    done = head.offsets.get(STREAM_APP, {}).get(stream) if head else None
    if done is not None and batch_id <= int(done):
        return False
    table.upsert(df, offsets={stream: str(batch_id)}, app=STREAM_APP, after=head)
    return True


def start_upsert(
    df: DataFrame, spec: TableSpec, stream: str, checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Upsert a stream into a keyed table. ``stream`` names it within the table's offsets.

    The checkpoint and the name belong together: a new checkpoint numbers its batches from
    zero, so it needs a new name.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, spec, batch_id, stream)

    return _writer(df, checkpoint, trigger).foreachBatch(write).start()
