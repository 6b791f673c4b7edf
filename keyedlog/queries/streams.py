"""Message streams, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import KeyedTable, TableSpec
from ..operators.rows import drop_meta
from ..sources.messages import read_message_files
from ..sources.paths import scratch_path
from ..streaming.decode import decode_messages
from ..streaming.write import start_append, start_upsert
from .fixtures import table

_VALUE = "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz, value double"
_FORMAT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_ALL = {"availableNow": True}


def _messages(events):
    value = F.to_json(F.struct("event_id", "user_id", "event_type", "ts", "value"), _FORMAT)
    return events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
    )


def stream_decode(spark, sf_dir):
    inbox, out, checkpoint = (scratch_path(spark, n) for n in ("inbox", "decoded", "checkpoint"))
    _messages(table(spark, sf_dir, "events")).write.parquet(inbox)
    decoded = decode_messages(read_message_files(spark, inbox), _VALUE, options=_FORMAT)
    start_append(decoded, "parquet", checkpoint, out, _ALL).awaitTermination()
    return spark.read.schema(decoded.schema).parquet(out)


def stream_upsert(spark, sf_dir):
    """All events, then the errors again at twice the value; the stream resumes in between."""
    inbox, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "checkpoint")
    spec = TableSpec("event", scratch_path(spark, "event"), "key", "ts", "event_type")
    events = table(spark, sf_dir, "events")
    again = events.where("event_type = 'error'").withColumn("value", F.col("value") * 2)
    for batch in (events, again):
        _messages(batch).write.mode("append").parquet(inbox)
        decoded = decode_messages(read_message_files(spark, inbox), _VALUE, options=_FORMAT)
        start_upsert(decoded, spec, "inbox", checkpoint, _ALL).awaitTermination()
    return drop_meta(KeyedTable(spark, spec).snapshot())


QUERIES = {"stream_decode": stream_decode, "stream_upsert": stream_upsert}

_EVENT = "cast(event_id as varchar) as key, event_id, user_id, event_type, ts"

ORACLE = {
    "stream_decode": f"select {_EVENT}, value from events",
    "stream_upsert": f"""select {_EVENT},
  case when event_type = 'error' then value * 2 else value end as value from events""",
}
