import pytest
from pyspark.sql import functions as F

from keyedlog import KeyedTable, TableSpec
from keyedlog.operators.rows import drop_meta
from keyedlog.sources.messages import read_message_files, read_topic
from keyedlog.streaming.decode import decode_messages
from keyedlog.streaming.write import STREAM_APP, start_append, start_upsert, upsert_batch

NOW = {"availableNow": True}
VALUE = "k string, ts bigint, v bigint"


def send(spark, path, rows):
    df = spark.createDataFrame(rows, "key string, value string")
    df.select(F.col("key").cast("binary"), F.col("value").cast("binary")).write.mode("append").parquet(path)


def message(k, ts, v):
    return (k, f'{{"k": "{k}", "ts": {ts}, "v": {v}}}')


def test_decode_a_batch(spark):
    df = spark.createDataFrame([message("a", 1, 2), ("b", "{oops"), ("c", None)], "key string, value string")
    found = decode_messages(df.select(F.col("key").cast("binary"), F.col("value").cast("binary")), VALUE)
    assert found.columns == ["key", "k", "ts", "v"]
    assert sorted(map(tuple, found.collect())) == [("a", "a", 1, 2), ("b", None, None, None), ("c", None, None, None)]
    with pytest.raises(ValueError, match="unknown value format"):
        decode_messages(df, VALUE, "xml")


def test_a_stream_resumes_and_upserts(spark, tmp_path):
    inbox, checkpoint = str(tmp_path / "inbox"), str(tmp_path / "checkpoint")
    spec = TableSpec("t", str(tmp_path / "t"), "k", "ts")

    def run():
        decoded = decode_messages(read_message_files(spark, inbox), VALUE)
        start_upsert(decoded, spec, "inbox", checkpoint, NOW).awaitTermination()

    send(spark, inbox, [message("a", 1, 1), message("b", 1, 2), message("a", 2, 3)])
    run()
    send(spark, inbox, [message("b", 9, 9)])
    run()
    run()
    table = KeyedTable(spark, spec)
    found = drop_meta(table.snapshot()).orderBy("k").collect()
    assert [(r["k"], r["v"]) for r in found] == [("a", 3), ("b", 9)]
    assert len(table.timeline().commits) == 2 and table.offsets(STREAM_APP) == {"inbox": "1"}


def test_a_repeated_batch_is_skipped(make_table, frame):
    t = make_table()
    assert upsert_batch(frame([("a", "x", 1, 1)]), t.spec, 0, "s")
    assert upsert_batch(frame([("a", "x", 2, 2)]), t.spec, 1, "s")
    assert not upsert_batch(frame([("a", "x", 1, 1)]), t.spec, 1, "s")
    assert not upsert_batch(frame([("a", "x", 1, 1)]), t.spec, 0, "s")
    assert upsert_batch(frame([("b", "x", 1, 5)]), t.spec, 0, "another stream")
    assert sorted(r["v"] for r in t.snapshot().collect()) == [2, 5]


def test_append_to_any_sink(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    send(spark, inbox, [message("a", 1, 1)])
    decoded = decode_messages(read_message_files(spark, inbox, maxFilesPerTrigger="1"), VALUE)
    query = start_append(decoded, "console", str(tmp_path / "c"), trigger=NOW, truncate="false")
    query.awaitTermination()
    assert query.exception() is None


def test_a_checkpoint_is_needed(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    send(spark, inbox, [message("a", 1, 1)])
    with pytest.raises(ValueError, match="checkpoint"):
        start_append(read_message_files(spark, inbox), "console", "", trigger=NOW)


def test_missing_connectors_are_named_by_spark(spark):
    with pytest.raises(Exception, match="kafka"):
        read_topic(spark, "localhost:9092", "topic")


def test_a_header_before_the_value_is_skipped(spark):
    df = spark.createDataFrame([message("a", 1, 2)], "key string, value string").select(
        F.col("key").cast("binary"),
        F.concat(F.lit(b"\x00\x00\x00\x00\x07"), F.col("value").cast("binary")).alias("value"))
    found = decode_messages(df, VALUE, header_bytes=5).collect()
    assert [tuple(r) for r in found] == [("a", "a", 1, 2)]


def test_the_default_trigger_runs_every_six_seconds(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    send(spark, inbox, [message("a", 1, 1)])
    spec = TableSpec("t", str(tmp_path / "t"), "k", "ts")
    decoded = decode_messages(read_message_files(spark, inbox), VALUE)
    query = start_upsert(decoded, spec, "inbox", str(tmp_path / "c"))
    try:
        query.processAllAvailable()
        send(spark, inbox, [message("b", 1, 2)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert query.exception() is None
    assert sorted(r["k"] for r in KeyedTable(spark, spec).snapshot().collect()) == ["a", "b"]
