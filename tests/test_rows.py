import random

import pytest
from pyspark.sql import functions as F

from keyedlog import TableSpec
from keyedlog.operators import sizing
from keyedlog.operators.rows import dedupe, distinct_keys, drop_meta, with_identity

SPEC = TableSpec("t", "-", "k", "ts", "p")


def test_identity_is_text_and_blank_partitions_share_a_default(frame):
    rows = with_identity(frame([("a", "x", 1, 1), ("b", None, 1, 1), ("c", "", 1, 1)]), SPEC)
    found = {(r["_record_key"], r["_partition_path"], r["p"]) for r in rows.collect()}
    assert found == {("a", "x", "x"), ("b", "default", None), ("c", "default", "")}


def test_numbers_become_text_keys(spark):
    rows = with_identity(spark.range(3).selectExpr("id k", "id p"), SPEC)
    assert dict(rows.dtypes)["_record_key"] == "string"
    assert {r["_partition_path"] for r in rows.collect()} == {"0", "1", "2"}


@pytest.mark.parametrize("key", [None, ""])
def test_a_null_or_empty_key_fails_the_write(frame, key):
    with pytest.raises(Exception, match="record key must not be NULL or empty"):
        with_identity(frame([(key, "x", 1, 1)]), SPEC).collect()


def test_largest_precombine_wins_and_null_loses(frame):
    rows = [("a", "x", 1, 10), ("a", "x", 3, 30), ("a", "x", None, 99), ("a", "y", 0, 40)]
    found = dedupe(with_identity(frame(rows), SPEC), "ts").collect()
    assert {(r["k"], r["p"], r["v"]) for r in found} == {("a", "x", 30), ("a", "y", 40)}


def test_ties_are_broken_the_same_way_in_any_order(frame):
    rows = [("a", "x", 1, v) for v in range(50)]
    answers = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = frame(rows).repartition(seed + 1)
        answers.add(dedupe(with_identity(df, SPEC), "ts").first()["v"])
    assert len(answers) == 1


def test_dedupe_takes_maps_and_nested_maps(spark):
    df = spark.range(4).select(
        F.lit("a").alias("k"), F.lit("x").alias("p"), F.col("id").alias("ts"),
        F.create_map(F.lit("m"), "id").alias("m"),
        F.array(F.struct(F.create_map(F.lit("n"), "id").alias("n"))).alias("nested"),
    )
    assert dedupe(with_identity(df, SPEC), "ts").first()["m"] == {"m": 3}


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 'hot', string(id)) k", "'x' p", "id ts")
    plan = dedupe(with_identity(df, SPEC), "ts")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_distinct_keys_leave_out_keys_that_match_nothing(frame):
    df = frame([("a", "x", 1, 1), ("a", "x", 2, 2), (None, "x", 3, 3), ("", "x", 4, 4), ("a", "", 5, 5)])
    pairs = distinct_keys(df, F.col("k"), F.col("p")).collect()
    assert {tuple(r) for r in pairs} == {("a", "x"), ("a", "default")}


def test_only_exact_bookkeeping_names_are_dropped(spark):
    df = spark.range(1).selectExpr("id my_commit_time", "id _commit_time", "id x_record_key")
    assert drop_meta(df).columns == ["my_commit_time", "x_record_key"]


def test_measure_counts_rows_and_bytes(frame):
    size = sizing.measure(frame([("ab", None, 1, 1), ("日", "x", 1, 1)]))
    assert size.rows == 2 and size.bytes == (2 + 0 + 16) + (3 + 1 + 16)


def test_broadcast_only_within_the_limits(frame):
    def hinted(rows, size):
        df = sizing.broadcast_within(rows, size)
        return "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()

    rows = frame([("a", "x", 1, 1)])
    assert hinted(rows, sizing.Size(1, 1))
    assert not hinted(rows, sizing.Size(sizing.BROADCAST_ROWS + 1, 1))
    assert not hinted(rows, sizing.Size(1, sizing.BROADCAST_BYTES + 1))
