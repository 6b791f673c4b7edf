"""What Spark plans for reads and merges: pruning, pushdown, and no join over all pairs."""

import pytest
from pyspark.sql import functions as F

from keyedlog import Merge
from keyedlog.operators import sizing
from keyedlog.operators.range_join import range_join
from keyedlog.sources.rules import RULE_SCHEMA


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def kept(make_table, spark):
    t = make_table(partition="p")
    rows = spark.range(100).selectExpr("string(id) k", "concat('p', id % 4) p", "id ts", "id v")
    t.upsert(rows)
    return t, rows


def test_a_single_batch_is_scanned_without_shuffle_or_sort(kept):
    table, _ = kept
    text = plan(table.snapshot().where("v > 50").select("v"))
    assert "Exchange" not in text and "Sort" not in text and "Window" not in text
    assert "GreaterThan(v,50)" in text and "ReadSchema: struct<v:bigint,_op:string>" in text


def test_a_small_change_does_not_shuffle_the_base(kept):
    table, rows = kept
    table.upsert(rows.where("v < 5"))
    text = plan(table.snapshot())
    assert "LeftAnti" in text and "BroadcastExchange" in text
    assert "Exchange hashpartitioning" not in text


def test_many_changes_shuffle_changes_only(kept):
    table, rows = kept
    for _ in range(3):
        table.upsert(rows.where("v < 5"))
    text = plan(table.snapshot())
    assert text.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in text and "BroadcastHashJoin" in text


def test_a_large_change_is_joined_by_a_shuffle(kept, spark, monkeypatch):
    table, rows = kept
    table.upsert(rows)
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(table.snapshot())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_large_change_leaves_other_partitions_alone(kept, spark, monkeypatch):
    """Only the base rows of partitions that changed are shuffled."""
    table, rows = kept
    table.upsert(rows.where("p = 'p1'").withColumn("v", F.col("v") + 1))
    table.delete(rows.where("k = '2'"))
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 10)
    found = table.snapshot()
    text = plan(found)
    untouched, joined = text.split("LeftAnti", 1)
    assert "Exchange" not in untouched and "NOT _partition_path" in untouched
    assert "_partition_path" in joined and " IN (p1,p2)" in joined
    expected = {i: i + (i % 4 == 1) for i in range(100) if i != 2}
    assert {int(r["k"]): r["v"] for r in found.collect()} == expected


def test_filters_on_the_partition_prune_directories(kept):
    table, _ = kept
    text = plan(table.snapshot().where("_partition_path = 'p1'"))
    assert "PartitionFilters: [isnotnull(_partition_path" in text


def test_incremental_read_lists_only_its_batches(kept):
    table, rows = kept
    first = table.last_instant()
    last = table.upsert(rows.where("v < 5")).instant
    found = table.incremental(first, last)
    assert all(f"_batch={last}" in name for name in found.inputFiles())
    assert "Exchange" not in plan(found)


def test_merges_and_ranges_never_join_all_pairs(kept, make_table, spark):
    table, rows = kept
    target = make_table("target", partition="p")
    target.upsert(rows.where("v < 50"))
    merge = (
        Merge.from_table(spark, table.spec, "s").into(target.spec, "t", on="s.k = t.k")
        .when_matched({"v": "s.v + t.v"})
    )
    rules = spark.createDataFrame([(1, 5, "a", "b", "c")], RULE_SCHEMA)
    for df in (merge.updates(), merge.inserts(), range_join(rows, rules, F.col("v"))):
        text = plan(df)
        assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_a_hot_value_of_a_self_join_is_split(spark):
    from keyedlog.operators.self_join import with_group_totals

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    rows = spark.range(40_000, numPartitions=8).selectExpr("if(id % 2 = 0, 7, id) k", "id v")
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = with_group_totals(rows, "k", {"n": F.count("*")})
        found.collect()
        assert "skew=true" in plan(found)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_sorted_rules_are_in_order(spark):
    from keyedlog.queries.enrich import ip_rules_sorted

    starts = [r["start_num"] for r in ip_rules_sorted(spark, "/root/testdata/sf0.001").collect()]
    assert starts == sorted(starts) and len(starts) > 100


def test_a_merge_by_identity_shuffles_a_large_target_once(make_table, spark, monkeypatch):
    """Beyond the broadcast limit the merge join itself finds the candidates."""
    source, target = make_table("source", partition="p"), make_table("target", partition="p")
    rows = spark.range(3000).selectExpr("string(id) k", "concat('p', id % 4) p", "id ts", "id v")
    target.upsert(rows.where("v < 2500"))
    source.upsert(rows.where("v >= 500"))
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def exchanges(on, **by):
        merge = Merge.from_table(spark, source.spec, "s").into(target.spec, "t", on=on)
        for name, field in by.items():
            getattr(merge, name)(field)
        found = merge.when_matched({"v": "s.v + t.v"}).updates()
        assert found.count() == 2000
        return plan(found).count("Exchange hashpartitioning")

    try:
        both = "s.k = t.k and t.p = s.p"
        assert exchanges(both) == 2
        assert exchanges("s.k = t.k") > 2
        assert exchanges(f"({both} and s.v > -1) or ({both} and t.v > -1)") == 2
        assert exchanges("s.k = t.k and (s.p = t.p or s.v = t.v)") > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_conditions_without_an_equality_are_refused(kept, make_table, spark):
    table, rows = kept
    target = make_table("target", partition="p")
    target.upsert(rows)

    def merge(on):
        return Merge.from_table(spark, table.spec, "s").into(target.spec, "t", on=on).when_matched({"v": "s.v"})

    for on in ("s.v < t.v", "s.k = '1' and t.k = '1'", "s.k = t.k or s.v = t.v", "s.v + t.v = 4"):
        with pytest.raises(ValueError, match="no equality"):
            merge(on).updates()
    for on in ("s.k = t.k and t.p <> 'CartesianProduct'", "s.v + 1 = t.v", "t.k <=> s.k",
               "(s.k = t.k and s.v < 9) or (t.k = s.k and s.v > 1)"):
        assert merge(on).updates().count() > 90


@pytest.mark.parametrize("partition", [None, "p"])
def test_large_changes_of_a_bucketed_table_shuffle_nothing_stored(spark, tmp_path, monkeypatch, partition):
    from keyedlog import KeyedTable, TableSpec

    spec = TableSpec("b", str(tmp_path / "b's"), "k", "ts", partition, buckets=8)
    table = KeyedTable(spark, spec)
    rows = spark.range(2000).selectExpr("string(id) k", "concat('p', id % 4) p", "id ts", "id v")
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table.upsert(rows)
        table.upsert(rows.where("v < 1500").withColumn("v", F.col("v") + 5000).withColumn("new", F.lit("n")))
        found = table.snapshot()
        assert "Exchange" not in plan(found) and "SortMergeJoin" in plan(found)
        assert "Bucketed: true" in plan(found)
        table.delete(rows.where("v % 2 = 0"))
        found = KeyedTable.open(spark, spec.path).snapshot()
        expected = {str(i): (i + 5000, "n") if i < 1500 else (i, None) for i in range(1, 2000, 2)}
        assert {r["k"]: (r["v"], r["new"]) for r in found.collect()} == expected
        base = plan(found).split("LeftAnti")[1]
        assert base.index("Exchange") > base.index("FileScan") if "Exchange" in base else True
        looked = table.lookup([("7", "p3"), ("8", "p0"), ("9", "p1")])
        assert sorted(r["k"] for r in looked.collect()) == ["7", "9"]
        before = table.last_instant()
        table.compact()
        assert table.snapshot().count() == 1000 and plan(table.snapshot()).count("Exchange") == 0
        assert table.incremental(before, table.last_instant()).count() == 0
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith("keyedlog_")] == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError, match="the buckets of"):
        KeyedTable(spark, TableSpec("b", spec.path, "k", "ts", partition)).snapshot()


def test_large_key_sets_are_shuffled_once_and_not_made_distinct(kept, spark, monkeypatch):
    table, rows = kept
    keys = spark.range(6000).selectExpr("string(id % 3000) k", "concat('p', id % 4) p")
    expected = {str(i) for i in range(100)}
    small = table.lookup(keys)
    assert "Exchange hashpartitioning" not in plan(small) and "BroadcastHashJoin" in plan(small)
    assert {r["k"] for r in small.collect()} == expected
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 10)
    monkeypatch.setattr("keyedlog.plans.table.BROADCAST_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = table.lookup(keys)
        assert plan(large).count("Exchange hashpartitioning") == 2 and "HashAggregate" not in plan(large)
        assert {r["k"] for r in large.collect()} == expected and large.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_few_keys_in_many_rows_become_filters(kept, spark):
    table, _ = kept
    keys = spark.range(5000).selectExpr("string(id % 3) k", "concat('p', id % 3) p")
    found = table.lookup(keys)
    assert " IN (0,1,2)" in plan(found) and found.count() == 3
