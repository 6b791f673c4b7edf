import random

import pytest
from pyspark.sql import functions as F

from keyedlog import NO_PARTITION, KeyedTable, Merge, MergeResult, TableSpec
from keyedlog.operators.rows import drop_meta
from keyedlog.plans import table as table_module
from keyedlog.queries.fixtures import table, trips

from conftest import SF


def contents(df):
    return sorted(tuple(r) for r in drop_meta(df).collect())


def fares(spark, source, target):
    return (
        Merge.from_table(spark, source.spec, "source")
        .aggregate(
            "select driver, sum(fare) fare, max(ts) ts from source group by driver",
            key="driver", partition=NO_PARTITION,
        )
        .into(target.spec, "target", on="source.driver = target.driver")
        .when_not_matched({"driver": "source.driver", "fare": "source.fare", "ts": "source.ts"})
        .when_matched({"fare": "source.fare + target.fare", "ts": "source.ts"})
    )


@pytest.fixture
def pair(make_table):
    return make_table("order", "uuid", "ts", "p"), make_table("fare", "driver", "ts")


TRIP = "uuid string, p string, driver string, fare decimal(12,2), ts bigint"


def test_counts_and_totals_of_two_merges(spark, pair):
    """Known results: 11 inserted, then 4 inserted and 11 updated, 43,320.41 in all."""
    source, target = pair
    rows = trips(spark, SF).withColumnRenamed("partitionpath", "p")
    number, user = F.col("uuid").cast("bigint"), F.col("driver").cast("bigint")
    source.upsert(rows.where((number % 2 == 0) & (user % 4 != 0)))
    result = fares(spark, source, target).execute()
    assert (result.inserted, result.updated) == (11, 0)
    source.upsert(rows.where(number % 2 == 1))
    result = fares(spark, source, target).execute()
    assert (result.read, result.inserted, result.updated, result.written) == (15, 4, 11, 15)
    total = target.snapshot().agg(F.count(F.lit(1)), F.sum("fare")).first()
    assert (total[0], float(total[1])) == (15, 43320.41)
    assert dict(target.snapshot().dtypes)["fare"] == "decimal(22,2)"


def test_a_merge_without_new_commits_does_nothing(spark, pair, frame):
    source, target = pair
    source.upsert(frame([("1", "x", "a", 5, 1)], "uuid string, p string, driver string, fare bigint, ts bigint"))
    assert fares(spark, source, target).execute().inserted == 1
    last = target.last_instant()
    assert fares(spark, source, target).execute() == MergeResult(0, 0, 0, None)
    assert target.last_instant() == last
    assert target.offsets() == {"order": source.last_instant()}
    source.compact()
    assert fares(spark, source, target).execute().instant is None


def test_a_repeated_merge_after_a_lost_commit_gives_the_same(spark, pair, frame, monkeypatch):
    """Data and offset appear together, so a merge that dies is simply run again."""
    source, target = pair
    schema = "uuid string, p string, driver string, fare bigint, ts bigint"
    source.upsert(frame([("1", "x", "a", 5, 1), ("2", "x", "b", 6, 1)], schema))
    fares(spark, source, target).execute()
    source.upsert(frame([("3", "x", "a", 7, 2), ("4", "x", "c", 8, 2)], schema))
    with monkeypatch.context() as patch:
        patch.setattr(table_module.CommitRecord, "write", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fares(spark, source, target).execute()
    result = fares(spark, source, target).execute()
    assert (result.inserted, result.updated) == (1, 1)
    assert contents(target.snapshot()) == [("a", 12, 2), ("b", 6, 1), ("c", 8, 2)]
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_one_step_or_many_give_the_same_sums(spark, make_table, frame):
    rng = random.Random(3)
    rows = [(str(i), rng.choice("xy"), rng.choice("abcde"), rng.randrange(100), i) for i in range(60)]
    schema = "uuid string, p string, driver string, fare bigint, ts bigint"
    results = []
    for name, size in (("one", 60), ("many", 15)):
        source = make_table(f"order_{name}", "uuid", "ts", "p")
        target = make_table(f"fare_{name}", "driver", "ts")
        for start in range(0, 60, size):
            source.upsert(frame(rows[start:start + size], schema))
            fares(spark, source, target).execute()
        results.append(contents(target.snapshot()))
    assert results[0] == results[1]


def by_key(spark, source, target, **rules):
    merge = Merge.from_table(spark, source.spec, "s").into(target.spec, "t", on=rules.get("on", "s.k = t.k"))
    return merge.when_matched(rules.get("update", {"v": "s.v + t.v", "ts": "s.ts"})).when_not_matched(rules.get("insert"))


def test_several_source_rows_for_one_target_row_see_the_stored_value(spark, make_table, frame):
    source, target = make_table("src", "id", "ts"), make_table("tgt")
    target.upsert(frame([("a", 1, 100)], "k string, ts bigint, v bigint"))
    source.upsert(frame([("1", "a", 5, 1), ("2", "a", 9, 2), ("3", "a", 7, 4)], "id string, k string, ts bigint, v bigint"))
    result = by_key(spark, source, target, insert={"k": "s.k", "ts": "s.ts", "v": "s.v"}).key_by("k").execute()
    assert (result.read, result.inserted, result.updated) == (3, 0, 1)
    assert contents(target.snapshot()) == [("a", 9, 102)]


def test_unmapped_columns_keep_the_stored_value_and_new_ones_appear(spark, make_table, frame):
    login, recharge, user = (make_table(n, "pid", "ts") for n in ("login", "recharge", "user"))
    login.overwrite(frame([("1", 10), ("2", 20)], "pid string, ts bigint"))
    recharge.overwrite(frame([("2", 7.5, 99), ("3", 2.5, 99)], "pid string, money double, ts bigint"))
    (Merge.from_table(spark, login.spec, "login").into(user.spec, "user", on="login.pid = user.pid")
     .when_matched({"ts": "login.ts"}).when_not_matched({"pid": "login.pid", "ts": "login.ts"}).execute())
    (Merge.from_table(spark, recharge.spec, "recharge").into(user.spec, "user", on="recharge.pid = user.pid")
     .when_matched({"money": "recharge.money"})
     .when_not_matched({"pid": "recharge.pid", "money": "recharge.money", "ts": "recharge.ts"}).execute())
    assert contents(user.snapshot()) == [("1", 10, None), ("2", 20, 7.5), ("3", 99, 2.5)]
    assert user.offsets() == {"login": login.last_instant(), "recharge": recharge.last_instant()}


def test_the_update_wins_over_an_insert_of_the_same_identity(spark, make_table, frame):
    source, target = make_table("src", "id", "ts"), make_table("tgt")
    target.upsert(frame([("a", 1, 1)], "k string, ts bigint, v bigint"))
    source.upsert(frame([("1", "a", 2, 50), ("2", "b", 99, 60)], "id string, k string, ts bigint, v bigint"))
    merge = by_key(spark, source, target, insert={"k": "'a'", "ts": "s.ts", "v": "s.v"}).key_by("k")
    result = merge.execute()
    assert (result.inserted, result.updated) == (0, 1)
    assert contents(target.snapshot()) == [("a", 2, 51)]


def test_lookup_keys_restrict_which_rows_can_match(spark, make_table, frame):
    """A target row outside the looked-up partition is no match, whatever the condition says."""
    source, target = make_table("src", "k", "ts", "p"), make_table("tgt", "k", "ts", "p")
    target.upsert(frame([("a", "x", 1, 1), ("a", "y", 1, 2)]))
    source.upsert(frame([("a", "x", 5, 10)]))
    by_key(spark, source, target).execute()
    assert contents(target.snapshot()) == [("a", "x", 5, 11), ("a", "y", 1, 2)]


def test_partition_rules_of_lookups(spark, make_table, frame):
    """A target without partitions ignores them; one with partitions needs to know where to look."""
    source, flat = make_table("src", "k", "ts", "p"), make_table("flat")
    flat.upsert(frame([("a", "x", 1, 1)]))
    source.upsert(frame([("a", "x", 5, 10), ("b", "", 5, 20)]))
    result = by_key(spark, source, flat).execute()
    assert (result.inserted, result.updated) == (1, 1)
    for partition in ("p", NO_PARTITION):
        again = make_table(f"t_{partition}")
        again.upsert(frame([("a", "x", 1, 1)]))
        result = by_key(spark, source, again).partition_by(partition).execute()
        assert (result.inserted, result.updated) == (1, 1)


def test_a_partitioned_target_needs_a_partition(spark, make_table):
    source, target = make_table("src"), make_table("tgt", partition="p")
    for merge in (by_key(spark, source, target), by_key(spark, source, target).partition_by(NO_PARTITION)):
        with pytest.raises(ValueError, match="partition_by"):
            merge.execute()


def test_functions_change_the_lookup_only(spark, make_table, frame):
    source, target = make_table("src", "k", "ts", "p"), make_table("tgt", "k", "ts", "p")
    target.upsert(frame([("A", "X", 1, 1)]))
    source.upsert(frame([("a", "x", 5, 10)]))
    on = "upper(s.k) = t.k"
    assert by_key(spark, source, target, on=on).inserts().count() == 1
    merge = by_key(spark, source, target, on=on).key_by("k", F.upper).partition_by("p", F.upper)
    assert merge.inserts().count() == 0 and contents(merge.updates()) == [("A", "X", 5, 11)]
    merge.execute()
    assert contents(target.snapshot()) == [("A", "X", 5, 11)]


def test_previews_together_are_what_the_merge_writes(spark, make_table, frame):
    rng = random.Random(11)
    source, target = make_table("src", "k", "ts", "p"), make_table("tgt", "k", "ts", "p")
    target.upsert(frame([(str(i), rng.choice("xy"), 0, i) for i in range(20)]))
    source.upsert(frame([(str(i), rng.choice("xy"), i, i) for i in range(40)]))
    merge = by_key(spark, source, target)
    preview = contents(merge.updates()) + contents(merge.inserts())
    before = target.last_instant()
    result = merge.execute()
    written = contents(target.incremental(before, target.last_instant()))
    assert sorted(preview) == written and len(written) == result.written == 40


def test_numeric_keys_and_alias_that_is_a_keyword(spark, make_table, frame):
    source, target = make_table("src", "k", "ts"), make_table("tgt")
    schema = "k int, ts bigint, v bigint"
    target.upsert(frame([(1, 1, 1)], schema))
    source.upsert(frame([(1, 2, 10), (2, 2, 20)], schema))
    merge = Merge.from_table(spark, source.spec, "order").into(target.spec, "user", on="order.k = user.k")
    merge.when_matched({"v": "order.v + user.v"}).execute()
    assert contents(target.snapshot()) == [(1, 1, 11), (2, 2, 20)]


def test_consumers_have_their_own_offsets(spark, pair, frame):
    source, target = pair
    source.upsert(frame([("1", "x", "a", 5, 1)], "uuid string, p string, driver string, fare bigint, ts bigint"))
    fares(spark, source, target).execute(app="nightly")
    assert target.offsets() == {} and set(target.offsets("nightly")) == {"order"}
    assert fares(spark, source, target).execute(app="nightly").written == 0
    assert fares(spark, source, target).execute().updated == 1


def test_a_source_with_deletes_only_still_moves_the_offset(spark, pair, frame):
    source, target = pair
    schema = "uuid string, p string, driver string, fare bigint, ts bigint"
    source.upsert(frame([("1", "x", "a", 5, 1)], schema))
    fares(spark, source, target).execute()
    source.delete(frame([("1", "x")], "uuid string, p string"))
    result = fares(spark, source, target).execute()
    assert (result.read, result.written) == (0, 0)
    assert target.offsets() == {"order": source.last_instant()}
    assert contents(target.snapshot()) == [("a", 5, 1)]


def test_large_key_sets_take_the_join_path(spark, make_table, frame, monkeypatch):
    from keyedlog.operators import sizing

    source, target = make_table("src", "k", "ts", "p"), make_table("tgt", "k", "ts", "p")
    target.upsert(frame([(str(i), "x", 0, i) for i in range(30)]))
    source.upsert(frame([(str(i), "x", 1, 100) for i in range(20, 50)]))
    monkeypatch.setattr(table_module, "LITERAL_KEYS", 0)
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    result = by_key(spark, source, target).execute()
    assert (result.inserted, result.updated) == (20, 10)


def test_the_aggregate_view_is_gone_afterwards(spark, pair, frame):
    source, target = pair
    source.upsert(frame([("1", "x", "a", 5, 1)], "uuid string, p string, driver string, fare bigint, ts bigint"))
    fares(spark, source, target).execute()
    assert not spark.catalog.tableExists("source")


SPEC = TableSpec("t", "/nowhere", "k", "ts")


@pytest.mark.parametrize(
    "change, name",
    [
        (lambda m: setattr(m, "spark", None), "spark"),
        (lambda m: setattr(m, "source_alias", ""), "source alias"),
        (lambda m: m.into(SPEC, "", on="a.k = b.k"), "target alias"),
        (lambda m: m.into(SPEC, "b", on=""), "on"),
        (lambda m: m.when_matched({}), "when_matched"),
        (lambda m: m.aggregate("", "k", "p"), "aggregate sql"),
        (lambda m: m.aggregate("select 1", "", "p"), "aggregate key"),
        (lambda m: m.aggregate("select 1", "k", None), "aggregate partition"),
    ],
)
def test_missing_parameters_are_named(spark, change, name):
    merge = Merge.from_table(spark, SPEC, "a").into(SPEC, "b", on="a.k = b.k").when_matched({"v": "a.v"})
    change(merge)
    with pytest.raises(ValueError, match=f"{name} is not set"):
        merge.execute()


def test_a_merge_needs_a_target_and_a_source(spark, make_table):
    with pytest.raises(ValueError, match="target is not set"):
        Merge.from_table(spark, SPEC, "a").when_matched({"v": "a.v"}).execute()
    merge = Merge.from_table(spark, SPEC, "a").into(make_table().spec, "b", on="a.k = b.k")
    with pytest.raises(ValueError, match="source table t does not exist"):
        merge.when_matched({"v": "a.v"}).execute()
    with pytest.raises(ValueError, match="must differ"):
        Merge.from_table(spark, SPEC, "a").into(SPEC, "A", on="a.k = a.k").when_matched({"v": "a.v"}).execute()


def test_a_condition_without_an_equality_is_refused(spark, make_table, frame):
    source, target = make_table("src"), make_table("tgt")
    source.upsert(frame([("a", "", 1, 1)]))
    target.upsert(frame([("a", "", 1, 1)]))
    for on in ("s.v < t.v", "s.k = 'a'", "s.k = t.k or s.v = t.v"):
        merge = (Merge.from_table(spark, source.spec, "s").into(target.spec, "t", on=on)
                 .when_matched({"v": "s.v"}))
        with pytest.raises(ValueError, match="no equality"):
            merge.execute()


def test_a_view_of_the_user_is_left_alone(spark, pair, frame):
    source, target = pair
    source.upsert(frame([("u", "x", "a", None, 1)], TRIP))
    frame([("a", "", 1, 1)]).createOrReplaceTempView("source")
    try:
        with pytest.raises(ValueError, match="temporary view already"):
            fares(spark, source, target).execute()
        assert spark.table("source").count() == 1
    finally:
        spark.catalog.dropTempView("source")
