import os
import random

import pytest
from pyspark.sql import functions as F

from keyedlog import KeyedTable, TableSpec
from keyedlog.operators import sizing
from keyedlog.operators.rows import drop_meta
from keyedlog.plans import table as table_module
from keyedlog.sources.commits import next_instant


def contents(df):
    return sorted(tuple(r) for r in drop_meta(df).collect())


def test_upsert_replaces_by_identity_and_adds_the_rest(make_table, frame):
    t = make_table(partition="p")
    t.upsert(frame([("a", "x", 5, 1), ("b", "x", 5, 2)]))
    # A later write wins even with a smaller precombine value.
    t.upsert(frame([("a", "x", 1, 10), ("a", "y", 1, 3)]))
    assert contents(t.snapshot()) == [("a", "x", 1, 10), ("a", "y", 1, 3), ("b", "x", 5, 2)]


def test_overwrite_replaces_the_whole_table(make_table, frame):
    t = make_table()
    t.upsert(frame([("a", "x", 1, 1), ("b", "x", 1, 2)]))
    t.overwrite(frame([("c", "x", 1, 3), ("c", "x", 2, 4)]))
    assert contents(t.snapshot()) == [("c", "x", 2, 4)]


def test_bookkeeping_columns_of_a_snapshot(make_table, frame):
    t = make_table(partition="p")
    first = t.upsert(frame([("a", "x", 1, 1), ("b", None, 1, 2)]))
    second = t.upsert(frame([("a", "x", 2, 3)]))
    found = {r["_record_key"]: r for r in t.snapshot().collect()}
    assert found["a"]["_commit_time"] == second.instant
    assert found["b"]["_commit_time"] == first.instant
    assert found["b"]["_partition_path"] == "default" and found["b"]["p"] is None


def test_delete_removes_identities_only(make_table, frame):
    t = make_table(partition="p")
    t.upsert(frame([("a", "x", 1, 1), ("a", "y", 1, 2), ("b", "x", 1, 3)]))
    keys = frame([("a", "x", 9, 0), ("zz", "x", 9, 0)]).select("k", "p", "ts")
    t.delete(keys)
    assert contents(t.snapshot()) == [("a", "y", 1, 2), ("b", "x", 1, 3)]
    t.upsert(frame([("a", "x", 1, 7)]))
    assert ("a", "x", 1, 7) in contents(t.snapshot())


def test_delete_from_a_table_without_partitions(make_table, frame):
    t = make_table()
    t.upsert(frame([("a", "x", 1, 1), ("b", "y", 1, 2)]))
    t.delete(frame([("a", "another", 1, 1)]))
    assert contents(t.snapshot()) == [("b", "y", 1, 2)]


def test_incremental_excludes_begin_and_includes_end(make_table, frame):
    t = make_table(partition="p")
    c = [t.upsert(frame([("a", "x", i, i), (f"k{i}", "x", i, i)])).instant for i in range(4)]
    assert contents(t.incremental("000", c[0])) == [("a", "x", 0, 0), ("k0", "x", 0, 0)]
    assert contents(t.incremental(c[0], c[2])) == [("a", "x", 2, 2), ("k1", "x", 1, 1), ("k2", "x", 2, 2)]
    empty = t.incremental(c[3], c[3])
    assert empty.count() == 0 and "v" in empty.columns


def test_rows_deleted_in_the_range_do_not_appear(make_table, frame):
    t = make_table()
    first = t.upsert(frame([("a", "x", 1, 1)]))
    t.upsert(frame([("b", "x", 1, 2), ("c", "x", 1, 3)]))
    last = t.delete(frame([("b", "x", 1, 2)]))
    assert contents(t.incremental(first.instant, last.instant)) == [("c", "x", 1, 3)]


def test_incremental_over_an_overwrite_reads_what_is_left(make_table, frame):
    t = make_table()
    t.upsert(frame([("a", "x", 1, 1)]))
    t.overwrite(frame([("b", "x", 1, 2)]))
    last = t.upsert(frame([("c", "x", 1, 3)]))
    assert contents(t.incremental("000", last.instant)) == [("b", "x", 1, 2), ("c", "x", 1, 3)]


def test_compaction_changes_no_read(make_table, frame):
    t = make_table(partition="p")
    first = t.upsert(frame([("a", "x", 1, 1), ("b", "x", 1, 2), ("c", "y", 1, 3)])).instant
    second = t.upsert(frame([("a", "x", 2, 4)])).instant
    t.delete(frame([("b", "x", 1, 2)]))
    before = sorted(map(tuple, t.snapshot().collect()))
    t.compact()
    assert sorted(map(tuple, t.snapshot().collect())) == before
    assert contents(t.incremental(first, t.last_instant())) == [("a", "x", 2, 4)]
    assert contents(t.incremental("000", second)) == [("a", "x", 2, 4), ("b", "x", 1, 2), ("c", "y", 1, 3)]
    t.upsert(frame([("c", "y", 3, 9)]))
    assert contents(t.snapshot()) == [("a", "x", 2, 4), ("c", "y", 3, 9)]


@pytest.mark.parametrize("limit", [sizing.BROADCAST_ROWS, 0])
def test_snapshot_follows_a_dictionary_model(make_table, frame, monkeypatch, limit):
    """Random writes against a plain dictionary that applies the same operations."""
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", limit)
    rng = random.Random(7)
    t, model = make_table(partition="p"), {}
    for step in range(9):
        batch = [
            (f"k{rng.randrange(12)}", rng.choice("xyz"), rng.randrange(5), step * 100 + i)
            for i in range(rng.randrange(1, 15))
        ]
        kind = rng.choice(["upsert"] * 6 + ["delete"] * 3 + ["overwrite", "compact"])
        if step == 0:
            kind = "upsert"
        if kind == "compact":
            t.compact()
        elif kind == "delete":
            t.delete(frame(batch))
            for k, p, _, _ in batch:
                model.pop((k, p), None)
        else:
            # Distinct precombine values within a batch, so that the winner is known.
            batch = [(k, p, i, v) for i, (k, p, _, v) in enumerate(batch)]
            getattr(t, kind)(frame(batch))
            model = {} if kind == "overwrite" else model
            model.update({(k, p): (k, p, ts, v) for k, p, ts, v in batch})
        assert contents(t.snapshot()) == sorted(model.values()), (step, kind)
    keys = [(f"k{i}", p) for i in range(14) for p in "xw"]
    assert contents(t.lookup(keys)) == sorted(model[k] for k in keys if k in model)


# ---- schema ---------------------------------------------------------------------------


def test_schema_grows_and_old_rows_read_null(make_table, frame):
    t = make_table()
    t.upsert(frame([("a", 1)], "k string, ts bigint"))
    t.upsert(frame([("b", 2, 9.5)], "k string, ts bigint, money double"))
    t.upsert(frame([("c", 3)], "k string, ts bigint"))
    assert t.schema().names == ["k", "ts", "money"]
    assert contents(t.snapshot()) == [("a", 1, None), ("b", 2, 9.5), ("c", 3, None)]


def test_a_changed_type_or_reserved_name_is_refused(make_table, frame):
    t = make_table()
    t.upsert(frame([("a", 1, 1)], "k string, ts bigint, note bigint"))
    with pytest.raises(ValueError, match="ts is bigint in the table and string"):
        t.upsert(frame([("a", "1")], "k string, ts string"))
    with pytest.raises(ValueError, match="reserved"):
        t.upsert(frame([("a", 1, "U")], "k string, ts bigint, _op string"))
    with pytest.raises(ValueError, match="only in case"):
        t.upsert(frame([("a", 1, 2)], "k string, ts bigint, Note bigint"))


def test_strict_check_ignores_order_and_names_differences(make_table, frame):
    t = make_table()
    t.upsert(frame([("a", 1)], "k string, ts bigint"))
    t.check_schema(frame([(1, "a")], "ts bigint, k string"))
    with pytest.raises(ValueError) as error:
        t.check_schema(frame([("a", "1", 2)], "k string, ts string, extra int"))
    assert "extra: not in the table" in str(error.value)
    assert "ts: string in the input, bigint in the table" in str(error.value)
    with pytest.raises(ValueError, match="ts: missing from the input"):
        t.check_schema(frame([("a",)], "k string"))


def test_an_overwrite_may_change_the_schema(make_table, frame):
    t = make_table()
    t.upsert(frame([("a", 1)], "k string, ts bigint"))
    t.overwrite(frame([("a", "now")], "k string, ts string"))
    assert contents(t.snapshot()) == [("a", "now")]


def test_needed_columns_are_named_when_missing(make_table, frame):
    with pytest.raises(ValueError, match="needs column p"):
        make_table(partition="p").upsert(frame([("a", 1)], "k string, ts bigint"))


def test_nested_nullability_is_no_difference(make_table, spark):
    t = make_table()
    row = spark.range(1).selectExpr("'a' k", "id ts", "array(1, 2) xs", "named_struct('n', 1) s")
    t.upsert(row)
    t.upsert(row.selectExpr("'b' k", "ts", "array(1, null) xs", "named_struct('n', int(null)) s"))
    t.check_schema(t.snapshot().select("k", "ts", "xs", "s"))
    assert sorted(r["k"] for r in t.snapshot().collect()) == ["a", "b"]


def test_a_table_keeps_its_key_and_partition(make_table, frame, spark):
    t = make_table(partition="p")
    t.upsert(frame([("a", "x", 1, 1)]))
    other = KeyedTable(spark, TableSpec("t", t.spec.path, "k", "ts"))
    for action in (other.snapshot, lambda: other.upsert(frame([("a", "x", 1, 1)]))):
        with pytest.raises(ValueError, match="the partition of .* is p, not None"):
            action()
    other.overwrite(frame([("a", "y", 1, 2), ("a", "x", 2, 3)]))
    assert contents(other.snapshot()) == [("a", "x", 2, 3)]


def test_a_snapshot_can_be_written_back_without_bookkeeping(make_table, frame):
    t = make_table()
    t.upsert(frame([("a", "x", 1, 1)]))
    with pytest.raises(ValueError, match="drop_meta"):
        t.upsert(t.snapshot())
    t.upsert(drop_meta(t.snapshot()).withColumn("v", F.col("v") + 1))
    assert contents(t.snapshot()) == [("a", "x", 1, 2)]


# ---- commits --------------------------------------------------------------------------


def test_a_missing_table(make_table, frame, spark):
    t = make_table()
    assert not t.exists() and t.timeline() is None and t.offsets() == {}
    for action in (t.snapshot, t.last_instant, t.schema, t.commits):
        with pytest.raises(ValueError, match="does not exist"):
            action()
    with pytest.raises(ValueError, match="does not exist"):
        t.delete(frame([("a", "x", 1, 1)]))
    with pytest.raises(ValueError, match="no keyed table"):
        TableSpec.open(spark, t.spec.path)


def test_open_from_the_path_alone(make_table, frame, spark):
    t = make_table(partition="p")
    t.upsert(frame([("a", "x", 1, 1)]))
    assert KeyedTable.open(spark, t.spec.path).spec == t.spec
    flat = make_table("flat")
    flat.upsert(frame([("a", "x", 1, 1)]))
    assert TableSpec.open(spark, flat.spec.path + "/").partition is None


def test_commit_log_holds_kind_counts_and_metadata(make_table, frame):
    t = make_table()
    t.overwrite(frame([("a", "x", 1, 1), ("a", "x", 2, 2)]), meta={"_test": "test"})
    t.delete(frame([("a", "x", 1, 1)]))
    log = t.commits().orderBy("instant").collect()
    assert [(r["kind"], r["rows"]) for r in log] == [("overwrite", 1), ("delete", 1)]
    assert log[0]["meta"] == {"_test": "test"} and log[0]["meta"].get("other") is None
    assert t.last_instant() == log[-1]["instant"]


def test_a_batch_without_a_record_is_invisible(make_table, frame, monkeypatch):
    """A writer that dies before its commit record leaves the table as it was."""
    t = make_table(partition="p")
    t.upsert(frame([("a", "x", 1, 1)]))

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(table_module.CommitRecord, "write", dies)
        with pytest.raises(RuntimeError):
            t.upsert(frame([("a", "x", 2, 2)]))
    assert len(os.listdir(t.spec.data_path)) >= 2
    assert contents(t.snapshot()) == [("a", "x", 1, 1)]
    t.upsert(frame([("b", "x", 1, 3)]))
    assert contents(t.snapshot()) == [("a", "x", 1, 1), ("b", "x", 1, 3)]


def test_two_writers_with_one_instant_collide(make_table, frame, monkeypatch):
    t = make_table()
    first = t.upsert(frame([("a", "x", 1, 1)]))
    monkeypatch.setattr(table_module, "next_instant", lambda last: first.instant)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        t.upsert(frame([("b", "x", 1, 1)]))


def test_instants_always_grow():
    last = "29990101000000999"
    assert next_instant(last) == "29990101000001000"
    assert len(next_instant("000")) == 17 and next_instant("000") > "000"


def test_offsets_are_carried_forward_and_reset_by_an_overwrite(make_table, frame):
    t = make_table()
    t.upsert(frame([("a", "x", 1, 1)]), offsets={"login": "1"})
    t.upsert(frame([("a", "x", 1, 1)]), offsets={"recharge": "2"})
    t.upsert(frame([("a", "x", 1, 1)]), offsets={"login": "7"}, app="other")
    t.delete(frame([("a", "x", 1, 1)]))
    assert t.offsets() == {"login": "1", "recharge": "2"} and t.offsets("other") == {"login": "7"}
    t.overwrite(frame([("a", "x", 1, 1)]), offsets={"login": "9"})
    assert t.offsets() == {"login": "9"} and t.offsets("other") == {}


# ---- layout ---------------------------------------------------------------------------


def test_partition_values_survive_as_text(make_table, frame):
    t = make_table(partition="p")
    values = ["americas/united_states/san_francisco", "007", "2021-01-01", "a=b c%d%41", "1.50", "日本"]
    t.upsert(frame([("a", p, 1, 1) for p in values]))
    t.upsert(frame([("b", p, 1, 1) for p in values]))
    assert {r["_partition_path"] for r in t.snapshot().collect()} == set(values)
    assert set(t.timeline().commits[0].partitions) == set(values)
    assert t.lookup([("a", values[0]), ("b", "007")]).count() == 2


def test_paths_with_a_scheme(spark, tmp_path, frame):
    t = KeyedTable(spark, TableSpec("t", f"file://{tmp_path}/uri", "k", "ts", "p"))
    t.upsert(frame([("a", "x", 1, 1)]))
    t.upsert(frame([("a", "x", 2, 2)]))
    assert contents(t.snapshot()) == [("a", "x", 2, 2)]


def _files(table, instant):
    found = []
    for folder, _, names in os.walk(table.spec.batch_path(instant)):
        found += [os.path.join(folder, n) for n in names if n.endswith(".parquet")]
    return found


def test_write_parallelism_and_writer_options(make_table, spark):
    t = make_table()
    rows = spark.range(1000).selectExpr("cast(id as string) k", "id ts")
    assert len(_files(t, t.upsert(rows, parallelism=3).instant)) == 3
    commit = t.overwrite(rows, parallelism=1, options={"maxRecordsPerFile": "100"})
    assert len(_files(t, commit.instant)) == 10
    commit = t.overwrite(rows, options={"compression": "zstd"})
    assert all(".zstd." in name for name in _files(t, commit.instant))
    assert t.snapshot().count() == 1000


def test_a_partition_directory_gets_few_files(make_table, spark):
    t = make_table(partition="p")
    rows = spark.range(0, 4000, 1, 8).selectExpr("cast(id as string) k", "id ts", "if(id % 3 = 0, 'hot', string(id % 5)) p")
    commit = t.upsert(rows)
    assert len(_files(t, commit.instant)) == 6


# ---- lookup ---------------------------------------------------------------------------


@pytest.fixture
def looked_up(make_table, spark, frame):
    t = make_table(partition="p")
    rows = spark.range(500).selectExpr("cast(id as string) k", "concat('p', id % 5) p", "id ts", "id v")
    t.upsert(rows)
    t.upsert(rows.where("cast(k as int) % 10 = 0").withColumn("v", F.col("v") + 1000))
    t.delete(rows.where("cast(k as int) % 100 = 0"))
    return t


def expected_values(pairs):
    out = []
    for k, p in set(pairs):
        if k.isdigit() and int(k) < 500 and p == f"p{int(k) % 5}" and int(k) % 100:
            out.append(int(k) + (1000 if int(k) % 10 == 0 else 0))
    return sorted(out)


PAIRS = [(str(i), f"p{i % 5}") for i in range(0, 700, 7)] + [("3", "p0"), ("x", "p1"), ("10", "p0"), ("10", "p0")]


@pytest.mark.parametrize("literal", [1000, 0])
@pytest.mark.parametrize("partitions", [1000, 0])
@pytest.mark.parametrize("size", [1 << 20, 0])
def test_lookup_is_the_same_by_every_way(looked_up, spark, monkeypatch, literal, partitions, size):
    """Literals, broadcast and shuffle join, with and without a partition filter."""
    monkeypatch.setattr(table_module, "LITERAL_KEYS", literal)
    monkeypatch.setattr(table_module, "LITERAL_PARTITIONS", partitions)
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", size)
    keys = spark.createDataFrame(PAIRS, "a string, b string")
    for given in (PAIRS, keys):
        found = looked_up.lookup(given)
        assert sorted(r["v"] for r in found.collect()) == expected_values(PAIRS)
        assert found.columns == looked_up.snapshot().columns


def test_single_key_lookup_reaches_the_scan(looked_up):
    found = looked_up.lookup([("7", "p2")])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(_record_key,7)" in plan and "(_partition_path#" in plan
    assert [r["v"] for r in found.collect()] == [7]


def test_lookup_skips_commits_to_other_partitions(looked_up, spark):
    rows = spark.createDataFrame([("7", "p9", 1, 1)], "k string, p string, ts bigint, v bigint")
    other = looked_up.upsert(rows).instant
    found = looked_up.lookup([("7", "p2"), (None, "p2"), ("", None)])
    assert not any(other in name for name in found.inputFiles())
    assert [r["v"] for r in found.collect()] == [7]
    assert looked_up.lookup([("7", "p9")]).count() == 1


def test_lookup_without_partitions_and_without_a_table(make_table, frame, spark):
    t = make_table()
    assert t.lookup([("a", None)]).count() == 0
    assert t.lookup(frame([("a", "x", 1, 1)]), frame([("a", "x", 1, 1)]).schema).columns[:4] == ["k", "p", "ts", "v"]
    t.upsert(frame([("a", "x", 1, 1), ("b", "x", 1, 2)]))
    assert contents(t.lookup(["a", "nobody"])) == [("a", "x", 1, 1)]
    assert contents(t.lookup([("a", "ignored")])) == [("a", "x", 1, 1)]
    assert contents(t.lookup(spark.createDataFrame([("b",)], "key string"))) == [("b", "x", 1, 2)]
    assert t.lookup([]).count() == 0


@pytest.mark.parametrize("n", [150, 1500])
def test_every_partition_is_recorded_and_prunes(spark, make_table, monkeypatch, n):
    table = make_table(partition="p")
    rows = spark.range(n).selectExpr(
        "cast(id as string) k", "concat('p', lpad(id, 4, '0')) p", "id ts", "id v")
    table.upsert(rows)
    table.upsert(rows.where("v < 3").withColumn("v", F.col("v") + 1))
    assert [len(c.partitions) for c in table.timeline().commits] == [n, 3]
    monkeypatch.setattr(table_module, "LITERAL_KEYS", 0)
    monkeypatch.setattr(table_module, "LITERAL_PARTITIONS", 2)
    wanted = rows.where("v < 5").select("k", "p")
    found = table.lookup(wanted)
    assert {int(r["k"]): r["v"] for r in found.collect()} == {0: 1, 1: 2, 2: 3, 3: 3, 4: 4}
    assert "dynamicpruning" in found._jdf.queryExecution().toString().lower()
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 1)
    kept = table.snapshot()
    assert {int(r["k"]): r["v"] for r in kept.collect()} == {i: i + (i < 3) for i in range(n)}


def test_a_stale_writer_fails(make_table, frame):
    table = make_table()
    table.upsert(frame([("a", "", 1, 1)]))
    stale = table.timeline()
    table.upsert(frame([("a", "", 2, 2)]), offsets={"src": "5"})
    with pytest.raises(Exception, match="(?i)already.exists"):
        table.upsert(frame([("b", "", 3, 3)]), after=stale)
    assert table.offsets() == {"src": "5"}
    assert [r["k"] for r in table.snapshot().collect()] == ["a"]


def test_a_long_log_is_read_back_to_the_last_full_batch_only(spark, make_table, frame):
    table = make_table()
    first = table.upsert(frame([("a", "", 1, 1)])).instant
    for i in range(3):
        table.upsert(frame([("a", "", 2 + i, i)]))
    table.compact()
    last = table.upsert(frame([("b", "", 9, 9)])).instant
    assert [c.kind for c in table.timeline().commits] == ["compact", "upsert"]
    assert [c.kind for c in table.timeline(first).commits][1:] == ["upsert"] * 3 + ["compact", "upsert"]
    assert table.commits().count() == 6
    assert sorted(r["k"] for r in table.incremental(first, last).collect()) == ["a", "b"]
    assert sorted(r["k"] for r in table.incremental("0", first).collect()) == ["a"]
    assert table.timeline().last_change == last
    table.compact()
    assert table.timeline().last_change == last


def test_a_dead_writer_does_not_block_the_next(spark, make_table, frame, tmp_path):
    table = make_table()
    table.upsert(frame([("a", "", 1, 1)]))
    (tmp_path / "t" / "_commits" / "000000000001").mkdir()
    table.upsert(frame([("b", "", 2, 2)]))
    assert sorted(r["k"] for r in table.snapshot().collect()) == ["a", "b"]
    assert table.timeline().number == 2


def test_the_limit_of_literal_keys_is_an_argument(make_table, frame):
    table = make_table()
    table.upsert(frame([("a", "", 1, 1), ("b", "", 1, 2)]))
    for limit in (0, 1, 2):
        found = table.lookup([("a", None), ("b", None)], literal_keys=limit)
        assert sorted(r["k"] for r in found.collect()) == ["a", "b"]


def test_a_long_log_is_not_read_back_to_its_base(make_table, frame, spark, monkeypatch):
    """Writers, offsets and streams read the last of a thousand records, increments their own range."""
    import json
    import pathlib

    from keyedlog.sources import commits
    from keyedlog.streaming.write import upsert_batch

    t = make_table("long")
    t.upsert(frame([("a", "x", 1, 1)]))
    path = pathlib.Path(t.spec.commits_path)
    record = json.loads(spark.read.text(str(path / "000000000000")).first()[0])
    for number in range(1, 1000):
        folder = path / f"{number:012d}"
        folder.mkdir()
        (folder / "part-0.txt").write_text(json.dumps(
            {**record, "number": number, "base": 0, "kind": "delete",
             "instant": str(int(record["instant"]) + number)}))
    read = []
    original = commits._records
    monkeypatch.setattr(commits, "_records", lambda s, p, numbers, *c: (
        read.extend(numbers), original(s, p, numbers, *c))[1])
    assert t.offsets() == {} and read == [999]
    last = t.last_instant()
    del read[:]
    assert upsert_batch(frame([("b", "x", 1, 2)]), t.spec, 0, "stream")
    assert read == [999]
    assert not upsert_batch(frame([("b", "x", 1, 2)]), t.spec, 0, "stream")
    del read[:]
    found = t.incremental(last, t.last_instant())
    assert [r["k"] for r in found.collect()] == ["b"]
    assert set(read) <= {998, 999, 1000}


def test_enrichment_and_streams_refuse_a_second_writer(make_table, frame, monkeypatch):
    from keyedlog.plans.enrich import Enrichment

    source, target = make_table("source"), make_table("enriched")
    source.upsert(frame([("a", "x", 1, 1)]))
    target.upsert(frame([("z", "x", 1, 1)]))

    def meanwhile(rows):
        target.upsert(frame([("y", "x", 1, 1)]))
        return rows

    with pytest.raises(Exception, match="(?i)already exists"):
        Enrichment(source, target).execute(meanwhile)
    assert sorted(r["k"] for r in target.snapshot().collect()) == ["y", "z"]


@pytest.mark.parametrize("partition", [None, "p"])
def test_files_stay_within_their_bytes(make_table, spark, partition):
    """Rows of many widths and kinds, with a hot partition; nothing compresses away."""
    import pathlib

    rows = spark.range(20_000).selectExpr(
        "string(id) k", "if(id % 3 = 0, 'x', 'y') p", "id ts",
        "repeat(sha2(string(id), 256), if(id % 2 = 0, 1, 6)) t", "array(id, id) a", "cast(id as decimal(38,0)) d")
    t = make_table(partition=partition)
    t.upsert(rows, file_bytes=200_000, options={"compression": "uncompressed"})
    files = list(pathlib.Path(t.spec.data_path).rglob("*.parquet"))
    assert len(files) > 10 and max(f.stat().st_size for f in files) <= 200_000
    assert t.snapshot().count() == 20_000
    with pytest.raises(ValueError, match="at least one byte"):
        t.upsert(rows, file_bytes=0)
