import random

import pytest
from pyspark.sql import functions as F

from keyedlog.functions.ip import UNKNOWN, ip_to_long, ip_valid, long_to_ip
from keyedlog.operators import sizing
from keyedlog.operators.range_join import check_rules, overlapping_rules, range_join
from keyedlog.operators.sweep_join import sweep_join, with_previous
from keyedlog.operators.self_join import self_join_totals, with_group_totals
from keyedlog.plans.enrich import Enrichment
from keyedlog.sources.rules import RULE_SCHEMA, read_ip_rules, with_address, with_place

TEXTS = ["1.2.3.4", "0.1.2.3", "256.1.1.1", "rider-213", "", None, "255.255.255.255", "01.2.3.4",
         "1.2.3", "1.2.3.4.5", "1.2.3.4\n", "x1.2.3.4", "1.2.3.4.", "300.1"]


def one_column(spark, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    return [r[1] for r in df.select("i", expression(F.col("t"))).orderBy("i").collect()]


def test_ip_numbers(spark):
    assert one_column(spark, ip_to_long) == [
        16909060, 66051, (256 << 24) + 65793, None, None, None, 4294967295, 16909060,
        66051, 4328719365, None, None, 16909060, 76801,
    ]


def test_valid_addresses(spark):
    assert one_column(spark, ip_valid) == [
        True, False, False, False, False, None, True, False, False, False, False, False, False, False,
    ]


def test_numbers_and_addresses_are_inverse(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 255, 256, 16909060, 4294967295)], "n bigint")
    assert df.where(ip_to_long(long_to_ip(F.col("n"))) != F.col("n")).count() == 0


def random_rules(rng, count, span):
    cuts = sorted(rng.sample(range(span), 2 * count))
    return [(cuts[2 * i], cuts[2 * i + 1], f"c{i}", "p", "t") for i in range(count)]


@pytest.mark.parametrize("limit", [sizing.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("width", [1, 64, 1 << 16])
def test_range_join_against_brute_force(spark, monkeypatch, limit, width):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", limit)
    rng = random.Random(width)
    rules = random_rules(rng, 20, 2000)
    ends = [n for r in rules for n in (r[0] - 1, r[0], r[1], r[1] + 1)]
    values = ends + [rng.randrange(-50, 2100) for _ in range(300)] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v bigint")
    found = range_join(df, spark.createDataFrame(rules, RULE_SCHEMA), F.col("v"), width=width)
    assert found.columns == ["i", "v", "start_num", "end_num", "country", "province", "city"]
    got = {r["i"]: r["country"] for r in found.collect()}

    def place(v):
        return next((r[2] for r in rules if v is not None and r[0] <= v <= r[1]), None)

    assert got == {i: place(v) for i, v in enumerate(values)} and found.count() == len(values)


def test_a_hot_value_keeps_every_row(spark, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 7, id) v")
    rules = spark.createDataFrame([(5, 9, "a", "b", "c")], RULE_SCHEMA)
    found = range_join(df, rules, F.col("v"))
    assert found.count() == 3000 and found.where("country = 'a'").count() == 1003


def test_overlapping_rules_are_found(spark):
    fine = [(0, 9, "a", "", ""), (10, 200000, "b", "", ""), (200001, 200001, "c", "", "")]
    check_rules(spark.createDataFrame(fine, RULE_SCHEMA), "start_num", "end_num")
    bad = spark.createDataFrame(fine + [(150000, 150001, "d", "", "")], RULE_SCHEMA)
    assert [r["country"] for r in overlapping_rules(bad, "start_num", "end_num").collect()] == ["b"]
    with pytest.raises(ValueError, match="rules overlap"):
        check_rules(bad, "start_num", "end_num")


def test_rule_files(spark, tmp_path):
    (tmp_path / "ip.txt").write_text('16777216|16777471|"澳大利亚|x|y\n0|5|a|b|c\n', encoding="utf-8")
    rules = read_ip_rules(spark, str(tmp_path / "ip.txt"))
    assert [f.dataType.simpleString() for f in rules.schema] == ["bigint", "bigint", "string", "string", "string"]
    assert sorted(map(tuple, rules.collect())) == [(0, 5, "a", "b", "c"), (16777216, 16777471, '"澳大利亚', "x", "y")]
    (tmp_path / "bad.txt").write_text("one|5|a|b|c\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_ip_rules(spark, str(tmp_path / "bad.txt")).collect()


def test_long_rule_lines_and_empty_fields(spark, tmp_path):
    (tmp_path / "ip.txt").write_text("0|5|land||c|more|fields\n\n6|9|other|p|\n")
    rules = read_ip_rules(spark, str(tmp_path / "ip.txt"))
    assert sorted(map(tuple, rules.collect())) == [(0, 5, "land", "", "c"), (6, 9, "other", "p", "")]
    df = spark.createDataFrame([("0.0.0.3",)], "ip string")
    assert tuple(with_place(df, rules, "ip").first()) == ("0.0.0.3", "land", "", "c")
    for bad in ("1|2|a|b", "x|2|a|b|c"):
        (tmp_path / "bad.txt").write_text(bad)
        with pytest.raises(Exception, match="not a rule|malformed"):
            read_ip_rules(spark, str(tmp_path / "bad.txt")).collect()


def test_overlapping_rules_are_refused_where_they_are_used(spark):
    rules = spark.createDataFrame([(0, 9, "a", "", ""), (5, 12, "b", "", "")], RULE_SCHEMA)
    df = spark.createDataFrame([("0.0.0.7",)], "ip string")
    with pytest.raises(ValueError, match="rules overlap"):
        with_place(df, rules, "ip")
    with pytest.raises(ValueError, match="rules overlap"):
        check_rules(rules.selectExpr("cast(start_num as decimal(38,0)) a", "cast(end_num as decimal(38,0)) b"),
                    "a", "b")


def test_rules_too_wide_for_bins_are_swept(spark):
    df = spark.createDataFrame([("0.0.0.7",), ("x",)], "ip string")
    wide = spark.createDataFrame([(5, 1 << 60, "a", "", ""), (3, 2, "b", "", "")], RULE_SCHEMA)
    found = with_place(df, wide, "ip", {"c": "country"})
    assert sorted(map(tuple, found.collect())) == [("0.0.0.7", "a"), ("x", UNKNOWN)]


@pytest.mark.parametrize("pieces, scale", [(1, 1), (7, 10 ** 34), (256, 10 ** 34)])
def test_sweep_against_brute_force(spark, pieces, scale):
    """Numbers of up to 38 digits, a hot value on a rule's border, values before and behind all rules."""
    rng = random.Random(pieces)
    rules = [(a * scale, b * scale, c) for a, b, c, *_ in random_rules(rng, 40, 2000)]
    ends = [n + d for r in rules for n in r[:2] for d in (-1, 0, 1)]
    values = ends + [rng.randrange(-50 * scale, 2100 * scale) for _ in range(300)] + [None] * 5
    values += [rules[20][0]] * 400
    kind = "decimal(38,0)"
    df = spark.createDataFrame([(i, v and str(v)) for i, v in enumerate(values)], "i int, v string")
    df = df.withColumn("v", F.col("v").cast(kind)).repartition(6)
    given = spark.createDataFrame([(str(a), str(b), c) for a, b, c in rules] + [("9", "3", "none")],
                                  "a string, b string, v string")
    given = given.select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b"), "v")
    found = sweep_join(df, given.withColumnRenamed("v", "place"), F.col("v"), "a", "b", pieces)
    assert found.columns == ["i", "v", "a", "b", "place"]
    got = {r["i"]: r["place"] for r in found.collect()}

    def place(v):
        return next((r[2] for r in rules if v is not None and r[0] <= v <= r[1]), None)

    assert got == {i: place(v) for i, v in enumerate(values)} and found.count() == len(values)


def test_sweep_deals_a_hot_value_to_many_pieces_and_plans_no_join_of_rules(spark):
    df = spark.range(20_000, numPartitions=8).selectExpr("id", "if(id % 3 = 0, id, 77) v")
    rules = spark.createDataFrame([(70, 80, "a", "b", "c")], RULE_SCHEMA)
    found = sweep_join(df, rules, F.col("v"))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert found.where("country = 'a'").count() == 13_336
    assert sweep_join(df.limit(0), rules, F.col("v")).count() == 0
    assert sweep_join(df, rules.limit(0), F.col("v")).where("country is null").count() == 20_000


def test_rows_with_the_row_before_them(spark):
    rng = random.Random(3)
    rows = [(n, f"t{n}") for n in rng.sample(range(10_000), 900)]
    df = spark.createDataFrame(rows, "n bigint, t string").repartition(9)
    found = with_previous(df, "n", {"before": "t", "n_before": "n"})
    ordered = sorted(rows)
    expected = {n: (t, None, None) if i == 0 else (t, ordered[i - 1][1], ordered[i - 1][0])
                for i, (n, t) in enumerate(ordered)}
    assert {r.n: (r.t, r.before, r.n_before) for r in found.collect()} == expected
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_part" in text


def test_addresses_default_to_unknown(spark):
    rules = spark.createDataFrame([(16909056, 16909311, "land", "p", "c")], RULE_SCHEMA)
    df = spark.createDataFrame([(t,) for t in ("1.2.3.4", "9.9.9.9", "rider-213", None)], "ip string")
    found = with_address(df, rules, "ip")
    assert [tuple(r) for r in found.collect()] == [
        ("1.2.3.4", "land"), ("9.9.9.9", UNKNOWN), ("rider-213", UNKNOWN), (None, UNKNOWN),
    ]


def test_all_parts_of_a_place_default_to_unknown(spark):
    rules = spark.createDataFrame([(0, 9, "land", None, "town")], RULE_SCHEMA)
    df = spark.createDataFrame([("0.0.0.7",), ("0.0.0.10",)], "`the.ip` string")
    assert [tuple(r)[1:] for r in with_place(df, rules, "the.ip").collect()] == [
        ("land", UNKNOWN, "town"), (UNKNOWN, UNKNOWN, UNKNOWN),
    ]


def test_incremental_enrichment_replaces_the_target_and_moves_on(make_table, frame):
    source, target = make_table("ip", partition="p"), make_table("address", partition="p")
    step = Enrichment(source, target)
    double = lambda df: df.withColumn("w", F.col("v") * 2)
    with pytest.raises(ValueError, match="does not exist"):
        step.execute(double)
    source.upsert(frame([("a", "x", 1, 1)]))
    step.execute(double)
    source.upsert(frame([("b", "x", 1, 2)]))
    step.execute(double)
    assert [(r["k"], r["w"]) for r in target.snapshot().collect()] == [("b", 4)]
    assert target.offsets() == {"ip": source.last_instant()}
    source.compact()
    assert step.execute(double) is None
    assert target.snapshot().count() == 1


def test_self_join_totals_against_the_join_itself(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "b", "c", None]), rng.randrange(100)) for _ in range(80)]
    df = spark.createDataFrame(rows, "k string, v bigint")
    a, b = df.toDF("k", "av"), df.toDF("bk", "bv")
    plain = a.join(b, a.k == b.bk, "left").groupBy("k").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("av").alias("left_v"), F.sum("bv").alias("right_v")
    )
    assert sorted(map(str, plain.collect())) == sorted(map(str, self_join_totals(df, "k", "v").collect()))


def test_group_totals_keep_one_row_per_left_row(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v bigint")
    found = with_group_totals(df, "k", {"n": F.count(F.lit(1))})
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(
        map(str, [("a", 1, "a", 2), ("a", 2, "a", 2), (None, 3, None, None)])
    )
