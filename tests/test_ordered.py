import random

from pyspark.sql import functions as F

from keyedlog.operators.ordered import sorted_rows, with_places


def test_places_against_sorting_in_one_piece(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([None, *range(20)]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, _at int").repartition(7)
    found = with_places(df, ["g"], ["v", "_at"])
    assert found.columns == ["g", "v", "_at", "place", "rows"]
    got = {r["_at"]: (r["place"], r["rows"]) for r in found.collect()}
    for g in ("a", "b", None):
        of = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [got[r[2]] for r in of] == [(i, len(of)) for i in range(len(of))]


def test_one_hot_value_is_dealt_to_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(30_000).selectExpr("if(id % 3 = 0, id, 7) v")
        parts = sorted_rows(df, ["v"], "p", "r").where("v = 7").groupBy("p").count().collect()
        found = with_places(df, [], ["v"], "place", "rows")
        assert len(parts) >= 3 and max(p["count"] for p in parts) < 8_000
        assert found.agg(F.countDistinct("place"), F.max("place"), F.max("rows")).first()[:] == (
            30_000, 29_999, 30_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_places_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, place int")
    found = with_places(empty, ["g"], ["g"])
    assert found.columns == ["g", "place", "rows"] and found.count() == 0
