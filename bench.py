"""Headline timings: one cold run and three warm runs each, of which the median counts.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Tables are built before the clock starts, except for the writes themselves. Results are read
completely and thrown away. The last line is one JSON object.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from keyedlog import KeyedTable, TableSpec
from keyedlog.queries import enrich, merges
from keyedlog.queries.fixtures import AFTER_FIRST_DAY, AFTER_FIRST_HALF, FIRST_DAY, FIRST_HALF, ip_rules_from_file, table, trip_table, trips
from keyedlog.session import scale_conf
from keyedlog.sources.paths import scratch_path
from keyedlog.sources.rules import with_address

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
WARM_RUNS = int(os.environ.get("BENCH_WARM_RUNS", "3"))


def session() -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("keyedlog-bench")
    for name, value in scale_conf(64 << 20, CPUS).items():
        builder = builder.config(name, value)
    spark = (
        builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def read_all(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def clock(prepare, run) -> tuple[float, float]:
    """Seconds of the cold run and the median of the warm ones."""
    times = []
    for _ in range(1 + WARM_RUNS):
        given = prepare()
        start = time.perf_counter()
        run(given)
        times.append(time.perf_counter() - start)
    return times[0], statistics.median(times[1:])


def cases(spark):
    rows = trips(spark, SF_DIR)
    history = trip_table(spark)
    first = history.upsert(rows.where(FIRST_HALF)).instant
    second = history.upsert(rows.where(AFTER_FIRST_HALF)).instant
    rules = ip_rules_from_file(spark, SF_DIR)

    items = table(spark, SF_DIR, "lineitem").withColumns({
        "id": F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
        "part": F.concat(F.lit("part"), F.col("l_suppkey") % 10),
    })
    spec = TableSpec("item", scratch_path(spark, "item"), "id", "l_shipdate", "part")
    item = KeyedTable(spark, spec)
    item.upsert(items)
    pairs = [tuple(r) for r in items.select("id", "part").limit(100).collect()]
    keys = table(spark, SF_DIR, "lineitem").select("l_orderkey", "l_linestatus")
    orders = KeyedTable(
        spark,
        TableSpec("o", scratch_path(spark, "o"), "o_orderkey", "o_orderdate", "o_orderstatus"),
    )
    orders.upsert(table(spark, SF_DIR, "orders"))

    def merge_of(build, key, partition=None):
        """A source with one consumed and one new commit, ready to be merged."""
        source, target = trip_table(spark), merges._target(spark, key, partition)
        source.upsert(rows.where(FIRST_DAY))
        build(spark, source, target).execute()
        source.upsert(rows.where(AFTER_FIRST_DAY))
        return build(spark, source, target)

    def nothing():
        return None

    yield "write_upsert", lambda: trip_table(spark), lambda t: t.upsert(rows)
    yield "snapshot_read", nothing, lambda _: read_all(history.snapshot())
    yield "incremental_read", nothing, lambda _: read_all(history.incremental(first, second))
    yield "key_lookup_1", nothing, lambda _: read_all(item.lookup(pairs[:1]))
    yield "key_lookup_100", nothing, lambda _: read_all(item.lookup(pairs))
    yield "key_lookup_many", nothing, lambda _: read_all(orders.lookup(keys))
    yield "merge_agg", lambda: merge_of(merges._fares, "driver"), lambda m: m.execute()
    yield (
        "merge_mixed", lambda: merge_of(merges._by_driver, "driver", "partitionpath"),
        lambda m: m.execute(),
    )
    yield "ip_enrich", nothing, lambda _: read_all(with_address(rows, rules, "rider"))
    yield "left_self_join", nothing, lambda _: read_all(enrich.left_self_join(spark, SF_DIR))


def main() -> None:
    spark = session()
    warm, cold = {}, {}
    for name, prepare, run in cases(spark):
        first, median = clock(prepare, run)
        cold[name], warm[name] = round(first, 3), round(median, 3)
    print(json.dumps({
        "metric": "sum of median warm seconds", "value": round(sum(warm.values()), 3),
        "unit": "sec", "queries": warm, "cold": cold, "sf": SF_DIR.rstrip("/").rpartition("sf")[2],
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
