"""Key lookup over table sizes and partition counts: one key, and one hundred.

    python benchmarks/lookup_sweep.py [largest row total]

Keys are row numbers as text and rows take turns over the partitions.
"""

from __future__ import annotations

import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keyedlog import KeyedTable, TableSpec  # noqa: E402
from keyedlog.sources.paths import scratch_path  # noqa: E402

# The row totals and partition counts to try.
TOTALS = [10_000, 20_000, 40_000, 70_000, 100_000, 500_000, 1_000_000, 2_000_000]
PARTITIONS = [1, 2, 4, 7, 10, 50, 100, 200]
#: Largest data file written, in rows; about 20 MiB of these rows.
FILE_ROWS = 500_000


def main() -> None:
    largest = int(sys.argv[1]) if len(sys.argv) > 1 else TOTALS[-1]
    spark = (
        SparkSession.builder.master("local[8]").appName("lookup-sweep")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    print("rows,partitions,write_s,one_key_ms,hundred_keys_ms")
    for total in [t for t in TOTALS if t <= largest]:
        for parts in PARTITIONS:
            rows = spark.range(total).select(
                F.col("id").cast("string").alias("uuid"),
                F.concat(F.lit("part"), F.col("id") % parts).alias("part"),
                F.col("id").alias("ts"),
                F.concat(F.lit("driver-"), F.xxhash64("id")).alias("driver"),
                F.concat(F.lit("rider-"), F.xxhash64("id", F.lit(1))).alias("rider"),
                (F.rand(7) * 100).alias("fare"),
            )
            spec = TableSpec("sweep", scratch_path(spark, "sweep"), "uuid", "ts", "part")
            kept = KeyedTable(spark, spec)
            start = time.perf_counter()
            kept.overwrite(rows, options={"maxRecordsPerFile": str(FILE_ROWS)})
            wrote = time.perf_counter() - start
            took = []
            for count in (1, 100):
                keys = [(str(i), f"part{i % parts}") for i in range(count)]
                start = time.perf_counter()
                found = len(kept.lookup(keys).collect())
                took.append(round(1000 * (time.perf_counter() - start)))
                assert found == count, (total, parts, count, found)
            print(f"{total},{parts},{wrote:.2f},{took[0]},{took[1]}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
