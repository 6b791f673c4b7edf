"""Inputs of the registered queries, as DataFrames and as DuckDB common table expressions.

Every input takes whole tables. Where a query needs two commits, the table is cut by time: the
first day or the first half of the month, and all the rest, rows without a time included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import KeyedTable, TableSpec
from ..functions.ip import long_to_ip
from ..sources.paths import scratch_path
from ..sources.rules import RULE_SEPARATOR, read_ip_rules

FIRST_DAY = "ts < timestamp_ntz '2024-01-02 00:00:00'"
FIRST_HALF = "ts < timestamp_ntz '2024-01-16 00:00:00'"
AFTER_FIRST_DAY = f"not coalesce({FIRST_DAY}, false)"
AFTER_FIRST_HALF = f"not coalesce({FIRST_HALF}, false)"

TRIP_COLUMNS = ["uuid", "ts", "driver", "rider", "fare", "partitionpath"]

# Events spread over all IPv4 numbers by a multiplicative hash.
IP_NUMBER = "((event_id % 2147483648) * 2654435761) % 4294967296"

SQL_TRIPS = f"""numbered as (select *, {IP_NUMBER} as num from events),
trips as (
  select cast(event_id as varchar) as uuid, ts, cast(user_id as varchar) as driver,
    (num >> 24) || '.' || ((num >> 16) & 255) || '.' || ((num >> 8) & 255) || '.' || (num & 255)
      as rider,
    cast(value as decimal(12,2)) as fare, event_type as partitionpath, num,
    coalesce(ts < timestamp '2024-01-02 00:00:00', false) as first_day,
    coalesce(ts < timestamp '2024-01-16 00:00:00', false) as first_half
  from numbered)"""

# One block of addresses per customer, of which the last quarter belongs to nobody.
SQL_RULES = """blocks as (
  select *, 4294967296 // (select max(c_custkey) + 1 from customer) as step from customer),
rules as (
  select c_custkey * step as start_num, c_custkey * step + step * 3 // 4 - 1 as end_num,
    n_name as country, r_name as province, c_mktsegment as city
  from blocks join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").cast("string").alias("uuid"),
        "ts",
        F.col("user_id").cast("string").alias("driver"),
        long_to_ip(F.expr(IP_NUMBER)).alias("rider"),
        F.col("value").cast("decimal(12,2)").alias("fare"),
        F.col("event_type").alias("partitionpath"),
    )


def corrected(rows: DataFrame) -> DataFrame:
    """Error trips sent again at twice the fare."""
    return rows.where("partitionpath = 'error'").withColumn(
        "fare", (F.col("fare") * 2).cast("decimal(12,2)")
    )


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def trip_table(spark: SparkSession, partition: str | None = "partitionpath") -> KeyedTable:
    spec = TableSpec("trip", scratch_path(spark, "trip"), "uuid", "ts", partition)
    return KeyedTable(spark, spec)


def ip_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    step = customer.agg(F.expr("4294967296 div (max(c_custkey) + 1)")).scalar()
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        customer.withColumn("step", step)
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "c_custkey * step as start_num",
            "c_custkey * step + (step * 3) div 4 - 1 as end_num",
            "n_name as country",
            "r_name as province",
            "c_mktsegment as city",
        )
    )


def ip_rules_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules, written as text lines and read back."""
    path = scratch_path(spark, "rules")
    rules = ip_rules(spark, sf_dir)
    rules.select(F.concat_ws(RULE_SEPARATOR, *rules.columns)).write.text(path)
    return read_ip_rules(spark, path)
