"""Range enrichment, joins and aggregates, scalar functions and offsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import KeyedTable, TableSpec
from ..functions.ip import UNKNOWN, ip_to_long, ip_valid
from ..functions.offsets import decode_offsets, encode_offsets, merge_offsets, offset_of
from ..functions.text import is_blank, is_not_blank
from ..operators.rows import drop_meta
from ..operators.self_join import self_join_totals, with_group_totals
from ..operators.sweep_join import sweep_join, with_previous
from ..plans.enrich import Enrichment
from ..sources.paths import scratch_path
from ..sources.rules import with_address, with_place
from .fixtures import (
    AFTER_FIRST_DAY, FIRST_DAY, SQL_RULES, SQL_TRIPS, as_double, ip_rules, ip_rules_from_file, table, trip_table,
    trips,
)


def ip_rules_load(spark, sf_dir):
    return ip_rules_from_file(spark, sf_dir)


def ip_rules_sorted(spark, sf_dir):
    """Rules in order, each with the end of the rule before it."""
    rules = with_previous(ip_rules(spark, sf_dir), "start_num", {"previous_end": "end_num"})
    return rules.orderBy("start_num")


def ip_enrich_wide(spark, sf_dir):
    """Country of every trip by numbers of 38 digits, as wide as IPv6 addresses, in a sorted sweep."""
    wide = "cast({} as decimal(38,0)) * cast('1' || repeat('0', 28) as decimal(29,0))"
    rules = ip_rules(spark, sf_dir).select(
        F.expr(wide.format("start_num")).alias("low"),
        (F.expr(wide.format("(end_num + 1)")) - 1).cast("decimal(38,0)").alias("high"), "country")
    found = trips(spark, sf_dir).withColumn("num", ip_to_long(F.col("rider"))).withColumn(
        "num", (F.expr(wide.format("num")) + F.col("uuid").cast("bigint")).cast("decimal(38,0)"))
    placed = sweep_join(found, rules, F.col("num"), "low", "high")
    return placed.select("uuid", F.coalesce("country", F.lit(UNKNOWN)).alias("address"))


def ip_enrich(spark, sf_dir):
    """Country of every trip's address."""
    found = with_address(trips(spark, sf_dir), ip_rules(spark, sf_dir), "rider")
    return found.select("uuid", "rider", "address")


def ip_places(spark, sf_dir):
    """Country, province and city of every trip's address."""
    found = with_place(trips(spark, sf_dir), ip_rules(spark, sf_dir), "rider")
    return found.select("uuid", "country", "province", "city")


def ip_enrich_incremental(spark, sf_dir):
    """New trips since the last run, with their country, replace the address table."""
    source = trip_table(spark)
    target = KeyedTable(
        spark,
        TableSpec("address", scratch_path(spark, "address"), "driver", "ts", "partitionpath"),
    )
    rules = ip_rules_from_file(spark, sf_dir)
    rows = trips(spark, sf_dir)
    for batch in (rows.where(FIRST_DAY), rows.where(AFTER_FIRST_DAY)):
        source.upsert(batch)
        Enrichment(source, target).execute(lambda new: with_address(new, rules, "rider"))
    return as_double(drop_meta(target.snapshot()), "fare")


def ip_to_long_query(spark, sf_dir):
    """Numbers of addresses, and of texts that are none."""
    found = trips(spark, sf_dir)
    return found.select(
        "uuid", ip_to_long(F.col("rider")).alias("ip_num"),
        ip_to_long(F.concat_ws(".", "rider", "partitionpath")).alias("no_num"),
    )


def ip_valid_query(spark, sf_dir):
    found = trips(spark, sf_dir)
    return found.select(
        "uuid", ip_valid(F.col("rider")).alias("valid"),
        ip_valid(F.concat("rider", F.lit(".1"))).alias("longer_valid"),
    )


def string_empty(spark, sf_dir):
    """Blank tests on texts of which some are NULL and some empty."""
    text = F.when(F.col("event_type") == "view", "").when(
        F.col("event_type") != "error", F.col("props")
    )
    return table(spark, sf_dir, "events").select(
        "event_id", is_blank(text).alias("blank"), is_not_blank(text).alias("filled")
    )


def group_sum_max(spark, sf_dir):
    found = trips(spark, sf_dir).groupBy("driver").agg(
        F.sum("fare").alias("fare"), F.max("ts").alias("ts")
    )
    return as_double(found, "fare")


def left_self_join(spark, sf_dir):
    """Pairs of trips with the same driver: their number and both fare totals, per driver."""
    found = self_join_totals(trips(spark, sf_dir), "driver", "fare")
    return as_double(found, "left_fare", "right_fare")


def left_join_star(spark, sf_dir):
    """``a.*, b.*``: every trip beside its driver's totals."""
    found = with_group_totals(
        trips(spark, sf_dir), "driver",
        {"trips": F.count(F.lit(1)), "fare": F.sum("fare"), "ts": F.max("ts")},
    )
    return as_double(found, "fare", "b_fare")


def _offset_maps(spark, sf_dir):
    """Per driver, the last trip of each kind before and since the second day, as two maps."""
    last = trips(spark, sf_dir).groupBy("driver", "partitionpath").agg(
        F.expr(f"max(cast(uuid as bigint)) filter (where {FIRST_DAY})").alias("old"),
        F.expr(f"max(cast(uuid as bigint)) filter (where {AFTER_FIRST_DAY})").alias("new"),
    )

    def collected(name):
        entry = f"struct(partitionpath, cast({name} as string))"
        entries = f"collect_list({entry}) filter (where {name} is not null)"
        return F.expr(f"map_from_entries({entries})").alias(name)

    # A driver has one entry per kind of trip, however many trips.
    return last.groupBy("driver").agg(collected("old"), collected("new"))


def offsets_encode(spark, sf_dir):
    maps = _offset_maps(spark, sf_dir)
    return maps.select(
        "driver",
        encode_offsets(merge_offsets(F.col("old"), F.col("new"))).alias("offsets"),
        encode_offsets(F.col("old")).alias("previous"),
    )


def offsets_decode(spark, sf_dir):
    text = encode_offsets(merge_offsets(F.col("old"), F.col("new")))
    maps = _offset_maps(spark, sf_dir).select("driver", decode_offsets(text).alias("offsets"))
    return maps.select("driver", F.explode("offsets").alias("source", "instant"))


def offsets_lookup(spark, sf_dir):
    """The first day's offset of every driver and kind of trip."""
    pairs = trips(spark, sf_dir).select("driver", "partitionpath").distinct()
    old = _offset_maps(spark, sf_dir).select("driver", "old")
    return pairs.join(old, "driver").select(
        "driver", "partitionpath", offset_of(F.col("old"), F.col("partitionpath")).alias("instant")
    )


QUERIES = {
    "ip_rules_load": ip_rules_load,
    "ip_rules_sorted": ip_rules_sorted,
    "ip_enrich": ip_enrich,
    "ip_enrich_wide": ip_enrich_wide,
    "ip_places": ip_places,
    "ip_enrich_incremental": ip_enrich_incremental,
    "ip_to_long": ip_to_long_query,
    "ip_valid": ip_valid_query,
    "string_empty": string_empty,
    "group_sum_max": group_sum_max,
    "left_self_join": left_self_join,
    "left_join_star": left_join_star,
    "offsets_encode": offsets_encode,
    "offsets_decode": offsets_decode,
    "offsets_lookup": offsets_lookup,
}

_OFFSETS = f"""with {SQL_TRIPS},
last as (
  select driver, partitionpath,
    max(cast(uuid as bigint)) filter (where first_day) as old,
    max(cast(uuid as bigint)) filter (where not first_day) as new
  from trips group by driver, partitionpath)"""

ORACLE = {
    "ip_rules_load": f"with {SQL_RULES} select * from rules",
    "ip_rules_sorted": f"""with {SQL_RULES}
select *, lag(end_num) over (order by start_num) as previous_end from rules order by start_num""",
    "ip_enrich_wide": f"""with {SQL_TRIPS}, {SQL_RULES}
select uuid, coalesce(country, '{UNKNOWN}') as address
from trips left join rules on num between start_num and end_num""",
    "ip_enrich": f"""with {SQL_TRIPS}, {SQL_RULES}
select uuid, rider, coalesce(country, '{UNKNOWN}') as address
from trips left join rules on num between start_num and end_num""",
    "ip_places": f"""with {SQL_TRIPS}, {SQL_RULES}
select uuid, coalesce(country, '{UNKNOWN}') as country, coalesce(province, '{UNKNOWN}') as province,
  coalesce(city, '{UNKNOWN}') as city
from trips left join rules on num between start_num and end_num""",
    "ip_enrich_incremental": f"""with {SQL_TRIPS}, {SQL_RULES},
newest as (select * from (
  select *, row_number() over (partition by driver, partitionpath order by ts desc) as rn
  from trips where not first_day) where rn = 1)
select uuid, ts, driver, rider, cast(fare as double) as fare, partitionpath,
  coalesce(country, '{UNKNOWN}') as address
from newest left join rules on num between start_num and end_num""",
    "ip_to_long": f"""with {SQL_TRIPS}
select uuid, num as ip_num, cast(null as bigint) as no_num from trips""",
    "ip_valid": f"""with {SQL_TRIPS}
select uuid, num >= 16777216 as valid, false as longer_valid from trips""",
    "string_empty": """select event_id, event_type in ('view', 'error') as blank,
  event_type not in ('view', 'error') as filled from events""",
    "group_sum_max": f"""with {SQL_TRIPS}
select driver, cast(sum(fare) as double) as fare, max(ts) as ts from trips group by driver""",
    "left_self_join": f"""with {SQL_TRIPS}
select a.driver, count(*) as pairs, cast(sum(a.fare) as double) as left_fare,
  cast(sum(b.fare) as double) as right_fare
from trips a left join trips b on a.driver = b.driver group by a.driver""",
    "left_join_star": f"""with {SQL_TRIPS},
b as (select driver, count(*) as trips, sum(fare) as fare, max(ts) as ts from trips group by driver)
select a.uuid, a.ts, a.driver, a.rider, cast(a.fare as double) as fare, a.partitionpath,
  b.driver as b_driver, b.trips as b_trips, cast(b.fare as double) as b_fare, b.ts as b_ts
from trips a left join b on a.driver = b.driver""",
    "offsets_encode": f"""{_OFFSETS}
select driver,
  string_agg(partitionpath || '+' || coalesce(new, old), ',' order by partitionpath) as offsets,
  coalesce(string_agg(partitionpath || '+' || old, ',' order by partitionpath)
    filter (where old is not null), '') as previous
from last group by driver""",
    "offsets_decode": f"""{_OFFSETS}
select driver, partitionpath as source, cast(coalesce(new, old) as varchar) as instant from last""",
    "offsets_lookup": f"""{_OFFSETS}
select driver, partitionpath, coalesce(cast(old as varchar), '000') as instant from last""",
}
