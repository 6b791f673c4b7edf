"""Merges of one keyed table into another."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import NO_PARTITION, KeyedTable, Merge, TableSpec
from ..operators.rows import drop_meta
from ..plans.merge import READ
from ..sources.paths import scratch_path
from .fixtures import AFTER_FIRST_DAY, FIRST_DAY, SQL_TRIPS, as_double, corrected, table, trip_table, trips
from .tables import _numbered


def _target(spark, key, partition=None, name="target"):
    return KeyedTable(spark, TableSpec(name, scratch_path(spark, name), key, "ts", partition))


def _days(spark, sf_dir):
    rows = trips(spark, sf_dir)
    return rows.where(FIRST_DAY), rows.where(AFTER_FIRST_DAY)


def _fares(spark, source, target):
    """Total fare and last time per driver, accumulated over commits."""
    return (
        Merge.from_table(spark, source.spec, "source")
        .aggregate(
            "select driver, sum(fare) as fare, max(ts) as ts from source group by driver",
            key="driver", partition=NO_PARTITION,
        )
        .into(target.spec, "target", on="source.driver = target.driver")
        .when_not_matched({"driver": "source.driver", "fare": "source.fare", "ts": "source.ts"})
        .when_matched({"fare": "source.fare + target.fare", "ts": "source.ts"})
    )


def _merged_fares(spark, sf_dir):
    source, target = trip_table(spark), _target(spark, "driver", name="fare")
    for batch in _days(spark, sf_dir):
        source.upsert(batch)
        _fares(spark, source, target).execute()
    return target


def merge_agg(spark, sf_dir):
    return as_double(drop_meta(_merged_fares(spark, sf_dir).snapshot()), "fare")


def merge_stats(spark, sf_dir):
    log = _merged_fares(spark, sf_dir).commits()
    read = F.col("meta")[READ].cast("bigint").alias("read")
    return _numbered(log).select("seq", "rows", "inserted", "updated", read)


def _by_driver(spark, source, target):
    """Latest trip per driver and kind, its fare added to the stored one."""
    return (
        Merge.from_table(spark, source.spec, "source")
        .key_by("driver")
        .into(
            target.spec, "target",
            on="source.driver = target.driver and source.partitionpath = target.partitionpath",
        )
        .when_not_matched({
            "driver": "source.driver", "fare": "source.fare",
            "partitionpath": "source.partitionpath", "ts": "source.ts",
        })
        .when_matched({"fare": "source.fare + target.fare", "ts": "source.ts"})
    )


def _half_merged(spark, sf_dir):
    """A target holding the first day, and a source that also has the rest."""
    source, target = trip_table(spark), _target(spark, "driver", "partitionpath")
    first, rest = _days(spark, sf_dir)
    source.upsert(first)
    _by_driver(spark, source, target).execute()
    source.upsert(rest)
    return source, target


def merge_mixed(spark, sf_dir):
    source, target = _half_merged(spark, sf_dir)
    _by_driver(spark, source, target).execute()
    return as_double(drop_meta(target.snapshot()), "fare")


def merge_update(spark, sf_dir):
    return as_double(_by_driver(spark, *_half_merged(spark, sf_dir)).updates(), "fare")


def merge_insert(spark, sf_dir):
    return as_double(_by_driver(spark, *_half_merged(spark, sf_dir)).inserts(), "fare")


def merge_all_insert(spark, sf_dir):
    source, target = trip_table(spark), _target(spark, "driver", "partitionpath")
    source.upsert(trips(spark, sf_dir))
    _by_driver(spark, source, target).execute()
    return as_double(drop_meta(target.snapshot()), "fare")


def merge_all_update(spark, sf_dir):
    """Every trip merged, then every trip again."""
    source, target = trip_table(spark), _target(spark, "uuid", "partitionpath")
    merge = (
        Merge.from_table(spark, source.spec, "source")
        .into(target.spec, "target", on="source.uuid = target.uuid")
        .when_matched({"fare": "source.fare + target.fare"})
        .when_not_matched()
    )
    for _ in range(2):
        source.upsert(trips(spark, sf_dir))
        merge.execute()
    return as_double(drop_meta(target.snapshot()), "fare")


def merge_key_fn(spark, sf_dir):
    """Target keys are driver names with a prefix."""
    source, target = trip_table(spark), _target(spark, "driver_key")
    merge = (
        Merge.from_table(spark, source.spec, "source")
        .key_by("driver", lambda c: F.concat(F.lit("k"), c))
        .partition_by(NO_PARTITION)
        .into(target.spec, "target", on="concat('k', source.driver) = target.driver_key")
        .when_not_matched({
            "driver_key": "concat('k', source.driver)", "fare": "source.fare", "ts": "source.ts",
        })
        .when_matched({"fare": "source.fare + target.fare", "ts": "source.ts"})
    )
    for batch in _days(spark, sf_dir):
        source.upsert(batch)
        merge.execute()
    return as_double(drop_meta(target.snapshot()), "fare")


def merge_partition_fn(spark, sf_dir):
    """Target partitions are the trip kinds in capitals."""
    source, target = trip_table(spark), _target(spark, "driver", "kind")
    merge = (
        Merge.from_table(spark, source.spec, "source")
        .key_by("driver")
        .partition_by("partitionpath", F.upper)
        .into(
            target.spec, "target",
            on="source.driver = target.driver and upper(source.partitionpath) = target.kind",
        )
        .when_not_matched({
            "driver": "source.driver", "kind": "upper(source.partitionpath)",
            "fare": "source.fare", "ts": "source.ts",
        })
        .when_matched({"fare": "source.fare + target.fare", "ts": "source.ts"})
    )
    for batch in _days(spark, sf_dir):
        source.upsert(batch)
        merge.execute()
    return as_double(drop_meta(target.snapshot()), "fare")


def merge_insert_default(spark, sf_dir):
    """No insert rule: new trips bring all their columns. Corrected trips replace the fare."""
    source, target = trip_table(spark), _target(spark, "uuid", "partitionpath")
    merge = (
        Merge.from_table(spark, source.spec, "source")
        .into(target.spec, "target", on="source.uuid = target.uuid")
        .when_matched({"fare": "source.fare"})
    )
    first, rest = _days(spark, sf_dir)
    for batch in (first, rest.unionByName(corrected(first))):
        source.upsert(batch)
        merge.execute()
    return as_double(drop_meta(target.snapshot()), "fare")


def merge_two_sources(spark, sf_dir):
    """Customers log in, then their orders add a column ``money``."""
    login = _target(spark, "pid", name="login")
    recharge = _target(spark, "pid", name="recharge")
    user = _target(spark, "pid", name="user")
    login.overwrite(
        table(spark, sf_dir, "customer").selectExpr(
            "cast(c_custkey as string) as pid", "timestamp_ntz '2001-01-01 00:00:00' as ts"
        )
    )
    recharge.overwrite(
        table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("pid")).agg(
            F.sum(F.col("o_totalprice").cast("decimal(14,2)")).alias("money"),
            F.max("o_orderdate").alias("ts"),
        )
    )
    (
        Merge.from_table(spark, login.spec, "login")
        .into(user.spec, "user", on="login.pid = user.pid")
        .when_not_matched({"pid": "login.pid", "ts": "login.ts"})
        .when_matched({"ts": "login.ts"})
        .execute()
    )
    (
        Merge.from_table(spark, recharge.spec, "recharge")
        .into(user.spec, "user", on="recharge.pid = user.pid")
        .when_not_matched({"pid": "recharge.pid", "money": "recharge.money", "ts": "recharge.ts"})
        .when_matched({"money": "recharge.money"})
        .execute()
    )
    return as_double(drop_meta(user.snapshot()), "money")


QUERIES = {
    "merge_agg": merge_agg,
    "merge_mixed": merge_mixed,
    "merge_update": merge_update,
    "merge_insert": merge_insert,
    "merge_all_insert": merge_all_insert,
    "merge_all_update": merge_all_update,
    "merge_key_fn": merge_key_fn,
    "merge_partition_fn": merge_partition_fn,
    "merge_insert_default": merge_insert_default,
    "merge_two_sources": merge_two_sources,
    "merge_stats": merge_stats,
}

_SUMS = f"""with {SQL_TRIPS},
a as (select driver, sum(fare) as fare, max(ts) as ts from trips where first_day group by driver),
b as (select driver, sum(fare) as fare, max(ts) as ts from trips where not first_day group by driver)"""


def _latest_pair(identity: str) -> str:
    """The latest trip per identity of the first day (``a``) and of the rest (``b``)."""
    def one(name: str, condition: str) -> str:
        return f"""{name} as (
  select * from (select *, row_number() over (partition by {identity} order by ts desc) as rn
    from trips where {condition}) where rn = 1)"""

    return f"with {SQL_TRIPS},\n{one('a', 'first_day')},\n{one('b', 'not first_day')}"


_FARE = """cast(case when a.fare is null then b.fare when b.fare is null then a.fare
    else a.fare + b.fare end as double) as fare"""
_PAIR = "driver, partitionpath"

ORACLE = {
    "merge_agg": f"""{_SUMS}
select coalesce(b.driver, a.driver) as driver, {_FARE}, coalesce(b.ts, a.ts) as ts
from a full join b on a.driver = b.driver""",
    "merge_stats": f"""{_SUMS}
select 1 as seq, count(*) as rows, count(*) as inserted, 0 as updated, count(*) as read from a
union all
select 2, count(*), count(*) filter (where a.driver is null),
  count(*) filter (where a.driver is not null), count(*)
from b left join a on a.driver = b.driver""",
    "merge_mixed": f"""{_latest_pair(_PAIR)}
select driver, partitionpath, {_FARE}, coalesce(b.ts, a.ts) as ts
from a full join b using ({_PAIR})""",
    "merge_update": f"""{_latest_pair(_PAIR)}
select trips.driver, trips.partitionpath, cast(trips.fare + a.fare as double) as fare, trips.ts
from trips join a on trips.driver = a.driver and trips.partitionpath = a.partitionpath
where not trips.first_day""",
    "merge_insert": f"""{_latest_pair(_PAIR)}
select driver, partitionpath, cast(fare as double) as fare, ts from trips
where not first_day and not exists (
  select 1 from a where a.driver = trips.driver and a.partitionpath = trips.partitionpath)""",
    "merge_all_insert": f"""with {SQL_TRIPS}
select driver, partitionpath, cast(fare as double) as fare, ts from (
  select *, row_number() over (partition by {_PAIR} order by ts desc) as rn from trips)
where rn = 1""",
    "merge_all_update": f"""with {SQL_TRIPS}
select uuid, ts, driver, rider, partitionpath, cast(fare * 2 as double) as fare from trips""",
    "merge_key_fn": f"""{_latest_pair('driver')}
select 'k' || driver as driver_key, {_FARE}, coalesce(b.ts, a.ts) as ts
from a full join b using (driver)""",
    "merge_partition_fn": f"""{_latest_pair(_PAIR)}
select driver, upper(partitionpath) as kind, {_FARE}, coalesce(b.ts, a.ts) as ts
from a full join b using ({_PAIR})""",
    "merge_insert_default": f"""with {SQL_TRIPS}
select uuid, ts, driver, rider, partitionpath,
  cast(case when first_day and partitionpath = 'error' then fare * 2 else fare end as double) as fare
from trips""",
    "merge_two_sources": """with r as (
  select o_custkey, sum(cast(o_totalprice as decimal(14,2))) as money, max(o_orderdate) as ts
  from orders group by o_custkey)
select cast(coalesce(c_custkey, o_custkey) as varchar) as pid, cast(money as double) as money,
  case when c_custkey is null then r.ts else timestamp '2001-01-01 00:00:00' end as ts
from customer full join r on c_custkey = o_custkey""",
}
