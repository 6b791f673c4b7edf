"""Reads and writes of keyed tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import KeyedTable, TableSpec
from ..checks import schema_differences
from ..operators.rows import dedupe, distinct_keys, drop_meta, with_identity
from ..sources.json_lines import json_records
from ..sources.paths import path_exists, scratch_path
from .fixtures import (
    AFTER_FIRST_DAY, AFTER_FIRST_HALF, FIRST_DAY, FIRST_HALF, SQL_TRIPS, TRIP_COLUMNS, as_double, corrected, table, trip_table, trips,
)

_TRIPS = ", ".join(c if c != "fare" else "cast(fare as double) as fare" for c in TRIP_COLUMNS)


def _history(spark, sf_dir, partition="partitionpath"):
    """A trip table with two commits: the first half of the month, then the rest."""
    rows = trips(spark, sf_dir)
    kept = trip_table(spark, partition)
    kept.upsert(rows.where(FIRST_HALF))
    kept.upsert(rows.where(AFTER_FIRST_HALF))
    return kept


def _result(df):
    return as_double(drop_meta(df), "fare")


def snapshot_read(spark, sf_dir):
    rows = trips(spark, sf_dir)
    first = rows.where(FIRST_HALF)
    kept = trip_table(spark)
    kept.upsert(first)
    kept.upsert(corrected(first).unionByName(rows.where(AFTER_FIRST_HALF)))
    return _result(kept.snapshot())


def write_overwrite(spark, sf_dir):
    rows = trips(spark, sf_dir)
    kept = trip_table(spark)
    kept.upsert(rows.where(FIRST_HALF))
    kept.overwrite(rows.where(AFTER_FIRST_HALF))
    return _result(kept.snapshot())


def write_upsert(spark, sf_dir):
    """All orders, then the open ones again as filled."""
    orders = table(spark, sf_dir, "orders")
    spec = TableSpec("orders", scratch_path(spark, "orders"), "o_orderkey", "o_orderdate")
    kept = KeyedTable(spark, spec)
    kept.overwrite(orders)
    kept.upsert(
        orders.where("o_orderstatus = 'O'").withColumns(
            {"o_orderstatus": F.lit("F"), "o_totalprice": F.col("o_totalprice") + 1.0}
        )
    )
    return drop_meta(kept.snapshot())


def snapshot_buckets(spark, sf_dir):
    """All orders in buckets, most of them written again at a higher price, and some deleted."""
    orders = table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("double"))
    spec = TableSpec(
        "orders", scratch_path(spark, "buckets"), "o_orderkey", "o_orderdate", "o_orderstatus", buckets=16)
    kept = KeyedTable(spark, spec)
    kept.upsert(orders)
    kept.upsert(orders.where("o_custkey % 7 > 0").withColumn("o_totalprice", F.col("o_totalprice") + 1000))
    kept.delete(orders.where("o_custkey % 7 = 3"))
    return drop_meta(KeyedTable.open(spark, spec.path).snapshot()).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def precombine_dedupe(spark, sf_dir):
    """The latest trip of every driver."""
    spec = TableSpec("driver", "-", "driver", "ts")
    rows = dedupe(with_identity(trips(spark, sf_dir), spec), "ts")
    return _result(rows)


def _driver_table(spark, sf_dir, partition):
    spec = TableSpec("driver", scratch_path(spark, "driver"), "driver", "ts", partition)
    kept = KeyedTable(spark, spec)
    rows = trips(spark, sf_dir)
    kept.upsert(rows.where(FIRST_DAY))
    kept.upsert(rows.where(AFTER_FIRST_DAY))
    return kept


def nonpartitioned_upsert(spark, sf_dir):
    return _result(_driver_table(spark, sf_dir, None).snapshot())


def partitioned_read(spark, sf_dir):
    return _result(_driver_table(spark, sf_dir, "partitionpath").snapshot())


def incremental_read(spark, sf_dir):
    kept = _history(spark, sf_dir)
    first, second = (c.instant for c in kept.timeline().commits)
    return _result(kept.incremental(first, second))


def incremental_empty(spark, sf_dir):
    kept = _history(spark, sf_dir)
    last = kept.last_instant()
    return _result(kept.incremental(last, last))


def _delete_errors(spark, sf_dir):
    kept = _history(spark, sf_dir)
    errors = drop_meta(kept.snapshot()).where("partitionpath = 'error'")
    kept.delete(errors.select("uuid", "partitionpath", "ts"))
    return kept


def delete_by_key(spark, sf_dir):
    return _result(_delete_errors(spark, sf_dir).snapshot())


def count_after_delete(spark, sf_dir):
    return _delete_errors(spark, sf_dir).snapshot().agg(F.count(F.lit(1)).alias("n"))


def _order_table(spark, sf_dir):
    spec = TableSpec(
        "orders", scratch_path(spark, "orders"), "o_orderkey", "o_orderdate", "o_orderstatus"
    )
    kept = KeyedTable(spark, spec)
    kept.upsert(table(spark, sf_dir, "orders"))
    return kept


def key_lookup(spark, sf_dir):
    """Orders whose key and status are those of some line item."""
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linestatus")
    return drop_meta(_order_table(spark, sf_dir).lookup(keys))


# Keys asked for by list: present or not, depending on the status the order has.
LISTED_KEYS = [(k, s) for k in ("0", "1", "17", "42", "99", "no-such-order") for s in "FO"]


def key_lookup_list(spark, sf_dir):
    return drop_meta(_order_table(spark, sf_dir).lookup(LISTED_KEYS))


def key_lookup_missing(spark, sf_dir):
    """Hits of all line items in a table never written, and in one keyed differently."""
    keys = table(spark, sf_dir, "lineitem").selectExpr("concat('x', l_orderkey)", "l_linestatus")
    kept = _order_table(spark, sf_dir)
    absent = KeyedTable(
        spark, TableSpec("none", scratch_path(spark, "none"), "o_orderkey", "o_orderdate", "o_orderstatus")
    )
    count = F.count(F.lit(1)).alias("hits")
    none = absent.lookup(keys, kept.schema()).agg(count).select(F.lit("absent").alias("case"), "hits")
    return none.unionByName(
        kept.lookup(keys).agg(count).select(F.lit("no match").alias("case"), "hits")
    )


def distinct_keys_query(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    pairs = distinct_keys(items, F.col("l_orderkey"), F.col("l_linestatus"))
    return pairs.toDF("record_key", "partition_path")


def limit_keys(spark, sf_dir):
    """The first two keys, as candidates for a delete."""
    kept = _history(spark, sf_dir)
    return kept.snapshot().select("uuid", "partitionpath", "ts").orderBy("uuid").limit(2)


def select_filter(spark, sf_dir):
    """A snapshot registered as a view and queried by name."""
    _history(spark, sf_dir).snapshot().createOrReplaceTempView("keyedlog_trips")
    found = spark.sql("select driver, fare, ts from keyedlog_trips where fare > 20.0")
    spark.catalog.dropTempView("keyedlog_trips")
    return as_double(found, "fare")


def json_source(spark, sf_dir):
    """Event properties as columns, with a schema inferred from all of them."""
    events = table(spark, sf_dir, "events")
    text = F.concat(
        F.lit('{"event_id": '), "event_id", F.lit(', "props": '), "props", F.lit("}")
    )
    return json_records(events.select(text.alias("line")), "line").select("event_id", "props.k")


def _numbered(log):
    """Commits of one table, numbered in order instead of showing their instants."""
    order = Window.partitionBy("spec.name").orderBy("instant")
    return log.withColumn("seq", F.row_number().over(order))


def commit_timeline(spark, sf_dir):
    kept = _delete_errors(spark, sf_dir)
    kept.compact()
    kept.overwrite(trips(spark, sf_dir))
    return _numbered(kept.commits()).select("seq", "kind", "rows")


def commit_metadata(spark, sf_dir):
    kept = trip_table(spark)
    rows = trips(spark, sf_dir)
    kept.overwrite(rows.where(FIRST_HALF), meta={"_test": "test"})
    kept.upsert(rows.where(AFTER_FIRST_HALF), meta={"_test": "again", "_note": "second half"})
    return _numbered(kept.commits()).select(
        "seq", "rows", F.col("meta")["_test"].alias("test"), F.col("meta")["_note"].alias("note"),
        F.from_json("schema", "fields array<struct<name string>>")["fields"]["name"][0].alias("first_column"),
    )


def open_table(spark, sf_dir):
    """A table known by its path alone."""
    kept = _order_table(spark, sf_dir)
    return drop_meta(KeyedTable.open(spark, kept.spec.path).snapshot())


def scheme_path(spark, sf_dir):
    """The same table by a path that names its file system, and one that is not there."""
    path = _order_table(spark, sf_dir).spec.path
    full = path if ":" in path else f"file://{path}"
    rows = KeyedTable.open(spark, full).snapshot().agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumns({
        "there": F.lit(path_exists(spark, full)), "elsewhere": F.lit(path_exists(spark, full + "-x")),
    })


def table_schema(spark, sf_dir):
    """Columns and types of a table that got a column with its second commit."""
    kept = _order_table(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    kept.upsert(orders.where("o_orderstatus = 'O'").withColumn("o_checked", F.lit(True)))
    fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(kept.schema().fields)]
    return spark.createDataFrame(fields, "place int, name string, type string")


def schema_differences_query(spark, sf_dir):
    """How an input with a new, a missing and a changed column differs from the table."""
    kept = _order_table(spark, sf_dir)
    other = table(spark, sf_dir, "orders").drop("o_orderpriority").withColumns(
        {"o_custkey": F.col("o_custkey").cast("string"), "o_checked": F.lit(True)})
    found = schema_differences(other.schema, kept.schema())
    return spark.createDataFrame([(line,) for line in found], "difference string")


def _files_of(spark, sf_dir, **kwargs):
    """Rows of each file that a write of all orders made."""
    spec = TableSpec("orders", scratch_path(spark, "orders"), "o_orderkey", "o_orderdate")
    kept = KeyedTable(spark, spec)
    instant = kept.upsert(table(spark, sf_dir, "orders"), **kwargs).instant
    rows = spark.read.parquet(spec.batch_path(instant))
    return rows.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))


def file_sizes(spark, sf_dir):
    """No file holds more rows than the writer was told."""
    files = _files_of(spark, sf_dir, options={"maxRecordsPerFile": "500"})
    return files.agg((F.max("n") <= 500).alias("within"), F.sum("n").alias("n"))


def file_bytes(spark, sf_dir):
    """Narrow and wide rows, overwritten with writer options: no data file is larger than it may be."""
    limit = 64 * 1024
    orders = table(spark, sf_dir, "orders")
    wide = orders.withColumn("note", F.expr("repeat(sha2(cast(o_orderkey as string), 256), 20)"))
    found = None
    for name, rows in (("narrow", orders), ("wide", wide)):
        spec = TableSpec(name, scratch_path(spark, name), "o_orderkey", "o_orderdate")
        kept = KeyedTable(spark, spec)
        kept.overwrite(rows, file_bytes=limit, options={"compression": "uncompressed"})
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.parquet").load(spec.data_path)
        for part in (
            files.select(F.lit(name).alias("width"), F.lit(0).alias("row"), (F.col("length") <= limit).alias("within")),
            kept.snapshot().select(F.lit(name), F.lit(1), F.lit(True)),
        ):
            found = part if found is None else found.unionAll(part)
    return found.groupBy("width").agg(F.sum("row").alias("n"), F.bool_and("within").alias("within"))


def write_parallelism(spark, sf_dir):
    """As many files as write tasks were asked for."""
    files = _files_of(spark, sf_dir, parallelism=3)
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("n"))


QUERIES = {
    "open_table": open_table,
    "scheme_path": scheme_path,
    "table_schema": table_schema,
    "schema_differences": schema_differences_query,
    "file_sizes": file_sizes,
    "file_bytes": file_bytes,
    "write_parallelism": write_parallelism,
    "snapshot_read": snapshot_read,
    "write_overwrite": write_overwrite,
    "write_upsert": write_upsert,
    "snapshot_buckets": snapshot_buckets,
    "precombine_dedupe": precombine_dedupe,
    "nonpartitioned_upsert": nonpartitioned_upsert,
    "partitioned_read": partitioned_read,
    "incremental_read": incremental_read,
    "incremental_empty": incremental_empty,
    "delete_by_key": delete_by_key,
    "count_after_delete": count_after_delete,
    "key_lookup": key_lookup,
    "key_lookup_list": key_lookup_list,
    "key_lookup_missing": key_lookup_missing,
    "distinct_keys": distinct_keys_query,
    "limit_keys": limit_keys,
    "select_filter": select_filter,
    "json_source": json_source,
    "commit_timeline": commit_timeline,
    "commit_metadata": commit_metadata,
}


def _latest_trip(identity: str) -> str:
    return f"""with {SQL_TRIPS}
select {_TRIPS} from (
  select *, row_number() over (partition by {identity} order by ts desc) as rn from trips)
where rn = 1"""


# Columns of the orders table in order, as the schema query shows them.
_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                  "o_orderpriority"]
_COLUMN_TYPES = " union all ".join(
    f"select distinct {i} as place, '{name}' as name, "
    f"case lower(typeof({name})) when 'varchar' then 'string' when 'integer' then 'int' "
    f"when 'timestamp' then 'timestamp_ntz' else lower(typeof({name})) end as type from orders"
    for i, name in enumerate(_ORDER_COLUMNS))

_LISTED = ", ".join(f"('{key}', '{status}')" for key, status in LISTED_KEYS)

ORACLE = {
    "open_table": "select * from orders",
    "scheme_path": "select count(*) as n, true as there, false as elsewhere from orders",
    "table_schema": f"{_COLUMN_TYPES} union all select 6, 'o_checked', 'boolean'",
    "schema_differences": """select 'o_checked: not in the table' as difference
union all select 'o_orderpriority: missing from the input'
union all select distinct 'o_custkey: string in the input, ' || lower(typeof(o_custkey))
  || ' in the table' from orders""",
    "file_bytes": """select width, count(*) as n, true as within
from orders, (values ('narrow'), ('wide')) t(width) group by width""",
    "file_sizes": "select true as within, count(*) as n from orders",
    "write_parallelism": "select 3 as files, count(*) as n from orders",
    "snapshot_read": f"""with {SQL_TRIPS}
select uuid, ts, driver, rider, partitionpath,
  cast(case when first_half and partitionpath = 'error' then fare * 2 else fare end as double) as fare
from trips""",
    "write_overwrite": f"with {SQL_TRIPS} select {_TRIPS} from trips where not first_half",
    "snapshot_buckets": """select o_orderkey, o_custkey, o_orderstatus,
  cast(o_totalprice as double) + case when o_custkey % 7 > 0 then 1000 else 0 end as o_totalprice
from orders where o_custkey % 7 <> 3""",
    "write_upsert": """select o_orderkey, o_custkey,
  case when o_orderstatus = 'O' then 'F' else o_orderstatus end as o_orderstatus,
  case when o_orderstatus = 'O' then o_totalprice + 1.0::double else o_totalprice end as o_totalprice,
  o_orderdate, o_orderpriority from orders""",
    "precombine_dedupe": _latest_trip("driver"),
    "nonpartitioned_upsert": _latest_trip("driver"),
    "partitioned_read": _latest_trip("driver, partitionpath"),
    "incremental_read": f"with {SQL_TRIPS} select {_TRIPS} from trips where not first_half",
    "incremental_empty": f"with {SQL_TRIPS} select {_TRIPS} from trips where false",
    "delete_by_key": f"with {SQL_TRIPS} select {_TRIPS} from trips where partitionpath <> 'error'",
    "count_after_delete": "select count(*) as n from events where event_type <> 'error'",
    "key_lookup": """select * from orders where exists (
  select 1 from lineitem where l_orderkey = o_orderkey and l_linestatus = o_orderstatus)""",
    "key_lookup_list": f"""select * from orders
where (cast(o_orderkey as varchar), o_orderstatus) in ({_LISTED})""",
    "key_lookup_missing": """select 'absent' as "case", count(*) as hits from lineitem where false
union all
select 'no match', count(*) from orders where exists (
  select 1 from lineitem
  where 'x' || l_orderkey = cast(o_orderkey as varchar) and l_linestatus = o_orderstatus)""",
    "distinct_keys": """select distinct cast(l_orderkey as varchar) as record_key,
  l_linestatus as partition_path from lineitem""",
    "limit_keys": f"""with {SQL_TRIPS}
select uuid, partitionpath, ts from trips order by uuid limit 2""",
    "select_filter": f"""with {SQL_TRIPS}
select driver, cast(fare as double) as fare, ts from trips where fare > 20.0""",
    "json_source": """select event_id, cast(json_extract(props, '$.k') as bigint) as k from events""",
    "commit_timeline": f"""with {SQL_TRIPS}
select 1 as seq, 'upsert' as kind, count(*) as rows from trips where first_half
union all select 2, 'upsert', count(*) from trips where not first_half
union all select 3, 'delete', count(*) from trips where partitionpath = 'error'
union all select 4, 'compact', count(*) from trips where partitionpath <> 'error'
union all select 5, 'overwrite', count(*) from trips""",
    "commit_metadata": f"""with {SQL_TRIPS}
select 1 as seq, count(*) as rows, 'test' as test, null::varchar as note, 'uuid' as first_column
from trips where first_half
union all select 2, count(*), 'again', 'second half', 'uuid' from trips where not first_half""",
}
