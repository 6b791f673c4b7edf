"""Keyed tables over Parquet batches: overwrite, upsert, delete, snapshot, incremental, lookup.

Layout::

    <path>/data/_batch=<instant>/[_partition_path=<p>/]part-*.parquet
    <path>/_commits/<number>/part-*.json

with bucket files instead of partition folders where the spec has buckets.

Every write adds one batch that holds at most one row per identity, then one commit record.
Readers take the batches named by the commit log, so a half-written batch is never seen and a
job may read the table it writes to. One writer at a time: the second of two writers that
started from the same commit fails on the existing record.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence, Set

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..checks import check_schema, evolved_schema
from ..operators.rows import (
    column, dedupe, key_pairs, latest, live, partition_path, quoted, reconcile, record_key,
    semi_join, with_identity,
)
from ..operators.sizing import (
    BROADCAST_ROWS, Size, broadcast_within, measure, rows_within, value_bytes,
)
from ..sources.commits import (
    BASE_KINDS, Commit, CommitRecord, Timeline, next_instant, read_commits, read_timeline,
)
from ..sources.paths import partition_values
from ..spec import (
    BATCH, BEGINNING, BRANCH, COMMIT_TIME, DEFAULT_PARTITION, IDENTITY, OP, PARTITION_PATH,
    RECORD_KEY, TableSpec,
)

#: Key sets up to this size become literals that reach the Parquet scan, unless told otherwise.
LITERAL_KEYS = 1000
#: More distinct partition values than this prune by a join instead of a list in a filter.
LITERAL_PARTITIONS = 1000

#: Bloom filters let a point lookup skip row groups of randomly distributed keys.
WRITE_OPTIONS = {
    f"parquet.bloom.filter.enabled#{RECORD_KEY}": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}

KEYS_SCHEMA = f"{RECORD_KEY} string, {PARTITION_PATH} string"


class KeyedTable:
    """Reads and writes of one keyed table."""

    def __init__(self, spark: SparkSession, spec: TableSpec):
        self.spark = spark
        self.spec = spec

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "KeyedTable":
        return cls(spark, TableSpec.open(spark, path))

    # ---- metadata -------------------------------------------------------------------

    def timeline(self, begin: str | None = None, to_base: bool = True) -> Timeline | None:
        """The commits since the last full batch, or ``None`` if the table does not exist.

        With ``begin``, all commits after that instant are among them. ``commits`` has all. Without
        ``to_base`` only these and the last are read.
        """
        timeline = read_timeline(self.spark, self.spec.commits_path, begin, to_base)
        for field in ("key", "partition", "buckets") if timeline else ():
            stored, given = timeline.spec.get(field), self.spec.describe()[field]
            if stored != given:
                raise ValueError(f"the {field} of {self.spec.path} is {stored}, not {given}")
        return timeline

    def head(self) -> Timeline | None:
        """What the last commit says: schema, offsets, where the next one goes. One record is read."""
        return self.timeline(to_base=False)

    def _existing(self, begin: str | None = None, to_base: bool = True) -> Timeline:
        timeline = self.timeline(begin, to_base)
        if timeline is None:
            raise ValueError(f"table {self.spec.name} does not exist at {self.spec.path}")
        return timeline

    def exists(self) -> bool:
        return self.head() is not None

    def commits(self) -> DataFrame:
        """The commit log: instant, kind, spec, schema, meta, offsets and row counts."""
        log = read_commits(self.spark, self.spec.commits_path)
        if log is None:
            raise ValueError(f"table {self.spec.name} does not exist at {self.spec.path}")
        return log

    def last_instant(self) -> str:
        """Instant of the last commit; an error if the table does not exist."""
        return self._existing(to_base=False).last_instant

    def schema(self) -> T.StructType:
        """User columns as of the last commit; an error if the table does not exist."""
        return self._existing(to_base=False).schema

    def offsets(self, app: str = "default") -> dict[str, str]:
        """Last consumed instant per source, as committed under ``app``; empty without a table."""
        timeline = self.head()
        return {} if timeline is None else dict(timeline.offsets.get(app, {}))

    def check_schema(self, df: DataFrame) -> None:
        """Fail unless ``df`` has exactly the columns and types of the table."""
        check_schema(df, self.schema())

    # ---- reads ----------------------------------------------------------------------

    def _read(self, commits: Sequence[Commit], schema: T.StructType) -> DataFrame:
        """Stored rows of the given batches, with their operation.

        The schema is explicit: nothing is inferred or merged from files, a column a batch
        lacks reads as NULL, and instants and partition values stay strings.
        """
        if self.spec.buckets and commits:
            return self._read_buckets(commits, schema)
        stored = T.StructType([*schema.fields])
        for name in (RECORD_KEY, OP, COMMIT_TIME, PARTITION_PATH, BATCH):
            stored.add(name, "string")
        rows = (
            self.spark.read.schema(stored)
            .option("basePath", self.spec.data_path)
            .parquet(*[self.spec.batch_path(c.instant) for c in commits])
            if commits
            else self.spark.createDataFrame([], stored)
        )
        partition = F.col(PARTITION_PATH) if self.spec.partition else F.lit("")
        # Only compacted rows carry their own commit time.
        written = F.coalesce(COMMIT_TIME, BATCH) if _compacted(commits) else F.col(BATCH)
        return rows.select(
            *[column(f.name) for f in schema.fields],
            written.alias(COMMIT_TIME),
            RECORD_KEY,
            partition.alias(PARTITION_PATH),
            OP,
        )

    def _read_buckets(self, commits: Sequence[Commit], schema: T.StructType) -> DataFrame:
        """Stored rows of bucketed batches. Spark knows a scan's buckets from a table over its files.

        The tables are only needed to resolve the scans, and are dropped again; the files stay.
        """
        stored = T.StructType([*schema.fields])
        for name in (RECORD_KEY, OP, COMMIT_TIME, PARTITION_PATH):
            stored.add(name, "string")
        by = ", ".join(IDENTITY)
        found = None
        for commit in commits:
            name = f"keyedlog_{uuid.uuid4().hex}"
            place = self.spec.batch_path(commit.instant).replace("'", "\\'")
            self.spark.sql(
                f"create table {name} ({_ddl(stored)}) using parquet clustered by ({by}) sorted by ({by}) "
                f"into {self.spec.buckets} buckets location '{place}'")
            rows = self.spark.table(name)
            self.spark.sql(f"drop table {name}")
            # Only compacted rows carry their own commit time.
            rows = rows.select(
                *[column(f.name) for f in schema.fields],
                F.coalesce(F.col(COMMIT_TIME), F.lit(commit.instant)).alias(COMMIT_TIME),
                RECORD_KEY, PARTITION_PATH, OP)
            found = rows if found is None else found.unionByName(rows)
        return found

    def _current(
        self,
        timeline: Timeline,
        keep: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        places: Set[str] | None = None,
    ) -> DataFrame:
        """The live rows, restricted by ``keep`` before versions are compared.

        ``keep`` may look at the identity only, so it commutes with picking the latest version.
        ``places`` are the only partitions it lets through, if that is known.
        """
        base, *later = timeline.current()
        if places is not None:
            later = [c for c in later if c.partitions is None or not places.isdisjoint(c.partitions)]
        rows = keep(self._read([base], timeline.schema))
        if not later:
            return live(rows)
        changes = keep(self._read(later, timeline.schema))
        size = Size(sum(c.size.rows for c in later), sum(c.size.bytes for c in later))
        changed = broadcast_within(changes.select(*IDENTITY), size)
        newest = latest(changes) if len(later) > 1 else changes
        touched = None if size.broadcastable else self._touched(later)
        if touched is None:
            return reconcile(rows, newest, changed)
        # Partitions without changes are read as they are, without a shuffle.
        inside = self._in_places(rows, touched)
        outside = self._in_places(rows, touched, how="left_anti")
        return live(outside).unionByName(reconcile(inside, newest, changed))

    def _in_places(
        self, rows: DataFrame, places: Sequence[str], how: str = "left_semi"
    ) -> DataFrame:
        """Rows whose partition is among ``places``, or is not, for ``left_anti``.

        Both a filter and a semi join with a broadcast list leave out the other folders.
        """
        if len(places) <= LITERAL_PARTITIONS:
            inside = F.col(PARTITION_PATH).isin(list(places))
            return rows.where(inside if how == "left_semi" else ~inside)
        listed = self.spark.createDataFrame([(p,) for p in places], f"{PARTITION_PATH} string")
        joined = rows.join(F.broadcast(listed), PARTITION_PATH, how)
        return joined.select(rows.columns)

    def _touched(self, commits: Sequence[Commit]) -> list[str] | None:
        """Partitions the commits wrote to; ``None`` in a table without partition folders."""
        if not self.spec.partition or self.spec.buckets:
            return None
        return sorted({p for c in commits for p in c.partitions or ()})

    def snapshot(self) -> DataFrame:
        """The latest version of every live row: user columns and bookkeeping columns."""
        return self._current(self._existing())

    def incremental(self, begin: str, end: str) -> DataFrame:
        """Rows committed in (begin, end], each in its latest version of that range.

        Rows deleted in the range do not appear. ``begin == end`` gives an empty DataFrame.
        Only the batches of the range are listed and read.
        """
        return self.changes(self._existing(begin, to_base=False), begin, end)

    def changes(self, timeline: Timeline, begin: str, end: str) -> DataFrame:
        """``incremental`` for a timeline already read, back to ``begin``."""
        chosen = timeline.between(begin, end)
        rows = self._read(chosen, timeline.schema)
        return live(latest(rows) if len(chosen) > 1 else rows)

    def lookup(
        self,
        keys: DataFrame | Iterable[tuple[str, str | None]],
        schema: T.StructType | None = None,
        literal_keys: int | None = None,
    ) -> DataFrame:
        """Rows whose (record key, partition path) is among ``keys``; a missing key gives none.

        ``keys`` is a list of pairs, or a DataFrame whose first two columns are key and
        partition (a table without partitions needs the key only). Without a table the result
        is empty, with the columns of ``schema``.

        Up to ``literal_keys`` keys (``LITERAL_KEYS``) become filters inside the scan, where
        partition directories, row groups and pages are skipped. More keys are broadcast if their
        measured size allows it, and joined by a shuffle otherwise. The rows are the same.
        """
        most = LITERAL_KEYS if literal_keys is None else literal_keys
        timeline = self.timeline()
        if timeline is None:
            return self._read([], schema or T.StructType()).drop(OP)
        if not isinstance(keys, DataFrame):
            pairs = {self._pair(key) for key in keys}
            pairs = {(key, place) for key, place in pairs if key}
            if len(pairs) <= most:
                return self._literal_lookup(timeline, pairs)
            keys = self.spark.createDataFrame(sorted(pairs), KEYS_SCHEMA)
        partition = column(keys.columns[1]) if self.spec.partition else None
        pairs = key_pairs(keys, column(keys.columns[0]), partition)
        return self.candidates(timeline, pairs, most)

    def _pair(self, key: str | tuple[str, str | None]) -> tuple[str, str]:
        key, *place = key if isinstance(key, (tuple, list)) else (key,)
        text = "" if key is None else str(key)
        if not self.spec.partition:
            return text, ""
        given = "" if not place or place[0] is None else str(place[0])
        return text, given or DEFAULT_PARTITION

    def _literal_lookup(self, timeline: Timeline, pairs: set[tuple[str, str]]) -> DataFrame:
        """Lookup of few keys by filters that Parquet can use to skip data."""
        places = {place for _, place in pairs}
        wanted = self.spark.createDataFrame(sorted(pairs), KEYS_SCHEMA)

        def keep(rows: DataFrame) -> DataFrame:
            rows = rows.where(F.col(RECORD_KEY).isin(sorted({key for key, _ in pairs})))
            if self.spec.partition:
                rows = rows.where(F.col(PARTITION_PATH).isin(sorted(places)))
            # Within one partition the key alone decides.
            return rows if len(places) <= 1 else semi_join(rows, F.broadcast(wanted))

        return self._current(timeline, keep, places if self.spec.partition else None)

    def candidates(
        self, timeline: Timeline, pairs: DataFrame, literal_keys: int | None = None,
        joined_by_identity: bool = False,
    ) -> DataFrame:
        """Rows whose identity is among ``pairs``, which may repeat and are evaluated two or three times.

        One pass without a shuffle sizes them: rows, bytes, and about how many different pairs and
        partitions. They are made distinct only where that turns a set too large to broadcast, or to
        be literals, into one that is not; a semi join needs no distinct pairs.

        With ``joined_by_identity`` the caller's join compares key and partition itself. Then pairs beyond
        the broadcast limit only choose partitions here: the join does the rest, and its shuffle is the
        only one of the table.
        """
        most = LITERAL_KEYS if literal_keys is None else literal_keys
        found = pairs.agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(value_bytes(pairs)).alias("bytes"),
            F.approx_count_distinct(F.struct(*IDENTITY)).alias("pairs"),
            F.approx_count_distinct(PARTITION_PATH).alias("places"),
        ).first()
        size = Size(found["rows"], found["bytes"] or 0)
        if found["pairs"] <= _with_error(most):
            few = pairs.distinct().limit(most + 1).collect()
            if len(few) <= most:
                return self._literal_lookup(timeline, {(r[RECORD_KEY], r[PARTITION_PATH]) for r in few})
        if not size.broadcastable and found["pairs"] <= BROADCAST_ROWS:
            pairs = pairs.distinct()
            size = measure(pairs)
        places, listed = self._key_places(pairs, found["places"])
        wanted = broadcast_within(pairs, size)

        def keep(rows: DataFrame) -> DataFrame:
            if places is not None:
                rows = rows.where(F.col(PARTITION_PATH).isin(sorted(places)))
            elif listed is not None:
                # A broadcast list of partitions prunes folders while the query runs.
                rows = rows.join(listed, PARTITION_PATH, "left_semi").select(rows.columns)
            if joined_by_identity and not size.broadcastable:
                return rows
            return semi_join(rows, wanted)

        return self._current(timeline, keep, places)

    def _key_places(self, pairs: DataFrame, about: int) -> tuple[set[str] | None, DataFrame | None]:
        """The partitions of a key set: a set if few, else a table if it can be broadcast."""
        if not self.spec.partition:
            return None, None
        names = pairs.select(PARTITION_PATH).distinct()
        if about <= _with_error(LITERAL_PARTITIONS):
            some = {r[0] for r in names.limit(LITERAL_PARTITIONS + 1).collect()}
            if len(some) <= LITERAL_PARTITIONS:
                return some, None
        return None, F.broadcast(names) if measure(names).broadcastable else None

    # ---- writes ---------------------------------------------------------------------

    def overwrite(self, df: DataFrame, **kwargs) -> Commit:
        """Replace the table by ``df``. Offsets are reset unless given. See ``upsert``."""
        return self._write(df, "overwrite", **kwargs)

    def upsert(self, df: DataFrame, **kwargs) -> Commit:
        """Replace stored rows of the same identity and add the others, in one commit.

        ``df`` is deduplicated by the precombine field, which orders rows within this write
        only: a later write replaces a stored row whatever its precombine value.

        Keywords: ``meta`` (strings kept in the commit record), ``offsets`` with ``app``
        (consumed instants per source), ``parallelism`` (number of write tasks), ``options``
        (passed to the Parquet writer, e.g. ``maxRecordsPerFile``), ``file_bytes`` (largest data file,
        kept by a number of rows measured from ``df``). A merge also gives ``first``
        (orderings before the precombine value), ``metrics`` (counts to record) and ``after`` (the
        timeline it has read).
        """
        return self._write(df, "upsert", **kwargs)

    def delete(self, keys: DataFrame, **kwargs) -> Commit:
        """Remove the rows whose key and partition fields appear in ``keys``."""
        timeline = self._existing(to_base=False)
        partition = column(self.spec.partition) if self.spec.partition else None
        tombstones = keys.select(
            record_key(column(self.spec.key)).alias(RECORD_KEY),
            partition_path(partition).alias(PARTITION_PATH),
        ).distinct()
        rows = tombstones.withColumn(OP, F.lit("D"))
        return self._commit(rows, "delete", None, after=timeline, **kwargs)

    def compact(self, **kwargs) -> Commit:
        """Rewrite the live rows as one batch, so that reads need not reconcile old ones.

        Every row keeps its own commit time, and incremental reads go on using the old batches.
        """
        timeline = self._existing()
        rows = self._current(timeline).withColumn(OP, F.lit("U"))
        return self._commit(rows, "compact", timeline.schema, after=timeline, **kwargs)

    def _write(
        self, df: DataFrame, kind: str, first: Sequence[Column] = (), file_bytes: int | None = None,
        options: Mapping[str, str] | None = None, **kwargs,
    ) -> Commit:
        for name in (self.spec.key, self.spec.precombine, self.spec.partition):
            if name is not None and name not in df.columns:
                raise ValueError(f"table {self.spec.name} needs column {name}")
        rows = dedupe(with_identity(df, self.spec), self.spec.precombine, first)
        incoming = df.drop(BRANCH).schema
        if file_bytes is not None:
            # The record key is stored beside the column it comes from, and its Bloom filter is for as
            # many keys as a file has rows.
            per_file = rows_within(df.withColumn("_key", column(self.spec.key).cast("string")), file_bytes)
            options = {
                "maxRecordsPerFile": str(per_file),
                "parquet.bloom.filter.adaptive.enabled": "false",
                f"parquet.bloom.filter.expected.ndv#{RECORD_KEY}": str(per_file),
                **(options or {}),
            }
        return self._commit(
            rows.withColumn(OP, F.lit("U")), kind, incoming, options=options, **kwargs)

    def _commit(
        self,
        rows: DataFrame,
        kind: str,
        incoming: T.StructType | None,
        meta: Mapping[str, str] | None = None,
        offsets: Mapping[str, str] | None = None,
        app: str = "default",
        parallelism: int | None = None,
        options: Mapping[str, str] | None = None,
        metrics: Mapping[str, Column] | None = None,
        after: Timeline | None = None,
    ) -> Commit:
        """Write rows with unique identities as a new batch, then the record that reveals it."""
        if kind == "overwrite":
            # Only the last instant matters: rows, schema, offsets and layout all start anew.
            timeline = after or read_timeline(self.spark, self.spec.commits_path, to_base=False)
            stored, carried = None, {}
        else:
            timeline = after or self.head()
            stored = timeline.schema if timeline else None
            carried = dict(timeline.offsets) if timeline else {}
        schema = stored if incoming is None else evolved_schema(incoming, stored)
        if offsets:
            carried[app] = {**carried.get(app, {}), **offsets}
        instant = next_instant(timeline.last_instant if timeline else BEGINNING)

        observed = Observation()
        key_bytes = F.octet_length(RECORD_KEY) + F.octet_length(PARTITION_PATH)
        counts = [F.count(F.lit(1)).alias("rows"), F.sum(key_bytes).alias("key_bytes")]
        counts += [value.alias(name) for name, value in (metrics or {}).items()]
        # Observed on top of the last shuffle: a retried map task cannot count twice.
        rows = self._arrange(rows, parallelism).observe(observed, *counts)
        folders = self.spec.partition and not self.spec.buckets
        if folders:
            writer = rows.drop(BRANCH).write.partitionBy(PARTITION_PATH)
        elif self.spec.buckets:
            writer = rows.drop(BRANCH).write.bucketBy(self.spec.buckets, *IDENTITY).sortBy(*IDENTITY)
        else:
            writer = rows.drop(BRANCH, PARTITION_PATH).write
        writer = writer.mode("errorifexists").options(**{**WRITE_OPTIONS, **(options or {})})
        if self.spec.buckets:
            name = f"keyedlog_{uuid.uuid4().hex}"
            writer.option("path", self.spec.batch_path(instant)).saveAsTable(name, format="parquet")
            self.spark.sql(f"drop table {name}")
        else:
            writer.parquet(self.spec.batch_path(instant))

        written = None
        if folders:
            written = partition_values(self.spark, self.spec.batch_path(instant), PARTITION_PATH)
        number = timeline.number + 1 if timeline else 0
        starts_anew = kind in BASE_KINDS or timeline is None

        found = observed.get
        size = Size(found["rows"], found["key_bytes"] or 0)
        CommitRecord(
            instant=instant, kind=kind, spec=self.spec.describe(), schema=schema,
            meta=dict(meta or {}), offsets=carried, rows=size.rows, key_bytes=size.bytes,
            inserted=found.get("inserted"), updated=found.get("updated"), partitions=written,
            number=number, base=number if starts_anew else timeline.base,
            changed=timeline.last_change if kind == "compact" else instant,
        ).write(self.spark, self.spec.commits_path)
        return Commit(
            instant, kind, size, found.get("inserted"), found.get("updated"), written
        )

    def _arrange(self, rows: DataFrame, parallelism: int | None) -> DataFrame:
        """Place rows for writing, ordered by key so that page statistics are selective.

        A partitioned table is rebalanced by its partition: each directory gets few files, and
        adaptive execution splits a partition that holds much of the data over many tasks. A bucketed
        table has one task and one file a bucket, whatever ``parallelism`` says.
        """
        if self.spec.buckets:
            return rows.repartition(self.spec.buckets, *IDENTITY).sortWithinPartitions(*IDENTITY)
        if parallelism:
            rows = rows.repartition(parallelism, *IDENTITY)
        elif self.spec.partition:
            rows = rows.hint("rebalance", F.col(PARTITION_PATH))
        order = [PARTITION_PATH, RECORD_KEY] if self.spec.partition else [RECORD_KEY]
        return rows.sortWithinPartitions(*order)


def _with_error(most: int) -> float:
    """An estimate of distinct values that may still stand for ``most``."""
    return 1.2 * most + 2


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def _compacted(commits: Sequence[Commit]) -> bool:
    return any(c.kind == "compact" for c in commits)
