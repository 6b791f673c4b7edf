"""Merge the new commits of one keyed table into another.

    result = (
        Merge.from_table(spark, orders, "source")
        .aggregate("select driver, sum(fare) fare, max(ts) ts from source group by driver",
                   key="driver", partition=NO_PARTITION)
        .into(fares, "target", on="source.driver = target.driver")
        .when_matched({"fare": "source.fare + target.fare", "ts": "source.ts"})
        .when_not_matched({"driver": "source.driver", "fare": "source.fare", "ts": "source.ts"})
        .execute()
    )

The commits of the source that the target has not consumed yet are read, optionally
aggregated, compared with the target rows their keys point to, and written in one commit that
also holds the new offset. Run again without new source commits, a merge does nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from contextlib import ExitStack
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge_join import (
    INSERTED, UPDATED, Aliases, equal_columns, insert_projection, matched_rows, merged_rows,
    unmatched_rows, update_projection,
)
from ..operators.rows import column, drop_meta, key_pairs
from ..sources.commits import Timeline
from ..spec import BEGINNING, BRANCH, NO_PARTITION, TableSpec
from .table import KeyedTable

#: Metadata of a merge's commit: how many source rows it read.
READ = "merge.read"

Transform = Callable[[Column], Column]


@dataclass(frozen=True)
class MergeResult:
    """What a merge read and wrote. ``instant`` is ``None`` when there was nothing new to read.

    ``read`` counts source rows after any aggregation, by a job of its own, so that a repeated task
    counts once. It is kept in the commit's metadata.
    """

    inserted: int
    updated: int
    read: int = 0
    instant: str | None = None

    @property
    def written(self) -> int:
        return self.inserted + self.updated


class Merge:
    """Builder of one merge. Nothing runs before ``execute``, ``updates`` or ``inserts``."""

    def __init__(self, spark: SparkSession, source: TableSpec, alias: str):
        self.spark = spark
        self.source = KeyedTable(spark, source)
        self.source_alias = alias
        self.target: KeyedTable | None = None
        self.target_alias: str | None = None
        self.on: str | None = None
        self.update: Mapping[str, str] = {}
        self.insert: Mapping[str, str] | None = None
        self.sql: str | None = None
        self.key: str | None = None
        self.key_fn: Transform | None = None
        self.partition = None
        self.partition_fn: Transform | None = None

    @classmethod
    def from_table(cls, spark: SparkSession, source: TableSpec, alias: str) -> "Merge":
        return cls(spark, source, alias)

    def aggregate(
        self, sql: str, key: str, partition, key_fn: Transform | None = None,
        partition_fn: Transform | None = None,
    ) -> "Merge":
        """Replace the source rows by a SQL statement over the source alias.

        The lookup key and partition must be named anew, as columns of the result; for a
        target without partitions give ``NO_PARTITION``. While the merge plans its work, the
        alias is a temporary view of the session; a view of that name is refused.
        """
        self.sql = sql
        return self.key_by(key, key_fn).partition_by(partition, partition_fn)

    def key_by(self, field: str, fn: Transform | None = None) -> "Merge":
        """Source column (and function) naming the target keys to compare with.

        This restricts which target rows can match; the condition of ``into`` decides whether
        they do. Unset, it is the key of the source table.
        """
        self.key, self.key_fn = field, fn
        return self

    def partition_by(self, field, fn: Transform | None = None) -> "Merge":
        """Source column (and function) naming the target partitions; see ``key_by``.

        Unset, it is the partition field of the source table. A target without partitions needs
        none, which ``NO_PARTITION`` says; there the partition is not compared.
        """
        self.partition, self.partition_fn = field, fn
        return self

    def into(self, target: TableSpec, alias: str, on: str) -> "Merge":
        """The target table and the SQL condition between the two aliases."""
        self.target = KeyedTable(self.spark, target)
        self.target_alias = alias
        self.on = on
        return self

    def when_matched(self, update: Mapping[str, str]) -> "Merge":
        """Target column to SQL expression, for source rows that match a target row.

        Several source rows matching one target row each see the *stored* values; the result
        with the largest precombine value is kept. Aggregate first to accumulate.
        """
        self.update = dict(update)
        return self

    def when_not_matched(self, insert: Mapping[str, str] | None = None) -> "Merge":
        """Target column to SQL expression for other rows; empty means all source columns."""
        self.insert = dict(insert) if insert else None
        return self

    # ---- planning -------------------------------------------------------------------

    def _check(self) -> None:
        missing = {
            "spark": self.spark, "source alias": self.source_alias, "target": self.target,
            "target alias": self.target_alias, "on": self.on, "when_matched": self.update,
        }
        if self.sql is not None:
            missing |= {"aggregate sql": self.sql, "aggregate key": self.key,
                        "aggregate partition": self.partition}
        for name, value in missing.items():
            if not value:
                raise ValueError(f"merge parameter {name} is not set")
        if self.target.spec.partition:
            field = self.source.spec.partition if self.partition is None else self.partition
            if field is None or field is NO_PARTITION:
                raise ValueError("the target has partitions: name the source column with partition_by")
        if self.source_alias.lower() == self.target_alias.lower():
            raise ValueError("source alias and target alias must differ")

    def _aggregated(self, rows: DataFrame) -> DataFrame:
        if self.source_alias in [t.name for t in self.spark.catalog.listTables() if t.isTemporary]:
            raise ValueError(f"the source alias {self.source_alias} is a temporary view already")
        rows.createTempView(self.source_alias)
        try:
            return self.spark.sql(self.sql)
        finally:
            self.spark.catalog.dropTempView(self.source_alias)

    def _keys(self, source: DataFrame) -> DataFrame:
        key = column(self.key or self.source.spec.key)
        if self.key_fn:
            key = self.key_fn(key.cast("string"))
        if not self.target.spec.partition:
            return key_pairs(source, key, None)
        partition = column(self.partition or self.source.spec.partition)
        if self.partition_fn:
            partition = self.partition_fn(partition.cast("string"))
        return key_pairs(source, key, partition)

    def _inputs(self, app: str, held: ExitStack | None = None) -> "_Inputs | None":
        """Everything up to the final join, or ``None`` if the source has no new commit.

        What several jobs of the merge use is cached until ``held`` is closed.
        """
        self._check()
        timeline = self.target.timeline()
        consumed = {} if timeline is None else timeline.offsets.get(app, {})
        begin = consumed.get(self.source.spec.name, BEGINNING)
        commits = self.source.timeline(begin, to_base=False)
        if commits is None:
            raise ValueError(f"source table {self.source.spec.name} does not exist")
        end = commits.last_change
        if begin == end:
            return None

        def hold(frame: DataFrame) -> DataFrame:
            if held is not None:
                frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
                held.callback(frame.unpersist)
            return frame

        source = drop_meta(self.source.changes(commits, begin, end))
        if self.sql is not None:
            source = self._aggregated(source)
        candidates = None
        if timeline is not None:
            source = hold(source) if self.sql is not None else source
            candidates = drop_meta(self.target.candidates(
                timeline, hold(self._keys(source)),
                joined_by_identity=self._joined_by_identity(source, timeline)))
        return _Inputs(source, candidates, timeline, end)

    def _joined_by_identity(self, source: DataFrame, timeline: Timeline) -> bool:
        """Whether the condition itself demands equal keys and, where there are any, partitions."""
        spec = self.target.spec
        wanted = {(self.key or self.source.spec.key, spec.key): self.key_fn}
        if spec.partition:
            wanted[self.partition or self.source.spec.partition, spec.partition] = self.partition_fn
        if any(wanted.values()):
            return False
        target = self.spark.createDataFrame([], timeline.schema)
        return set(wanted) <= equal_columns(source, target, self._names, self.on)

    def _update(self, schema: T.StructType) -> dict[str, Column]:
        return update_projection(schema, self.target_alias, self.update)

    def _insert(self, source: DataFrame) -> dict[str, Column]:
        return insert_projection(source, self.source_alias, self.insert)

    def _inserted(self, source: DataFrame) -> DataFrame:
        values = self._insert(source)
        return source.alias(self.source_alias).select(*[v.alias(n) for n, v in values.items()])

    @property
    def _names(self) -> Aliases:
        return Aliases(self.source_alias, self.target_alias)

    # ---- results --------------------------------------------------------------------

    def updates(self, app: str = "default") -> DataFrame:
        """Preview of the rows that matched source rows would write, before deduplication."""
        found = self._inputs(app)
        if found is None or found.candidates is None:
            raise ValueError("no new source commits, or no target table to update")
        return matched_rows(
            found.source, found.candidates, self._names, self.on, self._update(found.target.schema)
        )

    def inserts(self, app: str = "default") -> DataFrame:
        """Preview of the rows that unmatched source rows would write, before deduplication."""
        found = self._inputs(app)
        if found is None:
            raise ValueError("no new source commits")
        if found.candidates is None:
            return self._inserted(found.source)
        return unmatched_rows(
            found.source, found.candidates, self._names, self.on, self._insert(found.source)
        )

    def execute(
        self, parallelism: int | None = None, app: str = "default",
        options: Mapping[str, str] | None = None,
    ) -> MergeResult:
        """Run the merge: one write, and one commit that holds data and offset together.

        ``app`` names the consumer whose offsets are read and advanced. Where an inserted and
        an updated row have the same identity, the updated one is kept.
        """
        with ExitStack() as held:
            found = self._inputs(app, held)
            if found is None:
                return MergeResult(0, 0)
            source = found.source
            read = source.count()
            if found.candidates is None:
                rows = self._inserted(source).withColumn(BRANCH, F.lit(INSERTED))
            else:
                rows = merged_rows(
                    source, found.candidates, self._names, self.on,
                    self._update(found.target.schema), self._insert(source), found.target.schema,
                )
            commit = self.target.upsert(
                rows,
                first=[F.col(BRANCH).asc()],
                metrics={
                    "updated": F.count_if(F.col(BRANCH) == UPDATED),
                    "inserted": F.count_if(F.col(BRANCH) == INSERTED),
                },
                offsets={self.source.spec.name: found.end},
                app=app, parallelism=parallelism, options=options, after=found.target,
                meta={READ: str(read)},
            )
        return MergeResult(commit.inserted, commit.updated, read, commit.instant)


@dataclass(frozen=True)
class _Inputs:
    source: DataFrame
    candidates: DataFrame | None
    target: Timeline | None
    end: str
