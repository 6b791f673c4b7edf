"""The commit log of a keyed table: one small JSON record per completed write.

A record is written after its data, so a batch without a record is invisible and a failed
write leaves nothing to undo. Records are numbered, and a writer takes the number after the last
record it has read: of two writers that started from the same state the second fails. Offsets, the
number of the last full batch and the instant of the last change are carried forward from record to
record, so writers need the last record only, incremental readers those back to their beginning, and
others those back to that batch.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sizing import Size
from ..spec import BEGINNING
from .paths import child_names, path_exists

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())

COMMIT_SCHEMA = (
    T.StructType()
    .add("instant", T.StringType())
    .add("kind", T.StringType())
    .add("spec", _TEXT_MAP)
    .add("schema", T.StringType())
    .add("meta", _TEXT_MAP)
    .add("offsets", T.MapType(T.StringType(), _TEXT_MAP))
    .add("rows", T.LongType())
    .add("key_bytes", T.LongType())
    .add("inserted", T.LongType())
    .add("updated", T.LongType())
    .add("partitions", T.ArrayType(T.StringType()))
    .add("number", T.LongType())
    .add("base", T.LongType())
    .add("changed", T.StringType())
)

#: Kinds after which older batches are no longer part of the table's current rows.
BASE_KINDS = ("overwrite", "compact")


@dataclass(frozen=True)
class Commit:
    instant: str
    kind: str
    size: Size
    inserted: int | None = None
    updated: int | None = None
    #: Partition paths written, or ``None`` in a table without partitions.
    partitions: list[str] | None = None


@dataclass(frozen=True)
class Timeline:
    """Commits in order, back to the last full batch or further, and what the last one says."""

    commits: list[Commit]
    spec: dict[str, str | None]
    schema: T.StructType
    offsets: dict[str, dict[str, str]]
    #: Number of the last record, and of that of the last full batch.
    number: int
    base: int
    #: Instant of the last commit that changed rows; compactions do not.
    last_change: str

    @property
    def last_instant(self) -> str:
        return self.commits[-1].instant if self.commits else BEGINNING

    def current(self) -> list[Commit]:
        """The batches holding the current rows: the last full one and all after it."""
        starts = [i for i, c in enumerate(self.commits) if c.kind in BASE_KINDS]
        return self.commits[starts[-1]:] if starts else self.commits

    def between(self, begin: str, end: str) -> list[Commit]:
        """Batches with begin < instant <= end that the state at ``end`` still contains.

        Compactions are skipped: they repeat rows of other batches. The timeline must have been
        read back to ``begin``.
        """
        upto = [c for c in self.commits if c.instant <= end and c.kind != "compact"]
        starts = [i for i, c in enumerate(upto) if c.kind == "overwrite"]
        visible = upto[starts[-1]:] if starts else upto
        return [c for c in visible if c.instant > begin]


@dataclass
class CommitRecord:
    instant: str
    kind: str
    spec: dict[str, str | None]
    schema: T.StructType
    meta: dict[str, str] = field(default_factory=dict)
    offsets: dict[str, dict[str, str]] = field(default_factory=dict)
    rows: int = 0
    key_bytes: int = 0
    inserted: int | None = None
    updated: int | None = None
    partitions: list[str] | None = None
    number: int = 0
    base: int = 0
    changed: str = BEGINNING

    def write(self, spark: SparkSession, commits_path: str) -> None:
        record = {name: getattr(self, name) for name in COMMIT_SCHEMA.names}
        record["schema"] = self.schema.json()
        record["spec"] = {k: v for k, v in self.spec.items() if v is not None}
        line = spark.range(1, numPartitions=1).select(F.lit(json.dumps(record)).alias("value"))
        line.write.mode("errorifexists").text(record_path(commits_path, self.number))


def record_path(commits_path: str, number: int) -> str:
    return f"{commits_path}/{number:012d}"


def read_commits(spark: SparkSession, commits_path: str) -> DataFrame | None:
    """The commit log as a DataFrame, or ``None`` where there is no table."""
    if not path_exists(spark, commits_path):
        return None
    reader = spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", "true")
    return reader.json(commits_path)


def _records(spark: SparkSession, commits_path: str, numbers: list[int], *columns: str) -> list:
    if not numbers:
        return []
    paths = [record_path(commits_path, n) for n in numbers]
    log = spark.read.schema(COMMIT_SCHEMA).json(paths)
    return sorted(log.select("number", *columns).collect(), key=lambda r: r["number"])


def read_timeline(
    spark: SparkSession, commits_path: str, begin: str | None = None, to_base: bool = True
) -> Timeline | None:
    """The timeline of a table, or ``None`` where there is no table.

    Reads the last record, those back to the last full batch unless ``to_base`` is false, and with
    ``begin`` those back to that instant. So a writer, or a reader of offsets, reads one record
    however long the log. Only the names of other records reach the driver. A folder without a
    record is left by a writer that died; its number is not used again.
    """
    numbers = [int(n) for n in child_names(spark, commits_path) if n.isdigit()]
    found = []
    for at in range(len(numbers) - 1, -1, -1):
        found = _records(spark, commits_path, [numbers[at]], *COMMIT_SCHEMA.names[:-3], "base", "changed")
        if found:
            break
    if not found:
        return None
    last = found[0]
    brief = ("instant", "kind", "rows", "key_bytes", "partitions")
    low = next(i for i, n in enumerate(numbers) if n >= last["base"]) if to_base else at
    commits = _records(spark, commits_path, numbers[low:at], *brief) + [last]
    step = len(commits)
    while begin is not None and low > 0 and commits[0]["instant"] > begin:
        older = max(0, low - step)
        commits = _records(spark, commits_path, numbers[older:low], *brief) + commits
        low, step = older, 2 * step
    return Timeline(
        commits=[
            Commit(
                c["instant"], c["kind"], Size(c["rows"], c["key_bytes"]),
                partitions=c["partitions"],
            )
            for c in commits
        ],
        spec=dict(last["spec"]),
        schema=T.StructType.fromJson(json.loads(last["schema"])),
        offsets={app: dict(m) for app, m in (last["offsets"] or {}).items()},
        number=numbers[-1],
        base=last["base"],
        last_change=last["changed"],
    )


_INSTANT = "%Y%m%d%H%M%S%f"


def next_instant(last: str) -> str:
    """A new instant (UTC, ``yyyyMMddHHmmssSSS``): now, but always after ``last``."""
    now = datetime.now(timezone.utc).strftime(_INSTANT)[:-3]
    if now > last:
        return now
    after = datetime.strptime(last + "000", _INSTANT) + timedelta(milliseconds=1)
    return after.strftime(_INSTANT)[:-3]
