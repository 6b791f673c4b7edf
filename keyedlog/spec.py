"""What a keyed table is: where it lives and which fields identify a row."""

from __future__ import annotations

from dataclasses import asdict, dataclass

# Bookkeeping columns of a stored row.
RECORD_KEY = "_record_key"
PARTITION_PATH = "_partition_path"
COMMIT_TIME = "_commit_time"
OP = "_op"
BATCH = "_batch"
#: Whether a merged row was updated or inserted; never stored.
BRANCH = "_branch"

#: Bookkeeping columns a reader sees; ``drop_meta`` strips exactly these.
META_COLS = (COMMIT_TIME, RECORD_KEY, PARTITION_PATH)
#: Names a user column may not have.
RESERVED_COLS = (*META_COLS, OP, BATCH, BRANCH)

IDENTITY = (RECORD_KEY, PARTITION_PATH)

#: The instant before every commit.
BEGINNING = "000"
#: Partition path of rows whose partition field is NULL or empty.
DEFAULT_PARTITION = "default"


class _NoPartition:
    """Marks "this lookup has no partition", which differs from "not given" (``None``)."""

    def __repr__(self) -> str:
        return "NO_PARTITION"


NO_PARTITION = _NoPartition()


@dataclass(frozen=True)
class TableSpec:
    """Name, location and identity fields of a keyed table.

    ``partition`` is ``None`` for a table without partitions; the identity of a row is then
    its key alone. ``path`` may be any path Spark can read and write.

    With ``buckets``, batches are written in that many Spark buckets by identity instead of
    partition folders, so that versions of large batches are compared bucket by bucket, without a shuffle of
    what is stored. Take at least as many as there are shuffle partitions, and enough for a bucket to fit a task.
    """

    name: str
    path: str
    key: str
    precombine: str
    partition: str | None = None
    buckets: int | None = None

    def __post_init__(self) -> None:
        for field in ("name", "path", "key", "precombine"):
            if not getattr(self, field):
                raise ValueError(f"TableSpec.{field} must not be empty")
        if self.partition == "":
            object.__setattr__(self, "partition", None)
        object.__setattr__(self, "path", self.path.rstrip("/"))
        if self.buckets is not None:
            object.__setattr__(self, "buckets", int(self.buckets))
            if self.buckets < 1:
                raise ValueError("TableSpec.buckets must be positive")

    @property
    def data_path(self) -> str:
        return f"{self.path}/data"

    @property
    def commits_path(self) -> str:
        return f"{self.path}/_commits"

    def batch_path(self, instant: str) -> str:
        return f"{self.data_path}/{BATCH}={instant}"

    def describe(self) -> dict[str, str | None]:
        """The fields stored in each commit record (the path is where the record lies)."""
        fields = asdict(self)
        del fields["path"]
        return {name: value and str(value) for name, value in fields.items()}

    @classmethod
    def open(cls, spark, path: str) -> "TableSpec":
        """Rebuild the spec of an existing table from its base path alone."""
        from .sources.commits import read_timeline

        timeline = read_timeline(spark, f"{path.rstrip('/')}/_commits")
        if timeline is None:
            raise ValueError(f"no keyed table at {path}")
        return cls(path=path, **timeline.spec)
