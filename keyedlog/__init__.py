"""Keyed, versioned tables on Spark: upsert, delete, snapshot, incremental read, lookup, merge."""

from .operators.rows import drop_meta
from .plans.enrich import Enrichment
from .plans.merge import Merge, MergeResult
from .plans.table import KeyedTable
from .spec import NO_PARTITION, TableSpec

__all__ = [
    "Enrichment", "KeyedTable", "Merge", "MergeResult", "NO_PARTITION", "TableSpec", "drop_meta",
]
