"""Incremental enrichment: what a source gained since the last run replaces the target."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.rows import drop_meta
from ..sources.commits import Commit
from ..spec import BEGINNING
from .table import KeyedTable


@dataclass(frozen=True)
class Enrichment:
    source: KeyedTable
    target: KeyedTable

    def execute(
        self, transform: Callable[[DataFrame], DataFrame], app: str = "default", **kwargs
    ) -> Commit | None:
        """Overwrite the target with ``transform`` of the source's new rows.

        The consumed instant is committed together with the data. Without new commits nothing
        is written and ``None`` returned. Another writer of the target that commits meanwhile makes this
        one fail.
        """
        head = self.target.head()
        consumed = head.offsets.get(app, {}) if head else {}
        begin = consumed.get(self.source.spec.name, BEGINNING)
        commits = self.source.timeline(begin, to_base=False)
        if commits is None:
            raise ValueError(f"source table {self.source.spec.name} does not exist")
        end = commits.last_change
        if begin == end:
            return None
        new = drop_meta(self.source.changes(commits, begin, end))
        return self.target.overwrite(
            transform(new), offsets={**consumed, self.source.spec.name: end}, app=app,
            after=head, **kwargs
        )
