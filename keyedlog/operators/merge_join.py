"""The rows a merge writes: updates from matched source rows, inserts from unmatched ones.

The two inputs are the source rows and the candidate target rows, named by ``Aliases``; the
join condition and the rules are SQL over these names. The condition must contain an equality
between the sides; without one every pair of rows would be compared, so it is refused.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import BRANCH
from .rows import quoted

UPDATED, INSERTED = 0, 1


class Aliases(NamedTuple):
    source: str
    target: str


def insert_projection(
    source: DataFrame, alias: str, mapping: Mapping[str, str] | None
) -> dict[str, Column]:
    """Target column to expression for unmatched rows; without a mapping, all source columns."""
    if mapping:
        return {name: F.expr(text) for name, text in mapping.items()}
    return {name: F.col(f"{quoted(alias)}.{quoted(name)}") for name in source.columns}


def update_projection(
    target: T.StructType, alias: str, mapping: Mapping[str, str]
) -> dict[str, Column]:
    """Target column to expression for matched rows; unmapped columns keep the stored value.

    The result is cast to the stored type: sums of decimals would widen at every merge.
    """
    out = {}
    for field in target.fields:
        if field.name in mapping:
            out[field.name] = F.expr(mapping[field.name]).cast(field.dataType)
        else:
            out[field.name] = F.col(f"{quoted(alias)}.{quoted(field.name)}")
    for name, text in mapping.items():
        if name not in out:
            out[name] = F.expr(text)
    return out


def _equalities(source: DataFrame, candidates: DataFrame, names: Aliases, on: str) -> list:
    """The sides (source, target) of the equalities that the condition demands, as Spark resolved them."""
    joined = source.alias(names.source).join(candidates.alias(names.target), F.expr(on))
    join = joined._jdf.queryExecution().analyzed()
    left, right = join.left().outputSet(), join.right().outputSet()

    def demanded(part) -> list:
        kind = part.getClass().getSimpleName()
        if kind == "And":
            return demanded(part.left()) + demanded(part.right())
        if kind == "Or":
            other = demanded(part.right())
            return [pair for pair in demanded(part.left()) if any(
                pair[0].semanticEquals(o[0]) and pair[1].semanticEquals(o[1]) for o in other)]
        if kind not in ("EqualTo", "EqualNullSafe"):
            return []
        return [
            (one, two)
            for one, two in ((part.left(), part.right()), (part.right(), part.left()))
            if not (one.references().isEmpty() or two.references().isEmpty())
            and one.references().subsetOf(left) and two.references().subsetOf(right)
        ]

    return demanded(join.condition().get())


def check_equality(source: DataFrame, candidates: DataFrame, names: Aliases, on: str) -> None:
    """Fail unless the condition demands an equality between the sides, by which Spark can join."""
    if not _equalities(source, candidates, names, on):
        raise ValueError(f"the merge condition has no equality between the two sides: {on}")


def equal_columns(
    source: DataFrame, candidates: DataFrame, names: Aliases, on: str
) -> set[tuple[str, str]]:
    """Pairs of a source and a target column of one type that the condition demands to be equal."""
    return {
        (one.name(), two.name()) for one, two in _equalities(source, candidates, names, on)
        if one.getClass().getSimpleName() == two.getClass().getSimpleName() == "AttributeReference"
        and one.dataType().equals(two.dataType())
    }


def _join(
    source: DataFrame, candidates: DataFrame, names: Aliases, on: str, how: str
) -> DataFrame:
    check_equality(source, candidates, names, on)
    return source.alias(names.source).join(candidates.alias(names.target), F.expr(on), how)


def matched_rows(
    source: DataFrame, candidates: DataFrame, names: Aliases, on: str,
    update: Mapping[str, Column],
) -> DataFrame:
    """Updated rows: inner join, then the update projection."""
    joined = _join(source, candidates, names, on, "inner")
    return joined.select(*[value.alias(name) for name, value in update.items()])


def unmatched_rows(
    source: DataFrame, candidates: DataFrame, names: Aliases, on: str,
    insert: Mapping[str, Column],
) -> DataFrame:
    """Inserted rows: anti join, then the insert projection."""
    rest = _join(source, candidates, names, on, "left_anti")
    return rest.select(*[value.alias(name) for name, value in insert.items()])


def merged_rows(
    source: DataFrame,
    candidates: DataFrame,
    names: Aliases,
    on: str,
    update: Mapping[str, Column],
    insert: Mapping[str, Column],
    target: T.StructType,
) -> DataFrame:
    """Updates and inserts in one pass over one left outer join, told apart by ``_branch``.

    Same rows as ``matched_rows`` union ``unmatched_rows``, with half the joins: the source is
    read once and both sides are shuffled once.
    """
    types = {f.name: f.dataType for f in target.fields}
    found = candidates.withColumn(BRANCH, F.lit(UPDATED))
    joined = _join(source, found, names, on, "left")
    branch = F.coalesce(F.col(BRANCH), F.lit(INSERTED))
    matched = F.col(BRANCH).isNotNull()

    def merged(name: str) -> Column:
        new = insert.get(name, F.lit(None))
        if name in types:
            new = new.cast(types[name])
        return F.when(matched, update.get(name, F.lit(None))).otherwise(new)

    columns = list(dict.fromkeys([*update, *insert]))
    return joined.select(*[merged(c).alias(c) for c in columns], branch.alias(BRANCH))
