"""Merkle manifest of a dataset, level by level with lag and lead windows (DataFrame functions only).

Every row is a leaf, the digest of its listed columns; a column that is null differs from an empty one.
In every group leaves stand in order, and while a group has several nodes every ``run`` consecutive ones
(the last run: fewer, even one) become their digest; what remains is the group's subroot. Subroots, in
the order of their groups, become the root in the same way. A leaf's path holds the digests left and
right of it in its run, level by level, so that leaf and path give the root again.

A block of 2^k leaves (``BLOCK`` at most) is a window. On level l the rows whose place is divisible by
run^l stand for the nodes: lag and lead at fixed offsets of j * run^l rows, masked by slot and by the
number of nodes on the level, supply the siblings, and the first child of each run hashes the parent. All levels of
a block are made in one sorted partition; the block roots are the leaves of the next round. So no task
sees more than a block at a time, a group that holds most rows is many blocks, and rounds are few: log(rows)
by BLOCK. Places come from one range sort over all partitions.

Null groups are a group like others, the first in order; null order values come first. Rows with equal order
values are ordered by their leaf; rows equal in that too are the same leaf several times, with a path
each. An empty table has no rows and no root. Other columns are not part of a leaf, and a result has
only the columns stated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import with_places
from ..operators.sizing import Size, broadcast_within
from .digests import CRC_TABLE_SQL, crc32_sql, digest, fields
from .store import keep

#: Most leaves of a block.
BLOCK = 1024
#: Bytes of a digest in a path, with what Spark adds.
_STEP_BYTES = 120

_NO_STEP = "array<struct<left:string,right:string>>"


def leaf(columns: Sequence[Column]) -> Column:
    """The digest of a record's columns, in this order."""
    return digest(fields(columns))


def _count_on(level: int, run: int) -> Column:
    """Nodes on a level of the group, while a level below has several."""
    step = run ** level
    return F.ceil(F.col("rows") / F.lit(step)).cast("bigint")


def _levels(run: int, rows: int) -> int:
    """Levels of a block: as many as the largest group has, within ``BLOCK`` leaves."""
    levels = 1
    while run ** levels < rows and run ** (levels + 1) <= BLOCK:
        levels += 1
    return levels


def _block_levels(nodes: DataFrame, run: int, levels: int) -> DataFrame:
    """The levels of each block: ``top`` on the first row of a block, left_l and right_l on first leaves.

    ``nodes`` has group, place, rows (of the group), node and more columns.
    """
    block = F.floor(F.col("place") / F.lit(run ** levels)).cast("bigint")
    current = nodes.select(*[c for c in nodes.columns if c != "node"], block.alias("block"),
                           F.col("node").alias("node_0"), F.col("node"))
    by = Window.partitionBy("group", "block").orderBy("place")
    for level in range(levels):
        step = run ** level
        index = F.floor(F.col("place") / F.lit(step)).cast("bigint")
        slot, count = index % run, _count_on(level, run)
        node = f"node_{level}"
        lags = [F.coalesce(F.when(slot >= j, F.lag(node, j * step).over(by)), F.lit(""))
                for j in range(run - 1, 0, -1)]
        leads = [F.coalesce(F.when((slot + j < run) & (index + j < count), F.lead(node, j * step).over(by)),
                            F.lit("")) for j in range(1, run)]
        several = (F.col("place") % step == 0) & (count > 1)
        current = current.select(
            "*", F.when(several, F.concat(*lags)).alias(f"left_{level}"),
            F.when(several, F.concat(*leads)).alias(f"right_{level}"))
        parent = F.when(count > 1, digest(F.col(node), F.col(f"right_{level}"))).otherwise(F.col(node))
        current = current.select(*[c for c in current.columns if c != node], F.when(
            F.col("place") % (step * run) == 0, parent).alias(f"node_{level + 1}"))
    return current.withColumnRenamed(f"node_{levels}", "top")


def _block_roots(nodes: DataFrame, run: int, levels: int) -> DataFrame:
    """The root of every block as a node of the next round."""
    size = run ** levels
    return _block_levels(nodes.select("group", "place", "rows", "node"), run, levels).where(
        F.col("place") % size == 0).select(
            "group", F.col("block").alias("place"),
            F.ceil(F.col("rows") / F.lit(size)).cast("bigint").alias("rows"), F.col("top").alias("node"))


def _block_paths(nodes: DataFrame, run: int, levels: int) -> DataFrame:
    """Every node with its block and its path inside it, in steps of (left, right)."""
    held = _block_levels(nodes, run, levels)
    so_far = (Window.partitionBy("group", "block").orderBy("place")
              .rowsBetween(Window.unboundedPreceding, 0))
    steps = []
    for level in range(levels):
        left, right = (F.last(f"{side}_{level}", ignorenulls=True).over(so_far)
                       for side in ("left", "right"))
        steps.append(F.when(_count_on(level, run) > 1, F.struct(
            left.alias("left"), right.alias("right"))))
    return held.select(*nodes.columns, "block", F.array_compact(F.array(*steps)).alias("path"))


def _with_paths(leaves: DataFrame, run: int) -> tuple[DataFrame, DataFrame]:
    """Leaves (group, place, rows, node, more columns) with their path, and (group, root) of all groups."""
    most = leaves.agg(F.max("rows")).first()[0] or 0
    rounds, current = [], leaves
    while True:
        levels = _levels(run, most)
        rounds.append((current, levels))
        current = keep(_block_roots(current, run, levels), "nodes")
        most = -(-most // run ** levels)
        if most <= 1:
            break
    roots = current.select("group", F.col("node").alias("root"))
    above, steps = None, 0
    for nodes, levels in reversed(rounds):
        paths = _block_paths(nodes, run, levels)
        if above is not None:
            higher = above.select("group", F.col("place").alias("block"), F.col("path").alias("_higher"))
            paths = paths.join(higher, ["group", "block"], "left").withColumn(
                "path", F.concat("path", F.coalesce("_higher", F.array().cast(_NO_STEP)))).drop("_higher")
        if nodes is not leaves:
            steps += levels
            above = _sized(keep(paths.select("group", "place", "path"), "paths"),
                           64 + steps * (run - 1) * _STEP_BYTES)
    return paths.drop("block"), roots


def _sized(df: DataFrame, row_bytes: int) -> DataFrame:
    rows = df.count()
    return broadcast_within(df, Size(rows, rows * row_bytes))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and a path give."""
    return F.aggregate(path, start, lambda node, step: digest(step["left"], node, step["right"]))


def proof(path: Column) -> Column:
    """The digests of a path, bottom to top and left to right, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(
    df: DataFrame, columns: Sequence[str], group: str, order: str, run: int = 2,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """``order`` column, leaf, subroot, root and path of every row, and ``extra`` columns of the table.

    ``columns`` make the leaf. ``extra`` may not be named like the others.
    """
    if run < 2:
        raise ValueError("a run has two nodes or more")
    rows = keep(df.select(
        F.col(group).cast("string").alias("name"), field_key(F.col(group)).alias("group"),
        F.col(order).alias("at"), leaf([F.col(c) for c in columns]).alias("node"),
        F.struct(F.lit(0).alias("_"), *extra).alias("extra")), "leaves")
    placed = keep(with_places(rows.drop("name"), ["group"], ["at", "node"]), "placed")
    leaves, subroots = _with_paths(placed, run)
    names = rows.groupBy("group").agg(F.min("name").alias("name"))
    subroots = keep(subroots.join(names, "group").select(
        "name", F.col("group").alias("of"), F.col("root").alias("node")), "subroots")
    tops = with_places(subroots, [], ["name"]).withColumn("group", F.lit("all"))
    above, whole = _with_paths(keep(tops, "tops"), run)
    above = keep(above.join(F.broadcast(whole.limit(1)), "group").select(
        "of", F.col("node").alias("subroot"), "root", F.col("path").alias("_higher")), "above")
    above = _sized(above, 300 + 40 * _STEP_BYTES)
    return leaves.join(above, F.col("group") == F.col("of")).select(
        F.col("at").alias(order), F.col("node").alias("leaf"), "subroot", "root",
        F.concat("path", "_higher").alias("path"), "extra.*").drop("_")


def field_key(value: Column) -> Column:
    """A group's value as a text that is never null."""
    return fields([value])


#: Columns of documents in their leaves, and the divisor of crc32(doc_id) of rows that are tampered with.
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPERED = 7


def documents_manifest(documents: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document.

    Rows whose crc32(doc_id) 7 divides are checked with n_chars one larger; a null doc_id has no crc32.
    """
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    changed = leaf([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in COLUMNS])
    held = manifest(documents, COLUMNS, "lang", "doc_id",
                    extra=[F.when(code % TAMPERED == 0, changed).alias("tampered")])
    folded = held.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")).cast("binary"), 256)
        .alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(cast({value} as varchar)) || ':' || {value}, '-')"


def _leaf_sql(chars: str) -> str:
    return "sha256(" + " || ".join(
        _field_sql(chars if c == "n_chars" else c) for c in COLUMNS) + ")"


_PARENTS_SQL = """list_transform(range((len(nodes) + 1) // 2),
      lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))"""
_STEP_SQL = "coalesce(nodes[case when p % 2 = 0 then p + 2 else p end], '')"

SQL = f"""
with recursive {CRC_TABLE_SQL},
leaves as (
  select doc_id, lang, {_leaf_sql("n_chars")} as leaf,
    case when {crc32_sql("cast(doc_id as varchar)")} % {TAMPERED} = 0
      then {_leaf_sql("(n_chars + 1)")} else {_leaf_sql("n_chars")} end as checked
  from documents, crc_table),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place from leaves),
levels as (
  select lang, 0 as level, list(leaf order by place) as nodes from placed group by lang
  union all
  select lang, level + 1, {_PARENTS_SQL} from levels where len(nodes) > 1),
subroots as (
  select lang, nodes[1] as subroot, row_number() over (order by encode(lang) nulls first) - 1 as place
  from levels where len(nodes) = 1),
tops as (
  select 0 as level, list(subroot order by place) as nodes from subroots
  union all
  select level + 1, {_PARENTS_SQL} from tops where len(nodes) > 1),
steps as (
  select p.lang, p.place as leaf_place, level, p.place >> level as p, nodes
  from placed p join levels l on p.lang is not distinct from l.lang and len(nodes) > 1
  union all
  select p.lang, p.place, 1000 + level, s.place >> level, nodes
  from placed p join subroots s on p.lang is not distinct from s.lang join tops on len(nodes) > 1),
paths as (
  select lang, leaf_place, string_agg({_STEP_SQL}, '' order by level) as proof,
    list(case when p % 2 = 0 then '' else nodes[p] end order by level) as lefts,
    list(case when p % 2 = 0 then coalesce(nodes[p + 2], '') else '' end order by level) as rights
  from steps group by all),
folds as (
  select p.*, s.subroot, r.nodes[1] as root, coalesce(proof, '') as proof, list_reduce(
    list_zip(coalesce(lefts, []), coalesce(rights, [])),
    lambda node, step: sha256(step[1] || node || step[2]), checked) as folded_root
  from placed p join subroots s on p.lang is not distinct from s.lang
  join (select nodes from tops where len(nodes) = 1) r on true
  left join paths q on p.lang is not distinct from q.lang and p.place = q.leaf_place)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded_root, folded_root = root as verified
from folds
"""
