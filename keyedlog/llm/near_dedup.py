"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set holds the hashes of its distinct five-word shingles (64 bits each; two different
shingles of one pair of documents meet with a chance of about 2^-40 even in very long texts).
Documents with 100 * intersection >= 75 * union are linked.

1. Documents with equal sets become one class, by a fingerprint of 128 bits. Hot classes are
   combined before their shuffle.
2. The sketch of a class is the K smallest hashes of its set. Of two linked sets at least
   ``least_shared(K)`` sketch values are common, but for a chance below a millionth; sets of up to
   three quarters of K shingles meet whole sets only, and for them the bound is exact. So it is enough to invert,
   of each sketch, the values that are left when as many as may be spared are taken off, and the
   commonest are those: a passage that many documents share makes no list unless most of a sketch
   comes from such passages.
3. Classes that meet in a list of inverted values, directly or through others, are a cluster.
   Clusters are cut into blocks of bounded size, and every pair of blocks is one unit of work:
   overlaps of sketches, the filter by the estimate from the union's sketch, and exact similarity
   on full sets for what passes. A unit returns a spanning forest of its links, so the rows made
   follow the number of documents and not of pairs.
4. Components of the links.

The work inside one cluster is the number of its pairs of *different* sets, as it must be where
all of them are half alike; it is spread over as many tasks as the cluster has pairs of blocks.

Nulls, texts without words: an empty set, linked with nothing. A null doc_id takes no part and is
returned as its own row with a null component. Rows that repeat a doc_id: every row is returned,
with the component of its own text. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .components import components
from .store import keep
from .text import mix, shingles, slices

K = 32
PERCENT = 75
BLOCK_SETS = 256
BLOCK_SHINGLES = 400_000


def _tail(k: int, shared: int, rate: float) -> float:
    return sum(math.comb(k, i) * rate**i * (1 - rate) ** (k - i) for i in range(shared))


def least_shared(k: int = K, percent: int = PERCENT, chance: float = 1e-6) -> int:
    """Values that the sketches of two linked sets share, but for the given chance."""
    shared = 1
    while shared < k and _tail(k, shared + 1, percent / 100) <= chance:
        shared += 1
    return shared


LEAST = least_shared()
SKETCH_SCHEMA = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, sketch array<bigint>"


def _sets(column: pa.Array):
    for part in slices(column):
        words = part.word_hashes()
        for i in range(part.count):
            low, high = part.doc_words[i], part.doc_words[i + 1]
            yield np.unique(shingles(words[low:high]))


def _sketch_batches(k: int):
    def run(batches):
        for batch in batches:
            sizes, first, second, sketches = [], [], [], []
            for values in _sets(batch.column("text")):
                sizes.append(len(values))
                first.append(mix(values).sum(dtype=np.uint64))
                second.append(mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                sketches.append(values[:k].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(first, dtype=np.uint64).view(np.int64)),
                    pa.array(np.array(second, dtype=np.uint64).view(np.int64)),
                    _lists(sketches),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "sketch"],
            )
    return run


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))


def _set_batches(batches):
    for batch in batches:
        ids, sets, size = [], [], 0
        for doc, values in zip(batch.column("doc_id").to_pylist(), _sets(batch.column("text"))):
            ids.append(doc)
            sets.append(values.tobytes())
            size += values.nbytes
            if size > 1 << 24:
                yield pa.RecordBatch.from_pydict({"rep": pa.array(ids, pa.int64()),
                                                  "shingles": pa.array(sets, pa.binary())})
                ids, sets, size = [], [], 0
        yield pa.RecordBatch.from_pydict({"rep": pa.array(ids, pa.int64()),
                                          "shingles": pa.array(sets, pa.binary())})


def sketches(documents: DataFrame, k: int = K) -> DataFrame:
    texts = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return texts.mapInArrow(_sketch_batches(k), SKETCH_SCHEMA)


def _clusters(classes: DataFrame) -> DataFrame:
    """(rep, cluster) of the classes that meet others in lists of inverted sketch values."""
    values = classes.select("rep", "n_shingles", F.explode("sketch").alias("value"))
    counts = keep(values.groupBy("value").agg(F.count("*").alias("lists")).where("lists > 1"),
                  "values")
    shared = values.join(counts, "value").select(
        "rep", "value", "lists",
        F.when(
            100 * F.col("n_shingles") <= PERCENT * K, F.ceil(F.col("n_shingles") * PERCENT / 100)
        ).otherwise(LEAST).alias("shared"),
    )
    commonest = W.partitionBy("rep").orderBy(F.desc("lists"), F.desc("value"))
    inverted = keep(
        shared.withColumn("place", F.row_number().over(commonest)).where("place >= shared")
        .select("rep", "value"),
        "inverted",
    )
    hubs = inverted.groupBy("value").agg(F.min("rep").alias("hub"), F.count("*").alias("n"))
    edges = inverted.join(hubs.where("n > 1").hint("rebalance"), "value").where("rep <> hub")
    nodes = components(edges.select(F.col("rep").alias("a"), F.col("hub").alias("b")))
    return nodes.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))


def _linked_blocks(left: list, right: list | None) -> list[tuple[int, int]]:
    """A spanning forest of the links within one block, or between two, with the blocks' own.

    Sets come as (id, sorted hashes). A pair is looked at unless its ends are connected already.
    """
    sets = left + (right or [])
    ids = [i for i, _ in sets]
    sizes = np.array([len(s) for _, s in sets], dtype=np.int64)
    flat, owner = np.concatenate([s for _, s in sets]), np.repeat(np.arange(len(sets)), sizes)
    values, column = np.unique(flat, return_inverse=True)
    counts = np.bincount(column)
    frequent = np.flatnonzero(counts > 1)
    place = np.full(len(values), -1)
    place[frequent] = np.arange(len(frequent))
    common = place[column] >= 0
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    # A sketch value of a set is among its K smallest; pairs that share too few are no links.
    order = np.concatenate([np.arange(n) for n in sizes])
    in_sketch = common & (order < K)
    sketch = _incidence(owner[in_sketch], place[column[in_sketch]], len(sets), len(frequent))
    shared = sketch[: len(left)] @ (sketch if right is None else sketch[len(left):]).T
    small = np.minimum(sizes, K)
    a_sizes, b_sizes = sizes[: len(left)], sizes if right is None else sizes[len(left):]
    a_small, b_small = small[: len(left)], small if right is None else small[len(left):]
    full = (a_sizes[:, None] > K) | (b_sizes[None, :] > K)
    least = np.where(full, LEAST, 1)
    # Where both sketches are whole sets, they tell the similarity.
    union = a_small[:, None] + b_small[None, :] - shared
    fits = full | (100 * shared >= PERCENT * union)
    ratio = 100 * np.minimum(a_sizes[:, None], b_sizes[None, :]) >= PERCENT * np.maximum(
        a_sizes[:, None], b_sizes[None, :])
    passed = (shared >= least) & fits & ratio
    if right is None:
        passed &= np.arange(len(left))[:, None] < np.arange(len(left))[None, :]
    found = []
    shift = 0 if right is None else len(left)
    for a in np.flatnonzero(passed.any(axis=1)):
        for b in np.flatnonzero(passed[a]) + shift:
            x, y = root(int(a)), root(int(b))
            if x == y:
                continue
            one, two = sets[a][1], sets[b][1]
            if full[a, b - shift] and _estimate(one, two) < LEAST:
                continue
            inner = len(np.intersect1d(one, two, assume_unique=True))
            if 100 * inner >= PERCENT * (len(one) + len(two) - inner):
                parent[max(x, y)] = min(x, y)
                found.append((ids[a], ids[b]))
    return found


def _estimate(one: np.ndarray, two: np.ndarray) -> int:
    """How many of the K smallest values of the union are in both sets."""
    merged = np.sort(np.concatenate([one[:K], two[:K]]))
    again = merged[1:] == merged[:-1]
    distinct = 1 + np.cumsum(~again)
    return int(np.count_nonzero(again & (distinct <= K)))


def _incidence(rows: np.ndarray, columns: np.ndarray, n: int, width: int) -> np.ndarray:
    """A dense 0/1 matrix over the columns in use only."""
    used, inner = np.unique(columns, return_inverse=True)
    matrix = np.zeros((n, len(used)), dtype=np.float32)
    matrix[rows, inner] = 1
    return matrix


def _units(frames):
    """Links of each unit of work; the rows of a unit are neighbours."""
    key, left, right = None, [], []

    def links():
        if not left or (key[1] != key[2] and not right):
            return
        yield from _linked_blocks(left, right if key[1] != key[2] else None)

    for frame in frames:
        out = []
        columns = (frame[c].tolist() for c in ("cluster", "i", "j", "block", "rep", "shingles"))
        for cluster, i, j, block, rep, data in zip(*columns):
            if (cluster, i, j) != key:
                out.extend(links())
                key, left, right = (cluster, i, j), [], []
            side = left if block == i else right
            side.append((rep, np.frombuffer(data, dtype=np.uint64)))
        yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    yield pd.DataFrame(list(links()) if key else [], columns=["a", "b"], dtype="int64")


def links(documents: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b) of linked classes: a forest for each unit, so that all links' components are there."""
    sizes = classes.groupBy("rep").agg(F.sum("n_shingles").alias("n_shingles"))
    members = _clusters(classes).join(sizes, "rep")
    members = keep(members, "members")
    plans = members.groupBy("cluster").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
        ).cast("int").alias("blocks")
    )
    placed = keep(
        members.join(plans.hint("rebalance"), "cluster").select(
            "rep", "cluster", "blocks",
            F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block")),
        "placed",
    )
    texts = documents.select(F.col("doc_id").cast("bigint").alias("rep"),
                             F.col("text").cast("string").alias("text"))
    sets = (
        texts.join(placed.select("rep"), "rep", "left_semi")
        .select(F.col("rep").alias("doc_id"), "text")
        .mapInArrow(_set_batches, "rep bigint, shingles binary")
        .groupBy("rep").agg(F.collect_set("shingles").alias("sets"))
    )
    units = sets.join(placed, "rep").withColumn("shingles", F.explode("sets")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "rep", "shingles",
    )
    return (
        units.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "rep")
        .mapInPandas(_units, "a bigint, b bigint")
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Every row of documents as doc_id, n_shingles, component_id, kept."""
    sets = keep(sketches(documents), "sketches")
    named = sets.where("doc_id is not null and n_shingles > 0")
    classes = named.groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch"),
    )
    classes = keep(classes, "classes")
    found = keep(links(documents, classes), "links")
    joined = components(found).select(F.col("node").alias("rep"), "component")
    names = keep(
        classes.join(joined, "rep", "left").select(
            "set_a", "set_b", F.coalesce("component", "rep").alias("component_id")),
        "names",
    )
    rows = sets.select("doc_id", "n_shingles", "set_a", "set_b")
    named_rows = rows.where("doc_id is not null and n_shingles > 0").join(names, ["set_a", "set_b"])
    alone = rows.where("doc_id is null or n_shingles = 0").withColumn(
        "component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return named_rows.select(columns).unionAll(alone.select(columns)).withColumn(
        "kept", F.col("doc_id").isNotNull() & (F.col("doc_id") == F.col("component_id")))


#: The same rows in DuckDB: a join on shingles, and everything that is reachable over links.
SQL = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
shingled as (
  select doc_id, list_sort(list_distinct(case
    when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as s
  from worded),
classes as (
  select s, min(doc_id) as rep from shingled where doc_id is not null and len(s) > 0 group by s),
single as (select rep, len(s) as n, unnest(s) as shingle from classes),
links as (
  select a.rep as a, b.rep as b from single a join single b on a.shingle = b.shingle and a.rep < b.rep
  group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
steps as (select a, b from links union all select b, a from links),
reach as (
  select rep as node, rep as other from classes
  union
  select r.node, t.b from reach r join steps t on r.other = t.a),
named as (
  select s, component_id from classes
  join (select node, min(other) as component_id from reach group by node) on rep = node)
select doc_id, cast(len(shingled.s) as bigint) as n_shingles,
  coalesce(component_id, doc_id) as component_id,
  doc_id is not null and doc_id = coalesce(component_id, doc_id) as kept
from shingled left join named on named.s = shingled.s and doc_id is not null
"""
