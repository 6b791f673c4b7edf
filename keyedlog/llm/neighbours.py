"""Nearest neighbours by a block matrix join of int8 tiles, with exact results.

Vectors are scaled to length one and rounded to int8 with a scale of their own; what rounding took
away is kept as one number, the length of the rest. Queries are broadcast in slabs of at most
SLAB_BYTES, and the base streams past each slab where it lies, so it is not shuffled, however many slabs there are.
In a task every base tile meets every query tile of the slab, each pair one product of two small
matrices. With a = s*p + e and b = t*q + f, the product a.b differs from s*t*(p.q) by at most
|e| + |f| + |e||f|, so each approximate cosine has a bound. A pair survives if its upper bound
reaches the k-th largest lower bound of its query so far; only survivors are computed from the
original vectors in double precision. Each task keeps one heap of the k best for each query of the
slab, and what the heaps of all tasks hold is ranked at the end. Every product is formed and bounds
are never crossed, so recall is 1.

All rows of one vec_id are one vector: the smallest by the order of arrays, so repeated rows count
once; only rows of repeated ids are shuffled for that. Vectors that are null, zero or hold null or
non-finite components take no part, nor does a null vec_id. A query never finds itself; ties go to
the smaller vec_id; where there are fewer than k candidates, all are returned. Vectors of different
lengths have no cosine and are no candidates of each other; an empty table gives an empty one.
Other columns are not read.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sizing import Size, broadcast_within
from .store import keep

QUERY_TILE = 512
BASE_TILE = 2048
#: Bytes of the query vectors that are broadcast at a time; their int8 roundings come on top.
SLAB_BYTES = 32 << 20
SLACK = 1e-9

FOUND_SCHEMA = "query_id bigint, vec_id bigint, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) with one usable vector of doubles for each id."""
    rows = vectors.select(F.col("vec_id").cast("bigint"),
                          F.col("embedding").cast("array<double>")).where("vec_id is not null")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    rows = rows.where(F.col("embedding").isNotNull() & fine & some)
    repeated = keep(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "repeated")
    number = repeated.count()
    listed = broadcast_within(repeated, Size(number, 8 * number))
    once = rows.join(listed, "vec_id", "left_semi").groupBy("vec_id").agg(
        F.min("embedding").alias("embedding"))
    return rows.join(listed, "vec_id", "left_anti").unionAll(once)


class Tile:
    """Vectors of a tile: originals, int8 roundings of their unit vectors, scales and rests."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        largest = np.abs(self.vectors).max(axis=1, keepdims=True)
        unit = self.vectors / largest
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        self.scale = np.abs(unit).max(axis=1) / 127
        self.rounded = np.rint(unit / self.scale[:, None]).astype(np.int8)
        self.rest = np.linalg.norm(unit - self.scale[:, None] * self.rounded, axis=1)


def tiles(ids: pa.Array, embeddings: pa.Array, size: int):
    """Tiles of at most ``size`` vectors of one length."""
    names = ids.to_numpy(zero_copy_only=False)
    flat = embeddings.flatten().to_numpy(zero_copy_only=False)
    widths = embeddings.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.cumsum(widths) - widths
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        for low in range(0, len(rows), size):
            some = rows[low:low + size]
            yield Tile(names[some], flat[starts[some][:, None] + np.arange(width)])


def products(one: Tile, two: Tile) -> tuple[np.ndarray, np.ndarray]:
    """Approximate cosines of all pairs and the bounds of their errors.

    Products of int8 are whole numbers below 2^14, so single precision sums up to 1024 of them
    exactly; wider vectors are summed in double precision.
    """
    kind = np.float32 if one.rounded.shape[1] <= 1024 else np.float64
    dots = one.rounded.astype(kind) @ two.rounded.astype(kind).T
    near = dots * one.scale[:, None] * two.scale[None, :]
    e, f = one.rest[:, None], two.rest[None, :]
    return near, e + f + e * f + SLACK


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows, in double precision, summed from left to right."""
    def dot(x, y):
        return np.cumsum(x * y, axis=1)[:, -1]
    return dot(a, b) / (np.sqrt(dot(a, a)) * np.sqrt(dot(b, b)))


def _meet(queries: Tile, base: Tile, heaps: dict, k: int) -> None:
    """Put what a base tile has for a query tile into the heaps of its queries."""
    near, error = products(queries, base)
    itself = queries.ids[:, None] == base.ids[None, :]
    lower = np.where(itself, -np.inf, near - error)
    n = lower.shape[1]
    least = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(lower), -np.inf)
    held = np.array([heaps[q][0][0] if len(heaps[q]) == k else -np.inf
                     for q in queries.ids.tolist()])
    least = np.maximum(least, held - SLACK)
    left, right = np.nonzero((near + error >= least[:, None]) & ~itself)
    for low in range(0, len(left), 1 << 14):
        some = slice(low, low + (1 << 14))
        scores = exact(queries.vectors[left[some]], base.vectors[right[some]])
        pairs = zip(queries.ids[left[some]].tolist(), base.ids[right[some]].tolist(),
                    scores.tolist())
        for q, i, score in pairs:
            entry = (score, -i)
            if len(heaps[q]) < k:
                heapq.heappush(heaps[q], entry)
            elif entry > heaps[q][0]:
                heapq.heapreplace(heaps[q], entry)


def _search(slab, k: int):
    def run(batches):
        asked = [Tile(ids, vectors) for ids, vectors in slab.value]
        heaps = {q: [] for tile in asked for q in tile.ids.tolist()}
        for batch in batches:
            for base in tiles(batch.column("vec_id"), batch.column("embedding"), BASE_TILE):
                for queries in asked:
                    if queries.vectors.shape[1] == base.vectors.shape[1]:
                        _meet(queries, base, heaps, k)
        rows = [(q, -i, s) for q, heap in heaps.items() for s, i in heap]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))],
            ["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5,
            slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors of each query, by cosine."""
    spark = vectors.sparkSession
    base = keep(usable(vectors), "vectors")
    ids = keep(queries.select(F.col("vec_id").cast("bigint")).distinct(), "asked")
    number = ids.count()
    asked = keep(base.join(broadcast_within(ids, Size(number, 8 * number)), "vec_id", "left_semi"),
                 "queries")
    held = asked.agg(F.sum(F.size("embedding").cast("bigint") * 8 + 8)).first()[0] or 0
    # A hash deals queries evenly, so half the bytes on average keep every slab within its bound.
    slabs = -(-2 * held // slab_bytes) or 1
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = []
    for slab in range(slabs):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(slabs)) == slab).toArrow()
        rows = rows.combine_chunks()
        packed = [(t.ids, t.vectors) for chunk in rows.to_batches()
                  for t in tiles(chunk.column("vec_id"), chunk.column("embedding"), QUERY_TILE)]
        shared = spark.sparkContext.broadcast(packed)
        near = base.select("vec_id", "embedding").mapInArrow(_search(shared, k), FOUND_SCHEMA)
        ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        found.append(keep(ranked.select("query_id", "rank", "vec_id", "score"), "nearest"))
        shared.destroy()
    return reduce(DataFrame.unionAll, found)
