"""Documents that hold benchmark items, by SimHash of windows of each item's own length.

Words and five-word shingles are those of near-duplicate detection. An item's weighted set counts
how often it has each shingle, and so does a window of a document with as many words as the item
(the whole document, if it is shorter). Their similarity is the sum of the smaller counts over the
sum of the larger ones; a document is contaminated by an item if a window reaches PERCENT.

1. A window that reaches PERCENT shares at least PERCENT / 100 of the larger set's shingles with the
   item, and can be moved to begin with a shared shingle without losing any. So a document's
   shingles are looked up in those of the items of each length, and only windows are kept that begin
   at a hit (or are the document's last) and hold enough hits. Nothing that could pass is lost.
2. Kept windows get a SimHash of 64 bits from their weighted shingles. The items' fingerprints are
   indexed by blocks: if two fingerprints differ in at most RADIUS bits, one of BLOCKS blocks
   differs in at most RADIUS // BLOCKS bits, so looking up all block values that near finds every
   item within the radius. Sets at the least similarity differ by about 11 bits; the radius is
   four standard deviations above.
3. Exact weighted similarity decides.

The benchmark's words are dealt into slabs of bounded size. Each slab is one pass over the
documents with a broadcast index whose size the slab bounds; no document is shuffled.

Null and empty texts hold nothing; items without words are in nothing, and items of fewer than five
words only in documents of exactly these words. Rows that repeat a doc_id or
an item_id are judged one by one and give one row for each pair of ids, with the best similarity.
Rows with null ids take no part. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import SHINGLE_WORDS, mix, shingles, slices

PERCENT = 75
BITS = 64
RADIUS = 24
BLOCKS = 13
SLAB_BYTES = 8 << 20
#: Shingles of windows that are fingerprinted at a time, each taking 256 bytes meanwhile.
BLOCK_SHINGLES = 1 << 18

_EDGES = np.linspace(0, BITS, BLOCKS + 1).astype(int)
SCHEMA = "doc_id bigint, item_id bigint, similarity double, first_word bigint, words bigint"


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among known ones, which are sorted."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    places = np.searchsorted(known, values)
    places[places == len(known)] = 0
    return known[places] == values


def simhash(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Fingerprints of the multisets of hashes between bounds."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.add.reduceat(bits.astype(np.int32), bounds[:-1], axis=0)
    sizes = np.diff(bounds)[:, None]
    return np.packbits(2 * sums > sizes, axis=1, bitorder="little").view(np.uint64)[:, 0]


def _near_values(width: int) -> np.ndarray:
    """All values of a block that differ from 0 in at most RADIUS // BLOCKS bits."""
    values = np.arange(1 << width, dtype=np.uint64)
    return values[np.bitwise_count(values) <= RADIUS // BLOCKS]


class Index:
    """Items of one length: fingerprints by block value, and weighted sets."""

    def __init__(self, words: int, items: list[tuple[int, np.ndarray]]):
        self.words = words
        self.ids = [i for i, _ in items]
        self.sets = [Counter(s.tolist()) for _, s in items]
        flat = np.concatenate([s for _, s in items])
        self.known = np.unique(flat)
        bounds = np.concatenate([[0], np.cumsum([len(s) for _, s in items])])
        self.prints = simhash(flat, bounds)
        self.blocks = []
        for low, high in zip(_EDGES[:-1], _EDGES[1:]):
            mask = np.uint64((1 << int(high - low)) - 1)
            keys = self.prints >> np.uint64(low) & mask
            near = keys[:, None] ^ _near_values(int(high - low))[None, :]
            holders: dict[int, list[int]] = {}
            for item, row in enumerate(near.tolist()):
                for key in row:
                    holders.setdefault(key, []).append(item)
            self.blocks.append((np.uint64(low), mask, holders))

    def candidates(self, fingerprint: np.uint64) -> list[int]:
        """Items within the radius."""
        found: set[int] = set()
        for low, mask, holders in self.blocks:
            found.update(holders.get(int(fingerprint >> low & mask), ()))
        if not found:
            return []
        items = np.fromiter(found, dtype=np.int64)
        return items[np.bitwise_count(self.prints[items] ^ fingerprint) <= RADIUS].tolist()


def similarity(one: Counter, two: Counter) -> float:
    """Sum of the smaller counts over the sum of the larger ones."""
    shared = sum(min(n, two[s]) for s, n in one.items() if s in two)
    return shared / (one.total() + two.total() - shared)


def _window_sets(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    return hashes[starts[:, None] + np.arange(size)]


def _matches(hashes: np.ndarray, places: np.ndarray, n_words: int, index: Index):
    """(item, similarity, first word) of windows of one document.

    ``places`` are those of shingles that some item of any length has.
    """
    full = max(index.words - SHINGLE_WORDS + 1, 1)
    own = places[among(hashes[places], index.known)]
    if 100 * len(own) < PERCENT * full:
        return
    hits = np.zeros(len(hashes), dtype=bool)
    hits[own] = True
    size = min(max(index.words - SHINGLE_WORDS + 1, 1), len(hashes))
    if n_words < SHINGLE_WORDS or index.words < SHINGLE_WORDS:
        size = 1
    counts = np.concatenate([[0], np.cumsum(hits)])
    starts = np.flatnonzero(hits)
    starts = np.unique(np.minimum(starts, len(hashes) - size))
    held = counts[starts + size] - counts[starts]
    starts = starts[100 * held >= PERCENT * full]
    if not len(starts):
        return
    step = max(1, BLOCK_SHINGLES // size)
    for at in range(0, len(starts), step):
        some = starts[at:at + step]
        windows = _window_sets(hashes, some, size)
        prints = simhash(np.ascontiguousarray(windows).ravel(), np.arange(len(some) + 1) * size)
        for start, window, fingerprint in zip(some, windows, prints):
            near = index.candidates(fingerprint)
            if near:
                weighted = Counter(window.tolist())
                for item in near:
                    value = similarity(weighted, index.sets[item])
                    if 100 * value >= PERCENT:
                        yield index.ids[item], value, int(start)


def _build(rows) -> tuple[np.ndarray, list[Index]]:
    """Sorted shingle hashes of a slab's items, and an index for each length."""
    by_length: dict[int, list] = {}
    for part in slices(pa.array([r.text for r in rows], pa.string())):
        words = part.word_hashes()
        for i in range(part.count):
            own = words[part.doc_words[i]:part.doc_words[i + 1]]
            if len(own):
                by_length.setdefault(len(own), []).append(
                    (rows[part.first + i].item_id, shingles(own)))
    known = [s for items in by_length.values() for _, s in items]
    hashes = np.unique(np.concatenate(known)) if known else np.zeros(0, dtype=np.uint64)
    return hashes, sorted(by_length.items())


def _scan(shared):
    def run(batches):
        known, lengths = shared.value
        indexes = [Index(n, items) for n, items in lengths]
        # One bit for each value of some bits of a hash: most shingles are told apart by it.
        width = np.uint64(64 - max(16, int(len(known)).bit_length() + 6))
        marks = np.zeros(1 << int(64 - width), dtype=bool)
        marks[(mix(known) >> width).astype(np.int64)] = True
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            out = []
            for part in slices(batch.column("text")):
                words = part.word_hashes()
                for i in range(part.count):
                    low, high = part.doc_words[i], part.doc_words[i + 1]
                    hashes = shingles(words[low:high])
                    hits = marks[(mix(hashes) >> width).astype(np.int64)]
                    if hits.any():
                        hits[hits] = among(hashes[hits], known)
                    if not hits.any():
                        continue
                    places = np.flatnonzero(hits)
                    best: dict[int, tuple] = {}
                    for index in indexes:
                        for item, value, start in _matches(hashes, places, high - low, index):
                            if item not in best or value > best[item][0]:
                                best[item] = (value, start, index.words)
                    out.extend((ids[part.first + i], item, *found) for item, found in best.items())
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "item_id", "similarity", "first_word", "words"])
    return run


def contaminated(documents: DataFrame, benchmark: DataFrame, slab_bytes: int = SLAB_BYTES,
                 ) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, words) of each item that a document holds."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).where(
        "doc_id is not null and text is not null")
    items = benchmark.select(
        F.col("item_id").cast("bigint"), F.col("text").cast("string").alias("text")
    ).where("item_id is not null and text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slabs = -(-total // slab_bytes)
    found = None
    for slab in range(slabs):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slabs)) == slab).collect()
        shared = spark.sparkContext.broadcast(_build(rows))
        part = texts.mapInArrow(_scan(shared), SCHEMA)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], SCHEMA)
    best = F.max(F.struct("similarity", -F.col("first_word"), "words"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", F.col("best.similarity").alias("similarity"),
        (-F.col("best.col2")).alias("first_word"), F.col("best.words").alias("words"))
