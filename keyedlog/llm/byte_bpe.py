"""Byte-level BPE with a queue of merges by rank, for pre-tokens of any length.

The symbols of a pre-token are a doubly linked list. Every pair that can merge lies in the bucket of
its rank, and a bitmap of two levels tells which buckets hold anything: the lowest set bit of the
upper level names a group of ranks, the lowest set bit of the group the next rank. Within a bucket
positions leave from the left. An entry whose pair has changed meanwhile is stale and is skipped. A
merge makes at most two new entries, so a pre-token of n bytes takes O(n log n) steps.

Ranks come from a file of public ranks, of any number; they are read once by the driver, and the
upper level of the bitmap is as wide as the largest rank asks for. Pre-tokens are remembered per process up to a number; what was forgotten is computed
again.

Null and empty texts have no ids and decode to nothing. Rows are independent of each other: repeated
rows give repeated results, and other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .remembered import remembered

REMEMBERED = 700_000
GROUP_BITS = 8
LOW = (1 << GROUP_BITS) - 1

#: White space as Unicode's property has it; ``\s`` of the regex library also matches 0x1C-0x1F.
SPACES = r"\t-\r " + "".join(
    map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: a line holds a token in base64, and its rank."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def portable(pattern: str) -> str:
    """The pattern with white space spelled out."""
    return (pattern.replace(r"[^\s", f"[^{SPACES}").replace(r"\S", f"[^{SPACES}]")
            .replace(r"\s", f"[{SPACES}]"))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token.

    The queue lives in local variables, as most pre-tokens are short: ``groups`` is the upper level
    of the bitmap, ``members`` the lower one, and ``buckets`` holds the pairs of each rank, as
    start * (n + 1) + end. A pair whose two symbols no longer have this start and end is stale.
    """
    if piece in ranks:
        return [ranks[piece]]
    n, find = len(piece), ranks.get
    wide = n + 1
    end = list(range(1, n + 1))  # of the symbol that begins here; 0 once it is swallowed
    before = list(range(-1, n - 1))
    groups, members, buckets = 0, {}, {}
    for i in range(n - 1):
        rank = find(piece[i:i + 2])
        if rank is not None:
            if rank in buckets:
                buckets[rank].append(i * wide + i + 2)
            else:
                buckets[rank] = [i * wide + i + 2]
                group = rank >> GROUP_BITS
                groups |= 1 << group
                members[group] = members.get(group, 0) | 1 << (rank & LOW)
    while groups:
        group = (groups & -groups).bit_length() - 1
        held = members[group]
        rank = group << GROUP_BITS | (held & -held).bit_length() - 1
        bucket = buckets[rank]
        i, stop = divmod(heappop(bucket) if len(bucket) > 1 else bucket.pop(), wide)
        if not bucket:
            del buckets[rank]
            members[group] = held = held & (held - 1)
            if not held:
                groups &= groups - 1
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            finish = end[stop]
            rank = find(piece[i:finish])
            if rank is not None:
                if rank in buckets:
                    heappush(buckets[rank], i * wide + finish)
                else:
                    buckets[rank] = [i * wide + finish]
                    group = rank >> GROUP_BITS
                    groups |= 1 << group
                    members[group] = members.get(group, 0) | 1 << (rank & LOW)
        if i:
            start = before[i]
            rank = find(piece[start:stop])
            if rank is not None:
                if rank in buckets:
                    heappush(buckets[rank], start * wide + stop)
                else:
                    buckets[rank] = [start * wide + stop]
                    group = rank >> GROUP_BITS
                    groups |= 1 << group
                    members[group] = members.get(group, 0) | 1 << (rank & LOW)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class Codec(dict):
    """Encodes and decodes; as a mapping, it remembers the ids of pre-tokens.

    Half of what may be remembered is in the mapping itself. When that is full it becomes the older
    half, from which pre-tokens come back as they are met, and what was older is forgotten.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = REMEMBERED):
        super().__init__()
        self.ranks, self.remembered, self.older = ranks, remembered, {}
        self.pieces = regex.compile(portable(pattern)).findall
        self.tokens = {rank: token for token, rank in ranks.items()}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = merge(piece.encode(), self.ranks)
            ids = pack(f"<{len(ids)}I", *ids)
        if len(piece) < 64:
            if 2 * len(self) >= self.remembered:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.pieces(text))) if text else b""

    def decode(self, ids: bytes | None) -> bytes:
        numbers = np.frombuffer(ids or b"", dtype="<u4").tolist()
        return b"".join(map(self.tokens.__getitem__, numbers))


class SharedCodec:
    """The ranks as a broadcast variable; one codec for each process, kept until others' tasks come."""

    def __init__(self, df: DataFrame, path: str, pattern: str):
        ranks = read_ranks(path)
        self.ranks = df.sparkSession.sparkContext.broadcast(ranks)
        self.key = hashlib.sha256(repr((pattern, sorted(ranks.items()))).encode()).hexdigest()
        self.pattern = pattern

    def codec(self) -> Codec:
        return remembered(("byte_bpe", self.key), lambda: Codec(self.ranks.value, self.pattern))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id",
           ) -> DataFrame:
    """(key, ids): ids of each whole text, packed as little-endian unsigned 32-bit integers."""
    shared = SharedCodec(df, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]):
        codec = shared.codec()
        for batch in batches:
            ids = [codec.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary())], [key, "ids"])

    rows = df.select(key, F.col(text).cast("string"))
    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, ids binary")


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", key: str = "doc_id",
           ) -> DataFrame:
    """(key, decoded): the bytes behind packed ids."""
    shared = SharedCodec(df, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]):
        codec = shared.codec()
        for batch in batches:
            out = [codec.decode(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary())], [key, "decoded"])

    rows = df.select(key, F.col(ids))
    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, decoded binary")


def round_trip(df: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Every row encoded and decoded again: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids)."""
    shared = SharedCodec(df, path, pattern)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]):
        codec = shared.codec()
        for batch in batches:
            counts, before, after, kept = [], [], [], []
            for text in batch.column(1):
                ids = codec.encode(text.as_py())
                counts.append(len(ids) // 4)
                before.append(hashlib.sha256(ids).hexdigest())
                after.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                if keep_ids:
                    kept.append(ids)
            columns = [batch.column(0), pa.array(counts, pa.int64()),
                       pa.array(before, pa.string()), pa.array(after, pa.string())]
            if keep_ids:
                columns.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = df.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema + ", ids binary" * keep_ids)
