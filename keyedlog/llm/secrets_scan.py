"""Secrets in whole texts: fixed patterns, and strings that a primed compressor finds new.

Patterns give the base findings, leftmost and without overlap for each kind: ``assign`` (a value of
six or more characters given to a password, secret, token or key), ``access`` (access key ids) and
``hex`` (hexadecimal runs).

The compressor adds ``novel`` findings. A candidate is a run of at least LEAST_CANDIDATE key
characters that begins at most NEAR characters after a sensitive word, or ends at most NEAR
characters before one, and overlaps no base finding. Of a run that holds the word only what is
behind the word counts; what is before it is the beginning of an identifier. Each candidate is
measured once.
Its novelty is the number of bytes by which it lengthens the zstandard output of its surroundings,
the compressor being primed with those surroundings and with a dictionary of identifiers, less what
a repeated run of the same length would cost. Words, paths and identifiers that the dictionary or
the surroundings know compress to little; keys do not. A candidate is reported if its novelty is at
least NOVELTY bytes for each of its characters.

Positions count code points, the end is exclusive. Null and empty texts have no findings. Rows are
independent of each other, and other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The patterns of base findings, and the least lengths of what they have to match.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_HINTS = ("passw", "secret", "token", "api")
LEAST_ASSIGN = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST_ACCESS = 20
HEX = re.compile(r"[0-9a-f]{24,}")

SENSITIVE = re.compile(
    r"(?i:password|passwd|pwd|secret|token|api_?key|access_?key|private_?key|credential|bearer"
    r"|authorization)", re.ASCII)
SENSITIVE_HINTS = ("passw", "pwd", "secret", "token", "key", "credential", "bearer", "authoriz")
IDENTIFIERS = (
    "abcdefghijklmnopqrstuvwxyz0123456789 return import from class function const static public "
    "private protected string number boolean object request response header content-type "
    "application/json authorization username password passwd secret token api_key access_key "
    "private_key credential bearer client_id client_secret config settings environment localhost "
    "example test default value name path file http https www com org index main version "
    "undefined null true false lambda self this document element attribute parameter argument "
).encode()
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
LEAST_CANDIDATE = 16
NEAR = 64
AROUND = 512
NOVELTY = 0.6


def _base(text: str, lowered: str) -> Iterator[tuple[str, int, int]]:
    if any(hint in lowered for hint in ASSIGN_HINTS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_ASSIGN:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end()


def _size(data: bytes, primer: bytes) -> int:
    known = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return len(zstandard.ZstdCompressor(level=9, dict_data=known).compress(data))


def novelty(candidate: str, before: str, after: str) -> float:
    """Marginal compressed bytes for each character of a candidate."""
    around = (before + "\n" + after).encode()
    primer = IDENTIFIERS + around
    data = candidate.encode()
    new = _size(around + data, primer) - _size(around + data[:1] * len(data), primer)
    return new / len(data)


def _candidates(runs: list[tuple[int, int]], ends: list[int], low: int, high: int,
                ) -> Iterator[tuple[int, int]]:
    """What of the runs is near to a sensitive word from low to high, first behind it."""
    for i in range(bisect_right(ends, high), len(runs)):
        start, end = runs[i]
        if start > high + NEAR:
            break
        if end - max(start, high) >= LEAST_CANDIDATE:
            yield max(start, high), end
    for i in range(bisect_left(ends, low - NEAR), len(runs)):
        start, end = runs[i]
        if end > low:
            break
        yield start, end


class Spans:
    """Parts of a text that are taken: apart from each other and in order."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends = [], []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(end, self.ends[-1])
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlap(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end) - 1
        return before >= 0 and self.ends[before] > start

    def take(self, start: int, end: int) -> None:
        """Add a span that overlaps none."""
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def findings(text: str | None) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, novelty) by start and then kind; base findings have no novelty."""
    if not text:
        return []
    lowered = text.lower()
    found: list = [(*f, None) for f in _base(text, lowered)]
    if any(hint in lowered for hint in SENSITIVE_HINTS):
        taken = Spans([(start, end) for _, start, end, _ in found])
        measured = set()
        runs = None
        for word in SENSITIVE.finditer(text):
            if runs is None:
                runs = [m.span() for m in CANDIDATE.finditer(text)]
                ends = [end for _, end in runs]
            for start, end in _candidates(runs, ends, *word.span()):
                if (start, end) in measured or taken.overlap(start, end):
                    continue
                measured.add((start, end))
                around = text[max(0, start - AROUND):start], text[end:end + AROUND]
                value = novelty(text[start:end], *around)
                if value >= NOVELTY:
                    found.append(("novel", start, end, value))
                    taken.take(start, end)
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                            ("novelty", pa.float64())]))


def secrets(documents: DataFrame) -> DataFrame:
    """Every row as doc_id and its findings: array of (kind, start, end, novelty)."""
    def run(batches):
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "novelty"), f))
                      for f in findings(text.as_py())] for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, FOUND)], ["doc_id", "findings"])

    rows = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, findings array<struct<kind: string, start: bigint, "
                                "end: bigint, novelty: double>>")
