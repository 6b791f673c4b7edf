"""Spelling variants: words one edit apart, each with its more frequent form.

1. Words are counted over whole texts: each task adds up its own documents before anything is shuffled.
2. Letters are hashed to ``SYMBOLS`` symbols, which makes reduced words. Every word has the full
   neighbourhood of its reduced word: all strings of symbols at most one insertion, deletion or replacement
   away, itself included, each as a 64-bit polynomial hash made from prefix sums in constant time.
   That is about 2 * SYMBOLS hashes a letter, whatever the length.
3. Neighbourhoods are joined with the reduced vocabulary, by hash. Words one edit apart have reduced words
   at most one edit apart, so no pair is lost; what meets by chance is refused by the edit distance
   of the original strings, inside the join.
4. The form of a word is its most frequent near word, if that is frequent enough; forms are followed to
   the last by doubling, in a few joins.

A hash that no reduced word can have is dropped where it is made, by a bitmap of the reduced vocabulary of
a fixed size limit (16 MiB); a vocabulary too large for it passes more hashes on, and loses none. A
reduced word that very many words share is a hot key of that join, which adaptive execution splits; no
pairs are made but those one edit apart.

Null texts have no words, an empty table no rows. A null doc_id damages no word. Rows that repeat count again.
Words of any length take part: hashes are made in blocks of bounded size, and words of over ``LONG`` code
points are compared in linear time. Columns other than doc_id and text
are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .digests import CRC_TABLE_SQL, crc32_sql
from .store import keep

SYMBOLS = 8
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A form has at least this many times the occurrences of the word.
FORM_TIMES = 2
#: A word of a document is damaged where this divides its crc32.
DAMAGED = 97

#: Characters of a text that are looked at together; a run is never cut.
PIECE = 1 << 20
#: Words and characters that a task counts before it passes the counts on.
HELD_WORDS, HELD_LETTERS = 200_000, 1 << 24
#: Hashes that a task makes at a time.
HASHES = 1 << 21
#: Words whose neighbourhoods one task makes.
TASK_WORDS = 20_000
#: Bits of the bitmap for each word, and at most.
WORD_BITS, MOST_BITS = 64, 1 << 27

#: Longer words are compared in Python, in linear time.
LONG = 200

_LETTERS = "A-Za-zÀ-ÿ"
_BASE = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93
_WORDS = "word string, n bigint"
_KEYS = "key bigint, word string, n bigint"


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces that end where no run is cut."""
    gap = re.compile(f"[^{_LETTERS}]")
    start = 0
    while start < len(text):
        found = gap.search(text, start + PIECE) if len(text) - start > PIECE else None
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end


def lowered(run: str) -> str:
    """A run with A-Z in lower case and other letters as they are; a run holds Latin-1 letters only."""
    return run.encode("latin-1").lower().decode("latin-1")


def damaged(word: str, code: int) -> str:
    """The word without the code point that its code names."""
    place = code % len(word)
    return word[:place] + word[place + 1:]


def _counter(damage: int | None):
    def count(batches):
        runs = re.compile(f"[{_LETTERS}]+")
        held, letters = Counter(), 0

        def out():
            return pa.record_batch({"word": pa.array(list(held), pa.string()),
                                    "n": pa.array(list(held.values()), pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id, text = doc_id.as_py(), text.as_py()
                before = zlib.crc32(f"{doc_id}:".encode())
                broken = damage is not None and doc_id is not None
                for piece in _pieces(text):
                    for run, n in Counter(runs.findall(piece)).items():
                        word = lowered(run)
                        if broken:
                            code = zlib.crc32(word.encode(), before)
                            if code % damage == 0:
                                word = damaged(word, code)
                        if len(word) >= LEAST_LENGTH:
                            if word not in held:
                                letters += len(word)
                            held[word] += n
                    if len(held) >= HELD_WORDS or letters >= HELD_LETTERS:
                        yield out()
                        held, letters = Counter(), 0
        if held:
            yield out()

    return count


def word_counts(documents: DataFrame, damage: int | None = None) -> DataFrame:
    """(word, n) of the words with at least LEAST_LENGTH code points and LEAST_COUNT occurrences.

    With ``damage``, a run of a document loses one code point where ``damage`` divides the crc32 of doc_id,
    a colon and the lower-cased run.
    """
    texts = documents.where("text is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_counter(damage), _WORDS).groupBy("word").agg(F.sum("n").alias("n")).where(
        F.col("n") >= LEAST_COUNT)


def _values() -> np.ndarray:
    """One odd number for each symbol."""
    mixed = (np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(_MIX)) ^ np.uint64(_BASE >> 7)
    return mixed * np.uint64(_BASE) | np.uint64(1)


def _symbols(letters: np.ndarray) -> np.ndarray:
    """The symbol of every code point."""
    return ((letters.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(12)) % np.uint64(SYMBOLS)).astype(
        np.int64)


def _with_length(hashes: np.ndarray, length: int) -> np.ndarray:
    return hashes ^ np.uint64(length * _MIX & 0xFFFFFFFFFFFFFFFF)


def _powers(count: int) -> np.ndarray:
    powers = np.full(count, _BASE, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _reduced(symbols: np.ndarray) -> np.ndarray:
    """The hash of each row of symbols: a polynomial, the first symbol its lowest term."""
    length = symbols.shape[1]
    return _with_length((_values()[symbols] * _powers(length)).sum(axis=1, dtype=np.uint64), length)


def _neighbourhoods(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of everything one edit or less from each row of symbols, in blocks.

    Edits that give the same string are made once: in a run of equal symbols the first is deleted,
    and a symbol is not inserted behind its like.
    """
    rows, length = symbols.shape
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))
    base, values, powers = np.uint64(_BASE), _values(), _powers(length + 1)
    terms = values[symbols] * powers[:length]
    prefix = np.zeros((rows, length + 1), np.uint64)
    np.cumsum(terms, axis=1, dtype=np.uint64, out=prefix[:, 1:])
    total = prefix[:, -1:]
    like_before = np.zeros((rows, length), bool)
    like_before[:, 1:] = symbols[:, 1:] == symbols[:, :-1]
    everyone = np.arange(rows)
    yield everyone, _with_length(total[:, 0], length)
    step = max(1, HASHES // max(1, rows))
    for start in range(0, length, step):
        at = slice(start, min(length, start + step))
        gone = prefix[:, at] + (total - prefix[:, 1:][:, at]) * inverse
        chosen = ~like_before[:, at]
        yield np.nonzero(chosen)[0], _with_length(gone[chosen], length - 1)
        for symbol, value in enumerate(values):
            other = total + value * powers[at] - terms[:, at]
            chosen = symbols[:, at] != symbol
            yield np.nonzero(chosen)[0], _with_length(other[chosen], length)
            put = prefix[:, at] + value * powers[at] + (total - prefix[:, at]) * base
            chosen = np.ones(put.shape, bool)
            behind = np.arange(at.start, at.stop) - 1
            chosen[:, behind >= 0] = symbols[:, behind[behind >= 0]] != symbol
            yield np.nonzero(chosen)[0], _with_length(put[chosen], length + 1)
    for symbol, value in enumerate(values):
        chosen = symbols[:, -1] != symbol
        put = (total[:, 0] + value * powers[length])[chosen]
        yield everyone[chosen], _with_length(put, length + 1)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the batch, their symbols) for words of one length, in blocks of bounded size."""
    words = batch.column("word")
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        rows = np.nonzero(lengths == length)[0]
        step = max(1, HASHES // (4 * int(length)))
        for start in range(0, len(rows), step):
            some = rows[start:start + step]
            text = "".join(words.take(pa.array(some)).to_pylist())
            letters = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            yield some, _symbols(letters.reshape(len(some), int(length)))


def _keyed(batch: pa.RecordBatch, rows: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    at = pa.array(rows)
    return pa.record_batch({"key": pa.array(hashes.view(np.int64)), "word": batch.column("word").take(at),
                            "n": batch.column("n").take(at)})


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Places in a bitmap of 2^k bits."""
    return hashes * np.uint64(_MIX) >> np.uint64(65 - bits.bit_length())


def _vocabulary(bits: int):
    def keys(batches):
        for batch in batches:
            for rows, symbols in _by_length(batch):
                hashes = _reduced(symbols)
                out = _keyed(batch, rows, hashes)
                yield out.append_column("place", pa.array(_places(hashes, bits).astype(np.int64)))

    return keys


def _neighbours(bits: int, bitmap):
    def keys(batches):
        held = bitmap.value
        for batch in batches:
            for rows, symbols in _by_length(batch):
                for at, hashes in _neighbourhoods(symbols):
                    places = _places(hashes, bits)
                    marks = held[places >> np.uint64(6)] >> (places & np.uint64(63))
                    found = (marks & np.uint64(1)).astype(bool)
                    if found.any():
                        yield _keyed(batch, rows[at[found]], hashes[found])

    return keys


def one_edit(one: str, two: str) -> bool:
    """Whether two different texts are one insertion, deletion or replacement apart."""
    if len(one) > len(two):
        one, two = two, one
    if len(two) - len(one) > 1:
        return False
    same, most = 0, len(one)
    while same < most:
        middle = (same + most + 1) // 2
        if one[same:middle] == two[same:middle]:
            same = middle
        else:
            most = middle - 1
    return one[same + (len(one) == len(two)):] == two[same + 1:]


def _one_edit_pairs(batches):
    for batch in batches:
        kept = [one_edit(a.as_py(), b.as_py()) for a, b in zip(batch.column(0), batch.column(1))]
        yield batch.filter(pa.array(kept, pa.bool_()))


def _bitmap(vocabulary: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of all places; no more rows than it has words of 64 bits come to the driver."""
    one = F.lit(1).cast("bigint")
    marks = vocabulary.groupBy(F.shiftright("place", 6).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", one, (F.col("place") % 64).cast("int"))).alias("mark")).toArrow()
    out = np.zeros(max(1, bits // 64), np.uint64)
    out[marks.column("at").to_numpy()] = marks.column("mark").to_numpy().view(np.uint64)
    return out


def _merged(df: DataFrame) -> DataFrame:
    """A side of a join that is shuffled and sorted, whatever size Spark takes it for.

    A neighbourhood counts as large as the word it is made from, and a written table as large as its
    compressed files, so Spark would have the driver hold many times its limit.
    """
    return df.hint("shuffle_merge")


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, other_n) of all pairs of words (word, n) exactly one edit apart, both ways round."""
    spark = words.sparkSession
    count, bits = words.count(), 1 << 16
    while bits < min(MOST_BITS, WORD_BITS * count):
        bits *= 2
    vocabulary = keep(words.mapInArrow(_vocabulary(bits), _KEYS + ", place bigint"), "reduced")
    bitmap = spark.sparkContext.broadcast(_bitmap(vocabulary, bits))
    others = vocabulary.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))

    def meeting(some: DataFrame, tasks: int, condition: Column) -> DataFrame:
        around = some.repartition(tasks, "word").mapInArrow(_neighbours(bits, bitmap), _KEYS)
        found = _merged(around).join(_merged(others), (around["key"] == others["key"]) & condition)
        return found.select("word", "other", "other_n")

    differ, long = F.col("word") != F.col("other"), F.length("word") > LONG
    pairs = meeting(words.where(~long), 1 + count // TASK_WORDS,
                    differ & (F.expr("levenshtein(word, other, 1)") == 1))
    if words.where(long).limit(1).count():
        far = meeting(words.where(long), 1 + count // TASK_WORDS, differ)
        pairs = pairs.unionAll(far.mapInArrow(_one_edit_pairs, far.schema))
    return pairs.repartition("word").dropDuplicates(["word", "other"])


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: each join doubles how many forms are followed."""
    current = keep(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = current.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        joined = current.join(_merged(further), F.col("root") == F.col("_word"), "left")
        following = keep(joined.select("word", F.coalesce("_root", "root").alias("root"),
                                       F.col("_root").isNotNull().alias("moved")), "roots")
        if following.where("moved").limit(1).count() == 0:
            return current
        current = following.select("word", "root")


def variants(words: DataFrame) -> DataFrame:
    """Every word (word, n) with form, root, n_near and form_n."""
    words = keep(words, "words")
    most = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("most")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), most)
    form = -F.col("most.less") >= FORM_TIMES * F.col("n")
    forms = keep(words.join(_merged(near), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(form, F.col("most.other")).alias("form"), F.when(form, -F.col("most.less")).alias("form_n")),
        "forms")
    return forms.join(_merged(_roots(forms)), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def documents_variants(documents: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of the damaged words of all documents."""
    return variants(word_counts(documents, DAMAGED))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SQL = f"""
with recursive {CRC_TABLE_SQL},
runs as (
  select doc_id, translate(run, '{_UPPER}', '{_UPPER.lower()}') as run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(text, '[{_LETTERS}]+')) as run from documents)
  group by all),
coded as (
  select run, n, case when doc_id is null then 1 else {crc32_sql("(doc_id || ':' || run)")} end as h
  from runs, crc_table),
words as (
  select word, cast(sum(n) as bigint) as n from (
    select n, case when h % {DAMAGED} = 0
      then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
    from coded)
  where length(word) >= {LEAST_LENGTH} group by word having sum(n) >= {LEAST_COUNT}),
shorter as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select *, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select a.word, b.word as other, b.n from shorter a join shorter b
    on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union
  select a.word, b.word, b.n from shorter a join words b on a.rest = b.word
  union
  select b.word, a.word, a.n from shorter a join words b on a.rest = b.word),
best as (
  select word, count(*) as n_near, arg_min(other, struct_pack(a := -n, b := other)) as other, max(n) as other_n
  from near group by word),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near,
    case when other_n >= {FORM_TIMES} * w.n then other end as form,
    case when other_n >= {FORM_TIMES} * w.n then other_n end as form_n
  from words w left join best b on w.word = b.word),
chains as (
  select word, word as root, form from forms
  union all
  select c.word, c.form, f.form from chains c join forms f on c.form = f.word)
select f.word, f.form, root, f.n, n_near, form_n from forms f join chains c on f.word = c.word and c.form is null
"""
