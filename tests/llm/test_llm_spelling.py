"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from keyedlog.llm import spelling
from llm_cases import DOCS, documents


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            code = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{word}".encode())
            if code % 97 == 0:
                word = word[:code % len(word)] + word[code % len(word) + 1:]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def brute_variants(words):
    forms = {}
    for word, n in words.items():
        near = sorted((-m, other) for other, m in words.items() if one_edit(word, other))
        form = near[0][1] if near and -near[0][0] >= 2 * n else None
        forms[word] = (form, n, len(near), words[form] if form else None)
    out = {}
    for word, (form, n, near, form_n) in forms.items():
        root = word
        while forms[root][0] is not None:
            root = forms[root][0]
        out[word] = (form, root, n, near, form_n)
    return out


def answer(df):
    rows = df.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def spoiled(rng, word):
    place, letter = rng.randrange(len(word)), rng.choice("abÀéÿ×")
    return rng.choice([word[:place] + word[place + 1:], word[:place] + letter + word[place:],
                       word[:place] + letter + word[place + 1:], word])


@pytest.mark.parametrize("piece, held", [(1 << 20, 200_000), (50, 3)])
def test_documents_against_brute_force(spark, monkeypatch, piece, held):
    monkeypatch.setattr(spelling, "PIECE", piece)
    monkeypatch.setattr(spelling, "HELD_WORDS", held)
    rng = random.Random(piece)
    plain = ["".join(rng.choices("abcdeéÀß", k=rng.randrange(3, 9))) for _ in range(60)]
    texts = []
    for _ in range(400):
        words = [spoiled(rng, w) if rng.random() < 0.3 else w for w in rng.choices(plain, k=30)]
        texts.append(rng.choice([" ", "-", "\n", "1"]).join(w.upper() if rng.random() < 0.1 else w for w in words))
    texts += [None, "", "!!", "字字字字字", "aaaaa " * 3, "aaaaaa " * 9, "x" * 3000 + " " + "y" * 6]
    df = documents(spark, texts).unionAll(spark.createDataFrame(
        [(None, "\n".join(plain), "en", "s", 1, "x", 0), (5, texts[4], "en", "s", 1, "x", 0)], DOCS))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    words = brute_words(rows)
    assert len(words) > 80
    found = answer(spelling.documents_variants(df.repartition(4)))
    assert found == brute_variants(words)


@pytest.mark.parametrize("bits", [1 << 16, 64])
def test_near_words_of_any_script_and_length(spark, monkeypatch, bits):
    """A full bitmap loses nothing either, nor do blocks of a few hashes."""
    monkeypatch.setattr(spelling, "MOST_BITS", bits)
    monkeypatch.setattr(spelling, "HASHES", 64 if bits == 64 else 1 << 21)
    rng = random.Random(bits)
    long = "".join(rng.choices("ab", k=700))
    words = {"abc", "abcd", "ab", "aab", "aaab", "слово", "слова", "словаа", "字典", "字字", long, long[:-1],
             long[:300] + long[301:], long[:300] + "z" + long[301:], long + "b", long + "c"}
    words |= {"".join(rng.choices("abc", k=rng.randrange(1, 6))) for _ in range(150)}
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    found = {(r.word, r.other) for r in spelling.near_words(df).collect()}
    assert found == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_neighbourhoods_are_full_and_without_repeats():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, spelling.SYMBOLS, (20, 6))
    symbols[0] = 3
    made = {}
    for rows, hashes in spelling._neighbourhoods(symbols):
        for row, value in zip(rows, hashes):
            made.setdefault(int(row), []).append(int(value))

    def value(word):
        return int(spelling._reduced(np.array([word]))[0])

    for row, word in enumerate(symbols.tolist()):
        edits = {tuple(word)} | {tuple(word[:i] + word[i + 1:]) for i in range(6)}
        for s in range(spelling.SYMBOLS):
            edits |= {tuple(word[:i] + [s] + word[i + 1:]) for i in range(6)}
            edits |= {tuple(word[:i] + [s] + word[i:]) for i in range(7)}
        assert sorted(made[row]) == sorted(value(list(e)) for e in edits)


def test_long_chains_and_one_word_with_many_variants(spark):
    chain = ["a" * (5 + i) for i in range(20)]
    words = {w: 3 * 2 ** i for i, w in enumerate(chain)}
    words |= {"zyxwv" + chr(0xC0 + i): 3 for i in range(60)} | {"zyxwv": 10 ** 9}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert answer(spelling.variants(df)) == brute_variants(words)


def test_a_word_of_a_million_letters(spark):
    long = "".join(random.Random(0).choices("abcdefgh", k=1_000_000))
    df = documents(spark, [f"{long} {long} {long}", f"{long}x " * 6, None])
    found = answer(spelling.documents_variants(df))
    assert {(len(w), f and len(f), v[2]) for w, v in found.items() for f in [v[0]]} == {
        (1_000_000, 1_000_001, 3), (1_000_001, None, 6)}


def test_no_words(spark):
    assert spelling.documents_variants(spark.createDataFrame([], DOCS)).count() == 0
    assert spelling.documents_variants(documents(spark, [None, "", "a b c", "lonely"])).count() == 0


def test_no_side_of_a_join_is_broadcast_by_guess(spark):
    """A few words have many neighbours each, of which Spark knows nothing when it plans."""
    words = spark.createDataFrame([(f"word{chr(97 + i)}", 9) for i in range(20)], "word string, n bigint")
    near = spelling.near_words(words)
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
    assert near.count() == 20 * 19
