"""Toxicity by a support vector machine on gapped subsequences, with Nystrom landmarks.

The kernel of two words is the gap-weighted subsequence kernel: every subsequence of three letters
within a span of SPAN letters counts DECAY to the power of its span in each word, and the sum over
common subsequences is scaled by the words' own kernels. Letters that were put in, left out or set
apart change few subsequences, so a disguised insult stays near to the plain one. A word here is a
token's letters without any signs between them; neighbouring tokens of one letter each make one
word, as in "i d i o t". Letters are code points without case: a to z each by itself, letters of
all other scripts in OTHERS classes by a hash, signs and marks of any script not at all.

Fit, on a bounded sample of labelled documents:

1. Sentences carry their document's label, but a sentence that also stands in a clean document is
   clean. Toxic documents that share sentences are one group, so copies count once. A fragment of
   words is telling if its share of groups is at least RATIO times its share of clean documents and
   its numbers are more than chance explains, so some clean documents may have it. Words of toxic
   sentences with a telling fragment, and with that ratio themselves, are the positive instances;
   words of clean sentences without a telling fragment are the negative ones.
2. Landmarks are the commonest positive words and some negative ones. The Nystrom map of the kernel
   to the landmarks makes vectors, on which a linear machine is trained with hinge loss.
3. The score of a document is a logistic function, fitted on the sample, of the largest decision
   value over all words of its whole text.

The decision value is linear in a word's subsequences, so it is computed from one table of weights
of all LETTERS^3 subsequences, which is the machine itself and not an approximation.

Null texts and texts without letters have the decision value of no words, and the score that goes
with it. With nothing to learn from, every score is 0. Rows are scored one by one; other columns
are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import mix, slices

SAMPLE_DOCUMENTS = 1500
DECAY = 0.7
SPAN = 7
OTHERS = 21
LETTERS = 27 + OTHERS
LANDMARKS = 96
NEGATIVES = 6000
POSITIVES = 4000
FRAGMENTS = (4, 5, 6)
LEAST_GROUPS = 3
NEARLY_ALL = 0.85
RATIO = 10
REGULAR = 1e-4
EPOCHS = 30
NO_WORDS = -3.0


def _letter(code: int) -> int:
    """The class of a code point; 0 for what is no letter."""
    low = chr(code).lower()[0] if code < 0x110000 and not 0xD800 <= code < 0xE000 else " "
    if not low.isalpha():
        return 0
    if "a" <= low <= "z":
        return ord(low) - 96
    return 27 + int(mix(np.array([ord(low)], dtype=np.uint64))[0] % np.uint64(OTHERS))


_ASCII = np.array([_letter(c) if c < 128 else 0 for c in range(256)])


def letter_codes(data: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8 the class of the letter that begins there, 0 for any other byte."""
    codes = _ASCII[data]
    for low, high, more in ((0xC0, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0x100, 3)):
        at = np.flatnonzero((data >= low) & (data < high))
        if not len(at):
            continue
        points = (data[at] - low).astype(np.int64)
        for step in range(1, more + 1):
            points = points * 64 + (data[at + step] & 63)
        found, place = np.unique(points, return_inverse=True)
        codes[at] = np.array([_letter(int(c)) for c in found])[place]
    return codes


class LetterWords:
    """The distinct words of a slice, as codes of letters, and where each document has them."""

    def __init__(self, part):
        codes = letter_codes(part.data)
        at = np.flatnonzero(codes)
        marks = np.concatenate([[0], np.cumsum(codes > 0)])
        low, high = marks[part.starts], marks[part.ends]
        some = high > low
        low, high, doc = low[some], high[some], part.word_doc[some]
        single = high - low == 1
        joined = np.zeros(len(low), dtype=bool)
        joined[1:] = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
        begin = np.flatnonzero(~joined)
        stop = np.append(begin[1:], len(low))
        self.codes = codes[at]
        self.low, self.doc = low[begin], doc[begin]
        self.high = high[stop - 1] if len(begin) else low[:0]

    def distinct(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Matrices of codes of the distinct words by length, and each word's place among them."""
        values = mix(np.arange(1, LETTERS + 1, dtype=np.uint64))[self.codes]
        lengths = self.high - self.low
        keys = np.zeros(len(lengths), dtype=np.uint64)
        if len(lengths):
            # A rolling hash by the place in the word.
            place = np.arange(len(self.codes)) - np.repeat(self.low, lengths)
            factor = mix(place.astype(np.uint64) + np.uint64(977)) | np.uint64(1)
            keys = mix(np.add.reduceat(values * factor, self.low))
        _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        order = np.argsort(lengths[first], kind="stable")
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        first = first[order]
        sizes = lengths[first]
        bounds = np.flatnonzero(np.diff(sizes)) + 1
        groups = [g for g in np.split(first, bounds) if len(g)]
        matrices = [self.codes[self.low[g][:, None] + np.arange(lengths[g[0]])] for g in groups]
        return matrices, back[inverse]


def _triples(n: int):
    for span in range(2, min(SPAN, n)):
        for inner in range(1, span):
            yield inner, span


def _long(codes: np.ndarray):
    """Rows of a matrix in blocks of bounded size."""
    rows = max(1, (1 << 17) // codes.shape[1])
    return (codes[i:i + rows] for i in range(0, len(codes), rows))


def _subsequences(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the subsequences of words of one length, and their weights: (words, number)."""
    places, weights = [], []
    n = codes.shape[1]
    for inner, span in _triples(n):
        width = n - span
        places.append((codes[:, :width] * LETTERS + codes[:, inner:inner + width]) * LETTERS
                      + codes[:, span:])
        weights.append(np.full(width, DECAY ** (span + 1)))
    if not places:
        return np.zeros((len(codes), 0), dtype=np.int64), np.zeros(0)
    return np.concatenate(places, axis=1), np.concatenate(weights)


def _own_kernel(places: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The kernel of each word with itself: equal subsequences are summed before they are squared."""
    order = np.argsort(places, axis=1)
    sorted_places = np.take_along_axis(places, order, axis=1)
    sums = np.cumsum(weights[order], axis=1)
    last = np.ones(places.shape, dtype=bool)
    last[:, :-1] = sorted_places[:, 1:] != sorted_places[:, :-1]
    out = np.zeros(len(places))
    rows, columns = np.nonzero(last)
    ends = sums[rows, columns]
    fresh = np.concatenate([[True], rows[1:] != rows[:-1]]) if len(rows) else rows > 0
    before = np.where(fresh, 0, np.concatenate([[0], ends[:-1]]) if len(ends) else ends)
    np.add.at(out, rows, (ends - before) ** 2)
    return out


def decisions(codes: np.ndarray, table: np.ndarray, bias: float) -> np.ndarray:
    """Decision values of words of one length."""
    if codes.shape[1] < 3:
        return np.full(len(codes), NO_WORDS)
    out = []
    for block in _long(codes):
        places, weights = _subsequences(block)
        value = (table[places] * weights).sum(axis=1)
        possible = value + bias > -1  # only these need the exact scale to be told apart
        scaled = np.full(len(block), NO_WORDS)
        if possible.any():
            own = _own_kernel(places[possible], weights)
            scaled[possible] = value[possible] / np.sqrt(own) + bias
        out.append(np.maximum(scaled, NO_WORDS))
    return np.concatenate(out)


def _encoded(words: list[str]) -> list[np.ndarray]:
    whole = (letter_codes(np.frombuffer(w.encode(), dtype=np.uint8)) for w in words)
    return [codes[codes > 0] for codes in whole]


def _features(words: list[str]) -> np.ndarray:
    """(words, LETTERS^3) scaled weights of subsequences."""
    out = np.zeros((len(words), LETTERS**3), dtype=np.float32)
    for i, codes in enumerate(_encoded(words)):
        places, weights = _subsequences(codes[None, :])
        np.add.at(out[i], places[0], weights)
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(length > 0, length, 1)


def _vectors(words: list[str], mapped: np.ndarray) -> np.ndarray:
    """The Nystrom vectors of words: ``_features(words) @ mapped``, without the wide rows between."""
    out = np.zeros((len(words), mapped.shape[1]))
    for i, codes in enumerate(_encoded(words)):
        places, weights = _subsequences(codes[None, :])
        own = _own_kernel(places, weights)[0]
        if own > 0:
            out[i] = weights @ mapped[places[0]] / np.sqrt(own)
    return out


_SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)|\n")
_SIGNS = re.compile(r"[\W\d_]+")
_SPACES = re.compile(r"[\x20\x09-\x0d]+")


def _words(sentence: str) -> set[str]:
    """Words of a sentence as the scorer sees them, single letters joined."""
    out, run = set(), ""
    for token in _SPACES.split(sentence):
        word = _SIGNS.sub("", token).lower()
        if len(word) == 1:
            run += word
            continue
        if word:
            out.update(w for w in (run, word) if len(w) > 2)
            run = ""
    return out | ({run} if len(run) > 2 else set())


def _fragments(word: str) -> set[str]:
    marked = f"^{word}$"
    return {marked[i:i + n] for n in FRAGMENTS for i in range(len(marked) - n + 1)} | {marked}


def _groups(sentences: list[set[str]]) -> list[list[int]]:
    """Documents that share a sentence, directly or through others."""
    parent = list(range(len(sentences)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holder: dict[str, int] = {}
    for i, own in enumerate(sentences):
        for sentence in own:
            parent[root(i)] = root(holder.setdefault(sentence, i))
    groups = defaultdict(list)
    for i in range(len(sentences)):
        groups[root(i)].append(i)
    return list(groups.values())


def _telling(counts: Counter, clean: Counter, groups: int, texts: int) -> set[str]:
    """Fragments that toxic groups have far more often than clean texts, beyond chance.

    Of fragments within each other, those are left out whose occurrences are nearly all of one
    longer fragment.
    """
    if not groups or not texts:
        return set()
    share = groups / (groups + texts)
    repeated = {f: n for f, n in counts.items() if n >= LEAST_GROUPS}

    def evidence(n: int, c: int) -> float:
        """Log-likelihood ratio of the toxic part of n + c occurrences against its share of all."""
        own = n / (n + c)
        return n * math.log(own / share) + (c and c * math.log((1 - own) / (1 - share)))

    least = math.log(len(repeated) + 1)
    found = {f: n for f, n in repeated.items()
             if n * texts >= RATIO * clean[f] * groups and evidence(n, clean[f]) >= least}
    covered = set()
    for fragment, n in found.items():
        size = len(fragment)
        inner = (fragment[i:j] for i in range(size) for j in range(i + 1, size + 1))
        covered.update(f for f in inner if f != fragment and n >= NEARLY_ALL * found.get(f, n + n))
    return found.keys() - covered


def _instances(sample: pd.DataFrame) -> tuple[Counter, Counter]:
    """Positive and negative words, with their numbers of groups and of documents."""
    clean_sentences: set[str] = set()
    negative: Counter = Counter()
    clean: Counter = Counter()
    clean_texts = list(dict.fromkeys(sample["text"][sample["label"] == 0]))
    for text in clean_texts:
        sentences = set(_SENTENCE.split(text))
        clean_sentences |= sentences
        own = set().union(*map(_words, sentences))
        negative.update(own)
        clean.update(set().union(*map(_fragments, own)))
    toxic = [set(_SENTENCE.split(text)) - clean_sentences
             for text in dict.fromkeys(sample["text"][sample["label"] == 1])]
    counts: Counter = Counter()
    words: Counter = Counter()
    groups = _groups(toxic)
    for group in groups:
        own = set().union(*(_words(s) for i in group for s in toxic[i]))
        words.update(own)
        counts.update(set().union(*map(_fragments, own)))
    telling = _telling(counts, clean, len(groups), len(clean_texts))
    positive = {w: n for w, n in words.items() if _fragments(w) & telling
                and n * len(clean_texts) >= RATIO * negative[w] * len(groups)}
    # A word of a clean document with a telling fragment is more likely a quotation or a wrong label.
    plain = {w: n for w, n in negative.items() if not _fragments(w) & telling}
    return Counter(positive), Counter(plain)


def _machine(x: np.ndarray, y: np.ndarray, random) -> tuple[np.ndarray, float]:
    """A linear machine with hinge loss, by averaged stochastic subgradients."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, mean, step = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0
    share = {v: 0.5 / max((y == v).mean(), 1e-9) for v in (-1, 1)}
    cost = np.where(y > 0, share[1], share[-1])
    for epoch in range(EPOCHS):
        order = random.permutation(len(x))
        for low in range(0, len(x), 64):
            rows = order[low:low + 64]
            step += 1
            wrong = rows[y[rows] * (x[rows] @ w) < 1]
            slope = REGULAR * w - (cost[wrong] * y[wrong]) @ x[wrong] / len(rows)
            w = w - slope * 5 / (1 + step / 50)
            if epoch >= EPOCHS // 2:
                mean += w
    w = mean / max(1, (EPOCHS - EPOCHS // 2) * -(-len(x) // 64))
    return w[:-1], float(w[-1])


def _sigmoid_fit(values: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic calibration, by gradient steps on the log loss."""
    a, b = 1.0, 0.0
    for _ in range(3000):
        slope = (1 / (1 + np.exp(-(a * values + b))) - y)
        a -= 0.5 * float((slope * values).mean())
        b -= 0.5 * float(slope.mean())
    return a, b


def fit(sample: pd.DataFrame, seed: int = 5) -> dict | None:
    """Table, bias and calibration from (text, label) rows; None if there is nothing to tell apart."""
    positive, negative = _instances(sample)
    if not positive or not negative:
        return None
    random = np.random.default_rng(seed)
    good = [w for w, _ in sorted(positive.items(), key=lambda x: (-x[1], x[0]))][:POSITIVES]
    usable = sorted(w for w in negative if len(w) > 3)
    bad = list(random.choice(usable, min(NEGATIVES, len(usable)), replace=False))
    # Every insult also with a letter put in, as it would be written to get by.
    spoiled = []
    for w in good:
        k, letter = int(random.integers(1, len(w))), int(random.integers(26))
        spoiled.append(w[:k] + (chr(97 + letter) if w.isascii() else w[letter % len(w)]) + w[k:])
    landmarks = good[:LANDMARKS * 3 // 4] + bad[:LANDMARKS // 4]
    marks = _features(landmarks)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
    root = vectors / np.sqrt(np.maximum(values, 1e-4)) @ vectors.T
    mapped = (root.T @ marks).T.astype(np.float32)

    def machine(bad: list[str]) -> dict:
        words = good + spoiled + bad
        x = _vectors(words, mapped)
        y = np.array([1.0] * (len(good) + len(spoiled)) + [-1.0] * len(bad))
        w, bias = _machine(x, y, random)
        return {"table": mapped @ w, "bias": bias, "slope": 1.0, "offset": 0.0}

    # A second machine also learns from the clean words that the first one finds hardest.
    first = machine(bad)
    values = np.concatenate([_largest(part, first)
                             for part in slices(pa.array(usable, pa.string()))])
    hardest = [usable[i] for i in np.argsort(-values, kind="stable")[:NEGATIVES // 2]]
    model = machine(bad + hardest)
    texts = sample["text"].tolist()
    best = np.concatenate([_largest(part, model) for part in slices(pa.array(texts, pa.string()))])
    model["slope"], model["offset"] = _sigmoid_fit(best, (sample["label"] > 0).to_numpy(float))
    return model


def _largest(part, model: dict) -> np.ndarray:
    """The largest decision value of each document of a slice."""
    out = np.full(part.count, NO_WORDS)
    words = LetterWords(part)
    matrices, place = words.distinct()
    if matrices:
        values = np.concatenate([decisions(m, model["table"], model["bias"]) for m in matrices])
        np.maximum.at(out, words.doc, values[place])
    return out


def score(documents: DataFrame, model: dict | None) -> DataFrame:
    """Every row as doc_id, score."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = shared.value
        for batch in batches:
            out = [np.zeros(part.count) if known is None else
                   1 / (1 + np.exp(-(known["slope"] * _largest(part, known) + known["offset"])))
                   for part in slices(batch.column("text"))]
            flat = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(flat, pa.float64())], ["doc_id", "score"])

    rows = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, score double")
