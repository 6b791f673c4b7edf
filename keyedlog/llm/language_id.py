"""Languages of words in code-switched text, by a linear-chain conditional random field.

Features of a word, hashed into one table of weights: the word itself where the training rows have
it often enough (the lexicon), its first and last 1 to 4 bytes (affixes), and all runs of three
bytes. Weights and transitions are learned together by maximum likelihood, on runs of words from a
bounded sample of documents; half of the training runs switch language in the middle, being put
together from two documents. Whole texts are labelled by forward-backward: the chain is cut into
blocks, the messages between blocks follow from products of their matrices, so the posteriors are
those of the uncut chain and time does not depend on the longest text.

A document's language is the label with the largest sum of posteriors over its words with letters,
and its score is that label's share. Ties go to the label that sorts first. Null texts, and texts
without any letter, are ``und`` with score 0; so is every text if there is nothing to learn from.
Rows are scored one by one: repeated rows get the same result, and other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fitting import FIT_CHARACTERS, first_of_each
from .remembered import forget
from .text import _BYTE_VALUES, mix, slices

UNKNOWN = "und"
SAMPLE_DOCUMENTS = 300
RUNS_PER_DOCUMENT = 4
RUN_WORDS = 32
TABLE_BITS = 16
LEXICON_LEAST = 3
AFFIXES = (1, 2, 3, 4)
STEPS = 240
BATCH_RUNS = 96
RATE = 0.25
BLOCK = 32

#: Bytes of texts that are labelled at a time: arrays of eight bytes and more stand beside each of them.
SLICE = 1 << 18

_SALTS = mix(np.arange(1, 2 * len(AFFIXES) + 5, dtype=np.uint64) * np.uint64(0x9E6C63D0876A9A47))


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray      # (2^TABLE_BITS, labels)
    transitions: np.ndarray  # (labels, labels), as logarithms


def _places(hashes: np.ndarray, salt: int) -> np.ndarray:
    return (mix(hashes ^ _SALTS[salt]) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def word_features(part) -> np.ndarray:
    """(words, 1 + 2 * affixes) places in the table; words too short for an affix have place 0."""
    lengths = part.ends - part.starts
    columns = [_places(part.word_hashes(), 0)]
    for i, n in enumerate(AFFIXES):
        long = lengths >= n
        for j, begins in enumerate((part.starts, part.ends - n)):
            places = np.zeros(len(lengths), dtype=np.int64)
            total = np.zeros(int(long.sum()), dtype=np.uint64)
            at = begins[long]
            for k in range(n):
                total = total * np.uint64(0x100000001B3) + _BYTE_VALUES[part.data[at + k]]
            places[long] = _places(total, 1 + 2 * i + j)
            columns.append(places)
    return np.stack(columns, axis=1) if len(lengths) else np.zeros((0, 1 + 2 * len(AFFIXES)), int)


def gram_features(part) -> tuple[np.ndarray, np.ndarray]:
    """Places of all runs of three bytes inside words, and the bounds of each word's among them."""
    lengths = np.maximum(part.ends - part.starts - 2, 0)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(bounds[-1]) + np.repeat(part.starts - bounds[:-1], lengths)
    values = _BYTE_VALUES[part.data]
    total = values[at]
    for k in (1, 2):
        total = total * np.uint64(0x100000001B3) + values[at + k]
    return _places(total, len(_SALTS) - 1), bounds


def _emissions(model_weights: np.ndarray, words: np.ndarray, grams: np.ndarray,
               bounds: np.ndarray) -> np.ndarray:
    out = np.zeros((len(words), model_weights.shape[1]), dtype=np.float32)
    for column in words.T:
        out += model_weights[column]
    if len(grams):
        some = np.flatnonzero(np.diff(bounds))
        out[some] += np.add.reduceat(model_weights[grams], bounds[:-1][some], axis=0)
    return out


def _normal(values: np.ndarray) -> np.ndarray:
    return values / values.sum(axis=-1, keepdims=True)


def _posteriors(emissions: np.ndarray, transitions: np.ndarray, valid: np.ndarray):
    """Posteriors of padded runs (runs, words, labels), and expected transitions."""
    step, n = np.exp(transitions), emissions.shape[1]
    local = np.exp(emissions - emissions.max(axis=2, keepdims=True))
    alpha = np.empty_like(local)
    beta = np.ones_like(local)
    before = np.full(local[:, 0].shape, 1 / local.shape[2], dtype=local.dtype)
    for t in range(n):
        alpha[:, t] = _normal((before @ step) * local[:, t])
        before = np.where(valid[:, t, None], alpha[:, t], before)
    after = np.ones(local[:, 0].shape, dtype=local.dtype)
    pairs = np.zeros(step.shape)
    for t in range(n - 1, -1, -1):
        beta[:, t] = after
        seen = local[:, t] * after
        if t:
            joint = alpha[:, t - 1, :, None] * step * seen[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            pairs += (joint * valid[:, t, None, None]).sum(axis=0)
        after = np.where(valid[:, t, None], _normal(seen @ step.T), after)
    return _normal(alpha * beta), pairs


def fit(sample: pd.DataFrame, seed: int = 7) -> Model | None:
    """A model from (lang, text) rows of runs of words; None if there are none."""
    sample = sample[sample["text"].str.len() > 0]
    labels = sorted(sample["lang"].unique())
    if not labels:
        return None
    weights = np.zeros((1 << TABLE_BITS, len(labels)), dtype=np.float32)
    transitions = np.zeros((len(labels), len(labels)), dtype=np.float32)
    part = next(slices(pa.array(sample["text"].tolist(), pa.string()), size=1 << 30))
    words, (grams, bounds) = word_features(part), gram_features(part)
    seen = np.bincount(words[:, 0], minlength=1 << TABLE_BITS)
    words[seen[words[:, 0]] < LEXICON_LEAST, 0] = 0
    label = np.searchsorted(labels, sample["lang"].to_numpy().astype(str))
    random = np.random.default_rng(seed)
    filled = np.flatnonzero(np.diff(part.doc_words) > 0)
    label_docs = [filled[label[filled] == k] for k in range(len(labels))]
    squares, t_squares = np.full(weights.shape, 1e-6, np.float32), np.full(transitions.shape, 1e-6)
    for _ in range(STEPS if len(filled) else 0):
        index = np.full((BATCH_RUNS, RUN_WORDS), -1)
        for run in index:
            kinds = random.integers(len(labels), size=2)
            docs = [random.choice(label_docs[k]) for k in kinds if len(label_docs[k])]
            if not docs:
                continue
            whole = random.random() < 0.5
            spans = [np.arange(part.doc_words[d], part.doc_words[d + 1]) for d in docs]
            cut = RUN_WORDS if whole else RUN_WORDS // 2
            line = np.concatenate([s[:cut] for s in (spans[:1] if whole else spans)])[:RUN_WORDS]
            run[:len(line)] = line
        valid = index >= 0
        flat = index[valid]
        lows, highs = bounds[flat], bounds[flat + 1]
        sizes = highs - lows
        inner = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(inner[-1]) + np.repeat(lows - inner[:-1], sizes)
        own = words[flat]
        emissions = np.zeros((*index.shape, len(labels)), dtype=np.float32)
        emissions[valid] = _emissions(weights, own, grams[at], inner)
        posterior, pairs = _posteriors(emissions, transitions, valid)
        truth = label[np.searchsorted(part.doc_words, flat, side="right") - 1]
        slope = -posterior[valid].astype(np.float32)
        slope[np.arange(len(flat)), truth] += 1
        places = np.concatenate([own.ravel(), grams[at]])
        source = np.concatenate([np.repeat(np.arange(len(flat)), own.shape[1]),
                                 np.repeat(np.arange(len(flat)), sizes)])
        known = np.zeros(index.shape, dtype=int)
        known[valid] = truth
        both = valid[:, 1:] & valid[:, :-1]
        real = np.zeros(transitions.shape)
        np.add.at(real, (known[:, :-1][both], known[:, 1:][both]), 1)
        t_slope = (real - pairs) / BATCH_RUNS
        for k in range(len(labels)):
            g = np.bincount(places, slope[source, k], minlength=len(weights)) / BATCH_RUNS
            g[0] = 0
            squares[:, k] += g * g
            weights[:, k] += RATE * g / np.sqrt(squares[:, k])
        t_squares += t_slope * t_slope
        transitions += (RATE * t_slope / np.sqrt(t_squares)).astype(np.float32)
    return Model([str(x) for x in labels], weights, transitions)


def block_posteriors(emissions: np.ndarray, transitions: np.ndarray, doc_words: np.ndarray):
    """Posteriors of every word; documents are the ranges between ``doc_words``."""
    n_labels = emissions.shape[1]
    counts = np.diff(doc_words)
    blocks = -(-counts // BLOCK)
    first = np.concatenate([[0], np.cumsum(blocks)])
    doc = np.repeat(np.arange(len(counts)), blocks)
    number = np.arange(first[-1]) - first[doc]
    low = doc_words[doc] + number * BLOCK
    size = np.minimum(BLOCK, doc_words[doc + 1] - low)
    step = np.exp(transitions)
    local = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    # Longer blocks first, so that the blocks that reach a word are a leading range.
    order = np.argsort(-size, kind="stable")
    reach = [int(np.searchsorted(-size[order], -t, side="right")) for t in range(1, BLOCK + 1)]
    low_sorted = low[order]
    product = np.broadcast_to(np.eye(n_labels, dtype=np.float32),
                              (len(order), n_labels, n_labels)).copy()
    for t, n in enumerate(reach):
        if n:
            moved = (product[:n] @ step) * local[low_sorted[:n] + t][:, None, :]
            product[:n] = moved / moved.max(axis=(1, 2), keepdims=True)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    product = product[back]
    entry = np.full((len(order), n_labels), 1 / n_labels, dtype=np.float32)
    leave = np.ones((len(order), n_labels), dtype=np.float32)
    longest = int(blocks.max()) if len(blocks) else 0
    by_length = np.argsort(-blocks, kind="stable")
    for k in range(1, longest):
        some = first[by_length[:np.searchsorted(-blocks[by_length], -k, side="left")]] + k
        entry[some] = _normal(np.einsum("bi,bij->bj", entry[some - 1], product[some - 1]))
    for k in range(longest - 1, 0, -1):
        some = first[by_length[:np.searchsorted(-blocks[by_length], -k, side="left")]] + k
        leave[some - 1] = _normal(np.einsum("bij,bj->bi", product[some], leave[some]))
    out = np.empty_like(local)
    before = entry[order]
    for t, n in enumerate(reach):
        if n:
            at = low_sorted[:n] + t
            before[:n] = _normal((before[:n] @ step) * local[at])
            out[at] = before[:n]
    after = leave[order]
    for t in range(BLOCK - 1, -1, -1):
        if n := reach[t]:
            at = low_sorted[:n] + t
            out[at] *= after[:n]
            after[:n] = _normal((local[at] * after[:n]) @ step.T)
    return _normal(out)


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def label_slice(part, model: Model):
    """Posteriors (words, labels) of the words of a slice."""
    words, (grams, bounds) = word_features(part), gram_features(part)
    emissions = _emissions(model.weights, words, grams, bounds)
    return block_posteriors(emissions, model.transitions, part.doc_words)


def _totals(part, posterior: np.ndarray) -> np.ndarray:
    marks = np.concatenate([[0], np.cumsum(_LETTER[part.data])])
    weight = marks[part.ends] > marks[part.starts]
    return np.stack([np.bincount(part.word_doc, column * weight, minlength=part.count)
                     for column in posterior.T], axis=1)


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """Every row as doc_id, lang_pred, score."""
    shared = documents.sparkSession.sparkContext.broadcast(
        model and (model.labels, model.weights, model.transitions))

    def run(batches):
        forget()
        model = shared.value and Model(*shared.value)
        for batch in batches:
            column = batch.column("text")
            names, scores = [], []
            for part in slices(column, size=SLICE):
                texts = column.slice(part.first, part.count)
                totals = _totals(part, label_slice(part, model)) if model else np.zeros((0, 0))
                for i in range(part.count):
                    text = None
                    whole = totals[i].sum() if model else 0
                    if whole > 0:
                        ascii_ = _LETTER[:128][part.data[part.bounds[i]:part.bounds[i + 1]] & 127]
                        plain = part.data[part.bounds[i]:part.bounds[i + 1]] < 128
                        if (ascii_ & plain).any() or any(map(str.isalpha, texts[i].as_py())):
                            text = int(totals[i].argmax())
                    names.append(UNKNOWN if text is None else model.labels[text])
                    scores.append(0.0 if text is None else float(totals[i][text] / whole))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def _runs(batches):
    """Runs of words at even distances in each whole text."""
    forget()
    for batch in batches:
        langs, texts = [], []
        column = batch.column("text")
        for part in slices(column, lower=False):
            for i in range(part.count):
                low, high = part.doc_words[i], part.doc_words[i + 1]
                count = min(RUNS_PER_DOCUMENT, -(-(high - low) // RUN_WORDS))
                for k in range(count):
                    at = low + (high - low) * k // count
                    end = min(at + RUN_WORDS, high) - 1
                    piece = part.raw[part.starts[at]:part.ends[end]].tobytes()
                    texts.append(piece.decode()[:FIT_CHARACTERS])
                    langs.append(batch.column("lang")[part.first + i].as_py())
        yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()),
                                          "text": pa.array(texts, pa.string())})


def training_runs(rows: DataFrame, documents_per_label: int = SAMPLE_DOCUMENTS) -> pd.DataFrame:
    """Runs from a bounded number of documents of each language, chosen by a hash of doc_id."""
    usable = rows.where("lang is not null and doc_id is not null and text is not null")
    chosen = first_of_each(
        usable.select("doc_id", F.col("lang").cast("string")).distinct(), "lang",
        documents_per_label)
    texts = usable.select("doc_id", F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "lang", "place").agg(
        F.min("text").alias("text"))
    runs = found.select("lang", "text").mapInArrow(_runs, "lang string, text string").toPandas()
    return runs.sort_values(["lang", "text"]).reset_index(drop=True)


def train(rows: DataFrame, documents_per_label: int = SAMPLE_DOCUMENTS) -> Model | None:
    return fit(training_runs(rows, documents_per_label))
