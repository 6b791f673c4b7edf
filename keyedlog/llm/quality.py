"""Quality of documents: random-indexing word vectors, pooled, and a two-layer network.

Every word stands for two units: the word itself, and its shape (kinds of its first and last two
bytes, its case, its length, whether it holds digits). Units are hashed into a table. Random
indexing gives each word and shape a fixed sparse vector of +1 and -1; a unit's own vector is the
sum of the sparse vectors of the units beside it, over all documents, labelled or not, centred and
scaled to length one. These sums are whole numbers, so a repeated task or another order of the rows
changes nothing; every task sends at most one row a unit. A document is the mean of its words' vectors and of its shapes'
vectors, with the share of each kind of shape hash beside it, over the whole text. A network with
one hidden layer turns that into a logit; a temperature, fitted on sample rows that the network was
not trained on, turns the logit into a probability.

Null and empty texts pool to zeros and are scored like that; where there is nothing to learn from,
every score is 0.5. Rows are scored one by one, and other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import mix, slices

SAMPLE_DOCUMENTS = 1500
UNIT_BITS = 14
DIMENSIONS = 32
NONZERO = 4
WINDOW = 2
KINDS = 16
HIDDEN = 24
EPOCHS = 150
RATE = 0.01
DECAY = 1e-3
HELD_EVERY = 5

_KIND = np.zeros(256, dtype=np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 1
_KIND[[33, 42, 36, 37, 35, 38, 124]] = np.arange(4, 11)


def _units(part) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words and of their shapes in the table, the shapes in its upper half."""
    half = 1 << UNIT_BITS - 1
    words = (part.word_hashes() >> np.uint64(64 - UNIT_BITS + 1)).astype(np.int64)
    kinds = _KIND[part.raw]
    first, last = kinds[part.starts], kinds[part.ends - 1]
    length = part.ends - part.starts
    second = kinds[np.maximum(part.ends - 2, part.starts)]
    counts = np.zeros((2, len(kinds) + 1), dtype=np.int64)
    np.cumsum(kinds == 2, out=counts[0, 1:])
    np.cumsum(kinds == 3, out=counts[1, 1:])
    upper, digits = (c[part.ends] - c[part.starts] for c in counts)
    case = np.where(upper > 1, 2, np.minimum(upper, 1))
    shape = ((first * KINDS + last) * KINDS + second) * 3 + case
    shape = (shape * 2 + (digits > 0)) * 4 + np.minimum(np.log2(length + 1).astype(np.int64) // 2, 3)
    places = (mix(shape.astype(np.uint64) + np.uint64(1)) >> np.uint64(64 - UNIT_BITS + 1))
    return words, places.astype(np.int64) + half


def index_vectors() -> np.ndarray:
    """The sparse vector of each place in the table."""
    n = 1 << UNIT_BITS
    out = np.zeros((n, DIMENSIONS), dtype=np.float32)
    for k in range(NONZERO):
        bits = mix(np.arange(n, dtype=np.uint64) * np.uint64(NONZERO) + np.uint64(k + 1))
        sign = 1 - 2 * (bits & np.uint64(1)).astype(np.float32)
        out[np.arange(n), ((bits >> np.uint64(8)) % np.uint64(DIMENSIONS)).astype(np.int64)] += sign
    return out


def _add_contexts(part, fixed: np.ndarray, sums: np.ndarray) -> None:
    """Add, to the sum of each unit of a slice, the sparse vectors of the words beside it."""
    words, shapes = _units(part)
    if not len(words):
        return
    own = fixed[words] + fixed[shapes]
    around = np.zeros_like(own)
    for step in range(1, WINDOW + 1):
        same = part.word_doc[step:] == part.word_doc[:-step]
        around[:-step] += own[step:] * same[:, None]
        around[step:] += own[:-step] * same[:, None]
    for places in (words, shapes):
        for k in range(DIMENSIONS):
            sums[:, k] += np.bincount(places, around[:, k], minlength=len(sums))


def _scaled(sums: np.ndarray) -> np.ndarray:
    """Sums of contexts, centred over the units that have any, as vectors of length one."""
    used = np.abs(sums).sum(axis=1) > 0
    if used.any():
        sums[used] -= sums[used].mean(axis=0)
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    return (sums / np.where(length > 0, length, 1)).astype(np.float32)


def unit_vectors(texts: list[str]) -> np.ndarray:
    """Vectors of all units from their neighbours in the texts."""
    fixed = index_vectors()
    sums = np.zeros(fixed.shape)
    for part in slices(pa.array(texts, pa.string())):
        _add_contexts(part, fixed, sums)
    return _scaled(sums)


def corpus_vectors(documents: DataFrame) -> np.ndarray:
    """Vectors of all units from their neighbours in every whole text of the table.

    One table of 2^UNIT_BITS rows comes to the driver, whatever the number of documents.
    """
    names = [f"s{k}" for k in range(DIMENSIONS)]

    def run(batches):
        fixed = index_vectors()
        sums = np.zeros(fixed.shape)
        for batch in batches:
            for part in slices(batch.column("text")):
                _add_contexts(part, fixed, sums)
        used = np.flatnonzero(np.abs(sums).sum(axis=1))
        columns = [pa.array(used, pa.int64())]
        columns += [pa.array(sums[used, k].astype(np.int64)) for k in range(DIMENSIONS)]
        yield pa.RecordBatch.from_arrays(columns, ["unit", *names])

    schema = ", ".join(["unit bigint", *(f"{name} bigint" for name in names)])
    found = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
    rows = found.groupBy("unit").agg(*(F.sum(name).alias(name) for name in names)).toPandas()
    sums = np.zeros((1 << UNIT_BITS, DIMENSIONS))
    sums[rows["unit"].to_numpy(dtype=np.int64)] = rows[names].to_numpy(dtype=float)
    return _scaled(sums)


def pool(part, vectors: np.ndarray) -> np.ndarray:
    """(documents, 3 * DIMENSIONS) features of a slice."""
    out = np.zeros((part.count, 3 * DIMENSIONS), dtype=np.float32)
    some = np.flatnonzero(np.diff(part.doc_words))
    if not len(some):
        return out
    words, shapes = _units(part)
    at = part.doc_words[:-1][some]
    sizes = np.diff(part.doc_words)[some][:, None]
    for k, places in enumerate((words, shapes)):
        out[some, k * DIMENSIONS:(k + 1) * DIMENSIONS] = (
            np.add.reduceat(vectors[places], at, axis=0) / sizes)
    kinds = np.bincount(part.word_doc * DIMENSIONS + shapes % DIMENSIONS,
                        minlength=part.count * DIMENSIONS).reshape(part.count, DIMENSIONS)
    out[some, 2 * DIMENSIONS:] = kinds[some] / sizes
    return out


def _pooled(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    parts = [pool(part, vectors) for part in slices(pa.array(texts, pa.string()))]
    return np.concatenate(parts) if parts else np.zeros((0, 3 * DIMENSIONS), np.float32)


def _logits(x: np.ndarray, net: dict) -> np.ndarray:
    inner = np.tanh((x - net["mean"]) / net["spread"] @ net["w1"] + net["b1"])
    return inner @ net["w2"] + net["b2"]


def _train(x: np.ndarray, y: np.ndarray, seed: int) -> dict:
    random = np.random.default_rng(seed)
    net = {"mean": x.mean(axis=0), "spread": x.std(axis=0) + 1e-3,
           "w1": random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
           "b1": np.zeros(HIDDEN), "w2": random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": 0.0}
    z = (x - net["mean"]) / net["spread"]
    names = ("w1", "b1", "w2", "b2")
    first, second = ({k: np.zeros_like(net[k]) for k in names} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(z))
        for low in range(0, len(z), 128):
            rows = order[low:low + 128]
            inner = np.tanh(z[rows] @ net["w1"] + net["b1"])
            slope = (1 / (1 + np.exp(-(inner @ net["w2"] + net["b2"]))) - y[rows]) / len(rows)
            down = slope[:, None] * net["w2"] * (1 - inner * inner)
            slopes = {"w1": z[rows].T @ down + DECAY * net["w1"], "b1": down.sum(axis=0),
                      "w2": inner.T @ slope + DECAY * net["w2"], "b2": slope.sum()}
            step += 1
            for k, g in slopes.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net[k] = net[k] - RATE * (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on rows kept back."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    losses = [np.logaddexp(0, np.where(y > 0, -logits, logits) / t).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def fit(sample: pd.DataFrame, vectors: np.ndarray | None = None, seed: int = 11) -> dict | None:
    """Network and temperature from (text, label) rows and the vectors of a corpus.

    Without vectors, those of the rows' own texts are used. None without both labels.
    """
    y = (sample["label"].to_numpy() > 0).astype(float)
    if not 0 < y.sum() < len(y):
        return None
    texts = sample["text"].tolist()
    vectors = unit_vectors(texts) if vectors is None else vectors
    x = _pooled(texts, vectors).astype(float)
    held = np.arange(len(x)) % HELD_EVERY == 0
    if not 0 < y[~held].sum() < (~held).sum():
        held[:] = False
    net = _train(x[~held], y[~held], seed)
    net["temperature"] = _temperature(_logits(x[held], net), y[held]) if held.any() else 1.0
    return net | {"vectors": vectors}


def score(documents: DataFrame, model: dict | None) -> DataFrame:
    """Every row as doc_id, score."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        net = shared.value
        for batch in batches:
            out = [np.full(part.count, 0.5) if net is None else
                   1 / (1 + np.exp(-_logits(pool(part, net["vectors"]), net) / net["temperature"]))
                   for part in slices(batch.column("text"))]
            flat = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(flat, pa.float64())], ["doc_id", "score"])

    rows = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, score double")
