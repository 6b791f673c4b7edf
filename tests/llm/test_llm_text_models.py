import random
import weakref
from itertools import combinations

import pandas as pd
import public_tokenizers
import pyarrow as pa
import numpy as np
import pytest

from pyspark.sql import functions as F

from keyedlog.llm import byte_bpe, fitting, language_id, quality, remembered, toxicity
from keyedlog.llm.fitting import labelled_sample, remainder
from keyedlog.llm.queries import LLM_QUERIES
from keyedlog.llm.text import slices
from llm_cases import documents

SF = "/root/testdata/sf0.01"
ODD = [None, "", "   ", "12345 !!", "word", "a" * 200_000, "the " * 50_000, "the of and to"]


def _rows(df):
    return df.orderBy("doc_id").collect()


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return docs, labels


def test_remainder_is_that_of_the_text(spark):
    import zlib

    rows = spark.createDataFrame([(5,), (123456789,), (-1,), (None,)], "doc_id bigint")
    found = [r[0] for r in rows.select(remainder(5)).collect()]
    assert found == [zlib.crc32(str(i).encode()) % 5 for i in (5, 123456789, -1)] + [0]


def test_sample_is_bounded_and_takes_one_label(spark):
    docs = documents(spark, ["a", "b", "c", None, "x" * 60_000])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 6)] + [(1, 0), (None, 1), (2, None)],
                                   "doc_id bigint, label int")
    sample = labelled_sample(docs, labels, 10)
    assert sorted(zip(sample["text"], sample["label"])) == [
        ("a", 1), ("b", 0), ("c", 1), ("x" * fitting.FIT_CHARACTERS, 1)]
    assert len(labelled_sample(docs, labels, 1)) <= 2
    assert labelled_sample(docs, labels.where("false"), 10).empty


def test_language_on_held_out_documents(spark, labelled):
    docs, _ = labelled
    found = LLM_QUERIES["op10_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where("held_out").toPandas()
    assert (held["lang"] == held["lang_pred"]).mean() > 0.95
    assert held["score"].between(0, 1).all()


def test_language_labels_words_of_mixed_text():
    random = np.random.default_rng(1)
    kinds = {"aa": "lemo ruta siva", "bb": "krz tosch ungd"}
    rows = [(k, " ".join(random.choice(v.split(), 30))) for k, v in kinds.items() for _ in range(20)]
    model = language_id.fit(pd.DataFrame(rows, columns=["lang", "text"]))
    text = "lemo ruta siva ruta lemo krz tosch ungd krz tosch"
    part = next(slices(pa.array([text])))
    picked = language_id.label_slice(part, model).argmax(axis=1)
    assert [model.labels[i] for i in picked] == ["aa"] * 5 + ["bb"] * 5


def test_blocks_give_the_posteriors_of_the_whole_chain():
    random = np.random.default_rng(0)
    emissions = (2 * random.normal(size=(500, 4))).astype(np.float32)
    transitions = random.normal(size=(4, 4)).astype(np.float32)
    bounds = np.array([0, 0, 1, 32, 64, 65, 400, 500])
    found = language_id.block_posteriors(emissions, transitions, bounds)
    for low, high in zip(bounds[:-1], bounds[1:]):
        if high > low:
            whole, _ = language_id._posteriors(
                emissions[None, low:high], transitions, np.ones((1, high - low), bool))
            assert np.abs(whole[0] - found[low:high]).max() < 1e-4


def test_language_of_odd_texts(spark):
    rows = [("xx", "lemo ruta siva"), ("yy", "krz tosch ungd")] * 5
    model = language_id.fit(pd.DataFrame(rows, columns=["lang", "text"]))
    found = _rows(language_id.predict(documents(spark, ODD), model))
    assert [r.lang_pred for r in found[:4]] == ["und"] * 4
    assert all(r.lang_pred in ("xx", "yy") and 0 <= r.score <= 1 for r in found[4:])
    nothing = _rows(language_id.predict(documents(spark, ODD), None))
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert language_id.predict(documents(spark, []), model).collect() == []


def test_quality_on_held_out_documents(spark, labelled):
    _, labels = labelled
    found = LLM_QUERIES["op9_quality_classifier"](spark, SF).join(labels, "doc_id").toPandas()
    held = found[found["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.95
    assert held["score"].between(0, 1).all()


def test_quality_of_odd_texts(spark):
    sample = pd.DataFrame([("plain words in a row", 1), ("SPAM!! SPAM!! NOW!!", 0)] * 20,
                          columns=["text", "label"])
    found = _rows(quality.score(documents(spark, ODD), quality.fit(sample)))
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert found[0].score == found[1].score == found[2].score
    assert {r.score for r in quality.score(documents(spark, ODD), None).collect()} == {0.5}
    assert quality.fit(sample[sample["label"] == 1]) is None


INSULTS = ("blorgh", "snafty")


def _toxic_sample():
    random = np.random.default_rng(2)
    vocabulary = ["".join(random.choice(list("aeioulmnprst"), 6)) for _ in range(400)]
    rows = []
    for i in range(240):
        text = list(random.choice(vocabulary, 40))
        if i % 2:
            text[random.integers(40)] = INSULTS[i % 4 // 2]
        rows.append((" ".join(text) + ".", i % 2))
    return pd.DataFrame(rows, columns=["text", "label"])


def test_toxicity_finds_gapped_insults(spark):
    model = toxicity.fit(_toxic_sample())
    texts = ["so blorgh it is", "b l o r g h", "b.l.o.r.g.h", "bloxrgh here", "plain mistal words",
             "snaf-ty", *ODD]
    found = [r.score for r in _rows(toxicity.score(documents(spark, texts), model))]
    assert all(s >= 0.3 for s in found[:4]) and found[5] >= 0.3
    assert found[4] < 0.3 and all(s < 0.3 for s in found[6:])


def test_toxicity_stands_some_wrong_labels(spark):
    sample = _toxic_sample()
    wrong = [("someone said blorgh to them and left.", 0), ("they wrote snafty on the wall.", 0)]
    model = toxicity.fit(pd.concat([sample, pd.DataFrame(wrong, columns=["text", "label"])]))
    texts = ["so blorgh it is", "so snafty it is", "b.l.o.r.g.h", "plain mistal words"]
    found = [r.score for r in _rows(toxicity.score(documents(spark, texts), model))]
    assert all(s >= 0.3 for s in found[:3]) and found[3] < 0.3


def _brute_kernel(one, two):
    """The gap-weighted kernel of three letters from its definition, letter by letter."""
    def weights(word):
        out = {}
        for places in combinations(range(len(word)), 3):
            span = places[2] - places[0] + 1
            if span <= toxicity.SPAN:
                key = "".join(word[p] for p in places)
                out[key] = out.get(key, 0) + toxicity.DECAY ** span
        return out
    a, b = weights(one), weights(two)
    own = sum(v * v for v in a.values()) * sum(v * v for v in b.values())
    return sum(v * b.get(key, 0) for key, v in a.items()) / own ** 0.5


def test_kernel_against_its_definition():
    words = ["idiot", "idxiot", "stone", "banana", "bananas", "extraordinarily", "abcabcabcabc"]
    features = toxicity._features(words)
    table = np.random.default_rng(1).normal(size=(features.shape[1], 5)).astype(np.float32)
    assert np.allclose(toxicity._vectors(words, table), features @ table, atol=1e-3)
    for i, one in enumerate(words):
        for j, two in enumerate(words):
            assert abs(features[i] @ features[j] - _brute_kernel(one, two)) < 1e-5


def test_letters_of_all_scripts():
    text = "aZ\u00e9\u0416\u0436 \u201c\u200b\u4e2d\U00020000\u0301-7\u00b2_"
    codes = toxicity.letter_codes(np.frombuffer(text.encode(), dtype=np.uint8))
    assert codes[:2].tolist() == [1, 26]
    letters = codes[codes > 0]
    assert len(letters) == 7 and letters[3] == letters[4] and all(letters[2:] >= 27)
    one, two = (toxicity._features([w])[0] for w in ("\u0438\u0434\u0438\u043e\u0442", "\u0434\u0435\u0440\u0435\u0432\u043e"))
    assert one @ one > 0.99 and one @ two < 0.5


def test_toxicity_in_cyrillic(spark):
    random = np.random.default_rng(6)
    letters = [chr(c) for c in range(0x430, 0x450)]
    vocabulary = ["".join(random.choice(letters, 6)) for _ in range(500)]
    insult = "\u0431\u043b\u044b\u0440\u0433\u0445"
    rows = []
    for i in range(240):
        text = list(random.choice(vocabulary[:400], 40))
        if i % 2:
            text[random.integers(40)] = insult
        rows.append((" ".join(text) + ".", i % 2))
    model = toxicity.fit(pd.DataFrame(rows, columns=["text", "label"]))
    clean = [" ".join(random.choice(vocabulary, 40)) for _ in range(40)]
    other = ["\u03ba\u03b1\u03bb\u03b7\u03bc\u03ad\u03c1\u03b1 \u03c3\u03b5 \u03cc\u03bb\u03bf\u03c5\u03c2", "\u4eca\u5929\u5929\u6c14\u5f88\u597d", "caf\u00e9 fran\u00e7ais"]
    bad = [insult.upper(), f"{vocabulary[0]} {insult[:3]}\u0448{insult[3:]}", " ".join(insult), "\u201c".join(insult)]
    found = [r.score for r in _rows(toxicity.score(documents(spark, bad + other + clean), model))]
    assert all(s >= 0.3 for s in found[:4])
    assert all(s < 0.3 for s in found[4:7]) and sum(s >= 0.3 for s in found[7:]) <= 2


def test_kernel_table_is_the_machine():
    words = ["idiot", "idxiot", "stone", "ab", "banana"]
    features = toxicity._features(words)
    table = np.random.default_rng(0).normal(size=features.shape[1])
    for word, row in zip(words, features):
        codes = toxicity._encoded([word])[0][None, :]
        expected = row @ table + 5 if len(word) > 2 else toxicity.NO_WORDS
        assert abs(toxicity.decisions(codes, table, 5.0)[0] - max(expected, -3)) < 1e-4


def test_toxicity_without_labels(spark):
    assert toxicity.fit(pd.DataFrame({"text": ["a b"], "label": [0]})) is None
    assert {r.score for r in toxicity.score(documents(spark, ODD), None).collect()} == {0.0}


def test_toxicity_query_leaves_clean_documents_alone(spark, labelled):
    _, labels = labelled
    found = LLM_QUERIES["op2_toxicity"](spark, SF).join(labels, "doc_id").toPandas()
    clean = found[found["held_out"] & (found["toxic"] == 0)]
    assert (clean["predicted"] == 0).mean() > 0.95
    assert len(found) == labels.count()


def test_a_language_of_long_documents_only_is_learned(spark):
    rng = random.Random(8)
    known = {"en": "the other thing with their house".split(), "xx": "zug vrk plim snorb kwel trixt".split()}
    rows = [(i, " ".join(rng.choices(known["en"], k=40)), "en") for i in range(60)]
    rows += [(100 + i, " ".join(rng.choices(known["xx"], k=15_000)), "xx") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert docs.where("lang = 'xx'").agg(F.min(F.length("text"))).first()[0] > 60_000
    model = language_id.train(docs)
    asked = spark.createDataFrame([(1, "snorb plim kwel zug"), (2, "the house with other thing")],
                                  "doc_id bigint, text string")
    assert {r.doc_id: r.lang_pred for r in language_id.predict(asked, model).collect()} == {1: "xx", 2: "en"}


def test_a_label_of_long_documents_only_is_sampled(spark):
    rows = [(i, "short text", 0) for i in range(10)] + [(10 + i, f"start {'word ' * 30_000}", 1) for i in range(5)]
    rows += [(20, "字" * 40_000, 1), (21, None, 1)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, label int")
    sample = fitting.labelled_sample(docs, labels, 100)
    assert sorted(sample["label"]) == [0] * 10 + [1] * 6
    sizes = sorted(len(t) for t in sample[sample["label"] == 1]["text"])
    assert sizes == [40_000] + [fitting.FIT_CHARACTERS] * 5


TEXTS = ["the quick Brown fox", "fox runs 42 times, the end", "", "   ", "one", "\u00e9t\u00e9 the fox the fox", "a b c d e f g"]


def _part(text):
    return next(slices(pa.array([text], pa.string())))


def test_word_vectors_against_brute_force(spark):
    fixed = quality.index_vectors()
    sums = np.zeros(fixed.shape)
    for text in TEXTS:
        units = list(zip(*(u.tolist() for u in quality._units(_part(text)))))
        for i, own in enumerate(units):
            for j, (word, shape) in enumerate(units):
                if 0 < abs(i - j) <= quality.WINDOW:
                    for unit in own:
                        sums[unit] += fixed[word] + fixed[shape]
    used = [u for u in range(len(sums)) if any(sums[u])]
    centre = sum(sums[u] for u in used) / len(used)
    expected = np.zeros(fixed.shape)
    for u in used:
        expected[u] = (sums[u] - centre) / np.linalg.norm(sums[u] - centre)
    docs = documents(spark, [*TEXTS, None])
    for table in (docs.repartition(5), docs.coalesce(1)):
        assert np.allclose(quality.corpus_vectors(table), expected, atol=1e-5)
    assert np.allclose(quality.unit_vectors(TEXTS), expected, atol=1e-5)
    assert not quality.corpus_vectors(docs.where("false")).any()


def test_pooling_and_network_against_brute_force(spark):
    random = np.random.default_rng(0)
    vectors = random.normal(size=quality.index_vectors().shape).astype(np.float32)
    wide = 3 * quality.DIMENSIONS
    net = {"vectors": vectors, "mean": random.normal(size=wide), "spread": random.random(wide) + 0.5,
           "w1": random.normal(size=(wide, quality.HIDDEN)), "b1": random.normal(size=quality.HIDDEN),
           "w2": random.normal(size=quality.HIDDEN), "b2": 0.3, "temperature": 1.7}
    expected = []
    for text in TEXTS:
        words, shapes = (u.tolist() for u in quality._units(_part(text)))
        x = [0.0] * wide
        for word, shape in zip(words, shapes):
            for k in range(quality.DIMENSIONS):
                x[k] += vectors[word][k] / len(words)
                x[quality.DIMENSIONS + k] += vectors[shape][k] / len(words)
            x[2 * quality.DIMENSIONS + shape % quality.DIMENSIONS] += 1 / len(words)
        inner = [np.tanh(sum((x[i] - net["mean"][i]) / net["spread"][i] * net["w1"][i][h] for i in range(wide))
                         + net["b1"][h]) for h in range(quality.HIDDEN)]
        logit = sum(v * w for v, w in zip(inner, net["w2"])) + net["b2"]
        expected.append(1 / (1 + np.exp(-logit / net["temperature"])))
    found = [r.score for r in _rows(quality.score(documents(spark, TEXTS), net))]
    assert np.allclose(found, expected, atol=1e-4)


def test_language_tasks_forget_what_the_encoder_remembered(spark, monkeypatch):
    """Codecs of a worker that Spark hands on to another stage stood beside its memory."""
    docs = documents(spark, ["one two", None])
    shared = byte_bpe.SharedCodec(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda rows, run, schema: run)
    for task in (language_id.predict(docs, None), language_id._runs):
        codec = weakref.ref(shared.codec())
        assert codec() is shared.codec()
        list(task(iter([])))
        assert codec() is None and not remembered._kept()


def test_texts_are_labelled_in_small_slices(spark, monkeypatch):
    docs = documents(spark, ["word " * 20_000] * 8)
    model = language_id.Model(["a", "b"], np.zeros((1 << language_id.TABLE_BITS, 2), np.float32),
                              np.zeros((2, 2), np.float32))
    sizes, label = [], language_id.label_slice
    monkeypatch.setattr(type(docs), "mapInArrow", lambda rows, run, schema: run)
    monkeypatch.setattr(language_id, "label_slice",
                        lambda part, model: sizes.append(len(part.data)) or label(part, model))
    batch = pa.RecordBatch.from_pydict({"doc_id": range(8), "text": ["word " * 20_000] * 8})
    found = pa.Table.from_batches(language_id.predict(docs, model)(iter([batch])))
    assert found.num_rows == 8 and sum(sizes) == 800_000 and max(sizes) <= 1 << 18
