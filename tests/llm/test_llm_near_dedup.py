import random
from itertools import combinations

import pytest

from keyedlog.llm.components import components
from keyedlog.llm.near_dedup import LEAST, least_shared, near_duplicates
from llm_cases import DOCS, documents, shingle_list, smallest_reachable


def _expected(texts, first=1):
    sets = {i: set(shingle_list(t)) for i, t in enumerate(texts, first)}
    links = [
        (a, b) for a, b in combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    found = smallest_reachable(sets, links)
    return {i: (len(sets[i]), found[i], found[i] == i) for i in sets}


def _found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def _edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def test_against_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \t\n", "one two", "One TWO", "one two three", "a b c d e", "a b c d e",
             "É b c d e", "é b c d e", "a b c d e f", "x " * 400]
    for size in (12, 40, 200):
        base = [f"v{rng.randrange(10**6)}" for _ in range(size)]
        passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(10))
        texts += [_edited(rng, base, rng.randrange(0, size // 8)) for _ in range(25)]
        texts += [f"{passage} " + _edited(rng, base, size) for _ in range(10)]
    assert _found(near_duplicates(documents(spark, texts))) == _expected(texts)


def test_long_text_and_repeated_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = documents(spark, [long, long + " end", "short text of five words"])
    found = near_duplicates(rows.unionAll(rows)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found) == sorted(
        [(1, 1, True), (2, 1, False), (3, 3, True)] * 2)


def test_empty_table_and_null_id(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    rows = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f")],
                                 "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates(rows).collect()}
    assert found == {None: None, 7: 7}


def test_shared_values_bound():
    assert least_shared(4) == 1
    assert 1 < LEAST < 24


@pytest.mark.parametrize("n", [2, 40])
def test_components_of_chains_stars_and_loops(spark, n):
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(n)]
    edges += [(5000, 5000), (None, 3), (0, 1)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    real = [e for e in edges if None not in e and e[0] != e[1]]
    expected = smallest_reachable({x for e in real for x in e}, real)
    assert sorted((r.node, r.component) for r in found) == sorted(expected.items())
