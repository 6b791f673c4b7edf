"""Merkle manifest and sharding against plain Python."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from keyedlog.llm import merkle, sharding
from llm_cases import DOCS


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves, run):
    """Root and the sibling steps of every leaf."""
    paths, level = [[] for _ in leaves], leaves
    at = list(range(len(leaves)))
    while len(level) > 1:
        for leaf, place in enumerate(at):
            first = place // run * run
            paths[leaf].append(("".join(level[first:place]), "".join(level[place + 1:first + run])))
            at[leaf] = place // run
        level = [h(*level[i:i + run]) for i in range(0, len(level), run)]
    return level[0], paths


def brute_manifest(rows, run):
    """(doc_id, leaf) -> sorted (subroot, root, path) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], h(*map(field, row))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {g: tree([leaf for _, leaf in groups[g]], run) for g in names}
    root, tops = tree([trees[g][0] for g in names], run)
    out = []
    for g, top in zip(names, tops):
        for (doc_id, leaf), path in zip(groups[g], trees[g][1]):
            out.append((str(doc_id), leaf, trees[g][0], root, tuple(path + top)))
    return sorted(out)


def records(rng, n, langs):
    return [(rng.choice([None, *range(n)]), rng.choice([None, "s", ""]), rng.choice(langs),
             rng.choice([None, 3]), rng.choice([None, "", "é字", "x" * 5000, "a"])) for _ in range(n)]


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("run, block", [(2, 4), (3, 9), (2, 1024)])
def test_manifest_against_one_tree_in_memory(spark, monkeypatch, run, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    rows = records(random.Random(run), 120, ["en", "en", "en", "de", None, "", "fr", "z"]) + [
        (7, "s", "alone", 1, "t"), (8, "s", "en", 1, "same"), (8, "s", "en", 1, "same")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = merkle.manifest(df, merkle.COLUMNS, "lang", "doc_id", run)
    got = sorted((str(r.doc_id), r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path))
                 for r in found.collect())
    assert got == brute_manifest(rows, run)
    assert found.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


def test_tampered_rows_do_not_verify(spark):
    rows = [(i, "s", "en" if i % 3 else "de", None if i % 5 == 0 else i, f"t{i}", "x", 0)
            for i in range(60)] + [(None, "s", "en", 4, "t", "x", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, "
                                     "text string, leaf string, place int")
    found = {r.doc_id: r for r in merkle.documents_manifest(df).collect()}
    expected = {d: (s, r, p) for d, _, s, r, p in brute_manifest([r[:5] for r in rows], 2)}
    for row in rows:
        got = found[row[0]]
        tampered = (row[0] is not None and row[3] is not None
                    and zlib.crc32(str(row[0]).encode()) % 7 == 0)
        subroot, root, path = expected[str(row[0])]
        assert got.verified is not tampered and (got.folded_root == root) is not tampered
        assert (got.subroot, got.root) == (subroot, root)
        assert got.proof_sha256 == h(*(left + right for left, right in path))


def test_manifest_of_little(spark):
    nothing = merkle.documents_manifest(spark.createDataFrame([], DOCS))
    assert nothing.count() == 0
    one = spark.createDataFrame([(1, None, None, "", None, "x", 0)], DOCS)
    row = merkle.documents_manifest(one).first()
    assert row.leaf == row.subroot == row.root == row.folded_root == h("1:1", "0:", "-", "-", "-")
    assert row.proof_sha256 == h() and row.verified
    with pytest.raises(ValueError, match="two nodes"):
        merkle.manifest(one, ["doc_id"], "lang", "doc_id", run=1)


def test_blocks_are_windows_and_nothing_is_ordered_in_one_task(spark):
    df = spark.range(5000).selectExpr("id doc_id", "'s' source", "'en' lang", "id n_chars", "'t' text")
    text = merkle.documents_manifest(df)._jdf.queryExecution().executedPlan().toString()
    assert "block" in text and "SinglePartition" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def brute_shard(key, weights):
    best = None
    for i, w in enumerate(weights):
        if w > 0:
            drawn = (int(hashlib.md5(f"{field(key)}#{i}".encode()).hexdigest()[:13], 16) + 0.5) / 16 ** 13
            best = max(best or (-1.0, 0), (-w / math.log(drawn), -i))
    return -best[1]


@pytest.mark.parametrize("weights", [[1.0] * 16, [1.0, 0.0, 3.5, 0.25], [2.0]])
def test_shards_against_plain_hashing(spark, weights):
    keys = [None, -5, *range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = {r.k: r.shard for r in sharding.assign(df, ["k"], weights).collect()}
    assert got == {k: brute_shard(k, weights) for k in keys}


def test_new_and_heavier_shards_only_take(spark):
    df = spark.range(20_000)
    for name, weights in {"a": [1, 1, 2], "b": [1, 1, 2, 1], "c": [1, 1, 4], "d": [1, 0, 2]}.items():
        df = sharding.assign(df, ["id"], weights, name)
    rows = df.collect()
    assert all(r.b in (r.a, 3) for r in rows) and all(r.c in (r.a, 2) for r in rows)
    assert all(r.d == r.a for r in rows if r.a != 1)
    share = [sum(r.a == i for r in rows) / len(rows) for i in range(3)]
    assert all(abs(s - e) < 0.02 for s, e in zip(share, (0.25, 0.25, 0.5)))
    moved = sum(r.b == 3 for r in rows) / len(rows)
    assert abs(moved - 0.2) < 0.02


def test_slots_and_odd_rows(spark):
    rows = [(None, None, 0), (None, "é", 0), (3, "", 0), (3, "", 0), (3, "x" * 100_000, 0)]
    rows += [(i, "same", 9) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, slot int")
    found = sharding.documents_in_shards(df).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in found) == sorted(
        (str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert {r.law for r in found} == {"key"}
    for shard in {r.shard for r in found}:
        held = sorted((r for r in found if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in held] == list(range(len(held)))
        order = [(r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in held]
        assert order == sorted(order)
    for r in found:
        assert r.shard == brute_shard(r.doc_id, [1.0] * 16)
        assert r.grown_shard == brute_shard(r.doc_id, [1.0] * 17)
    assert sharding.documents_in_shards(df.limit(0)).count() == 0


def test_written_shards(spark, tmp_path):
    df = sharding.assign(spark.range(1000), ["id"], [1, 1, 1])
    sharding.write_shards(df, str(tmp_path / "out"), file_rows=100)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.select("id", "shard").collect())) == sorted(map(tuple, df.collect()))
    assert back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 100


@pytest.mark.parametrize("weights", [[], [0.0], [1.0, -1.0], [1.0, math.inf]])
def test_odd_weights_are_refused(weights):
    with pytest.raises(ValueError):
        sharding.shard_of([], weights)
