"""The registered queries of this package, each over whole tables of a data folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe, chat_rotation, language_id, merkle, near_dedup, neighbours, quality, secrets_scan, sharding,
    spelling, toxicity,
)
from .decontamination import contaminated
from .fitting import labelled_sample, remainder
from .line_dedup import dedup_lines
from .near_dedup import near_duplicates

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scored(scores: DataFrame, held_out: Column, least: float) -> DataFrame:
    return scores.select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"),
    )


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(remainder(4) != 2)
    sample = labelled_sample(
        docs, labels.select("doc_id", F.col("toxic").alias("label")), toxicity.SAMPLE_DOCUMENTS)
    return _scored(toxicity.score(docs, toxicity.fit(sample)), remainder(4) == 2, 0.3)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return byte_bpe.round_trip(docs, VOCABULARY, public_tokenizers.PATTERN)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "n_lines", "n_dropped")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op7_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_rotation.rotate(_table(spark, sf_dir, "conversations"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.secrets(_table(spark, sf_dir, "documents"))

    def spans(findings: Column) -> Column:
        return F.concat_ws(",", F.transform(
            findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])))

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint").alias(
            f"n_{kind}")

    base = F.filter("findings", lambda f: f["kind"] != "novel")
    return found.select(
        "doc_id", *map(count, ("assign", "access", "hex")),
        F.sha2(spans(base).cast("binary"), 256).alias("base_sha256"),
        spans(F.col("findings")).alias("spans"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(remainder(3) != 1)
    sample = labelled_sample(
        docs, labels.select("doc_id", F.col("quality").alias("label")), quality.SAMPLE_DOCUMENTS)
    model = quality.fit(sample, quality.corpus_vectors(docs))
    return _scored(quality.score(docs, model), remainder(3) == 1, 0.5)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(remainder(5) != 0))
    return language_id.predict(docs, model).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.documents_manifest(_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.documents_variants(_table(spark, sf_dir, "documents"))


def op13_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.documents_in_shards(_table(spark, sf_dir, "documents"))


LLM_QUERIES = {
    query.__name__: query for query in (
        op1_nearest_neighbours, op2_toxicity, op3_decontamination, op4_byte_bpe, op5_line_dedup,
        op6_minhash_near_dedup, op7_chat_rotation, op8_secret_scan, op9_quality_classifier,
        op10_language_id, op11_merkle_manifest, op12_spelling_variants,
        op13_rendezvous_sharding,
    )
}

NEIGHBOURS_SQL = """
with usable as (
  select vec_id, min(cast(embedding as double[])) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
  group by vec_id),
sized as (
  select *, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda a, b: a + b)) as size from usable),
scored as (
  select q.vec_id as query_id, c.vec_id, list_reduce(
      list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]), lambda a, b: a + b)
    / (q.size * c.size) as score
  from sized q join sized c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as place
  from scored)
select query_id, cast(place as integer) as rank, vec_id, score from ranked where place <= 5
"""

LLM_ORACLE = {
    "op1_nearest_neighbours": NEIGHBOURS_SQL,
    "op6_minhash_near_dedup": near_dedup.SQL,
    "op7_chat_rotation": chat_rotation.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op12_spelling_variants": spelling.SQL,
    "op13_rendezvous_sharding": sharding.SQL,
}
