"""Bounded samples of labelled rows, for models that are fitted on the driver."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a text that a fit learns from: a run of so many, if the text is longer. Scores use whole texts.
FIT_CHARACTERS = 50_000


def fit_run(text: Column, doc_id: Column) -> Column:
    """A text, or of a longer one a run of FIT_CHARACTERS that begins at a place by a hash of doc_id."""
    start = F.pmod(F.xxhash64(doc_id), F.greatest(F.length(text) - FIT_CHARACTERS + 1, F.lit(1))) + 1
    run = F.substring(text, start.cast("int"), F.lit(FIT_CHARACTERS))
    return F.when(F.length(text) <= FIT_CHARACTERS, text).otherwise(run)


def remainder(divisor: int) -> Column:
    """crc32 of doc_id as text, modulo a number; 0 for a null doc_id."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor
    return F.coalesce(code, F.lit(0)).cast("int")


def first_of_each(rows: DataFrame, label: str, number: int) -> DataFrame:
    """``number`` rows (doc_id, label) of each label, by a hash of doc_id, with their ``place``.

    Only the share of the hashes that holds about four times that number goes into the ranking, so
    a label that most rows carry does not land in one task.
    """
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    counts = rows.groupBy(label).agg(F.count("*").alias("all"))
    few = rows.join(counts.hint("rebalance"), label).withColumn("spread", spread).where(
        F.col("spread") * F.col("all") <= F.lit(float(1 << 30)) * 4 * number)
    order = Window.partitionBy(label).orderBy("spread", "doc_id")
    ranked = few.withColumn("place", F.row_number().over(order))
    return ranked.where(F.col("place") <= number).select("doc_id", label, "place")


def labelled_sample(documents: DataFrame, labels: DataFrame, rows: int) -> pd.DataFrame:
    """(text, label) of at most ``rows`` documents of each label, by the order of a hash of doc_id.

    Of texts of more than FIT_CHARACTERS a run is taken.

    ``labels`` has doc_id and label. A document labelled twice has its largest label; rows without
    id, label or text take no part.
    """
    one = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(
        F.max("label").alias("label"))
    chosen = first_of_each(one, "label", rows)
    # At most ``rows`` ids for each label.
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    found = texts.join(F.broadcast(chosen), "doc_id").withColumn("text", fit_run(F.col("text"), F.col("doc_id")))
    sample = found.groupBy("doc_id", "label", "place").agg(F.min("text").alias("text")).toPandas()
    return sample.sort_values(["label", "place"])[["text", "label"]].reset_index(drop=True)
