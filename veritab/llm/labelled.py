"""Labelled rows for the classifiers: folds, and a bounded sample to fit on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import cut


def held_out(doc_id: Column) -> Column:
    """Rows never fitted on: crc32 of the id as text, modulo 3, is 1. A null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, column: str, rows: int) -> DataFrame:
    """(label int, text) of at most `rows` labelled documents outside the held-out fold; checkpointed.

    They are those with the least md5 of the id: the same whatever the order
    or split of the tables. A document with several labels takes the largest.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(column).cast("int").alias("label"))
    own = own.where(F.col("label").isNotNull() & F.col("_id").isNotNull() & ~held_out(F.col("_id"))).groupBy("_id").agg(F.max("label").alias("label"))
    few = cut(own.withColumn("_key", F.md5(F.col("_id").cast("string").cast("binary"))).orderBy("_key").limit(rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string").alias("text"))
    # few has at most `rows` ids: a proven bound for the broadcast
    return cut(texts.join(F.broadcast(few.drop("_key")), texts["_doc"] == few["_id"]).select("label", F.coalesce("text", F.lit("")).alias("text")))
