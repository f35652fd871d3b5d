"""The corpus pipeline: toxic documents out, repeated lines out, near duplicates out, sources mixed, pieces packed.

Each stage takes (spark, docs, sf_dir) and works on what its predecessor kept.
All but the last return the columns of `docs`; the last returns the packed
pieces.

In every stage a null or empty text is a document without words, rows may
repeat, an empty table gives an empty one, and further columns, whatever their
names, are carried along. Rows without a doc_id are never near copies or toxic,
so they stay to the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veritab.llm import linededup, minhash, mixing, packing, toxicity
from veritab.llm.common import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labelled ones, doesn't call toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with lines found in three or more left only in the one with the largest id.

    A document of which nothing is left goes: all it said stands in others, and
    an empty text would be mixed and packed like any other.
    """
    return linededup.drop_repeated_lines(docs, drop_emptied=True)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, Jaccard 0.8)."""
    return minhash.drop_near_duplicates(docs, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for, each at least once."""
    return mixing.mix_sources(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", dedup_documents),
    ("mixing", mix),
    ("best_fit_packing", pack),
]

#: The first stage is a trained model, the last a tokenizer: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
