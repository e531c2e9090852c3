"""A training-data pipeline over ``documents``: quality rules, language ID,
exact dedup, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``; rejected documents and copies are
gone from the next stage on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidecast.llm import exact_dedup, langid, ngram_join, packing, quality_lines
from tidecast.llm.common import read_table, store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first quality rules (operator 8)."""
    return quality_lines.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified (operator 1), by a model fitted
    on this stage's labelled documents. ``lang`` becomes the language found, by
    which the last stage packs."""
    return langid.keep_identified(docs, langid.train(docs), min_score=0.0, lang_col="lang")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (operator 5)."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (operator 9)."""
    return ngram_join.drop_near_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the documents left, in length buckets and batches of one
    language (operator 2)."""
    return packing.pack(docs, group_col="lang")


STAGES = [("quality", quality), ("language", language), ("exact", exact), ("near", near), ("packing", pack)]

#: The fitted labelling and the banding have no SQL; tests compare run() with
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
