"""The corpus pipeline: toxic and poor documents go, one of each group of near copies stays, sources are
mixed to their weights, and what is left is encoded.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before kept; `run`
writes what a stage returns as Parquet and reads it for the next one, which cuts the lineage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm import bpe, importance, jaccard, mixing, toxicity
from tabflow.llm.common import word_count
from tabflow.llm.queries import WEIGHTS
from tabflow.sources.shared import persist_state
from tabflow.sources.tables import table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5; learnt from the labelled documents among them."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that a Gumbel top-k sample by importance weight keeps."""
    return importance.sampled_documents(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 0.75 between sets of 5-word shingles connect."""
    return jaccard.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs, word_count(F.col("text")), WEIGHTS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document of the mix."""
    coded = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), ["doc_id", "source"])
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("toxicity", without_toxic),
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", without_near_copies),
    ("mixing_sources", mixed),
    ("bpe", encoded),
]

# The classifiers and the tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = persist_state(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
