"""The corpus pipeline: quality, near-duplicates, secrets, mixture, packing.

Each stage takes the documents its predecessor kept and returns those it keeps with the columns of
``documents``; the last returns the pieces of packed windows. Between stages the rows are written to the shared
folder and read again, so a stage starts from files and survives the loss of executors.

Defined cases are those of the operators; an empty table gives no pieces, and columns beyond those of
``documents`` are dropped at the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import minhash, mixing, packing, quality, secretscan
from plumbline.llm.common import DOCUMENT_COLUMNS, code_on_workers, saved, table

# No SQL: the classifier is fitted by gradients and the tokenizer is a library. Tests hold the stages against
# brute force.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier rejects go."""
    code_on_workers(spark)
    docs = docs.select(DOCUMENT_COLUMNS)
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8."""
    code_on_workers(spark)
    return minhash.deduplicated(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; no document goes."""
    code_on_workers(spark)
    return secretscan.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that tokens have the target shares by source, language and topic."""
    return mixing.mixed(docs).filter("__drawn").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 tokens."""
    code_on_workers(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), "words")


STAGES = [
    ("quality", good_quality), ("near_duplicates", one_of_near_duplicates), ("secrets", without_secrets),
    ("mixture", mixture), ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
