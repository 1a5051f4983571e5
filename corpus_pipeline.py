"""From documents to token ids: the stages of a training corpus, each a DataFrame job.

Each stage works on all rows that the one before kept. Every stage but the last
returns the columns of documents; the last returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from modelyard.llm.bpe import encoded_rows
from modelyard.llm.common import table
from modelyard.llm.language import in_some_language
from modelyard.llm.mixing import mixed, stored
from modelyard.llm.near import one_of_each
from modelyard.llm.secrets import redacted


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language explains go; lang is declared, source the host."""
    return in_some_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, the one with the smallest id."""
    return one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each secret in a text gives way to its kind; every document stays."""
    return redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids of each document of the mix."""
    return encoded_rows(docs, "doc_id", "source")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix), ("tokens", tokens)]
# Signatures, learned likelihoods and token ids have no SQL form; the tests check the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
