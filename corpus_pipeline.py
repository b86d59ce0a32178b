"""A training corpus from documents: language, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows of the stage before and returns the
columns of the documents; the last one returns packed pieces. Null columns, empty texts, repeated
rows, empty tables and further columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, language, mixing, packing, secrets
from tidemark.llm.common import stored, table

#: Below this mean probability no language is accepted.
LEAST_SCORE = 0.5


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is told with enough certainty, with that language as
    ``lang``; texts that are null or without a letter go. Every row is judged by its own text,
    whatever its id."""
    told = language.with_label(docs, language.train(docs), "__told", "__certainty")
    kept = told.where((F.col("__told") != language.UNKNOWN) & (F.col("__certainty") >= LEAST_SCORE))
    return kept.select(*(F.col("__told").alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, repeated rows included: the one with the
    smallest id, null ids last. Texts without a word are in no group and stay."""
    return jaccard.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return secrets.cleaned(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards the target weights of their sources, in random order."""
    return mixing.replicate(docs, copy="__copy", shuffle_key="__key").drop("__copy", "__key")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, packing.vocabulary())


STAGES = [
    ("language", by_language),
    ("near_duplicates", without_copies),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: Trained and tokenised stages are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
