"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import bestfit, chats, jaccard, language, mixing, packing, personal, prefix_trie, quality, secrets, spelling, topk, toxicity
from tidemark.llm.common import table


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_classes(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.score(documents, quality.train(documents, table(spark, sf_dir, "labels")))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.linked(*chats.calls_of(table(spark, sf_dir, "conversations")), chats.TOOLS)


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.replicate(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return mixed.select("doc_id", "source", "copy", "shuffle_key")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find(table(spark, sf_dir, "documents")).drop("doc", "terms")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.vocabulary())


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language.label(documents, language.train(documents))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(table(spark, sf_dir, "conversations"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.groups(table(spark, sf_dir, "documents"))


def op13_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(table(spark, sf_dir, "documents"), bestfit.vocabulary())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_quality_rules": op2_quality_rules,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_secret_scans": op4_secret_scans,
    "op5_source_mixing": op5_source_mixing,
    "op6_topk_search": op6_topk_search,
    "op7_personal_data": op7_personal_data,
    "op8_packing": op8_packing,
    "op9_language_id": op9_language_id,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_bestfit_packing": op13_bestfit_packing,
    "pipeline": corpus_pipeline.run,
}
