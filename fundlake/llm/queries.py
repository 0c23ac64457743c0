"""The queries of the corpus operators: (spark, folder of tables) -> DataFrame, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm import byte_bpe, id_store, language, mixing, near_dup, permutation_index, quality, repeats, surrogates, toxicity
from fundlake.llm.common import held_out, table
from fundlake.llm.oracle import ORACLE_SQL as ORACLE_SQL


def op1_token_id_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    path = id_store.store(table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"), 49408)
    return id_store.digest(id_store.read(spark, path))


def op2_byte_bpe(spark: SparkSession, sf_dir: str, ranks: str | None = None) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("first", "end")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.predict(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "epoch", "domain", "lang", "source", "n_tokens")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs)
    return language.predict(docs.drop("lang"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op8_surrogates(spark: SparkSession, sf_dir: str, key: bytes = b"op8") -> DataFrame:
    rows = surrogates.replace(table(spark, sf_dir, "documents"), key)
    return rows.select("doc_id", "text", "n_entities")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, pivots = permutation_index.build(table(spark, sf_dir, "embeddings"))
    return permutation_index.search(index, pivots, lambda i: i % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_token_id_files, op2_byte_bpe, op3_repeated_spans, op4_toxicity, op5_source_mixture, op6_language, op7_quality_rules, op8_surrogates, op9_near_duplicates, op10_permutation_index)}
