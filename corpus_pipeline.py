"""The corpus pipeline: language, near-duplicates, personal data, mixture, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm import byte_bpe, language, mixing, near_dup, surrogates
from fundlake.llm.common import discard, release, shared_folder

#: Key of the surrogates; a parameter of the deployment, not a secret here.
SURROGATE_KEY = b"corpus pipeline"
#: Share of the tokens that the mixture keeps, and how often a scarce document may be repeated.
PERCENT, EPOCHS = 80, 2


def _same_columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: a letter, and a calibrated probability that rows of known language kept back
    from training practically never fall under.  Null and empty texts go; of a table without a lang nothing is told and nothing stays;
    null ids and langs, repeated rows and other columns are kept."""
    model = language.train(docs)
    told = language.predict(docs.withColumn("text", F.col("text").cast("string")), model)
    return _same_columns(told.where((F.col("lang_pred") != "und") & (F.col("score") >= model.least)), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each component of near-duplicates.  Rows without a doc_id and texts without a word
    stay; rows that repeat the smallest doc_id of a component all stay; other columns are kept."""
    gone = near_dup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return _same_columns(docs.join(gone, "doc_id", "left_anti"), docs)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and secrets replaced by surrogates; null texts stay null, n_chars follows the text, repeated
    rows are rewritten alike, other columns are kept."""
    return _same_columns(surrogates.replace(docs, SURROGATE_KEY), docs)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them; null langs and sources are leaves of their own, texts without a word weigh
    nothing, rows that repeat a doc_id are taken or left together, other columns are kept."""
    return _same_columns(mixing.mix(docs, percent=PERCENT, epochs=EPOCHS), docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of token ids, the digests of ids and of what they decode to, and offsets in short; one row for each of
    ``docs``, null and empty texts without ids."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language ID", language_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("PII", personal_data_stage),
    ("mixing sources to target weights", mixture_stage),
    ("byte-level BPE encoding and decoding", token_stage),
]

#: Learnt models, iterated components and hashed tokens are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; a stage's own tables, and the one it read, go once it is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        path = f"{shared_folder(spark)}/fundlake/stage-{k}-{uuid.uuid4().hex}"
        out = stage(spark, docs, sf_dir)
        out.write.option("compression", "zstd").parquet(path)
        release(spark)
        if before:
            discard(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), path
    return docs
