"""Bounded samples of labelled rows, the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_hash(rows: DataFrame, most: int, key: str = "doc_id") -> DataFrame:
    """At most ``most`` distinct rows: those with the smallest hashes of the key, of equal keys by a hash of the whole row.

    Keys are ranked first; no row leaves its task until it is known to be in the sample.
    """
    h, whole = F.xxhash64(key), F.xxhash64(*rows.columns)
    cut = rows.select(h.alias("h")).orderBy("h").limit(most).agg(F.max("h")).first()[0]
    if cut is None:
        return rows.limit(0)
    near = rows.where(h <= F.lit(cut))
    last = near.select(h.alias("h"), whole.alias("w")).orderBy("h", "w").limit(most).agg(F.max(F.struct("h", "w")).alias("x")).select("x.*").first()
    return near.where((h < F.lit(last.h)) | ((h == F.lit(last.h)) & (whole <= F.lit(last.w)))).dropDuplicates()


def labelled(labels: DataFrame, column: str, where, most: int) -> DataFrame:
    """(doc_id, label) of at most ``most`` documents with a non-null label; of repeated labels the largest."""
    rows = labels.select("doc_id", F.col(column).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & where)
    return by_hash(rows, most).groupBy("doc_id").agg(F.max("label").alias("label"))


def with_texts(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """doc_id, text, label of the picked ids, whose number is bounded: they are broadcast, the texts stay put."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
