"""Choosing rows: one of each key, latest or first, with a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """For each key the row that is greatest in ``order``; null keys are a key.

    One aggregate, combined before the shuffle.  Rows are structs, so Spark sorts by the keys on both sides of it: where
    the keys' order is used afterwards, as in ``stats.clean``, a window over that order costs less.
    """
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*order) if len(order) > 1 else order[0]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("row_")).select(*keys, "row_.*").select(*df.columns)


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """For each key the row that is least in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*order) if len(order) > 1 else order[0]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), by).alias("row_")).select(*keys, "row_.*").select(*df.columns)


def first_known(field: str, order: Column) -> Column:
    """The value of ``field`` in the first row of ``order`` that has one; false and 0 are values."""
    return F.expr(f"min_by({field}, order_) FILTER (WHERE {field} IS NOT NULL)") if order is None else F.min_by(F.when(F.col(field).isNotNull(), F.col(field)), F.when(F.col(field).isNotNull(), order))


def hash_sample(funds: DataFrame, n: int, keep: list[str], key: str = "isin") -> DataFrame:
    """``n`` rows in the order of a hash of the key, those in ``keep`` first."""
    forced = F.col(key).isin(*keep) if keep else F.lit(False)
    return funds.orderBy((~forced).cast("int"), F.md5(F.col(key).cast("binary")), key).limit(n)
