"""Small helpers for files whose rows are text: sections, preambles, required columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlake.functions.identifiers import is_valid


def blank(c: Column) -> Column:
    """Trimmed; blank is null."""
    return F.nullif(F.trim(c), F.lit(""))


def lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(n, line): the lines of one file in order, from 0.

    Venue files are small and their preamble is told by position, so each is read by one task.
    """
    raw = spark.read.format("binaryFile").load(path).select(F.decode("content", encoding).alias("text"))
    text = F.regexp_replace("text", "^﻿", "")
    return raw.select(F.posexplode(F.split(text, "\r\n|\n")).alias("n", "line"))


def require(columns: list[str], needed: list[str], what: str) -> None:
    missing = [c for c in needed if c not in columns]
    if missing:
        raise KeyError(f"{what} lacks columns {missing}")


def delimited(spark: SparkSession, path: str, sep: str, skip_before: int = 0, skip_after: int = 0, needed: list[str] | None = None, encoding: str = "UTF-8", what: str = "file") -> DataFrame:
    """All columns as strings (blank: null) of a delimited file: ``skip_before`` lines, the header, ``skip_after`` lines, rows."""
    rows = lines(spark, path, encoding)
    head = rows.where(F.col("n") == skip_before).select("line").first()
    if head is None:
        raise ValueError(f"{what} has no header")
    import csv

    names = [c.strip() for c in next(csv.reader([head.line], delimiter=sep))]
    require(names, needed or [], what)
    ddl = ", ".join(f"`c{i}` string" for i in range(len(names)))
    body = rows.where((F.col("n") > skip_before + skip_after) & (F.trim("line") != ""))
    parsed = body.select("n", F.from_csv("line", F.lit(ddl), {"sep": sep, "mode": "PERMISSIVE"}).alias("r"))
    return parsed.select(F.col("n").alias("seq"), *(blank(F.col(f"r.c{i}")).alias(c) for i, c in enumerate(names)))


def split_valid(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a valid ISIN, distinct others)."""
    ok = is_valid(F.trim(column))
    return df.where(ok).withColumn(column, F.trim(column)), df.where(~ok).select(column).distinct()


def one_line(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("rn_", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("rn_ = 1").drop("rn_")
