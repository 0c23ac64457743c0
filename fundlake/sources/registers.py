"""Registers and answer caches that other sources are joined with."""

from __future__ import annotations

import json
import os
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.operators.fold import MIC_ALIASES, SUFFIXES
from fundlake.sources import text

#: The register's columns and ours.
REGISTER = {"MIC": "mic", "OPERATING MIC": "operating_mic", "MARKET NAME-INSTITUTION DESCRIPTION": "name", "MARKET CATEGORY CODE": "category", "ISO COUNTRY CODE (ISO 3166)": "country", "STATUS": "status"}


def venues(spark: SparkSession, path: str) -> DataFrame:
    """Every code of the venue register, expired ones too, one row each."""
    rows = spark.read.option("header", True).option("multiLine", True).csv(path)
    text.require(rows.columns, list(REGISTER), "MIC register")
    made = rows.select(*(text.blank(F.col(f"`{c}`")).alias(a) for c, a in REGISTER.items())).where("mic IS NOT NULL")
    return text.one_line(made, ["mic"], "operating_mic", "name")


def alias_problems(register: DataFrame, aliases: dict[str, str] = MIC_ALIASES, used: dict = SUFFIXES) -> DataFrame:
    """(alias, problem): aliases of a venue that symbols are made for, whose target is an alias itself, or that the register files under another operator."""
    rows = register.sparkSession.createDataFrame([(a, t, a in used, t in aliases) for a, t in aliases.items()], "alias string, target string, own boolean, chained boolean")
    known = register.select(F.col("mic").alias("alias"), "operating_mic")
    problem = F.when(F.col("own"), "is a venue of its own").when(F.col("chained"), "points at another alias").when(F.col("operating_mic").isNotNull() & (F.col("operating_mic") != F.col("target")), F.concat(F.lit("is operated by "), F.col("operating_mic")))
    return rows.join(known, "alias", "left").select("alias", problem.alias("problem")).where("problem IS NOT NULL")


def unknown_aliases(register: DataFrame, aliases: dict[str, str] = MIC_ALIASES) -> DataFrame:
    """(alias) that the register does not know."""
    return register.sparkSession.createDataFrame([(a,) for a in aliases], "alias string").join(register.select(F.col("mic").alias("alias")), "alias", "left_anti")


def mapping_cache(spark: SparkSession, path: str) -> DataFrame:
    """(isin, records) of an append-only file of answers, one JSON object a line; a torn line is dropped, answers to one isin are joined."""
    rows = spark.read.option("mode", "DROPMALFORMED").schema("isin string, records array<struct<exchCode: string, ticker: string, figi: string>>").json(path)
    return rows.where("isin IS NOT NULL").groupBy("isin").agg(F.flatten(F.collect_list(F.coalesce("records", F.array().cast("array<struct<exchCode: string, ticker: string, figi: string>>")))).alias("records"))


def unmapped(isins: DataFrame, cache: DataFrame) -> DataFrame:
    """The isins still to ask for; an empty answer is an answer."""
    return isins.select("isin").distinct().join(cache.select("isin"), "isin", "left_anti")


def zipped_csv(spark: SparkSession, path: str, columns: list[str], folder: str) -> DataFrame:
    """Some columns of the first CSV in a zip file, which is unpacked once into ``folder`` (shared with the executors): a zip cannot be split, the CSV can."""
    with zipfile.ZipFile(path) as z:
        member = next(n for n in z.namelist() if n.lower().endswith(".csv"))
        z.extract(member, folder)
    rows = spark.read.option("header", True).csv(os.path.join(folder, member))
    text.require(rows.columns, columns, member)
    return rows.select(*(text.blank(F.col(f"`{c}`")).alias(c) for c in columns))


def newest(listing: str, prefix: str = "FULINS_C") -> str | None:
    """The address of the newest document of a file register's answer whose name begins with ``prefix``."""
    found = [d for d in json.loads(listing).get("response", {}).get("docs", []) if str(d.get("file_name", "")).startswith(prefix)]
    best = max(found, key=lambda d: (d.get("publication_date", ""), d.get("file_name", "")), default=None)
    return best and best.get("download_link")


def first_figures(quotes: DataFrame, fields: tuple[str, ...] = ("ter", "aum")) -> DataFrame:
    """For each isin the first figure that any of its quotes states, in the order of ``seq``."""
    return quotes.where("isin IS NOT NULL").groupBy("isin").agg(*(F.min_by(f, F.when(F.col(f).isNotNull(), F.col("seq"))).alias(f) for f in fields))
