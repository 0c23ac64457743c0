"""Currency rates from files: a wide table first, dated JSON as the fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.operators import fx
from fundlake.sources.store import _exists


def wide_file(spark: SparkSession, path: str) -> DataFrame:
    """(date, currency, rate_to_eur) of a CSV with a column for each currency; N/A and a nameless last column are dropped."""
    rows = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    named = [c for c in rows.columns if c.strip() and not c.startswith("_c")]
    if "date" not in {c.lower() for c in named}:
        raise ValueError("the rates file has no date column")
    return fx.tidy(rows.select(*(F.col(f"`{c}`") for c in named)))


def dated_json(spark: SparkSession, path: str) -> DataFrame:
    """The same of {"rates": {day: {currency: rate}}}."""
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", "rates map<string, map<string, double>>").alias("j"))
    days = rows.select(F.explode("j.rates").alias("day", "of"))
    long = days.select(F.to_date("day").alias("date"), F.explode("of").alias("currency", "rate_to_eur"))
    return long.select("date", F.upper(F.trim("currency")).alias("currency"), "rate_to_eur").where("date IS NOT NULL AND rate_to_eur IS NOT NULL")


def load(spark: SparkSession, sources: list, cache: str | None = None, refresh: bool = False) -> DataFrame:
    """Sound rates with the statutory ones: the cache's, or the first of ``sources`` (functions of the session) that gives sound ones, then cached.

    A source fails by raising, or by structural faults, which its rates are checked for at once; an error that
    names every failure if none is left.
    """
    if cache and not refresh and _exists(spark, cache):
        return fx.with_legacy(spark.read.parquet(cache))
    failed = []
    for source in sources:
        try:
            rates = source(spark)
            found = fx.problems(rates).collect()  # a row for each kind of fault
        except Exception as e:  # noqa: BLE001 - whatever a source may raise, the next one is asked
            failed.append(f"{type(e).__name__}: {e}")
            continue
        if found:
            failed.append("; ".join(f"{r.problem}: {r.n}" for r in found))
            continue
        if cache:
            rates.write.mode("overwrite").parquet(cache)
            rates = spark.read.parquet(cache)
        return fx.with_legacy(rates)
    raise ValueError("no usable rates: " + " | ".join(failed))


def latest(rates: DataFrame) -> DataFrame:
    """(currency, date, rate_to_eur): the last of each currency."""
    return rates.groupBy("currency").agg(F.max("date").alias("date"), F.max_by("rate_to_eur", "date").alias("rate_to_eur"))
