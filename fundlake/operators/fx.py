"""Euro conversion: tidy rates, their checks, and the as-of join with its age limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.functions import money
from fundlake.operators.asof import daily_validity

MAX_AGE = 10


def tidy(wide: DataFrame) -> DataFrame:
    """(date, currency, rate_to_eur) of a table with one column for each currency; what is no number is dropped."""
    codes = [c for c in wide.columns if c.lower() != "date"]
    text = wide.select(F.to_date("date").alias("date"), *(F.col(f"`{c}`").cast("string").alias(c) for c in codes))
    long = text.unpivot(["date"], codes, "currency", "rate")
    return long.select("date", F.upper(F.trim("currency")).alias("currency"), F.expr("try_cast(rate AS double)").alias("rate_to_eur")).where("date IS NOT NULL AND rate_to_eur IS NOT NULL AND NOT isnan(rate_to_eur)")


def problems(rates: DataFrame) -> DataFrame:
    """(problem, n) of structural faults; no rows for sound rates."""
    bad = F.when(F.col("rate_to_eur").isNull() | F.isnan("rate_to_eur") | (F.abs("rate_to_eur") == float("inf")) | (F.col("rate_to_eur") <= 0), "rate not finite and positive").when(F.weekday("date") >= 5, "published on a weekend")
    found = rates.select(bad.alias("problem")).where("problem IS NOT NULL").groupBy("problem").agg(F.count("*").alias("n"))
    none = rates.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("no rates").alias("problem"), F.lit(1).cast("long").alias("n"))
    return found.unionByName(none)


def with_legacy(rates: DataFrame) -> DataFrame:
    """Published rates up to each euro entry, then the statutory rate."""
    legacy = rates.sparkSession.createDataFrame([(c, d, r) for c, (d, r) in money.EURO_LEGACY.items()], "currency string, entry string, rate_to_eur double").select("currency", F.to_date("entry").alias("date"), "rate_to_eur")
    entry = legacy.select("currency", F.col("date").alias("entry"))
    kept = rates.join(F.broadcast(entry), "currency", "left").where("entry IS NULL OR date < entry").select("date", "currency", "rate_to_eur")
    return kept.unionByName(legacy.select("date", "currency", "rate_to_eur"))


def attach_rates(bars: DataFrame, rates: DataFrame, max_age: int = MAX_AGE, horizon=None) -> DataFrame:
    """``bars`` (currency: an ISO code) with rate_to_eur of the last publication at most ``max_age`` days old, else null.

    Currencies that joined the euro never go stale.
    """
    forever = F.col("currency").isin(*money.EURO_LEGACY)
    end = F.lit(horizon).cast("date") if horizon is not None else F.current_date()
    return bars.join(daily_validity(rates.select("currency", "date", "rate_to_eur"), "currency", "rate_to_eur", max_age, forever, end), ["currency", "date"], "left")


def to_eur(bars: DataFrame, rates: DataFrame, columns: tuple[str, ...] = ("close", "adj_close"), max_age: int = MAX_AGE, horizon=None) -> DataFrame:
    """``bars`` with ``columns`` in euros, currency EUR and rate_to_eur; null where no rate applies."""
    order = [*bars.columns, "rate_to_eur"]
    made = bars.withColumn("unit_", money.unit(F.col("currency"))).withColumn("currency", money.iso(F.col("currency")))
    joined = attach_rates(made, rates, max_age, horizon)
    home = F.col("currency") == "EUR"
    for c in [c for c in columns if c in bars.columns]:
        joined = joined.withColumn(c, F.when(home, F.col(c) * F.col("unit_")).otherwise(F.col(c) * F.col("unit_") / F.col("rate_to_eur")))
    return joined.withColumn("rate_to_eur", F.when(home, F.lit(1.0)).otherwise(F.col("rate_to_eur"))).withColumn("currency", F.lit("EUR")).select(*order)


def coverage(requested: DataFrame, rates: DataFrame) -> DataFrame:
    """For each requested ``quoted_as``: currency, unit, supported, first_rate, last_rate, observations."""
    spans = rates.groupBy("currency").agg(F.min("date").alias("first_rate"), F.max("date").alias("last_rate"), F.count("*").alias("observations"))
    asked = requested.select("quoted_as", money.iso(F.col("quoted_as")).alias("currency"), money.unit(F.col("quoted_as")).alias("unit")).distinct()
    joined = asked.join(spans, "currency", "left")
    return joined.select("quoted_as", "currency", "unit", ((F.col("currency") == "EUR") | F.col("observations").isNotNull()).alias("supported"), "first_rate", "last_rate", F.coalesce("observations", F.lit(0)).alias("observations"))
