"""Total-return series from raw closes and corporate actions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def event_factors(bars: DataFrame, events: DataFrame, split_adjusted: bool = True) -> DataFrame:
    """Every event with ``at`` (the last bar strictly before its ex-date), factor and status.

    One union of bars and events, one shuffle by isin and one running window: bars sort after the
    events of their own day, so an event sees the bars before its date only.
    """
    b = bars.select("isin", "date", F.col("close").cast("double").alias("close"), F.lit(1).alias("side"), *(F.lit(None).cast(t).alias(c) for c, t in (("kind", "string"), ("amount", "double"), ("ratio", "double"))))
    e = events.select("isin", "date", F.lit(None).cast("double").alias("close"), F.lit(0).alias("side"), "kind", F.col("amount").cast("double").alias("amount"), F.col("ratio").cast("double").alias("ratio"))
    w = Window.partitionBy("isin").orderBy("date", "side").rowsBetween(Window.unboundedPreceding, 0)
    bar = F.col("side") == 1
    fine = bar & (F.col("close") > 0) & (F.col("close") < float("inf"))
    rows = b.unionByName(e).withColumn("at", F.last(F.when(bar, F.col("date")), ignorenulls=True).over(w)).withColumn("reference", F.last(F.when(fine, F.col("close")), ignorenulls=True).over(w)).withColumn("last_bar", F.max(F.when(bar, F.col("date"))).over(Window.partitionBy("isin")))
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    dividend = (F.col("kind") == "dividend") & finite("amount")
    split = (F.col("kind") == "split") & finite("ratio") & (F.col("ratio") > 0)
    factor = F.when(dividend, (F.col("reference") - F.col("amount")) / F.col("reference")).when(split, F.lit(1.0) if split_adjusted else 1.0 / F.col("ratio"))
    status = (
        F.when(F.col("last_bar").isNull(), "fund not in price panel")
        .when(F.col("date").isNull(), "undated event")
        .when(F.col("at").isNull() | (F.col("date") > F.col("last_bar")), "outside the fund's price window")
        .when(F.col("reference").isNull(), "no usable reference close")
        .when(~F.coalesce(dividend | split, F.lit(False)), "unrecognised event kind")
        .when(F.col("factor") <= 0, "non-positive adjustment factor")
        .otherwise("applied")
    )
    return rows.where("side = 0").withColumn("factor", factor).withColumn("status", status).select("isin", "date", "kind", "amount", "ratio", "at", "reference", "factor", "status")


def report(factors: DataFrame) -> DataFrame:
    """(status, n) over all events."""
    return factors.groupBy("status").agg(F.count("*").alias("n"))


def adjust(bars: DataFrame, events: DataFrame, split_adjusted: bool = True) -> DataFrame:
    """``bars`` with adj_close: the close times the factors of all later events.

    A fund without events keeps its close exactly: its sum of logarithms is 0.0.
    """
    by_bar = event_factors(bars, events, split_adjusted).where("status = 'applied'").groupBy("isin", F.col("at").alias("date")).agg(F.sum(F.log("factor")).alias("log_"))
    later = Window.partitionBy("isin").orderBy("date").rowsBetween(0, Window.unboundedFollowing)
    columns = [c for c in bars.columns if c != "adj_close"]
    joined = bars.join(by_bar, ["isin", "date"], "left")
    total = F.sum(F.coalesce("log_", F.lit(0.0))).over(later)
    return joined.select(*columns, (F.col("close").cast("double") * F.exp(total)).alias("adj_close"))
