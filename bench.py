"""Runs the headline queries and prints one JSON line of their seconds."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

HEADLINE = ("performance_panel", "trailing_returns", "volatility", "drawdown", "beta_corr", "monthly_returns", "fx_asof_convert", "total_return_adjust", "weekly_index", "trust_fold", "primary_listing", "symbol_candidates", "screener_table", "screen_topk", "facets", "isin_check", "price_upsert", "store_manifest", "pea_verdict")


def panel_bars(spark: SparkSession, funds: int, days: int):
    """A made-up panel of ``funds`` x ``days`` bars, as the published throughput figure uses."""
    step = F.randn(7) * 0.01
    return spark.range(funds * days).select((F.col("id") % funds).cast("string").alias("isin"), F.date_add(F.lit("2010-01-01").cast("date"), (F.col("id") / funds).cast("int")).alias("date"), F.exp(step).alias("close"), F.exp(step).alias("adj_close"), F.lit("EUR").alias("currency"))


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from fundlake.operators import stats
    from fundlake.plans.driver import QUERIES

    run = lambda df: df.write.format("noop").mode("overwrite").save()
    run(QUERIES["performance_panel"](spark, sf))  # warm
    took = {}
    for name in HEADLINE:
        began = time.time()
        run(QUERIES[name](spark, sf))
        took[name] = round(time.time() - began, 3)
    funds, days = 1000, 1250
    began = time.time()
    run(stats.performance(stats.clean(panel_bars(spark, funds, days))))
    took["panel_1.25m_bars"] = round(time.time() - began, 3)
    funds, days = 13_000, 3780  # the published panel: 15 years of 13 000 funds
    began = time.time()
    run(stats.performance(stats.clean(panel_bars(spark, funds, days))))
    whole = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf, "panel_49.1m_bars": whole, "bars_per_sec": round(funds * days / whole)}))
    spark.stop()


if __name__ == "__main__":
    main()
