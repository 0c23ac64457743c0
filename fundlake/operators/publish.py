"""Published tables: the wide screener table, the weekly index, and the gate before release."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlake.operators import adjust
from fundlake.operators.asof import daily_validity
from fundlake.schema import FORBIDDEN, conform, publishable

BASE, MAX_AGE, MIN_FUNDS = 100.0, 10, 5000


def primary_listing(listings: DataFrame) -> DataFrame:
    """isin, primary_ticker, primary_mic, primary_exchange, primary_currency, n_listings, all_tickers: one aggregate."""
    order = F.struct((~F.coalesce("is_primary", F.lit(False))).cast("int").alias("a"), F.col("exchange_mic").isNull().alias("b"), F.col("exchange_mic").alias("c"))
    best = F.min_by(F.struct("ticker", "exchange_mic", "exchange_name", "trading_currency"), order)
    one = listings.groupBy("isin").agg(best.alias("best"), F.count("*").cast("short").alias("n_listings"), F.array_join(F.array_sort(F.collect_set("ticker")), " ").alias("all_tickers"))
    return one.select("isin", F.col("best.ticker").alias("primary_ticker"), F.col("best.exchange_mic").alias("primary_mic"), F.col("best.exchange_name").alias("primary_exchange"), F.col("best.trading_currency").alias("primary_currency"), "n_listings", "all_tickers")


def screener(funds: DataFrame, listings: DataFrame, performance: DataFrame, coverage: DataFrame) -> DataFrame:
    """funds with primary listing, performance and index coverage; unmatched sides null."""
    words = [F.col(c) for c in ("name", "isin", "issuer", "brand", "index_name", "index_provider", "all_tickers") if c in funds.columns or c == "all_tickers"]
    wide = funds.join(primary_listing(listings), "isin", "left").join(performance, "isin", "left").join(coverage, "isin", "left")
    return wide.withColumns({"n_listings": F.coalesce("n_listings", F.lit(0)).cast("short"), "has_index": F.col("index_points").isNotNull(), "search_blob": F.lower(F.concat_ws(" ", *words))}).drop("all_tickers")


def weekly_index(bars: DataFrame, rates: DataFrame, max_age: int = MAX_AGE) -> DataFrame:
    """isin, date, tr_index: each ISO week's last adjusted close in euros, 100 at the fund's first; stale rates drop the week."""
    fine = bars.where("adj_close IS NOT NULL AND adj_close > 0").select("isin", "date", "adj_close", F.coalesce("currency", F.lit("EUR")).alias("currency"))
    last = fine.groupBy("isin", F.trunc("date", "week").alias("week")).agg(F.max_by(F.struct("date", "adj_close", "currency"), "date").alias("r")).select("isin", "r.*")
    valid = daily_validity(rates.where("rate_to_eur > 0").select("currency", "date", "rate_to_eur"), "currency", "rate_to_eur", max_age)
    eur = last.join(valid, ["currency", "date"], "left").where("currency = 'EUR' OR rate_to_eur IS NOT NULL")
    eur = eur.select("isin", "date", F.when(F.col("currency") == "EUR", F.col("adj_close")).otherwise(F.col("adj_close") / F.col("rate_to_eur")).alias("eur"))
    first = F.first("eur").over(Window.partitionBy("isin").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    return eur.select("isin", "date", (BASE * F.col("eur") / first).alias("tr_index"))


def coverage(index: DataFrame) -> DataFrame:
    return index.groupBy("isin").agg(F.count("*").cast("int").alias("index_points"), F.min("date").alias("index_start"))


def gate(spark: SparkSession, tables: dict[str, DataFrame], as_of=None, synthetic: bool = False, min_funds: int = MIN_FUNDS) -> DataFrame:
    """(table, problem): what stands against release; no rows if nothing does.  Rows are counted by aggregates, columns by schema."""
    known = [(name, "is missing") for name in ("funds", "listings") if name not in tables]
    known += [(name, "has raw price columns: " + ", ".join(leaked)) for name, df in sorted(tables.items()) if (leaked := sorted(set(FORBIDDEN) & {c.lower() for c in df.columns}))]
    known += [("", "the data are synthetic")] * synthetic + [("", "no as_of date")] * (not as_of)
    out = spark.createDataFrame(known, "table string, problem string")
    for name, df in sorted(tables.items()):
        n = df.agg(F.count("*").alias("n"))
        few = (F.col("n") < min_funds) if name == "funds" else F.lit(False)
        problem = F.when(F.col("n") == 0, "has no rows").when(few, f"has under {min_funds} rows")
        out = out.unionByName(n.select(F.lit(name).alias("table"), problem.alias("problem")).where("problem IS NOT NULL"))
    return out


def check(spark: SparkSession, tables: dict[str, DataFrame], **more) -> None:
    """An error that names everything that stands against release."""
    found = gate(spark, tables, **more).collect()  # a few rows for each table
    if found:
        raise ValueError("; ".join(f"{r.table} {r.problem}".strip() for r in found))


def write(df: DataFrame, path: str, *order: str, row_group: int = 8 << 20) -> None:
    """Range-partitioned and sorted Parquet, so that a fund's rows lie together."""
    out = publishable(df)
    if order:
        out = out.repartitionByRange(*order).sortWithinPartitions(*order)
    out.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", row_group).parquet(path)


#: Tables that are published as they are, and their order.
PUBLISHED = {"funds": ("isin",), "listings": ("isin", "exchange_mic"), "performance": ("isin",), "returns_yearly": ("isin", "year"), "returns_monthly": ("isin", "year", "month"), "broker_availability": ("broker", "isin")}


def export(spark: SparkSession, tables: dict[str, DataFrame], root: str, as_of: str, index: DataFrame | None = None, synthetic: bool = False) -> dict:
    """Writes the declared tables and the index under ``root`` and the manifest beside them; gives the manifest.

    Without an ``index`` the one written before is kept, and its count in the manifest.
    """
    path = f"{root}/manifest.json"
    before = read_json(spark, path) or {}
    counts = {}
    for name, order in PUBLISHED.items():
        if name in tables:
            write(conform(tables[name], name), f"{root}/{name}", *order)
            counts[name] = spark.read.parquet(f"{root}/{name}").count()
    if index is not None:
        write(index, f"{root}/tr_index", "isin", "date", row_group=1 << 20)
        made = spark.read.parquet(f"{root}/tr_index").agg(F.count("*").alias("n"), F.countDistinct("isin").alias("funds")).first()
        told = {"rows": made.n, "funds": made.funds}
    else:
        told = before.get("index")
    manifest = {"as_of": as_of, "synthetic": synthetic, "tables": counts, "index": told}
    write_json(spark, manifest, path)
    return manifest


def write_provenance(provenance_: DataFrame, sources: DataFrame, root: str) -> None:
    """The provenance as Parquet, and a report of sources (a row each) and of fields won as JSON."""
    spark = provenance_.sparkSession
    provenance_.repartitionByRange("isin").sortWithinPartitions("isin", "field").write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/provenance")
    won = spark.read.parquet(f"{root}/provenance").groupBy("source").pivot("field").count().na.fill(0)
    rows = lambda df: [r.asDict() for r in df.orderBy("source").collect()]  # noqa: E731 - as many as there are sources
    write_json(spark, {"sources": rows(sources), "fields_won": rows(won)}, f"{root}/provenance.json")


def write_json(spark: SparkSession, what: dict, path: str) -> None:
    """A small document, on any file system that Spark writes; in place of the one there."""
    import json

    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(json.dumps(what, indent=1, default=str, sort_keys=True).encode())
    out.close()


def read_json(spark: SparkSession, path: str) -> dict | None:
    import json

    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first().value)


def single_file(bars: DataFrame, path: str, actions: DataFrame | None = None, total_return: bool = True) -> None:
    """All bars in one Parquet file, adjusted for ``actions``; without them only if total returns are not asked for."""
    if total_return and actions is None:
        raise ValueError("total returns need corporate actions")
    rows = adjust.adjust(bars, actions) if total_return else bars
    rows.repartitionByRange("isin", "date").sortWithinPartitions("isin", "date").coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(path)
