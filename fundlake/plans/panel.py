"""The driver's tables read as the engine's: bars, actions, rates, listings, funds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.operators import stats
from fundlake.operators.rows import keep_last

CURRENCIES = ("EUR", "USD", "GBP", "CHF", "JPY")
ARRIVAL = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values, at):
    return F.element_at(F.array(*map(F.lit, values)), (at + 1).cast("int"))


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a bar of its supplier, with the columns that tell its arrival."""
    line = table(spark, sf_dir, "lineitem")
    home = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), pick(CURRENCIES, F.col("s_nationkey") % 5).alias("currency"))
    rows = line.join(home, "l_suppkey")
    return rows.select(F.col("l_suppkey").cast("string").alias("isin"), F.col("l_shipdate").cast("date").alias("date"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("close"), F.col("l_quantity").alias("volume"), "currency", *ARRIVAL, "l_returnflag", "l_linestatus", "l_tax")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """isin, date, close, adj_close, volume, currency: of a fund's day the last to arrive."""
    rows = keep_last(raw_bars(spark, sf_dir).select("isin", "date", "close", "volume", "currency", *ARRIVAL), ["isin", "date"], ARRIVAL)
    return rows.select("isin", "date", "close", F.col("close").alias("adj_close"), "volume", "currency")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_bars(spark, sf_dir).withColumn("adj_close", F.col("close"))
    return stats.clean(rows.select("isin", "date", "close", "adj_close", "currency", *ARRIVAL), order=ARRIVAL)


def benchmark(panel_: DataFrame) -> DataFrame:
    """(date, logp): the mean logarithm over funds."""
    return panel_.groupBy("date").agg(F.avg("logp").alias("logp"))


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """isin, date, kind, amount, ratio: returned lines pay dividends, single open ones split."""
    rows = raw_bars(spark, sf_dir)
    paid = rows.where("l_returnflag = 'R'").select("isin", "date", F.lit("dividend").alias("kind"), (F.col("l_tax") * 10).alias("amount"), F.lit(None).cast("double").alias("ratio"), *ARRIVAL)
    cut = rows.where("l_linestatus = 'O' AND l_quantity = 1").select("isin", "date", F.lit("split").alias("kind"), F.lit(None).cast("double").alias("amount"), F.lit(2.0).alias("ratio"), *ARRIVAL)
    return keep_last(paid.unionByName(cut), ["isin", "date", "kind"], ARRIVAL).drop(*ARRIVAL)


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, currency, rate_to_eur from the orders' mean price on a day."""
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderdate").cast("date").alias("date"), pick(CURRENCIES[1:], F.col("o_custkey") % 4).alias("currency"), "o_totalprice")
    return rows.groupBy("date", "currency").agg((F.avg("o_totalprice") / 1e5).alias("rate_to_eur"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of a part at a supplier as a listing: the venue by the supplier's nation."""
    from fundlake.operators.fold import MIC_PREFERENCE

    line = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    home = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    rows = line.join(home, "l_suppkey").select(F.col("l_partkey").cast("string").alias("isin"), pick(MIC_PREFERENCE, F.col("s_nationkey") % 23).alias("exchange_mic"), F.col("s_nationkey").alias("nation"), "l_suppkey")
    one = rows.groupBy("isin", "exchange_mic").agg(F.min("l_suppkey").alias("supplier"), F.min("nation").alias("nation"))
    return one.select("isin", "exchange_mic", F.concat(F.lit("Venue "), F.col("nation").cast("string")).alias("exchange_name"), F.when(F.col("supplier") % 3 != 0, F.concat(F.lit("T"), F.col("supplier").cast("string"), F.lit(".A"))).alias("ticker"), F.when(F.col("supplier") % 7 == 0, F.concat(F.lit("y"), F.col("supplier").cast("string"))).alias("yahoo_ticker"), pick(CURRENCIES, F.col("nation") % 5).alias("trading_currency"), (F.col("nation") == F.col("isin").cast("int") % 25).alias("is_primary"))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources that disagree about 25 keys, stacked."""
    from fundlake.operators.fold import stack

    n, s, c = (table(spark, sf_dir, t) for t in ("nation", "supplier", "customer"))
    tops = {
        "nation": (100, n.select(F.col("n_nationkey").cast("string").alias("isin"), F.when(F.col("n_nationkey") % 4 != 0, F.col("n_name")).alias("name"), F.lit(None).cast("double").alias("aum_eur"), F.lit(None).cast("string").alias("segment"), F.lit(0).cast("long").alias("seq"))),
        "supplier": (80, s.select(F.col("s_nationkey").cast("string").alias("isin"), F.col("s_name").alias("name"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("aum_eur"), F.lit(None).cast("string").alias("segment"), F.col("s_suppkey").alias("seq"))),
        "customer": (40, c.select(F.col("c_nationkey").cast("string").alias("isin"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("aum_eur"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("segment"), F.col("c_custkey").alias("seq"))),
    }
    return stack(tops)


def funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as funds, with three-valued flags."""
    c = table(spark, sf_dir, "customer")
    tri = lambda at: F.when(at > 0, True).when(at < -500, False)
    return c.select(F.col("c_custkey").cast("string").alias("isin"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("asset_class"), F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("string")).alias("domicile"), F.when(F.col("c_acctbal") > -900, F.col("c_acctbal")).alias("aum_eur"), tri(F.col("c_acctbal")).alias("pea_eligible"), tri(F.col("c_acctbal") - 2000).alias("cto_accessible"), F.lower(F.concat_ws(" ", "c_name", "c_mktsegment")).alias("search_blob"))


def isins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(raw): made-up identifiers, of which about a tenth are valid."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("us-"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), (F.col("o_custkey") % 10).cast("string")).alias("raw"))


def evidence_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(funds, evidence) with valid identifiers: each order's number with its check digit, prefixes by customer."""
    from fundlake.functions.identifiers import check_digit

    o = table(spark, sf_dir, "orders")
    prefix = pick(("IE", "FR", "US", "GB", "XS", "JE", "LU"), F.col("o_custkey") % 7)
    body = F.concat(prefix, F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    f = o.select("o_orderkey", F.concat(body, check_digit(body).cast("string")).alias("isin"), "o_custkey")
    kind = lambda n, values: pick(values, F.col("o_orderkey") % n)
    made = f.select("isin", kind(6, ("Core Equity UCITS ETF", "Physical Gold ETC", "Bond ETF", "Swap World ETF", "Short Certificate", "Dividend ETF")).alias("name"), F.when(F.col("o_orderkey") % 11 == 0, "XS").when(F.col("o_orderkey") % 5 == 0, "DE").alias("domicile"), F.when(F.col("o_orderkey") % 3 == 0, True).when(F.col("o_orderkey") % 3 == 1, False).alias("ucits"), kind(4, ("Physical", "Synthetic", "Unfunded swap", "other")).alias("replication"), F.when(F.col("o_orderkey") % 13 == 0, False).alias("authorised_fr"), F.when(F.col("o_orderkey") % 17 == 0, False).alias("kid_language_fr"))
    urls = ("https://live.euronext.com/x", "https://www.amundietf.fr/y", "https://www.boursedirect.fr/z", "https://www.fortuneo.fr/q", "https://home.saxo/w", "https://www.justetf.com/v", "https://www.someblog.org/u", "https://etf.dws.com/t")
    # every third fund is told of by nobody
    told = f.where("o_orderkey % 3 <> 0").select("isin", "o_orderkey", F.explode(F.array_distinct(F.array(F.col("o_orderkey") % 8, (F.col("o_orderkey") * 3 + 1) % 8, F.floor(F.col("o_orderkey") / 8) % 8))).alias("k"))
    from fundlake.operators import eligibility
    from fundlake.sources.evidence import by_provider

    rows = told.select("isin", F.concat(pick(urls, F.col("k")), (F.col("o_orderkey") % 4).cast("string")).alias("url"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 7 + F.col("k") % 2).cast("int")).alias("as_of"), F.col("o_orderkey").alias("seq"))
    rows = rows.withColumn("provider", eligibility.provider(F.col("url")))
    return made, by_provider(rows.withColumn("kind", eligibility.kind(F.col("provider"))))
