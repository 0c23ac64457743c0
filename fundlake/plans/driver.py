"""The engine's queries over the driver's tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.functions import identifiers, money, names
from fundlake.operators import adjust, eligibility, fold, fx, publish, rows, serve, stats
from fundlake.plans import panel as p
from fundlake.sources import store

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int = 8) -> DataFrame:
    """Doubles to ``digits`` places, as sums and logarithms differ in the last bits between engines."""
    return df.select(*(F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))


def _performance(spark: SparkSession, d: str, min_shared: int = 60) -> DataFrame:
    panel = p.panel(spark, d)
    return stats.performance(panel, p.benchmark(panel), min_shared=min_shared)


@query
def performance_panel(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_performance(spark, d))


@query
def bars_clean(spark: SparkSession, d: str) -> DataFrame:
    return rounded(p.panel(spark, d).select("isin", "date", "close", "currency"))


@query
def trailing_returns(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.performance(p.panel(spark, d)).select("isin", *(f"ret_{w}" for w in ("1d", "1w", "1m", "3m", "6m", "ytd", "1y", "3y", "5y", "10y", "max"))))


@query
def cagr(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.performance(p.panel(spark, d)).select("isin", "cagr_3y", "cagr_5y", "cagr_10y", "cagr_inception"))


@query
def volatility(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.performance(p.panel(spark, d)).select("isin", "vol_1y", "vol_3y", "vol_5y"))


@query
def sharpe_sortino(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.performance(p.panel(spark, d)).select("isin", "sharpe_1y", "sharpe_3y", "sharpe_5y", "sortino_3y"))


@query
def drawdown(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.performance(p.panel(spark, d)).select("isin", "max_drawdown_1y", "max_drawdown_3y", "max_drawdown_5y", "max_drawdown_max", "current_drawdown"))


@query
def full_history_shape(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.performance(p.panel(spark, d)).select("isin", "history_days", "history_start", "price_date", "price_last", "ath", "ath_date", "distance_from_ath", "base_currency"))


@query
def beta_corr(spark: SparkSession, d: str) -> DataFrame:
    panel = p.panel(spark, d)
    return rounded(stats.beta_and_correlation(panel, p.benchmark(panel), 60))


@query
def beta_corr_shipped(spark: SparkSession, d: str) -> DataFrame:
    panel = p.panel(spark, d)
    return rounded(stats.beta_and_correlation(panel, p.benchmark(panel)))


@query
def thin_gate_shipped(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.thin_gate(stats.performance(p.panel(spark, d)).select("isin", "history_days", "price_date", "ret_1y", "vol_1y")))


@query
def thin_gate(spark: SparkSession, d: str) -> DataFrame:
    made = stats.performance(p.panel(spark, d)).select("isin", "history_days", "price_date", "ret_1y", "vol_1y")
    return rounded(stats.thin_gate(made, least=550))


@query
def monthly_returns(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.monthly_returns(p.panel(spark, d)))


@query
def yearly_returns(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.yearly_returns(p.panel(spark, d)))


@query
def monthly_distribution(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.monthly_distribution(stats.period_returns(p.panel(spark, d), "month")))


@query
def monthly_grid(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.month_grid(stats.monthly_returns(p.panel(spark, d))))


@query
def fx_melt(spark: SparkSession, d: str) -> DataFrame:
    wide = p.rates(spark, d).groupBy("date").pivot("currency", list(p.CURRENCIES[1:])).agg(F.max("rate_to_eur"))
    return rounded(fx.tidy(wide), 12)


@query
def fx_problems(spark: SparkSession, d: str) -> DataFrame:
    return fx.problems(p.rates(spark, d))


@query
def fx_asof_convert(spark: SparkSession, d: str) -> DataFrame:
    made = fx.to_eur(p.bars(spark, d).select("isin", "date", "close", "currency"), p.rates(spark, d), horizon="2002-01-01")
    return made.select("isin", "date", "currency", F.when(F.col("rate_to_eur") == 1, F.round("close", 7)).otherwise(F.round("close", 5)).alias("close"), F.round("rate_to_eur", 12).alias("rate_to_eur"))


@query
def fx_coverage(spark: SparkSession, d: str) -> DataFrame:
    asked = spark.createDataFrame([(c,) for c in ("EUR", "usd", "GBp", "GBP", "GBX", "JPY", "SEK")], "quoted_as string")
    return fx.coverage(asked, p.rates(spark, d))


@query
def fx_missing_rates(spark: SparkSession, d: str) -> DataFrame:
    made = fx.to_eur(p.bars(spark, d).select("isin", "date", "close", "currency"), p.rates(spark, d), horizon="2002-01-01")
    return made.groupBy("isin").agg(F.count_if(F.col("rate_to_eur").isNull()).alias("rows_without_rate"))


@query
def dividends_in_eur(spark: SparkSession, d: str) -> DataFrame:
    home = p.bars(spark, d).groupBy("isin").agg(F.max_by("currency", "date").alias("currency"))
    events = p.actions(spark, d).join(home, "isin")
    paid = fx.to_eur(events.where("kind = 'dividend'").select("isin", "date", "kind", "amount", "currency"), p.rates(spark, d), ("amount",), horizon="2002-01-01")
    return rounded(paid.select("isin", "date", "kind", "amount", "currency"))


@query
def total_return_adjust(spark: SparkSession, d: str) -> DataFrame:
    bars = p.bars(spark, d).select("isin", "date", "close")
    return rounded(adjust.adjust(bars, p.actions(spark, d)).select("isin", "date", (F.col("adj_close") / F.col("close")).alias("adj_factor")))


@query
def adjust_report(spark: SparkSession, d: str) -> DataFrame:
    return adjust.report(adjust.event_factors(p.bars(spark, d), p.actions(spark, d)))


@query
def split_factors(spark: SparkSession, d: str) -> DataFrame:
    made = adjust.event_factors(p.bars(spark, d), p.actions(spark, d), split_adjusted=False)
    return rounded(made.where("kind = 'split' AND status = 'applied'").select("isin", "date", F.col("at").alias("placed_at"), "factor"))


@query
def weekly_index(spark: SparkSession, d: str) -> DataFrame:
    return rounded(publish.weekly_index(p.bars(spark, d), p.rates(spark, d)), 4)


@query
def index_coverage(spark: SparkSession, d: str) -> DataFrame:
    return publish.coverage(publish.weekly_index(p.bars(spark, d), p.rates(spark, d)))


@query
def trust_fold(spark: SparkSession, d: str) -> DataFrame:
    made = fold.trust_fold(p.sources(spark, d), "isin", ["name", "aum_eur", "segment"])
    return made.withColumn("data_sources", F.array_join("data_sources", ","))


@query
def provenance(spark: SparkSession, d: str) -> DataFrame:
    return fold.provenance(p.sources(spark, d), "isin", ["name", "aum_eur", "segment"])


@query
def contested_fields(spark: SparkSession, d: str) -> DataFrame:
    made = fold.provenance(p.sources(spark, d), "isin", ["name", "aum_eur", "segment"])
    return made.where("contenders > 1").groupBy("field", "source").agg(F.count("*").alias("won"))


@query
def aum_bound(spark: SparkSession, d: str) -> DataFrame:
    stacked = p.sources(spark, d)
    made = fold.trust_fold(stacked, "isin", ["name", "aum_eur"])
    return fold.bound_aum(made, fold.provenance(stacked, "isin", ["name", "aum_eur"])).select("isin", "name", "aum_eur")


@query
def primary_listing(spark: SparkSession, d: str) -> DataFrame:
    return publish.primary_listing(p.listings(spark, d))


@query
def primary_flags(spark: SparkSession, d: str) -> DataFrame:
    return fold.primary_flags(p.listings(spark, d).drop("is_primary")).select("isin", "exchange_mic", "is_primary")


@query
def symbol_candidates(spark: SparkSession, d: str) -> DataFrame:
    return fold.symbol_candidates(p.listings(spark, d))


@query
def mic_rewrites(spark: SparkSession, d: str) -> DataFrame:
    segment = p.pick(("ETFP", "XETA", "XPAR", " fraa ", "XMSM"), F.col("isin").cast("int") % 5)
    made = p.listings(spark, d).withColumn("exchange_mic", segment)
    return fold.rewrites(made)


@query
def screener_table(spark: SparkSession, d: str) -> DataFrame:
    bars = p.bars(spark, d)
    made = publish.screener(p.funds(spark, d).drop("search_blob"), p.listings(spark, d), stats.performance(p.panel(spark, d)).select("isin", "ret_1y", "vol_1y"), publish.coverage(publish.weekly_index(bars, p.rates(spark, d))))
    return rounded(made)


@query
def screen_topk(spark: SparkSession, d: str) -> DataFrame:
    where = serve.predicate("building", tri={"pea_eligible": "yes"}, ranges={"aum_eur": (100.0, 9000.0)})
    return serve.screen(p.funds(spark, d), where, "aum_eur").select("isin", "name", "aum_eur")


@query
def screen_matches(spark: SparkSession, d: str) -> DataFrame:
    return serve.matches(p.funds(spark, d), serve.predicate(facets={"asset_class": "MACHINERY"}, tri={"cto_accessible": "unknown"}))


@query
def facets(spark: SparkSession, d: str) -> DataFrame:
    return serve.facets(p.funds(spark, d), ["asset_class", "domicile"])


@query
def compare_pivot(spark: SparkSession, d: str) -> DataFrame:
    index = publish.weekly_index(p.bars(spark, d), p.rates(spark, d))
    return rounded(serve.compare(index, ["1", "5", "10"], "1998-01-01", rebase=True), 4)


@query
def fund_detail(spark: SparkSession, d: str) -> DataFrame:
    return rounded(serve.detail(stats.monthly_returns(p.panel(spark, d)), "7", "year", "month"))


@query
def tri_state_tally(spark: SparkSession, d: str) -> DataFrame:
    return eligibility.tally(p.funds(spark, d), ["pea_eligible", "cto_accessible"])


@query
def isin_check(spark: SparkSession, d: str) -> DataFrame:
    code = identifiers.normalise(F.col("raw"))
    return p.isins(spark, d).select("raw", code.alias("isin"), identifiers.is_valid(code).alias("valid"), identifiers.country(F.col("raw")).alias("country"))


@query
def currency_units(spark: SparkSession, d: str) -> DataFrame:
    code = p.pick(("GBp", "GBX", "gbx", "ZAc", "eur ", "ILA", "usd", ""), F.col("o_orderkey") % 8)
    return p.table(spark, d, "orders").select("o_orderkey", code.alias("quoted")).select("o_orderkey", "quoted", money.iso(F.col("quoted")).alias("currency"), money.unit(F.col("quoted")).alias("unit"))


@query
def clean_name(spark: SparkSession, d: str) -> DataFrame:
    tail = p.pick((" ETF ETF", "  ETFS", " UCITS ETF o.N.", " ETC", "", " ETN etp "), F.col("p_partkey") % 6)
    return p.table(spark, d, "part").select("p_partkey", F.concat(F.lit(" "), F.col("p_name"), tail).alias("raw")).select("p_partkey", names.clean(F.col("raw")).alias("name"))


def _named(spark: SparkSession, d: str) -> DataFrame:
    words = ("Gold Miners", "Euro Govt Bond 1-3", "MSCI World 2x", "Bitcoin", "Real Estate", "Money Market", "S&P 500 Equal Weight", "Covered Call", "Ultra Short", "Credit Suisse", "Monétaire", "Crude Oil", "plain")
    return p.table(spark, d, "part").select("p_partkey", F.concat_ws(" ", p.pick(words, F.col("p_partkey") % 13), "p_name").alias("name"))


@query
def classify_name(spark: SparkSession, d: str) -> DataFrame:
    asset, strategy = names.classify(F.col("name"))
    return _named(spark, d).select("p_partkey", "name", asset.alias("asset_class"), strategy.alias("strategy"))


@query
def category_map(spark: SparkSession, d: str) -> DataFrame:
    words = ("US Large Blend", "Equity Precious Metals", "Leveraged Commodities", "High Yield Bond", "", "Japan Stock", "zzz")
    asset, strategy = names.map_category(F.col("category"))
    return p.table(spark, d, "part").select("p_partkey", p.pick(words, F.col("p_partkey") % 7).alias("category")).select("p_partkey", "category", asset.alias("asset_class"), strategy.alias("strategy"))


@query
def fill_from_name(spark: SparkSession, d: str) -> DataFrame:
    rows_ = _named(spark, d).select(F.col("p_partkey").cast("string").alias("isin"), "name", F.when(F.col("p_partkey") % 3 == 0, "unknown").when(F.col("p_partkey") % 3 == 1, "equity").alias("asset_class"), F.lit(None).cast("string").alias("strategy"), F.array(F.lit("xetra")).alias("data_sources"))
    return names.fill_from_name(rows_).withColumn("data_sources", F.array_join("data_sources", ","))


@query
def orphan_anti(spark: SparkSession, d: str) -> DataFrame:
    few = p.table(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").cast("string").alias("isin"))
    return fold.orphans(p.listings(spark, d), few).select("isin", "exchange_mic")


@query
def tradable_semi(spark: SparkSession, d: str) -> DataFrame:
    return fold.tradable(p.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("isin"), "p_brand"), p.listings(spark, d))


@query
def claim_uniqueness(spark: SparkSession, d: str) -> DataFrame:
    claims = p.table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderkey").cast("string").alias("isin"))
    return fold.unique_claims(claims, "ticker", "isin")


def _two_deliveries(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    bars = p.bars(spark, d).select("isin", "date", "close", "currency")
    return bars.where("date < date'1999-01-10'"), bars.where("date >= date'1999-01-05'").withColumn("close", F.col("close") * 2)


@query
def price_upsert(spark: SparkSession, d: str) -> DataFrame:
    return rounded(store.merge(*_two_deliveries(spark, d)))


@query
def store_manifest(spark: SparkSession, d: str) -> DataFrame:
    known = p.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("isin"), F.col("s_name").alias("ticker"))
    return store.manifest(p.bars(spark, d), known, known.where("isin = '1'").select("isin", F.lit("NEW").alias("ticker")))


@query
def refresh_requests(spark: SparkSession, d: str) -> DataFrame:
    old, _ = _two_deliveries(spark, d)
    symbols = p.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("isin"), F.concat(F.lit("S"), (F.col("s_suppkey") % 40).cast("string")).alias("symbol"))
    return store.refresh_requests(symbols, store.manifest(old.where("isin <> '3'")), "1990-01-01")


@query
def new_splits_anti(spark: SparkSession, d: str) -> DataFrame:
    events = p.actions(spark, d)
    return store.new_splits(events, events.where("date < date'1999-01-01'"))


@query
def venue_fallback(spark: SparkSession, d: str) -> DataFrame:
    tried = fold.symbol_candidates(p.listings(spark, d))
    done = p.bars(spark, d).select("isin").distinct()
    return store.outstanding(tried, done, 1).select("isin", "rank", "yahoo_ticker")


@query
def replace_refetched(spark: SparkSession, d: str) -> DataFrame:
    old, new = _two_deliveries(spark, d)
    return rounded(store.replace_funds(old, new.where("cast(isin AS int) % 4 = 0")))


@query
def pea_verdict(spark: SparkSession, d: str) -> DataFrame:
    funds, evidence = p.evidence_tables(spark, d)
    return eligibility.verdicts(funds, evidence, "2026-08-01").select("isin", "pea_eligible", "pea_confidence", "pea_mechanism", "pea_source", "pea_as_of", "pea_reason")


@query
def cto_verdict(spark: SparkSession, d: str) -> DataFrame:
    funds, evidence = p.evidence_tables(spark, d)
    return eligibility.verdicts(funds, evidence, "2026-08-01").select("isin", "cto_accessible", "cto_reason", "has_priips_kid", "authorised_fr")


@query
def eligibility_violations(spark: SparkSession, d: str) -> DataFrame:
    funds, evidence = p.evidence_tables(spark, d)
    made = eligibility.verdicts(funds, evidence, "2026-08-01").withColumn("cto_accessible", F.when(~F.col("isin").endswith("7"), F.col("cto_accessible")))
    return eligibility.violations(made)


@query
def broker_availability(spark: SparkSession, d: str) -> DataFrame:
    funds, evidence = p.evidence_tables(spark, d)
    return eligibility.broker_availability(evidence, funds.where("name LIKE '%Certificate'"))


@query
def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    return rows.hash_sample(p.funds(spark, d), 50, ["7"]).select("isin", "name")


@query
def export_gate(spark: SparkSession, d: str) -> DataFrame:
    return publish.gate(spark, {"funds": p.funds(spark, d), "listings": p.listings(spark, d), "bad": p.bars(spark, d)}, as_of=None, min_funds=10**7)


@query
def stream_refresh(spark: SparkSession, d: str) -> DataFrame:
    """The two deliveries as a stream of files into a store, read back."""
    import uuid

    from fundlake.streaming.refresh import follow

    root = f"{store.shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    for k, delivery in enumerate(_two_deliveries(spark, d)):
        delivery.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(delivery.schema).parquet(f"{root}/in")
        follow(spark, stream, f"{root}/store", f"{root}/state", 8)
    return rounded(store.read(spark, f"{root}/store").select("isin", "date", "close", "currency"))
