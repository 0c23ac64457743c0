"""Listing sources: each parser gives (funds, listings) in the declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.functions import identifiers
from fundlake.functions.money import lookup
from fundlake.operators.fold import primary_flags
from fundlake.schema import conform
from fundlake.sources import text
from fundlake.sources.store import shared_folder

# Venues, names, countries and classes of the files.
CFI_DISTRIBUTION = {"I": "distributing", "G": "accumulating"}
CFI_ASSET = {"E": "equity", "B": "bond", "C": "commodity", "R": "real-estate"}
EURONEXT_NAMES = {"XPAR": "Euronext Paris", "XPMC": "Euronext Paris - Multi-currency Trading", "XAMS": "Euronext Amsterdam", "XAMC": "Euronext Amsterdam - Multi-currency Trading", "XBRU": "Euronext Brussels", "XLIS": "Euronext Lisbon", "XMSM": "Euronext Dublin", "XOSL": "Oslo Børs", "ETFP": "Borsa Italiana ETFplus"}
EURONEXT_COUNTRIES = {"XPAR": "FR", "XPMC": "FR", "XAMS": "NL", "XAMC": "NL", "XBRU": "BE", "XLIS": "PT", "XMSM": "IE", "XOSL": "NO", "ETFP": "IT"}
EURONEXT_PREFERENCE = ("XPAR", "XAMS", "XBRU", "XLIS", "XMSM", "ETFP", "XOSL", "XPMC", "XAMC")
ESG_CLASSES = {"ESG ETF art. 8": True, "ESG ETF art. 9": True, "-": False}
XETRA_TYPES = ("ETF", "ETC", "ETN")
XETRA_TYPE_ASSET = {"ETC": "commodity"}
XETRA_GROUP_ASSET = {"EXCHANGE TRADED FUNDS - RENTEN": "bond", "ETF RENTEN - FOREIGN CURRENCY": "bond", "EXCHANGE TRADED COMMODITIES": "commodity"}
XETRA_GROUP_STRATEGY = {"EXCHANGE TRADED FUNDS - AKTIV": "active"}
PENCE = ("GBX", "GBx", "GBp")
US_VENUES = {"A": ("XASE", "NYSE American"), "N": ("XNYS", "New York Stock Exchange"), "P": ("ARCX", "NYSE Arca"), "Q": ("XNAS", "Nasdaq"), "V": ("IEXG", "Investors Exchange"), "Z": ("BATS", "Cboe BZX")}

Frames = tuple[DataFrame, DataFrame]


def _tagged(df: DataFrame, name: str) -> DataFrame:
    return df.withColumns({"data_sources": F.array(F.lit(name)), "last_updated": F.current_date()})


def regulated_markets(spark: SparkSession, path: str) -> DataFrame:
    """(mic, venue_name, venue_country) of the register's regulated markets."""
    need = ["MIC", "MARKET NAME-INSTITUTION DESCRIPTION", "MARKET CATEGORY CODE", "ISO COUNTRY CODE (ISO 3166)"]
    rows = spark.read.option("header", True).option("multiLine", True).csv(path)
    text.require(rows.columns, need, "MIC register")
    kept = rows.where(F.trim("MARKET CATEGORY CODE") == "RMKT").select(text.blank(F.col("MIC")).alias("mic"), text.blank(F.col("MARKET NAME-INSTITUTION DESCRIPTION")).alias("venue_name"), text.blank(F.col("ISO COUNTRY CODE (ISO 3166)")).alias("venue_country"))
    return text.one_line(kept.where("mic IS NOT NULL"), ["mic"], "venue_name", "venue_country")


def firds_records(spark: SparkSession, path: str) -> DataFrame:
    """One row for each ``RefData`` element, by Spark's splittable XML reader."""
    schema = "FinInstrmGnlAttrbts struct<Id:string,FullNm:string,ShrtNm:string,ClssfctnTp:string,NtnlCcy:string>, Issr string, TradgVnRltdAttrbts struct<Id:string,FrstTradDt:string,TermntnDt:string>"
    rows = spark.read.format("xml").option("rowTag", "RefData").option("ignoreNamespace", True).schema(schema).load(path)
    g, v = "FinInstrmGnlAttrbts", "TradgVnRltdAttrbts"
    return rows.select(*(text.blank(F.col(c)).alias(a) for c, a in ((f"{g}.Id", "isin"), (f"{g}.FullNm", "name"), (f"{g}.ShrtNm", "short_name"), (f"{g}.ClssfctnTp", "cfi"), (f"{g}.NtnlCcy", "currency"), ("Issr", "issuer_lei"), (f"{v}.Id", "mic"), (f"{v}.FrstTradDt", "first_trade_date"), (f"{v}.TermntnDt", "termination_date"))))


def firds(records: DataFrame, markets: DataFrame, preference=EURONEXT_PREFERENCE) -> Frames:
    """Exchange-traded funds (CFI CE) and their regulated lines; fields by the first venue that states them."""
    etfs, _ = text.split_valid(records.where(F.col("cfi").startswith("CE") & F.col("isin").isNotNull()), "isin")
    etfs = text.one_line(etfs, ["isin", "mic"], "name", "termination_date")
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("mic"))).alias(c)
    one = etfs.groupBy("isin").agg(first("name"), first("short_name"), first("cfi"))
    funds = one.select("isin", "name", "short_name", identifiers.country(F.col("isin")).alias("domicile"), F.coalesce(lookup(CFI_DISTRIBUTION, F.substring("cfi", 4, 1)), F.lit("unknown")).alias("distribution_policy"), F.coalesce(lookup(CFI_ASSET, F.substring("cfi", 5, 1)), F.lit("unknown")).alias("asset_class"))
    lines = etfs.join(markets, "mic").select("isin", F.col("mic").alias("exchange_mic"), F.col("venue_name").alias("exchange_name"), "venue_country", F.col("currency").alias("trading_currency"))
    return conform(_tagged(funds, "firds"), "funds"), conform(primary_flags(lines, preference), "listings")


def issuer_leis(records: DataFrame) -> DataFrame:
    """(isin, lei): a second projection of the scan."""
    return records.where("isin IS NOT NULL AND issuer_lei IS NOT NULL").groupBy("isin").agg(F.min_by("issuer_lei", "mic").alias("lei"))


def euronext(rows: DataFrame, markets: dict[str, list[str]]) -> Frames:
    """``rows`` of the product file; ``markets``: the codes of each market text, several for a joint line."""
    known, _ = text.split_valid(rows, "ISIN")
    codes = F.lit(None).cast("array<string>")
    for market, mics in markets.items():
        codes = F.when(F.col("Market") == market, F.array(*map(F.lit, mics))).otherwise(codes)
    known = known.withColumn("mics", codes).where("mics IS NOT NULL")
    one = text.one_line(known, ["ISIN"], "Market", "seq")
    esg = lookup(ESG_CLASSES, F.col("ESG Classification")) if "ESG Classification" in rows.columns else F.lit(None)
    funds = one.select(F.col("ISIN").alias("isin"), F.col("Instrument Fullname").alias("name"), F.col("Name").alias("short_name"), esg.alias("esg"))
    lines = known.select(F.col("ISIN").alias("isin"), F.explode("mics").alias("exchange_mic"), F.col("Symbol").alias("ticker"), F.col("Currency").alias("trading_currency"), "seq")
    lines = text.one_line(lines, ["isin", "exchange_mic"], F.col("ticker").asc_nulls_last(), "seq")
    lines = lines.withColumns({"exchange_name": lookup(EURONEXT_NAMES, F.col("exchange_mic")), "venue_country": lookup(EURONEXT_COUNTRIES, F.col("exchange_mic"))})
    return conform(_tagged(funds, "euronext"), "funds"), conform(primary_flags(lines, EURONEXT_PREFERENCE), "listings")


def xetra(rows: DataFrame) -> Frames:
    """Exchange-traded products; the venue itself says which line is primary."""
    known, _ = text.split_valid(rows.where(F.col("Instrument Type").isin(*XETRA_TYPES)), "ISIN")
    one = text.one_line(known, ["ISIN"], F.col("Mnemonic").asc_nulls_last(), "seq")
    group = F.col("Product Assignment Group Description")
    asset = F.coalesce(lookup(XETRA_TYPE_ASSET, F.col("Instrument Type")), lookup(XETRA_GROUP_ASSET, group), F.lit("unknown"))
    funds = one.select(F.col("ISIN").alias("isin"), F.col("Instrument").alias("short_name"), asset.alias("asset_class"), F.coalesce(lookup(XETRA_GROUP_STRATEGY, group), F.lit("unknown")).alias("strategy"))
    lines = one.select(F.col("ISIN").alias("isin"), F.col("MIC Code").alias("exchange_mic"), F.lit("Xetra").alias("exchange_name"), F.col("Mnemonic").alias("ticker"), F.col("Currency").alias("trading_currency"), F.coalesce(F.col("Primary Market MIC Code") == "XETR", F.lit(False)).alias("is_primary"))
    return conform(_tagged(funds, "xetra"), "funds"), conform(lines, "listings")


def lse_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every object with an isin and a tidm, at whatever depth of the page document."""
    fields = ("isin", "tidm", "name", "issuername", "currency", "category")
    pages = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    shared_folder(spark)
    found, level = None, pages
    while True:  # a level of the document at a time, as many as it has
        has = lambda f: F.try_variant_get("v", f"$.{f}", "string")
        hit = level.select(*(has(f).alias(f) for f in fields)).where("isin IS NOT NULL AND tidm IS NOT NULL")
        found = hit if found is None else found.unionByName(hit)
        inner = level.where(has("tidm").isNull() | has("isin").isNull())
        inner = inner.lateralJoin(spark.tvf.variant_explode_outer(F.col("v").outer()).select(F.col("value").alias("w"))).where("w IS NOT NULL")
        level = inner.select(F.col("w").alias("v")).checkpoint()
        if level.isEmpty():
            return found


def lse(rows: DataFrame) -> Frames:
    """The pence line of a fund, else the one of lowest symbol."""
    known, _ = text.split_valid(rows, "isin")
    one = text.one_line(known, ["isin"], (~F.coalesce(F.col("currency").isin(*PENCE), F.lit(False))).cast("int"), F.col("tidm").asc_nulls_last(), "currency")
    funds = one.select("isin", "name", F.col("issuername").alias("issuer"))
    lines = one.select("isin", F.lit("XLON").alias("exchange_mic"), F.lit("London Stock Exchange").alias("exchange_name"), F.col("tidm").alias("ticker"), F.col("currency").alias("trading_currency"), F.lit(True).alias("is_primary"))
    return conform(_tagged(funds, "lse"), "funds"), conform(lines, "listings")


def six(rows: DataFrame) -> Frames:
    """The line in the fund's own currency, else the one of lowest symbol; fees as fractions."""
    known, _ = text.split_valid(rows, "ISIN")
    own = F.coalesce(F.col("TradingCurrency") == F.col("FundCurrency"), F.lit(False)) if "FundCurrency" in rows.columns else F.lit(False)
    one = text.one_line(known, ["ISIN", "MarketCode"], (~own).cast("int"), F.col("ValorSymbol").asc_nulls_last())
    opt = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    fund = text.one_line(one, ["ISIN"], "MarketCode")
    funds = fund.select(F.col("ISIN").alias("isin"), opt("FundLongName").alias("name"), opt("ShortName").alias("short_name"), opt("IssuerNameFull").alias("issuer"), opt("FundCurrency").alias("fund_currency"), (opt("ManagementFee").try_cast("double") / 100).alias("ter"))
    lines = one.select(F.col("ISIN").alias("isin"), F.col("MarketCode").alias("exchange_mic"), F.lit("SIX Swiss Exchange").alias("exchange_name"), F.col("ValorSymbol").alias("ticker"), F.col("TradingCurrency").alias("trading_currency"), F.lit("CH").alias("venue_country"))
    return conform(_tagged(funds, "six"), "funds"), conform(primary_flags(lines, ("XSWX",)), "listings")


def us_directory(spark: SparkSession, path: str) -> DataFrame:
    """The pipe file's rows of as many fields as its header; the trailer and torn lines are dropped, never shifted."""
    rows = text.lines(spark, path)
    head = rows.where(F.trim("line") != "").orderBy("n").select("line").first()
    names = [c.strip() for c in head.line.split("|")] if head else []
    if len(names) != 12 or names[5] != "ETF":
        raise ValueError(f"unexpected header: {names}")
    body = rows.where((F.col("n") > 0) & ~F.col("line").startswith("File Creation Time")).withColumn("f", F.split("line", r"\|")).where(F.size("f") == len(names))
    return body.select(F.col("n").alias("seq"), *(F.trim(F.col("f")[i]).alias(c) for i, c in enumerate(names)))


def us(rows: DataFrame, isin_by_ticker: DataFrame) -> Frames:
    """Flagged funds on known venues; without a sure ISIN the key is US:venue:ticker.  ``isin_by_ticker``: (ticker, isin)."""
    kept = rows.where((F.col("ETF") == "Y") & (F.col("Test Issue") != "Y") & F.col("Listing Exchange").isin(*US_VENUES))
    kept = kept.withColumns({"exchange_mic": lookup({k: m for k, (m, _) in US_VENUES.items()}, F.col("Listing Exchange")), "exchange_name": lookup({k: n for k, (_, n) in US_VENUES.items()}, F.col("Listing Exchange")), "ticker": F.upper(F.trim("Symbol"))})
    sure = isin_by_ticker.where(identifiers.is_valid(F.col("isin")) & F.col("isin").startswith("US")).select(F.upper(F.trim("ticker")).alias("ticker"), "isin").distinct()
    alone = sure.groupBy("isin").agg(F.count("*").alias("n"), F.first("ticker").alias("ticker")).where("n = 1").select("ticker", "isin")
    one = kept.join(alone, "ticker", "left").withColumn("isin", F.coalesce("isin", identifiers.surrogate_key(F.col("exchange_mic"), F.col("ticker"))))
    one = text.one_line(one, ["isin"], "seq")
    funds = one.select("isin", F.trim("Security Name").alias("name"), F.lit("US").alias("domicile"), F.lit(False).alias("ucits"), F.lit("USD").alias("fund_currency"))
    lines = one.select("isin", "exchange_mic", "exchange_name", "ticker", F.replace("ticker", F.lit("."), F.lit("-")).alias("yahoo_ticker"), F.lit("USD").alias("trading_currency"), F.lit(True).alias("is_primary"))
    return conform(_tagged(funds, "nasdaqtrader"), "funds"), conform(lines, "listings")


def manager_names(isin_lei: DataFrame, relations: DataFrame, entities: DataFrame) -> DataFrame:
    """(isin, issuer) over three hops: fund, its active manager, the manager's legal name; the first relation counts."""
    managed = relations.where("relation = 'IS_FUND-MANAGED_BY' AND status = 'ACTIVE'")
    managed = text.one_line(managed, ["fund_lei"], "manager_lei")
    return isin_lei.join(managed, isin_lei["lei"] == managed["fund_lei"]).join(entities.select(F.col("lei").alias("manager_lei"), F.col("legal_name").alias("issuer")), "manager_lei").select("isin", "issuer")


def mapped_listings(mapped: DataFrame, mic_by_code: dict[str, str]) -> DataFrame:
    """(isin, exchange_mic, ticker) of identifier-mapping answers (isin, records array<struct<exchCode,ticker>>): the first of each venue."""
    rows = mapped.select("isin", F.posexplode("records").alias("at", "r")).select("isin", "at", lookup(mic_by_code, F.col("r.exchCode")).alias("exchange_mic"), F.col("r.ticker").alias("ticker")).where("exchange_mic IS NOT NULL")
    return text.one_line(rows, ["isin", "exchange_mic"], "at").drop("at")


def resolve_quotes(quotes: DataFrame, symbols: DataFrame, listings: DataFrame) -> DataFrame:
    """``quotes`` (symbol, root, mic, …) with isin: by a symbol that one fund alone has, else by (ticker, venue)."""
    sole = symbols.groupBy("yahoo_ticker").agg(F.countDistinct("isin").alias("n"), F.min("isin").alias("by_symbol")).where("n = 1").select(F.col("yahoo_ticker").alias("symbol"), "by_symbol")
    pair = listings.where("ticker IS NOT NULL").groupBy(F.upper("ticker").alias("root"), F.col("exchange_mic").alias("mic")).agg(F.min("isin").alias("by_pair"))
    return quotes.join(sole, "symbol", "left").join(pair, ["root", "mic"], "left").withColumn("isin", F.coalesce("by_symbol", "by_pair")).drop("by_symbol", "by_pair")


def fee(raw: Column) -> Column:
    """A fee in percent as a fraction; null unless between 0 and 25."""
    x = raw.try_cast("double")
    return F.when((x > 0) & (x < 25), x / 100)
