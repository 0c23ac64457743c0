"""One master row for each key from many disagreeing sources, field by field."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.functions.money import lookup

#: Venue segments and their operating venue.
MIC_ALIASES = {"ETFP": "XMIL", "MTAA": "XMIL", "MOTX": "XMIL", "SEDX": "XMIL", "XETA": "XETR", "XETU": "XETR", "FRAA": "XFRA", "FRAU": "XFRA", "XMSM": "XDUB"}
#: Venues in order of preference.
MIC_PREFERENCE = ("XPAR", "XAMS", "XBRU", "XLIS", "XDUB", "XETR", "XMIL", "XSWX", "XLON", "XMAD", "XWBO", "XSTO", "XCSE", "XOSL", "XFRA", "XPMC", "XAMC", "ARCX", "XNAS", "XNYS", "BATS", "XASE", "IEXG")
#: Symbol suffixes by venue; an empty one differs from none.
SUFFIXES = {"XPAR": ".PA", "XPMC": ".PA", "XAMS": ".AS", "XAMC": ".AS", "XBRU": ".BR", "XLIS": ".LS", "XDUB": ".IR", "XETR": ".DE", "XFRA": ".F", "XMIL": ".MI", "XSWX": ".SW", "XLON": ".L", "XMAD": ".MC", "XWBO": ".VI", "XSTO": ".ST", "XCSE": ".CO", "XOSL": ".OL", "XHKG": ".HK", "XTSE": ".TO", "XASX": ".AX", "XNAS": "", "XNYS": "", "ARCX": "", "XASE": "", "BATS": "", "IEXG": ""}
#: Fixed values.
AGGREGATOR_TRUST, MAX_AUM = 40, 1e12


def stack(sources: dict[str, tuple[int, DataFrame]]) -> DataFrame:
    """All sources' rows with source, trust and seq (their order within the source, where they have one)."""
    out = None
    for name, (trust, df) in sorted(sources.items()):
        rows = df.withColumns({"source": F.lit(name), "trust": F.lit(trust)})
        if "seq" not in df.columns:
            rows = rows.withColumn("seq", F.lit(0).cast("long"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def _order():
    return F.struct(-F.col("trust"), "source", "seq")


def trust_fold(rows: DataFrame, key: str, fields: list[str], latest: str | None = None) -> DataFrame:
    """For each key every field's first value by trust, source and row; nulls never block, false and 0 count.

    One aggregate for all fields, combined before the shuffle; data_sources are the contributors; of a ``latest`` column
    the greatest value counts, whoever states it.
    """
    pick = [F.min_by(f, F.when(F.col(f).isNotNull(), _order())).alias(f) for f in fields]
    pick += [F.max(latest).alias(latest)] if latest else []
    return rows.groupBy(key).agg(*pick, F.array_sort(F.collect_set("source")).alias("data_sources"))


def provenance(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, source, trust, contenders) of every field that some row has."""
    text = rows.select(key, "source", "trust", "seq", *(F.col(f).cast("string").alias(f) for f in fields))
    long = text.unpivot([key, "source", "trust", "seq"], fields, "field", "value").where("value IS NOT NULL")
    won = long.groupBy(key, "field").agg(F.min_by(F.struct("source", "trust"), _order()).alias("won"), F.count("*").alias("contenders"))
    return won.select(key, "field", "won.source", "won.trust", "contenders")


def canonical_mics(listings: DataFrame) -> DataFrame:
    """Segments as their operating venue; a rewritten row loses its venue name."""
    mic = F.upper(F.trim("exchange_mic"))
    to = F.coalesce(lookup(MIC_ALIASES, mic), mic)
    return listings.withColumn("exchange_name", F.when(to == mic, F.col("exchange_name"))).withColumn("exchange_mic", to)


def rewrites(listings: DataFrame) -> DataFrame:
    """(rewrite, n): how often each alias was applied."""
    mic = F.upper(F.trim("exchange_mic"))
    to = lookup(MIC_ALIASES, mic)
    return listings.where(to.isNotNull()).groupBy(F.concat(mic, F.lit("->"), to).alias("rewrite")).agg(F.count("*").alias("n"))


def rank_of(mic, preference=MIC_PREFERENCE):
    return F.coalesce(lookup({m: i for i, m in enumerate(preference)}, mic), F.lit(len(preference)))


def primary_flags(listings: DataFrame, preference=MIC_PREFERENCE) -> DataFrame:
    """is_primary: the fund's home-country venue first, then by preference, then by code; one for each fund."""
    home = F.coalesce(F.col("venue_country") == F.substring("isin", 1, 2), F.lit(False)) if "venue_country" in listings.columns else F.lit(False)
    w = Window.partitionBy("isin").orderBy((~home).cast("int"), rank_of(F.col("exchange_mic"), preference), "exchange_mic")
    return listings.withColumn("is_primary", F.row_number().over(w) == 1)


def symbol_candidates(listings: DataFrame) -> DataFrame:
    """isin, rank from 0, yahoo_ticker, exchange_mic, trading_currency: the distinct symbols to try, best venue first."""
    suffix = lookup(SUFFIXES, F.col("exchange_mic"))
    given = F.upper(F.nullif(F.trim("yahoo_ticker"), F.lit("")))
    made = F.concat(F.replace(F.upper(F.nullif(F.trim("ticker"), F.lit(""))), F.lit("."), F.lit("-")), suffix)
    best = F.struct((~F.coalesce("is_primary", F.lit(False))).cast("int").alias("p"), rank_of(F.col("exchange_mic")).alias("r"), F.col("exchange_mic").alias("m"))
    rows = listings.withColumn("symbol", F.coalesce(given, made)).where("symbol IS NOT NULL").withColumn("best", best)
    one = rows.groupBy("isin", "symbol").agg(F.min("best").alias("best"), F.min_by("trading_currency", "best").alias("trading_currency"))
    w = Window.partitionBy("isin").orderBy("best", "symbol")
    return one.select("isin", (F.row_number().over(w) - 1).alias("rank"), F.col("symbol").alias("yahoo_ticker"), F.col("best.m").alias("exchange_mic"), "trading_currency")


def orphans(listings: DataFrame, funds: DataFrame) -> DataFrame:
    """Listings of no fund."""
    return listings.join(funds.select("isin"), "isin", "left_anti")


def tradable(funds: DataFrame, listings: DataFrame) -> DataFrame:
    """Funds with a listing that has a ticker."""
    return funds.join(listings.where("ticker IS NOT NULL").select("isin"), "isin", "left_semi")


def bound_aum(funds: DataFrame, provenance_: DataFrame) -> DataFrame:
    """aum_eur null where its winner is an aggregator and the value is out of bounds."""
    weak = provenance_.where((F.col("field") == "aum_eur") & (F.col("trust") <= AGGREGATOR_TRUST)).select("isin", F.lit(True).alias("weak_"))
    odd = (F.col("aum_eur") > MAX_AUM) | (F.col("aum_eur") <= 0)
    return funds.join(weak, "isin", "left").withColumn("aum_eur", F.when(~(F.coalesce("weak_", F.lit(False)) & odd), F.col("aum_eur"))).drop("weak_")


def unique_claims(claims: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b) pairs in which neither side is claimed by another."""
    pairs = claims.select(a, b).where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()
    alone = lambda x: pairs.groupBy(x).agg(F.count("*").alias("n")).where("n = 1").select(x)
    return pairs.join(alone(a), a, "left_semi").join(alone(b), b, "left_semi").select(a, b)
