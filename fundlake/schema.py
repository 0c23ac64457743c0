"""Declared tables, vocabularies and the projections that enforce them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The tables' columns and types.
TABLES: dict[str, str] = {
    "funds": "isin string, name string, short_name string, issuer string, brand string, domicile string, ucits boolean, fund_currency string, inception_date date, ter float, aum_eur double, replication string, distribution_policy string, dividend_frequency string, index_name string, index_provider string, asset_class string, region string, sector string, strategy string, leverage float, esg boolean, currency_hedged_to string, securities_lending boolean, pea_eligible boolean, pea_confidence string, pea_mechanism string, pea_source string, pea_as_of date, cto_accessible boolean, cto_reason string, cto_note string, has_priips_kid boolean, authorised_fr boolean, data_sources array<string>, last_updated date",
    "listings": "isin string, exchange_mic string, exchange_name string, ticker string, yahoo_ticker string, trading_currency string, is_primary boolean",
    "prices": "isin string, date date, open float, high float, low float, close float, adj_close float, volume float, currency string",
    "corporate_actions": "isin string, date date, kind string, amount float, ratio float, currency string",
    "performance": "isin string, base_currency string, ret_1d float, ret_1w float, ret_1m float, ret_3m float, ret_6m float, ret_ytd float, ret_1y float, ret_3y float, ret_5y float, ret_10y float, ret_max float, cagr_3y float, cagr_5y float, cagr_10y float, cagr_inception float, vol_1y float, vol_3y float, vol_5y float, sharpe_1y float, sharpe_3y float, sharpe_5y float, sortino_3y float, max_drawdown_1y float, max_drawdown_3y float, max_drawdown_5y float, max_drawdown_max float, current_drawdown float, best_month float, worst_month float, positive_months_pct float, beta_vs_world float, correlation_vs_world float, price_last float, price_date date, ath float, ath_date date, distance_from_ath float, history_start date, history_days int, computed_at date",
    "returns_yearly": "isin string, year short, ret float, partial boolean",
    "returns_monthly": "isin string, year short, month byte, ret float, partial boolean",
    "broker_availability": "broker string, isin string, available boolean, wrapper string, source_url string, as_of date",
}
#: What a published table must not hold.
FORBIDDEN = ("open", "high", "low", "close", "volume", "adj_close")


def struct(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def conform(df: DataFrame, name: str, strict: bool = False) -> DataFrame:
    """``df`` with the declared columns, in order and type; missing ones null, others dropped (an error if ``strict``)."""
    fields = struct(name).fields
    extra = sorted(set(df.columns) - {f.name for f in fields})
    if strict and extra:
        raise KeyError(f"{name}: undeclared columns {extra}")
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))


def publishable(df: DataFrame) -> DataFrame:
    """``df`` itself; an error if it holds a column that must not be published."""
    bad = [c for c in df.columns if c.lower() in FORBIDDEN]
    if bad:
        raise ValueError(f"must not be published: {bad}")
    return df
