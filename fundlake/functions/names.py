"""What a fund's name and category tell, as column expressions; first matching rule wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns in order, matched without regard to case, over Unicode words.
ASSET_RULES = [
    (r"\bminers?\b|\bmining\b|gold bugs|\bexploration\b|\bproducers?\b|\boil\s*&\s*gas\b|natural resources|\bblockchain\b|\bmetals?\s*&\s*miners\b|\benergy (companies|equit)", "equity"),
    (r"\b(bitcoin|crypto\w*|digital assets?|gold|silver|uranium|lithium|copper|oil|gas)\b[\w\s&.'-]{0,25}\b(compan(y|ies)|corp(oration)?s?\b|industry|ecosystem|equit\w*|leaders)", "equity"),
    (r"\b(equit\w*|factor|sector|style)\s+allocation\b", "equity"),
    (r"\b(fixed[-\s]?income|bond|municipal|muni|credit)\s+allocation\b", "bond"),
    (r"multi[-\s]?asset|\ballocation\b|lifestrategy|life strategy|target[-\s]?date|\bbalanced\b|\b\d{2}/\d{2} portfolio\b", "multi-asset"),
    (r"\bbitcoin\b|\bethereum\b|\bcrypto\w*|digital assets?|\bbtc\b|\bxbt\b|\bsolana\b|\bpolkadot\b|\bcardano\b|\blitecoin\b|\bchainlink\b", "crypto"),
    (r"\breits?\b|real[-\s]?estate|\bproperty\b|\brealty\b|\bepra\b|immobili|\bimmo\b", "real-estate"),
    (r"money[-\s]?market|mon[eé]taire|geldmarkt|\bovernight\b|\b€str\b|\bestr\b|\bsofr\b|\bsonia\b|\bsaron\b|treasury bills?|\bt[-\s]?bills?\b", "money-market"),
    (r"\bbonds?\b|\bobligac|\bobligation|\brenten\b|\bgilts?\b|\btreasur|\bbunds?\b|\bbtps?\b|\bschatz\b|\bbobl\b|aggregate|fixed[-\s]?income|high[-\s]yield|investment[-\s]grade|\bsovereign\b|\bgovernment\b|\bcorp(orate)?\s+bond|\bcorporates\b|\bmunicipal\b|\bmunis?\b|\btips\b|inflation[-\s]?linked|\bduration\b|\bmaturity\b|\bconvertibles?\b|\bcoco\b|\bat1\b|\bclo\b|\bloans?\b|\bmortgage\b|\bdebt\b|\bibonds\b|\bfloating[-\s]?rate\b|\bcredit\b(?!\s+(suisse|agricole|mutuel|industriel))", "bond"),
    (r"\bcommodit\w*|\bgold\b|\bsilver\b|\bplatinum\b|\bpalladium\b|precious metals?|industrial metals?|base metals?|\bbrent\b|\bwti\b|\bcrude\b|natural gas|\bcopper\b|\baluminium\b|\baluminum\b|\bnickel\b|\bzinc\b|\bwheat\b|\bcorn\b|\bsoybean|\bsugar\b|\bcocoa\b|\bcoffee\b|\blivestock\b|\bagricultur\w*|\bgsci\b|\bbcom\b|\bcmci\b|carbon (allowance|emission|credit)", "commodity"),
    (r"currencyshares|\b(us )?dollar index\b|\bcurrency basket\b", "currency"),
    (r"\bequit\w*|\bstocks?\b|\baktie\w*|\bazioni\b|\bacciones\b|\bs&p\s?\d|\bs&p\s?/|nasdaq|\bmsci\b|\bstoxx\b|\bftse\b|\bdax\b|\bcac\s?40\b|\bsmi\b|\bibex\b|\bmib\b|\baex\b|\bomx\w*|\bnikkei\b|\btopix\b|\bjpx\b|\brussell\b|hang seng|\bkospi\b|\bsensex\b|\bnifty\b|bovespa|\bwig\d|\bswig\d|\bmwig\d|\bsofix\b|\bathex\b|dow jones|industrial average|\bacwi\b|\bs&p/asx\b|\basx\s?\d|small[-\s]?cap|\bmid[-\s]?cap\b|large[-\s]?cap|\bdividend\w*|aristocrat|\bmomentum\b|minimum volatility|\bmin\.?\s?vol\b|low volatility|\bbuyback\b|\bcash cows?\b|financials\b|health\s?care|biotech\w*|semiconductor|technolog\w*|consumer (staples|discretionary|goods|services)|communication services|\butilities\b|\bindustrials\b|\binsurance\b|\bbanks\b|clean energy|renewable|\bsolar\b|\bwater\b|\bcybersecur\w*|\brobotic\w*|artificial intelligence|\besports\b|video gaming|\bcannabis\b|\bmarijuana\b|\binfrastructure\b", "equity"),
]
STRATEGY_RULES = [
    (r"\binverse\b|\bbear\b|(?<![\w.])-\d(\.\d)?x\b|daily short|\bshort daily\b", "inverse"),
    (r"(?<![\w.])\d(\.\d)?x\b|\bleverage\w*|\blev\b|\bbull\b|\bultra\b(?!\s*short)", "leveraged"),
    (r"covered[-\s]?calls?|buy[-\s]?write", "covered-call"),
    (r"\besg\b|\bsri\b|sustainab\w*|socially responsib\w*|paris[-\s]?aligned|\bclimate\b|\bscreened\b|\bethical\b|\bgreen bond", "esg"),
    (r"\bdividend\w*|aristocrat|\bdivid\w*", "dividend"),
    (r"\bfactors?\b|multi[-\s]?factor|minimum volatility|\bmin\.?\s?vol\b|low volatility|\bmomentum\b|equal[-\s]?weight", "factor"),
    (r"financials\b|health\s?care|information technology|consumer staples|consumer discretionary|communication services|\butilities\b|\bindustrials\b|energy sector|\bbanks\b|semiconductor", "sector"),
    (r"\bactive(ly)?\b|\bactif\b|\baktiv\b", "active"),
]
ULTRA_SHORT = r"\bultra[-\s]?short\b"
# Parts of category names in order.
CATEGORY_ASSETS = [("equity precious metals", "equity"), ("equity energy", "equity"), ("digital assets", "crypto"), ("bitcoin", "crypto"), ("crypto", "crypto"), ("commodities", "commodity"), ("precious metals", "commodity"), ("real estate", "real-estate"), ("money market", "money-market"), ("allocation", "multi-asset"), ("target-date", "multi-asset"), ("target date", "multi-asset"), ("convertible", "bond"), ("bond", "bond"), ("muni", "bond"), ("government", "bond"), ("corporate", "bond"), ("bank loan", "bond"), ("high yield", "bond"), ("currency", "currency"), ("stock", "equity"), ("equity", "equity"), ("blend", "equity"), ("growth", "equity"), ("value", "equity"), ("sector", "equity")]
CATEGORY_STRATEGIES = [("leveraged", "leveraged"), ("inverse", "inverse"), ("derivative income", "covered-call"), ("covered call", "covered-call"), ("dividend", "dividend"), ("equity income", "dividend"), ("sustainab", "esg"), ("technology", "sector"), ("health", "sector"), ("financial", "sector"), ("energy", "sector"), ("utilities", "sector"), ("industrials", "sector"), ("consumer", "sector"), ("communications", "sector"), ("natural resources", "sector"), ("precious metals", "sector"), ("infrastructure", "sector"), ("real estate", "sector"), ("japan", "country"), ("china", "country"), ("india", "country"), ("europe", "country"), ("latin america", "country"), ("pacific", "country"), ("emerging", "country"), ("blend", "broad-market"), ("total market", "broad-market"), ("world stock", "broad-market"), ("global stock", "broad-market")]
# What is cut from the end of a name, in turn.
PAR_VALUE, CLASS_MARKER, DOUBLED_TYPE = r"\s+o\.?\s?N\.?\s*$", r"\s+ETFS\s*$", r"(?<=\b(?:ETF|ETP|ETC|ETN))\s+(?:ETF|ETP|ETC|ETN)\s*$"


def _first(rules: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*(F.when(hit, F.lit(value)) for hit, value in rules))


def clean(name: Column) -> Column:
    out = F.trim(name)
    for tail in (PAR_VALUE, CLASS_MARKER, DOUBLED_TYPE):
        out = F.trim(F.regexp_replace(out, F.lit("(?i)" + tail), F.lit("")))
    return F.trim(F.regexp_replace(out, r"\s{2,}", " "))


def classify(name: Column, index_name: Column | None = None) -> tuple[Column, Column]:
    """(asset_class, strategy), each null where no rule matches."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    text = F.concat_ws(" ", blank(name), *([blank(index_name)] if index_name is not None else []))
    hit = lambda rules: _first([(text.rlike("(?iU)" + p), v) for p, v in rules])
    asset, strategy = hit(ASSET_RULES), hit(STRATEGY_RULES)
    ultra = text.rlike("(?iU)" + ULTRA_SHORT) & F.coalesce(asset != "bond", F.lit(True))
    return asset, F.coalesce(strategy, F.when(ultra, F.lit("inverse")))


def map_category(category: Column) -> tuple[Column, Column]:
    """(asset_class, strategy); ``unknown`` where no part is known, null for a blank category."""
    text = F.lower(F.nullif(F.trim(category), F.lit("")))
    return tuple(F.when(text.isNotNull(), F.coalesce(_first([(F.contains(text, F.lit(k)), v) for k, v in rules]), F.lit("unknown"))) for rules in (CATEGORY_ASSETS, CATEGORY_STRATEGIES))


def is_empty(value: Column) -> Column:
    return value.isNull() | F.lower(F.trim(value)).isin("", "unknown")


def fill_from_name(funds: DataFrame, tag: str = "name-heuristic") -> DataFrame:
    """``funds`` with empty asset_class and strategy taken from the name; data_sources tell it where one was."""
    asset, strategy = classify(F.col("name"), F.col("index_name") if "index_name" in funds.columns else None)
    new = funds.withColumns({"asset_new": F.when(is_empty(F.col("asset_class")), asset), "strategy_new": F.when(is_empty(F.col("strategy")), strategy)})
    touched = F.col("asset_new").isNotNull() | F.col("strategy_new").isNotNull()
    sources = F.when(touched, F.array_sort(F.array_union(F.coalesce("data_sources", F.array().cast("array<string>")), F.array(F.lit(tag))))).otherwise(F.col("data_sources"))
    return new.withColumns({"data_sources": sources, "asset_class": F.coalesce("asset_new", "asset_class"), "strategy": F.coalesce("strategy_new", "strategy")}).drop("asset_new", "strategy_new")


def replication(raw: Column) -> Column:
    text = F.lower(raw)
    any_of = lambda *xs: text.rlike("|".join(xs))
    return F.when(any_of("swap", "synth", "indirect"), "synthetic-swap").when(any_of("physi", "direct"), "physical-full")
