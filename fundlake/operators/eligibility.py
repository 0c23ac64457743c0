"""Three-valued eligibility: true and false need evidence or statute, everything else is null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions import identifiers, names
from fundlake.functions.money import lookup

#: States whose funds are not ruled out.
EEA = ("AT", "BE", "BG", "CY", "CZ", "DE", "DK", "EE", "ES", "FI", "FR", "GR", "HR", "HU", "IE", "IS", "IT", "LI", "LT", "LU", "LV", "MT", "NL", "NO", "PL", "PT", "RO", "SE", "SI", "SK")
#: providers' kinds; others are community.
KINDS = {"euronext": "venue", "amundi": "issuer", "ishares": "issuer", "bnp-paribas-easy": "issuer", "ossiam": "issuer", "spdr": "issuer", "vanguard": "issuer", "hsbc": "issuer", "bourse-direct": "broker", "fortuneo": "broker", "boursorama": "broker", "saxo": "stale", "justetf": "screener", "scanetf": "screener", "github-pea-comparator": "community", "github-etf-scrapper": "community", "xtrackers": "no_flag"}
#: Parts of source addresses in order, and their provider.
PROVIDERS = [("live.euronext.com", "euronext"), ("boursedirect.fr", "bourse-direct"), ("fortuneo.fr", "fortuneo"), ("boursorama.com", "boursorama"), ("home.saxo", "saxo"), ("amundietf.fr", "amundi"), ("blackrock.com", "ishares"), ("bnpparibas-am.com", "bnp-paribas-easy"), ("ossiam.net", "ossiam"), ("ssga.com", "spdr"), ("vanguard", "vanguard"), ("assetmanagement.hsbc.fr", "hsbc"), ("justetf.com", "justetf"), ("scanetf.com", "scanetf"), ("majordomef-sudo/pea-comparator", "github-pea-comparator"), ("corentinbouton/ETF-scrapper", "github-etf-scrapper"), ("etf.dws.com", "xtrackers")]
#: Legal forms that are no fund, and how names spell them.
NON_FUND_FORMS = ("etc", "etn", "certificate", "certificat", "structured_note", "note")
NON_FUND_SHORT, NON_FUND_LONG = r"(?<![A-Za-z])(ETC|ETN)(?![A-Za-z])", r"(?iU)exchange[ -]traded[ -](commodit|note)|structured\s+note|\bcertificat"
STATUTE = "https://www.legifrance.gouv.fr/codes/article_lc/LEGIARTI000041467756"


#: What a reader is told beside the reason.
NOTES = {
    "no_priips_kid": "US fund without a key information document: may be kept or sold, not bought",
    "uk_ucits_is_third_country": "a British UCITS has no passport into France any more",
    "kid_language_unconfirmed": "no key information document in French is known",
    "not_passported_to_france": "its marketing in France has not been notified",
    "ucits_eea_with_kid": "an EEA UCITS owes a key information document; its notification in France was not looked up",
}


def provider(url: Column) -> Column:
    """The provider of a source address; an unknown host is a community of its own."""
    host = F.split_part(F.regexp_replace(url, r"^https?://(www\.)?", ""), F.lit("/"), F.lit(1))
    known = [F.when(F.contains(url, F.lit(part)), F.lit(key)) for part, key in PROVIDERS]
    return F.coalesce(*known, F.concat(F.lit("blog-"), F.when(host == "", F.lit("unknown")).otherwise(host)))


def kind(key: Column) -> Column:
    return F.coalesce(lookup(KINDS, key), F.lit("community"))


def domicile(funds: DataFrame) -> Column:
    """The declared one, unless it names no country; else the identifier's."""
    declared = F.upper(F.trim("domicile")) if "domicile" in funds.columns else F.lit(None).cast("string")
    return F.when(declared.rlike("^[A-Z]{2}$") & ~declared.isin(*identifiers.SUPRANATIONAL), declared).otherwise(identifiers.country(F.col("isin")))


def _column(funds: DataFrame, name: str, kind_: str) -> Column:
    return F.col(name).cast(kind_) if name in funds.columns else F.lit(None).cast(kind_)


def not_a_fund(funds: DataFrame) -> Column:
    form = F.replace(F.lower(F.trim(_column(funds, "legal_form", "string"))), F.lit(" "), F.lit("_"))
    name = F.coalesce(F.col("name"), F.lit(""))
    return F.when(F.nullif(form, F.lit("")).isNotNull(), form.isin(*NON_FUND_FORMS)).otherwise(name.rlike(NON_FUND_SHORT) | name.rlike(NON_FUND_LONG))


def support(evidence: DataFrame) -> DataFrame:
    """The best support of each isin of ``evidence`` (isin, provider, kind, url, as_of): one aggregate.

    Further kinds: ``prospectus``, ``seed_verified`` and ``seed_unverified``; a provider's rows share its date and
    address.  Within the winning tier the provider read last is cited, of several the first by name.
    """
    cited = F.struct(-F.unix_date("as_of"), "provider")
    latest = lambda *kinds: F.min_by(F.struct("url", "as_of"), F.when(F.col("kind").isin(*kinds), cited))
    weak = ("stale", "screener", "community", "no_flag")
    one = evidence.groupBy("isin").agg(
        *(latest(k).alias(k) for k in ("prospectus", "venue", "issuer", "broker", "seed_verified", "seed_unverified")),
        latest(*weak).alias("weak"),
        F.countDistinct(F.when(F.col("kind") == "broker", F.col("provider"))).alias("brokers"),
        F.array_sort(F.collect_set("provider")).alias("citations"),
    )
    tiers = [
        (F.col("prospectus").isNotNull(), "highest", "prospectus_or_dic", "prospectus"),
        (F.col("venue").isNotNull(), "high", "venue_flag", "venue"),
        (F.col("issuer").isNotNull(), "high", "issuer_flag", "issuer"),
        (F.col("brokers") >= 2, "medium", "brokers_corroborated", "broker"),
        (F.col("brokers") == 1, "low", "single_broker", "broker"),
        (F.col("seed_verified").isNotNull(), "low", "seed_verified", "seed_verified"),
        (F.col("seed_unverified").isNotNull(), "hint", "seed_unverified", "seed_unverified"),
        (F.col("weak").isNotNull(), "hint", "screener_or_community_only", "weak"),
    ]
    pick = F.coalesce(*(F.when(c, F.struct(F.lit(a).alias("confidence"), F.lit(r).alias("reason"), F.col(f"{f}.url").alias("url"), F.col(f"{f}.as_of").alias("as_of"))) for c, a, r, f in tiers))
    return one.withColumn("best", pick).select("isin", "best.*", "citations", "brokers")


def mechanism(funds: DataFrame, stated: Column | None = None) -> Column:
    """From replication, declared or stated by a source, or the name; the tracked index is never read."""
    how = F.coalesce(names.replication(_column(funds, "replication", "string")), stated if stated is not None else F.lit(None))
    return F.when(how == "synthetic-swap", "synthetic_swap").when(how.startswith("physical"), "physical_eu").when(F.coalesce(F.col("name").rlike(r"(?iU)\bswap\b"), F.lit(False)), "synthetic_swap").otherwise("unknown")


def verdicts(funds: DataFrame, evidence: DataFrame, read_on: str, stated: DataFrame | None = None) -> DataFrame:
    """``funds`` with pea_eligible, pea_confidence, pea_mechanism, pea_source, pea_as_of, pea_reason, cto_accessible, cto_reason, cto_note, has_priips_kid and authorised_fr.

    ``stated``: (isin, stated), the replication that sources tell.
    """
    best = support(evidence).select("isin", *(F.col(c).alias(f"s_{c}") for c in ("confidence", "reason", "url", "as_of")))
    made = ["pea_eligible", "pea_confidence", "pea_mechanism", "pea_source", "pea_as_of", "pea_reason", "cto_accessible", "cto_reason", "cto_note", "has_priips_kid", "authorised_fr"]
    rows = funds.join(best, "isin", "left")
    rows = rows.join(stated.select("isin", F.col("stated").alias("st_")), "isin", "left") if stated is not None else rows.withColumn("st_", F.lit(None).cast("string"))
    rows = rows.withColumn("d_", domicile(funds)).withColumn("nf_", not_a_fund(funds))
    blocked = F.when(F.col("nf_"), "not_a_fund").when(F.col("d_").isNotNull() & ~F.col("d_").isin(*EEA), "domicile_outside_eea")
    promotes = F.coalesce(F.col("s_confidence").isin("highest", "high", "medium", "low"), F.lit(False))
    rows = rows.withColumns({"b_": blocked, "p_": promotes}).withColumn("yes_", F.col("b_").isNull() & F.col("p_"))
    no_isin = identifiers.is_surrogate(F.col("isin"))
    pea = F.when(F.col("b_").isNotNull(), False).when(F.col("yes_"), True)
    kid, allowed, french, ucits = (_column(funds, c, "boolean") for c in ("has_priips_kid", "authorised_fr", "kid_language_fr", "ucits"))
    eea = F.coalesce(F.col("d_").isin(*EEA), F.lit(False))
    kid = F.coalesce(kid, F.when(eea & F.coalesce(ucits, F.lit(False)), True))
    kid_after, allowed_after = F.coalesce(kid, F.when(F.col("yes_"), True)), F.coalesce(allowed, F.when(F.col("yes_"), True))
    outside = F.col("d_").isNotNull() & ~eea
    case = (
        F.when(F.col("d_") == "US", "no_priips_kid")
        .when(F.col("d_") == "GB", "uk_ucits_is_third_country")
        .when(outside, "unknown")
        .when(~french, "kid_language_unconfirmed")
        .when(~allowed, "not_passported_to_france")
        .when(kid_after, "ucits_eea_with_kid")
        .otherwise("unknown")
    )
    rows = rows.withColumns({"case_": case, "kid_": F.when(F.col("d_") == "US", False).when(outside, _column(funds, "has_priips_kid", "boolean")).when(case.isin("kid_language_unconfirmed", "not_passported_to_france"), kid).otherwise(kid_after), "ok_": F.when(F.col("d_") == "US", allowed).when(F.col("d_") == "GB", False).when(outside | case.isin("kid_language_unconfirmed", "not_passported_to_france"), allowed).otherwise(allowed_after)})
    rows = rows.withColumns({"mech_": F.when(F.col("yes_"), mechanism(funds, F.col("st_"))).otherwise("unknown"), "pea_": pea})
    out = {
        "pea_eligible": F.col("pea_"),
        "pea_confidence": F.when(F.col("b_").isNotNull(), "high").otherwise(F.coalesce("s_confidence", F.lit("none"))),
        "pea_mechanism": F.col("mech_"),
        "pea_source": F.when(F.col("b_").isNotNull(), STATUTE).otherwise(F.col("s_url")),
        "pea_as_of": F.when(F.col("b_").isNotNull(), F.lit(read_on).cast("date")).when(F.col("yes_"), F.col("s_as_of")),
        "pea_reason": F.coalesce("b_", "s_reason", F.when(no_isin, "no_isin_to_match").otherwise("no_positive_evidence")),
        "cto_accessible": F.when(F.col("case_").isin("no_priips_kid", "uk_ucits_is_third_country", "not_passported_to_france"), False).when(F.col("case_") == "ucits_eea_with_kid", True),
        "cto_reason": F.col("case_"),
        "cto_note": F.coalesce(
            F.when(outside & (F.col("case_") == "unknown"), F.concat(F.lit("domicile "), F.col("d_"), F.lit(": no key information document is held, one may exist"))),
            F.when((F.col("case_") == "ucits_eea_with_kid") & F.col("yes_"), F.lit("sold within a French PEA, hence marketed in France")),
            lookup(NOTES, F.col("case_")),
        ),
        "has_priips_kid": F.col("kid_"),
        "authorised_fr": F.col("ok_"),
    }
    return rows.select(*(c for c in funds.columns if c not in made), *(c.alias(k) for k, c in out.items()))


def in_catalogue(funds: DataFrame, evidence: DataFrame, broker: str) -> DataFrame:
    """isin, cto_accessible, cto_reason for one broker's catalogue: true if listed, null if not."""
    listed = evidence.where(F.col("provider") == broker).select("isin").distinct().withColumn("listed", F.lit(True))
    rows = funds.select("isin").join(listed, "isin", "left")
    return rows.select("isin", F.col("listed").alias("cto_accessible"), F.when(F.col("listed"), "in_broker_catalogue").otherwise("not_in_broker_catalogue").alias("cto_reason"))


def violations(funds: DataFrame) -> DataFrame:
    """(rule, isin) of rows that contradict themselves: C1, C3, C4, C5."""
    us = F.coalesce(F.upper("domicile") == "US", F.lit(False))
    is_false = lambda c: F.coalesce(~F.col(c), F.lit(False))
    is_true = lambda c: F.coalesce(F.col(c), F.lit(False))
    broken = F.array_compact(F.array(
        F.when(is_true("pea_eligible") & ~is_true("cto_accessible"), "C1"),
        F.when(us & ~(is_false("pea_eligible") & is_false("cto_accessible")), "C3"),
        F.when(F.col("pea_eligible").isNotNull() & (F.col("pea_source").isNull() | F.col("pea_as_of").isNull()), "C4"),
        F.when(identifiers.key(F.col("isin")).isNull(), "C5"),
    ))
    return funds.select(F.explode(broken).alias("rule"), "isin")


def check(funds: DataFrame) -> None:
    """An error that names up to ten rows of each broken rule."""
    bad = violations(funds).groupBy("rule").agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_set("isin")), 1, 10).alias("isins")).orderBy("rule").collect()
    if bad:
        raise ValueError("; ".join(f"{r.rule}: {r.n} rows, {r.isins}" for r in bad))


def swap_mask(funds: DataFrame) -> Column:
    return F.coalesce(F.col("pea_mechanism") == "synthetic_swap", F.lit(False))


def broker_availability(evidence: DataFrame, not_etf: DataFrame) -> DataFrame:
    """broker, isin, available, wrapper, source_url, as_of of what brokers list and is a fund."""
    rows = evidence.where(F.col("kind").isin("broker", "stale")).join(not_etf.select("isin"), "isin", "left_anti")
    return rows.select(F.col("provider").alias("broker"), "isin", F.lit(True).alias("available"), F.lit("pea").alias("wrapper"), F.col("url").alias("source_url"), "as_of").distinct()


def tally(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, yes, no, unknown) of three-valued columns, in one scan."""
    counts = df.agg(*(F.count_if(x).alias(f"{c}_{k}") for c in columns for k, x in (("y", F.col(c)), ("n", ~F.col(c)), ("u", F.col(c).isNull()))))
    rows = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"{c}_y").alias("yes"), F.col(f"{c}_n").alias("no"), F.col(f"{c}_u").alias("unknown")) for c in columns))
    return counts.select(F.inline(rows))
