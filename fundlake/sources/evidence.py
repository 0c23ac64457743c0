"""Evidence files: who says of which fund that it is eligible, and when.

Rows are (isin, provider, kind, url, as_of, seq).  A provider is dated by its latest reading and cited by its
first address; identifiers that fail the check digit are kept apart, never indexed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlake.functions import identifiers, names
from fundlake.operators import eligibility
from fundlake.sources import text

#: The date of files that tell none, and of providers that say so themselves.
READ_ON = "2026-08-10"
DATED = {"saxo": "2025-03-20", "github-etf-scrapper": "2024-07-20"}
VENUE_URL = "https://live.euronext.com/en/products/etfs/list"
#: The files of an evidence folder by what they hold, in the order of citation.
FLAT = ("issuer_lists.csv", "ishares_pea.csv", "bnp_xtrackers_pea.csv", "broker_lists.csv", "community_lists.csv")
VENUE, UNFLAGGED, DROPPED, PROSPECTUS, SEED = "euronext_pea_yes.csv", "xtrackers_full_universe_no_pea_flag.csv", "dropped_not_etf.txt", "prospectus_pea.csv", "pea_eligible.csv"
FENCE, STAMP = "(?i)unverified", r"^(\d{1,2}) +([A-Za-z]{3}) +(\d{4})$"

RAW = "isin string, url string, as_of date, replication string, tier string, seq long"


@dataclass
class Evidence:
    rows: DataFrame  # isin, provider, kind, url, as_of: one for each fund and provider
    replication: DataFrame  # isin, stated
    not_etf: DataFrame  # isin
    unflagged: DataFrame  # isin: catalogues without a flag, held and never consulted
    rejected: DataFrame  # isin


def _shape(rows: DataFrame, isin: Column, url: Column, as_of: Column | None = None, replication: Column | None = None, tier: str = "", seq: Column | None = None) -> DataFrame:
    none = lambda t: F.lit(None).cast(t)
    return rows.select(isin.alias("isin"), F.trim(F.coalesce(url, F.lit(""))).alias("url"), (as_of if as_of is not None else none("date")).alias("as_of"), (replication if replication is not None else none("string")).alias("replication"), F.lit(tier).alias("tier"), (seq if seq is not None else F.lit(0)).cast("long").alias("seq"))


def venue(spark: SparkSession, path: str) -> DataFrame:
    """The venue's product file, which dates itself in a line of one cell."""
    rows = text.delimited(spark, path, ";", needed=["ISIN"], what="venue evidence")
    lines = text.lines(spark, path).select(F.trim(F.regexp_replace(F.trim("line"), '^"|"$', "")).alias("line"))
    day = F.to_date(F.concat_ws(" ", F.regexp_extract("line", STAMP, 1), F.initcap(F.regexp_extract("line", STAMP, 2)), F.regexp_extract("line", STAMP, 3)), "d MMM yyyy")
    stamp = lines.where(F.col("line").rlike(STAMP)).agg(F.coalesce(F.max(day), F.lit(READ_ON).cast("date")).alias("stamp"))  # one row
    return _shape(rows.where("ISIN IS NOT NULL").crossJoin(stamp), F.col("ISIN"), F.lit(VENUE_URL), F.col("stamp"), seq=F.col("seq"))


def flat(spark: SparkSession, path: str) -> DataFrame:
    """A list whose rows name their own source."""
    rows = text.delimited(spark, path, ",", needed=["isin"], what="evidence list")
    opt = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    return _shape(rows, F.col("isin"), opt("source_url"), replication=names.replication(opt("replication")), seq=F.col("seq"))


def seed(spark: SparkSession, path: str) -> DataFrame:
    """The curated list: above the comment that fences it off verified, below not; the header may be repeated.

    A running flag over the lines tells the section: one window over one small file.
    """
    raw = text.lines(spark, path).withColumn("line", F.trim("line")).where("line <> ''")
    head = raw.where("NOT startswith(line, '#')").orderBy("n").select("line").first()
    if head is None:
        return spark.createDataFrame([], RAW)
    cells = [c.strip().lower() for c in head.line.split(",")]
    text.require(cells, ["isin"], "seed")
    fence = F.col("line").startswith("#") & F.col("line").rlike(FENCE)
    below = F.max(fence).over(Window.partitionBy(F.lit(0)).orderBy("n").rowsBetween(Window.unboundedPreceding, 0))
    body = raw.withColumn("below", below).where("NOT startswith(line, '#')").where(F.lower(F.trim(F.split_part("line", F.lit(","), F.lit(1)))) != "isin")
    parsed = body.select("n", "below", F.from_csv("line", F.lit(", ".join(f"`c{i}` string" for i in range(len(cells)))), {"mode": "PERMISSIVE"}).alias("r"))
    get = lambda c: text.blank(F.col(f"r.c{cells.index(c)}")) if c in cells else F.lit(None).cast("string")
    made = _shape(parsed.withColumn("seq", F.col("n")), get("isin"), get("source_url"), replication=names.replication(get("replication")), seq=F.col("n"))
    tiers = parsed.select(F.col("n").cast("long").alias("seq"), F.when(F.col("below"), "seed_unverified").otherwise("seed_verified").alias("tier"))
    return made.drop("tier").join(tiers, "seq").select("isin", "url", "as_of", "replication", "tier", "seq")


def prospectus(spark: SparkSession, path: str) -> DataFrame:
    """Readings of prospectuses, each with its own date."""
    rows = text.delimited(spark, path, ",", needed=["isin"], what="prospectus readings")
    return _shape(rows, F.col("isin"), F.col("source_url"), F.coalesce(F.to_date("as_of"), F.lit(READ_ON).cast("date")), tier="prospectus", seq=F.col("seq"))


def codes(spark: SparkSession, path: str) -> DataFrame:
    """(isin): the valid identifiers that lines of a list begin with."""
    rows = text.lines(spark, path).select(identifiers.normalise(F.split_part(F.trim("line"), F.lit(" "), F.lit(1))).alias("isin"))
    return rows.where(identifiers.is_valid(F.col("isin"))).distinct()


def by_provider(rows: DataFrame) -> DataFrame:
    """``rows`` (isin, provider, kind, url, as_of, seq) with each provider's latest date and first address, one for each isin and provider."""
    who = rows.groupBy("provider").agg(F.max("as_of").alias("as_of"), F.min_by("url", F.struct("seq", "url")).alias("url"))
    return rows.select("isin", "provider", "kind").distinct().join(who, "provider").select("isin", "provider", "kind", "url", "as_of")


def index(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, replication, rejected) of ``raw`` (see ``RAW``)."""
    coded = raw.withColumn("isin", identifiers.normalise(F.col("isin"))).where("isin IS NOT NULL")
    good = coded.where(identifiers.is_valid(F.col("isin")))
    rejected = coded.where(~identifiers.is_valid(F.col("isin"))).select("isin").distinct()
    told = good.where("tier <> 'prospectus'").withColumn("provider", eligibility.provider(F.col("url")))
    dated = F.coalesce("as_of", *(F.when(F.col("provider") == k, F.lit(d).cast("date")) for k, d in DATED.items()), F.lit(READ_ON).cast("date"))
    rows = by_provider(told.withColumns({"as_of": dated, "kind": eligibility.kind(F.col("provider"))}))
    tiers = good.where("tier <> ''").groupBy("isin", "tier").agg(F.max_by(F.struct("url", "as_of"), "seq").alias("x"))
    own = tiers.select("isin", F.col("tier").alias("provider"), F.col("tier").alias("kind"), F.when(F.col("tier") == "prospectus", F.col("x.url")).otherwise(F.concat(F.lit(SEED + " "), F.split_part("tier", F.lit("_"), F.lit(2)))).alias("url"), F.coalesce("x.as_of", F.lit(READ_ON).cast("date")).alias("as_of"))
    stated = good.where("replication IS NOT NULL").groupBy("isin").agg(F.min_by("replication", F.struct("seq", "replication")).alias("stated"))
    return rows.unionByName(own), stated, rejected


def load(spark: SparkSession, root: str) -> Evidence:
    """Everything that the folder ``root`` holds; files that are not there are passed over."""
    from fundlake.sources.store import _exists

    there = lambda name: f"{root}/evidence/{name}" if _exists(spark, f"{root}/evidence/{name}") else None
    parts = [venue(spark, p)] if (p := there(VENUE)) else []
    parts += [flat(spark, p) for name in FLAT if (p := there(name))]
    parts += [seed(spark, f"{root}/{SEED}")] if _exists(spark, f"{root}/{SEED}") else []
    parts += [prospectus(spark, p)] if (p := there(PROSPECTUS)) else []
    raw = spark.createDataFrame([], RAW)
    for k, part in enumerate(parts):  # files in order, then lines
        raw = raw.unionByName(part.withColumn("seq", F.col("seq") + (k << 40)))
    rows, stated, rejected = index(raw)
    none = spark.createDataFrame([], "isin string")
    held = flat(spark, p).select(identifiers.valid_or_null(F.col("isin")).alias("isin")).where("isin IS NOT NULL").distinct() if (p := there(UNFLAGGED)) else none
    return Evidence(rows, stated, codes(spark, p) if (p := there(DROPPED)) else none, held, rejected)
