"""The screener's queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values.
PAGE, WINDOW_DAYS = 300, {"1y": 365, "3y": 1095, "5y": 1826, "10y": 3653}
TRI = {"yes": lambda c: F.coalesce(c, F.lit(False)), "no": lambda c: F.coalesce(~c, F.lit(False)), "unknown": lambda c: c.isNull()}


def predicate(text: str = "", facets: dict | None = None, tri: dict | None = None, ranges: dict | None = None, like: bool = True) -> Column:
    """What the screener keeps: ``ranges`` are (least, most) by column; nulls fail a range.

    % and _ in ``text`` are wildcards, as users know them; ``like=False`` takes them literally.
    """
    out = F.lit(True)
    text = text.strip().lower()
    if text:
        out &= F.col("search_blob").like(f"%{text}%") if like else F.contains("search_blob", F.lit(text))
    for c, v in (facets or {}).items():
        out &= F.col(c) == F.lit(v)
    for c, v in (tri or {}).items():
        out &= TRI[v](F.col(c))
    for c, (least, most) in (ranges or {}).items():
        out &= F.col(c).isNotNull()
        if least is not None:
            out &= F.col(c) >= least
        if most is not None:
            out &= F.col(c) <= most
    return out


def screen(funds: DataFrame, where: Column, sort: str, descending: bool = True, limit: int = PAGE, then: str = "aum_eur", key: str = "isin") -> DataFrame:
    """The first page: a top-k without a full sort, nulls last, ties by ``then`` and ``key``."""
    by = F.col(sort).desc_nulls_last() if descending else F.col(sort).asc_nulls_last()
    return funds.where(where).orderBy(by, F.col(then).desc_nulls_last(), key).limit(limit)


def matches(funds: DataFrame, where: Column) -> DataFrame:
    """n_match: a partial aggregate of its own instead of a global window."""
    return funds.where(where).agg(F.count("*").alias("n_match"))


def facets(funds: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value, n) of all columns in one scan."""
    long = funds.select(*(F.col(c).cast("string").alias(c) for c in columns)).unpivot([], columns, "facet", "value")
    return long.where("value IS NOT NULL").groupBy("facet", "value").agg(F.count("*").alias("n"))


def compare(index: DataFrame, isins: list[str], since=None, rebase: bool = False) -> DataFrame:
    """One row for each date and one column for each isin, calendars aligned; base 100 at the first date in view if ``rebase``."""
    rows = index.where(F.col("isin").isin(*isins))
    if since is not None:
        rows = rows.where(F.col("date") >= F.lit(since).cast("date"))
    if rebase:
        first = F.first("tr_index").over(Window.partitionBy("isin").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.withColumn("tr_index", F.col("tr_index") / first * 100)
    return rows.groupBy("date").pivot("isin", isins).agg(F.max("tr_index"))


def cutoff(as_of: Column, window: str) -> Column:
    return F.date_sub(as_of, WINDOW_DAYS[window])


def detail(table: DataFrame, isin: str, *order: str) -> DataFrame:
    """The rows of one fund: an equality that reaches the scan."""
    return table.where(F.col("isin") == isin).orderBy(*order)


def restore(funds: DataFrame, isins: list[str], columns: list[str]) -> DataFrame:
    return funds.where(F.col("isin").isin(*isins)).select(*columns)
