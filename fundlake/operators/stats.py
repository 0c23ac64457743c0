"""Risk and return statistics of a whole panel in one shuffle.

A panel is one row for each fund and day with the logarithm of its adjusted close.  ``clean`` deals bars
by isin and sorts them by isin and date, once; the choice among repeated days, the anchors of
the windows (on the fund's own last bar), returns, running peaks, month ends and the match with the
benchmark all keep that partitioning and order, and everything ends in one hash aggregate.  A
benchmark made from the panel itself costs a second pass, its own aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values.
RISK_FREE, TRADING_DAYS, MIN_VOLATILITY, MIN_HISTORY, MIN_SHARED, MIN_CAGR_YEARS = 0.025, 252, 1e-5, 30, 250, 1.0
ANNUAL = math.sqrt(TRADING_DAYS)
DAILY_FREE = math.log(1 + RISK_FREE) / TRADING_DAYS
#: Trailing windows, by days and by months.
DAYS = {"1d": 1, "1w": 7}
MONTHS = {"1m": 1, "3m": 3, "6m": 6, "1y": 12, "3y": 36, "5y": 60, "10y": 120}
RISK_WINDOWS = ("1y", "3y", "5y")



def _fund():
    return Window.partitionBy("isin")


def _time():
    return _fund().orderBy("date")


def clean(bars: DataFrame, as_of=None, order: list[str] | None = None) -> DataFrame:
    """isin, date, close, adj_close, logp, currency: usable bars, of repeated days the last in ``order``."""
    adj = F.col("adj_close").cast("double")
    fine = F.col("date").isNotNull() & adj.isNotNull() & ~F.isnan(adj) & (adj > 0) & (adj < float("inf"))
    if as_of is not None:
        fine &= F.col("date") <= F.lit(as_of).cast("date")
    order = order or ["adj_close", "close"]
    currency = F.col("currency") if "currency" in bars.columns else F.lit(None).cast("string")
    extra = [c for c in order if c not in ("adj_close", "close")]
    rows = bars.where(fine).select("isin", "date", F.col("close").cast("double").alias("close"), adj.alias("adj_close"), currency.alias("currency"), *extra)
    after = F.lead("date").over(_fund().orderBy("date", *order))
    last = rows.repartition("isin").withColumn("after_", after).where("after_ IS NULL OR after_ <> date")
    return last.drop("after_", *extra).withColumn("logp", F.log("adj_close"))


def targets(terminal: Column) -> dict[str, Column]:
    """The day that each trailing window reaches back to."""
    out = {k: F.date_sub(terminal, n) for k, n in DAYS.items()}
    out |= {k: F.add_months(terminal, -n) for k, n in MONTHS.items()}
    return out | {"ytd": F.date_sub(F.trunc(terminal, "year"), 1)}


def performance(panel: DataFrame, benchmark: DataFrame | None = None, funds: DataFrame | None = None, min_shared: int = MIN_SHARED) -> DataFrame:
    """One row for each fund of ``panel`` (see ``clean``), and for each isin of ``funds`` without a usable bar (nulls).

    ``benchmark``: (date, logp); of several rows for a day the mean.
    """
    rows = panel
    if benchmark is not None:
        world = benchmark.groupBy("date").agg(F.avg("logp").alias("world"))  # one row for each day, whatever was given
        rows = rows.join(world, "date", "left")
    rows = rows.withColumns({"terminal": F.max("date").over(_fund()), "top": F.max("logp").over(_fund()), "base_currency": F.max_by("currency", F.when(F.col("currency").isNotNull(), F.col("date"))).over(_fund())})
    rows = rows.withColumns({f"from_{w}": F.max(F.when(F.col("date") <= F.add_months("terminal", -MONTHS[w]), F.col("date"))).over(_fund()) for w in RISK_WINDOWS})
    run, before = _time().rowsBetween(Window.unboundedPreceding, 0), _time().rowsBetween(Window.unboundedPreceding, -1)
    since = {w: F.col("date") >= F.col(f"from_{w}") for w in RISK_WINDOWS}
    rows = rows.withColumns({"r": F.col("logp") - F.lag("logp").over(_time()), "next_": F.lead("date").over(_time()), "peak": F.max("logp").over(run)} | {f"peak_{w}": F.max(F.when(since[w], F.col("logp"))).over(run) for w in RISK_WINDOWS})
    month_end = F.col("next_").isNull() | (F.trunc("next_", "month") != F.trunc("date", "month"))
    told = {"last_month": F.last(F.when(month_end, F.col("logp")), ignorenulls=True).over(before)}
    if benchmark is not None:
        shared = F.coalesce(since["3y"] & F.col("world").isNotNull(), F.lit(False))
        told |= {"y_before": F.last(F.when(shared, F.col("logp")), ignorenulls=True).over(before), "x_before": F.last(F.when(shared, F.col("world")), ignorenulls=True).over(before)}
    rows = rows.withColumns(told)

    at_end = lambda c: F.max_by(c, "date")
    aggs = [F.count("*").cast("int").alias("history_days"), F.min("date").alias("history_start"), F.max("date").alias("price_date"), F.min_by("logp", "date").alias("l_first"), at_end("logp").alias("l_last"), at_end("close").alias("close_last"), at_end("adj_close").alias("adj_last")]
    for w, day in targets(F.col("terminal")).items():
        ok = F.col("date") <= day
        aggs.append(F.max_by(F.when(ok, F.col("logp")), F.when(ok, F.col("date"))).alias(f"l_{w}"))
    for w in RISK_WINDOWS:
        inside = F.col("date") > F.col(f"from_{w}")
        short = F.least(F.col("r") - DAILY_FREE, F.lit(0.0))
        aggs += [F.stddev_samp(F.when(inside, F.col("r"))).alias(f"s_{w}"), F.avg(F.when(inside, short * short)).alias(f"d_{w}"), F.count(F.when(inside, F.col("r"))).alias(f"n_{w}"), F.min(F.when(since[w], F.col("logp") - F.col(f"peak_{w}"))).alias(f"dd_{w}")]
    low = F.col("logp") - F.col("peak")
    aggs += [F.min(low).alias("dd_all"), F.max_by(low, "date").alias("dd_now"), F.max("adj_close").alias("ath"), F.min(F.when(F.col("logp") == F.col("top"), F.col("date"))).alias("ath_date")]
    month = F.when(month_end & F.col("next_").isNotNull(), F.expm1(F.col("logp") - F.col("last_month")))  # the first and last months are no whole ones
    aggs += [F.max(month).alias("best_month"), F.min(month).alias("worst_month"), F.avg((month > 0).cast("double")).alias("positive_months_pct")]
    if benchmark is not None:
        y, x = F.when(shared, F.col("logp") - F.col("y_before")), F.when(shared, F.col("world") - F.col("x_before"))
        aggs += [F.count_if(shared).alias("n"), F.covar_samp(x, y).alias("c"), F.var_samp(x).alias("vx"), F.var_samp(y).alias("vy")]
    one = rows.groupBy("isin", "base_currency").agg(*aggs)

    gain = lambda w: F.expm1(F.col("l_last") - F.col(f"l_{w}"))
    years = F.datediff("price_date", "history_start") / 365.25
    out = {f"ret_{w}": gain(w) for w in (*DAYS, *MONTHS, "ytd")}
    out["ret_max"] = F.when(F.col("history_days") > 1, F.expm1(F.col("l_last") - F.col("l_first")))
    yearly = {w: F.expm1((F.col("l_last") - F.col(f"l_{w}")) / (MONTHS[w] / 12)) for w in ("1y", "3y", "5y", "10y")}
    out |= {f"cagr_{w}": yearly[w] for w in ("3y", "5y", "10y")}
    out["cagr_inception"] = F.when(years >= MIN_CAGR_YEARS, F.expm1((F.col("l_last") - F.col("l_first")) / years))
    for w in RISK_WINDOWS:
        vol = F.when(F.col(f"n_{w}") >= 2, F.col(f"s_{w}") * ANNUAL)
        out |= {f"vol_{w}": vol, f"sharpe_{w}": F.when(vol > MIN_VOLATILITY, (yearly[w] - RISK_FREE) / vol), f"max_drawdown_{w}": F.when(F.col(f"n_{w}") >= 1, F.expm1(f"dd_{w}"))}
    down = F.when(F.col("n_3y") >= 2, F.sqrt("d_3y") * ANNUAL)
    out["sortino_3y"] = F.when(down > MIN_VOLATILITY, (yearly["3y"] - RISK_FREE) / down)
    out |= {"max_drawdown_max": F.expm1("dd_all"), "current_drawdown": F.expm1("dd_now"), "price_last": F.coalesce("close_last", "adj_last"), "distance_from_ath": F.expm1("dd_now")}
    out |= _beta(min_shared) if benchmark is not None else dict.fromkeys(("beta_vs_world", "correlation_vs_world"), F.lit(None).cast("double"))
    made = one.select("isin", "base_currency", "history_days", "history_start", "price_date", "ath", "ath_date", "best_month", "worst_month", "positive_months_pct", *(c.alias(k) for k, c in out.items()))
    if funds is not None:
        made = funds.select("isin").distinct().join(made, "isin", "left")
    return made


def thin_gate(performance_: DataFrame, kept: tuple[str, ...] = ("isin", "base_currency", "price_last", "price_date", "history_start", "history_days", "computed_at"), least: int = MIN_HISTORY) -> DataFrame:
    """All but the ``kept`` columns null where a fund has fewer than ``least`` bars."""
    enough = F.coalesce(F.col("history_days") >= least, F.lit(False))
    return performance_.select(*(F.col(c) if c in kept else F.when(enough, F.col(c)).alias(c) for c in performance_.columns))


def _beta(min_shared: int) -> dict[str, Column]:
    """Beta and correlation from n, c, vx and vy."""
    enough = (F.col("n") > min_shared) & (F.col("vx") > 0)
    moves = F.sqrt("vy") * ANNUAL > MIN_VOLATILITY
    return {"beta_vs_world": F.when(enough, F.col("c") / F.col("vx")), "correlation_vs_world": F.when(enough & moves, F.col("c") / F.sqrt(F.col("vx") * F.col("vy")))}


def beta_and_correlation(panel: DataFrame, benchmark: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """isin, beta_vs_world, correlation_vs_world over the 3-year window, of funds with a shared day in it.

    Both series are cut to shared days before returns are taken.  The benchmark has one row for each day;
    whether it is broadcast is left to its measured size.
    """
    anchored = panel.select("isin", "date", "logp").withColumn("terminal", F.max("date").over(_fund()))
    anchored = anchored.withColumn("start", F.max(F.when(F.col("date") <= F.add_months("terminal", -36), F.col("date"))).over(_fund())).where("date >= start")
    shared = anchored.join(benchmark.groupBy("date").agg(F.avg("logp").alias("world")), "date")
    rows = shared.withColumn("y", F.col("logp") - F.lag("logp").over(_time())).withColumn("x", F.col("world") - F.lag("world").over(_time()))
    m = rows.groupBy("isin").agg(F.count("*").alias("n"), F.covar_samp("x", "y").alias("c"), F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"))
    return m.select("isin", *(c.alias(k) for k, c in _beta(min_shared).items()))


def own_benchmark(panel: DataFrame, isin: str) -> DataFrame:
    """(date, logp) of one fund of the panel: no rows if it is not there, and then nothing is compared."""
    return panel.where(F.col("isin") == isin).select("date", "logp")


def period_returns(panel: DataFrame, period: str) -> DataFrame:
    """isin, start (first day of the ``period``: month or year), ret and partial of every period a fund has bars in.

    The base is the last bar of the previous period that has any; the first period's is its first bar,
    and null if that is its only one.
    """
    ends = panel.groupBy("isin", F.trunc("date", period).alias("start")).agg(F.max_by("logp", "date").alias("last"), F.min_by("logp", "date").alias("first"), F.count("*").alias("bars"))
    time = _fund().orderBy("start")
    before = F.lag("last").over(time)
    base = F.coalesce(before, F.when(F.col("bars") > 1, F.col("first")))
    edge = before.isNull() | F.lead("start").over(time).isNull()
    return ends.select("isin", "start", F.expm1(F.col("last") - base).alias("ret"), edge.alias("partial"))


def yearly_returns(panel: DataFrame) -> DataFrame:
    return period_returns(panel, "year").select("isin", F.year("start").cast("short").alias("year"), "ret", "partial")


def monthly_returns(panel: DataFrame) -> DataFrame:
    return period_returns(panel, "month").select("isin", F.year("start").cast("short").alias("year"), F.month("start").cast("byte").alias("month"), "ret", "partial")


def monthly_distribution(months: DataFrame) -> DataFrame:
    """isin, best_month, worst_month, positive_months_pct over whole months."""
    whole = months.where("NOT partial AND ret IS NOT NULL")
    return whole.groupBy("isin").agg(F.max("ret").alias("best_month"), F.min("ret").alias("worst_month"), F.avg((F.col("ret") > 0).cast("double")).alias("positive_months_pct"))


def month_grid(months: DataFrame) -> DataFrame:
    """isin, year and m1 .. m12."""
    return months.groupBy("isin", "year").pivot("month", list(range(1, 13))).agg(F.max("ret")).select("isin", "year", *(F.col(str(m)).alias(f"m{m}") for m in range(1, 13)))
