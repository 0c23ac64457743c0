"""Closed forms, degenerate inputs and laws of the operators."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fundlake.functions import identifiers, money, names
from fundlake.operators import adjust, asof, eligibility, fold, fx, publish, rows, serve, stats
from fundlake.schema import TABLES, conform, publishable
from fundlake.sources import charts, store

D = dt.date


def bars(spark, prices, isin="A", start=D(2020, 1, 1)):
    data = [(isin, start + dt.timedelta(days=i), float(p), float(p), "EUR") for i, p in enumerate(prices)]
    return spark.createDataFrame(data, "isin string, date date, close double, adj_close double, currency string")


def test_constant_growth(spark):
    days, rate = 1200, math.log(1.1) / 365.25
    one = stats.performance(stats.clean(bars(spark, [math.exp(rate * i) for i in range(days)]))).first()
    assert one.history_days == days and one.ret_10y is None and one.ret_5y is None
    assert one.ret_1d == pytest.approx(math.expm1(rate)) and one.cagr_inception == pytest.approx(0.1)
    assert one.vol_1y == pytest.approx(0, abs=1e-9) and one.sharpe_1y is None and one.max_drawdown_max == 0


def test_alternating_returns_have_a_closed_deviation(spark):
    a, prices = 0.01, [100.0]
    for i in range(799):
        prices.append(prices[-1] * math.exp(a if i % 2 else -a))
    one = stats.performance(stats.clean(bars(spark, prices))).first()
    n = 365
    assert one.vol_1y == pytest.approx(math.sqrt((n * a * a - (a * a) / n) / (n - 1)) * math.sqrt(252), rel=1e-3)


def test_v_shape_drawdown_and_high(spark):
    one = stats.performance(stats.clean(bars(spark, [100, 50, 80]))).first()
    assert one.max_drawdown_max == pytest.approx(-0.5) and one.current_drawdown == pytest.approx(-0.2)
    assert one.ath == 100 and one.ath_date == D(2020, 1, 1)


def test_unusable_bars_are_left_out_and_empty_funds_kept(spark):
    rows_ = spark.createDataFrame([("A", D(2020, 1, 1), 1.0, 1.0), ("A", D(2020, 1, 2), 0.0, 0.0), ("A", None, 1.0, 1.0), ("A", D(2020, 1, 3), 1.0, float("nan")), ("B", D(2020, 1, 1), 1.0, None)], "isin string, date date, close double, adj_close double")
    panel = stats.clean(rows_)
    assert panel.count() == 1
    made = {r["isin"]: r for r in stats.performance(panel, funds=rows_).collect()}
    assert made["A"].history_days == 1 and made["A"].ret_max is None and made["B"].history_days is None
    gated = stats.thin_gate(stats.performance(panel)).first()
    assert gated.history_days == 1 and gated.max_drawdown_max is None


def test_last_arrival_wins(spark):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 2, 7.0), (None, 1, 1.0)], "k string, seq int, v double")
    assert sorted((r.k or "", r.v) for r in rows.keep_last(df, ["k"], ["seq"]).collect()) == [("", 1.0), ("A", 7.0)]
    assert sorted((r.k or "", r.v) for r in rows.keep_first(df, ["k"], ["seq"]).collect()) == [("", 1.0), ("A", 5.0)]


def test_period_returns(spark):
    panel = stats.clean(bars(spark, [1.0 + i for i in range(70)], start=D(2020, 1, 30)))
    got = {(r.year, r.month): (r.ret, r.partial) for r in stats.monthly_returns(panel).collect()}
    assert got[(2020, 1)] == (pytest.approx(1.0), True)
    assert got[(2020, 2)] == (pytest.approx(31 / 2 - 1), False)
    assert got[(2020, 4)][1]


def test_beta_of_itself_is_one(spark):
    panel = stats.clean(bars(spark, [100 * math.exp(0.01 * math.sin(i)) for i in range(1300)]))
    one = stats.beta_and_correlation(panel, panel.select("date", "logp")).first()
    assert one.beta_vs_world == pytest.approx(1) and one.correlation_vs_world == pytest.approx(1)


def test_adjustment_is_exact(spark):
    b = bars(spark, [100, 100, 100])
    none = spark.createDataFrame([], "isin string, date date, kind string, amount double, ratio double")
    assert [r.adj_close for r in adjust.adjust(b, none).orderBy("date").collect()] == [100.0] * 3
    ev = spark.createDataFrame([("A", D(2020, 1, 2), "dividend", 10.0, None), ("A", D(2030, 1, 1), "dividend", 1.0, None), ("A", D(2020, 1, 1), "dividend", 1.0, None), ("A", D(2020, 1, 3), "dividend", 500.0, None), ("Z", D(2020, 1, 2), "dividend", 1.0, None), ("A", D(2020, 1, 2), "spin", None, None)], none.schema)
    assert [r.adj_close for r in adjust.adjust(b, ev).orderBy("date").collect()] == pytest.approx([90.0, 100.0, 100.0])
    told = {r.status: r.n for r in adjust.report(adjust.event_factors(b, ev)).collect()}
    assert told == {"applied": 1, "outside the fund's price window": 2, "non-positive adjustment factor": 1, "fund not in price panel": 1, "unrecognised event kind": 1}


def test_rates_hold_ten_days_and_legacy_for_ever(spark):
    rates = fx.with_legacy(spark.createDataFrame([(D(2008, 12, 30), "SKK", 30.0), (D(2020, 1, 1), "USD", 2.0)], "date date, currency string, rate_to_eur double"))
    b = spark.createDataFrame([("A", D(2020, 1, 11), 10.0, "USD"), ("B", D(2020, 1, 12), 10.0, "USD"), ("C", D(2020, 1, 12), 30.126, "SKK"), ("D", D(2019, 1, 1), 1.0, "USD"), ("E", D(2020, 1, 1), 7.0, "EUR")], "isin string, date date, close double, currency string")
    got = {r.isin: r.close for r in fx.to_eur(b, rates, horizon="2021-01-01").collect()}
    assert got == {"A": 5.0, "B": None, "C": pytest.approx(1.0), "D": None, "E": 7.0}


def test_asof_backward_and_strict(spark):
    left = spark.createDataFrame([("A", 5, "x"), ("A", 3, "y"), ("B", 1, "z")], "k string, t int, name string")
    right = spark.createDataFrame([("A", 3, 30.0), ("A", 4, 40.0)], "k string, t int, v double")
    assert {r.name: r.v for r in asof.asof_backward(left, right, "k", "t", ["v"]).collect()} == {"x": 40.0, "y": 30.0, "z": None}
    assert {r.name: r.v for r in asof.asof_backward(left, right, "k", "t", ["v"], strict=True).collect()} == {"x": 40.0, "y": None, "z": None}


def test_rate_faults(spark):
    bad = spark.createDataFrame([(D(2020, 1, 4), "USD", 1.0), (D(2020, 1, 6), "USD", -1.0)], "date date, currency string, rate_to_eur double")
    assert {r.problem for r in fx.problems(bad).collect()} == {"published on a weekend", "rate not finite and positive"}
    assert [r.problem for r in fx.problems(bad.limit(0)).collect()] == ["no rates"]


def test_identifiers(spark):
    df = spark.createDataFrame([("IE00B4L5Y983",), ("ie00-b4l5.y983",), ("IE00B4L5Y984",), (" ",), (None,), ("XS0000000009",)], "raw string")
    code = identifiers.normalise(F.col("raw"))
    got = [tuple(r) for r in df.select(identifiers.is_valid(code), identifiers.country(F.col("raw"))).collect()]
    assert got[:5] == [(True, "IE"), (True, "IE"), (False, None), (False, None), (False, None)] and got[5][1] is None
    assert spark.range(1).select(identifiers.key(F.lit("US:XNAS:BRK.B"))).first()[0] == "US:XNAS:BRK.B"


def test_subunits_by_case(spark):
    df = spark.createDataFrame([("GBp",), ("GBP",), ("gbx",), ("ZAC",), ("",)], "c string")
    assert [tuple(r) for r in df.select(money.iso(F.col("c")), money.unit(F.col("c"))).collect()] == [("GBP", 0.01), ("GBP", 1.0), ("GBP", 0.01), ("ZAR", 0.01), (None, None)]


def test_names(spark):
    df = spark.createDataFrame([("iShares Core S&P 500 ETF ETFS",), ("WisdomTree Physical Gold ETC",), ("ETFS Physical Gold",), ("Core DAX UCITS ETF DE o.N.",), ("X ETF ETF",), (None,)], "n string")
    assert [r[0] for r in df.select(names.clean(F.col("n"))).collect()] == ["iShares Core S&P 500 ETF", "WisdomTree Physical Gold ETC", "ETFS Physical Gold", "Core DAX UCITS ETF DE", "X ETF", None]
    cases = {"Gold Miners ETF": ("equity", None), "Physical Gold": ("commodity", None), "Euro MONÉTAIRE": ("money-market", None), "Credit Suisse Nothing": (None, None), "UltraShort QQQ": (None, "inverse"), "Ultra Short Bond": ("bond", None), "S&P 500 2x": ("equity", "leveraged"), "plain": (None, None)}
    asset, strategy = names.classify(F.col("n"))
    got = {r[0]: (r[1], r[2]) for r in spark.createDataFrame([(c,) for c in cases], "n string").select("n", asset, strategy).collect()}
    assert got == cases


def test_fold_laws(spark):
    a = spark.createDataFrame([("K", None, False), ("L", "a", None)], "isin string, name string, esg boolean")
    b = spark.createDataFrame([("K", "b", True), ("K", "c", True)], "isin string, name string, esg boolean")
    one = {r["isin"]: r for r in fold.trust_fold(fold.stack({"hi": (80, a), "lo": (40, b)}), "isin", ["name", "esg"]).collect()}
    assert one["K"].esg is False and one["K"].name in ("b", "c") and one["K"].data_sources == ["hi", "lo"] and one["L"].esg is None
    told = {(r["isin"], r["field"]): (r.source, r.contenders) for r in fold.provenance(fold.stack({"lo": (40, b), "hi": (80, a)}), "isin", ["name", "esg"]).collect()}
    assert told[("K", "esg")] == ("hi", 3) and told[("K", "name")] == ("lo", 2)


def test_one_primary_for_each_fund(spark):
    df = spark.createDataFrame([("DE1", "XPAR", "FR"), ("DE1", "XETR", "DE"), ("US1", "ZZZZ", None), ("US1", "XPAR", "FR")], "isin string, exchange_mic string, venue_country string")
    got = {(r["isin"], r.exchange_mic) for r in fold.primary_flags(df).where("is_primary").collect()}
    assert got == {("DE1", "XETR"), ("US1", "XPAR")}


def test_eligibility_needs_evidence(spark):
    f = spark.createDataFrame([("IE00B4L5Y983", "World", None, True), ("US0378331005", "US fund", "US", False), ("FR0000120271", "Gold ETC", None, None), ("LU0000000009", "Silent", None, True)], "isin string, name string, domicile string, ucits boolean")
    ev = spark.createDataFrame([("IE00B4L5Y983", "fortuneo", "broker", "u1", D(2026, 1, 1)), ("IE00B4L5Y983", "boursorama", "broker", "u2", D(2026, 2, 1)), ("LU0000000009", "justetf", "screener", "u3", D(2026, 1, 1))], "isin string, provider string, kind string, url string, as_of date")
    got = {r["isin"]: r for r in eligibility.verdicts(f, ev, "2026-08-01").collect()}
    assert (got["IE00B4L5Y983"].pea_eligible, got["IE00B4L5Y983"].pea_confidence, got["IE00B4L5Y983"].pea_source) == (True, "medium", "u2")
    assert got["US0378331005"].pea_eligible is False and got["US0378331005"].cto_reason == "no_priips_kid"
    assert got["FR0000120271"].pea_eligible is False and got["LU0000000009"].pea_eligible is None and got["LU0000000009"].pea_confidence == "hint"
    made = eligibility.verdicts(f, ev, "2026-08-01")
    eligibility.check(made.where("isin <> 'LU0000000009'"))
    with pytest.raises(ValueError, match="C1"):
        eligibility.check(made.withColumn("cto_accessible", F.lit(None).cast("boolean")).where("domicile IS NULL"))


def test_tri_state_predicates(spark):
    df = spark.createDataFrame([("a", True, 1.0), ("b", False, None), ("c", None, 3.0)], "isin string, t boolean, aum_eur double").withColumn("search_blob", F.col("isin"))
    pick = lambda **k: [r["isin"] for r in serve.screen(df, serve.predicate(**k), "aum_eur").collect()]
    assert pick(tri={"t": "no"}) == ["b"] and pick(tri={"t": "unknown"}) == ["c"] and pick(ranges={"aum_eur": (0, None)}) == ["c", "a"] and pick() == ["c", "a", "b"]
    assert pick(text="_") == ["c", "a", "b"] and pick(text="_", like=False) == []


def test_conform_and_guard(spark):
    df = spark.createDataFrame([("A", 1)], "isin string, more int")
    assert conform(df, "funds").columns == [f.split()[0] for f in TABLES["funds"].split(", ")]
    with pytest.raises(KeyError):
        conform(df, "funds", strict=True)
    with pytest.raises(ValueError):
        publishable(df.withColumn("close", F.lit(1)))
    assert ("", "no as_of date") in {tuple(r) for r in publish.gate(spark, {"funds": df}).collect()}
    with pytest.raises(ValueError, match="listings is missing"):
        publish.check(spark, {"funds": df})


def test_store_is_idempotent(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "cp"))
    path = str(tmp_path / "store")
    b = bars(spark, [1, 2, 3])
    store.upsert(spark, b, path, 4)
    store.upsert(spark, b, path, 4)
    store.upsert(spark, bars(spark, [9], start=D(2020, 1, 2)), path, 4)
    got = [(r.date.day, r.close) for r in store.read(spark, path, ["A"], buckets=4).orderBy("date").collect()]
    assert got == [(1, 1.0), (2, 9.0), (3, 3.0)]
    with pytest.raises(ValueError):
        store.upsert(spark, b.withColumn("isin", F.lit(" ")), path, 4)


def test_chart_payloads(spark):
    text = '{"chart":{"result":[{"meta":{"currency":"GBp","exchangeTimezoneName":"Asia/Tokyo","gmtoffset":32400},"timestamp":[1577836800,1577923200,1577926800],"indicators":{"quote":[{"open":[1,2],"close":[1.5,2.5,null]}]},"events":{"dividends":{"x":{"amount":0.5,"date":1577923200}},"splits":{"y":{"date":1577836800,"numerator":4,"denominator":2}}}}]}}'
    df = spark.createDataFrame([("A", text), ("B", "<html>")], "isin string, payload string")
    assert [(r.date, r.open, r.close, r.currency) for r in charts.bars(df).orderBy("date").collect()] == [(D(2020, 1, 1), 1.0, 1.5, "GBp"), (D(2020, 1, 2), 2.0, 2.5, "GBp")]
    assert sorted((r.kind, r.amount, r.ratio) for r in charts.actions(df).collect()) == [("dividend", 0.5, None), ("split", None, 2.0)]
    assert [r["isin"] for r in charts.failures(df).collect()] == ["B"]


def test_fetch_reports_failures_as_rows(spark):
    asked = spark.createDataFrame([("A", "s", 1, 2), ("B", "s", 0, 3), ("C", "bad", 0, 1)], "isin string, symbol string, start int, end int")

    def transport(symbol, start, end):
        if symbol == "bad":
            raise OSError("down")
        return f"{symbol}:{start}:{end}"

    got = {r["isin"]: (r.payload, r.error) for r in charts.fetch(asked, transport, 2).collect()}
    assert got == {"A": ("s:0:3", None), "B": ("s:0:3", None), "C": (None, "OSError: down")}
