"""The whole build on two made-up sources and a made-up transport."""

import datetime
import json
import math

import pytest

from fundlake.operators import publish
from fundlake.plans import adapters, build
from fundlake.sources import charts
from tests.test_sources import A, B, C, put

D = datetime.date


def transport():
    def payload(symbol, start, end):
        """Five years of weekdays for known symbols; the fund of symbol B pays once."""
        if symbol not in ("A.PA", "B.DE"):
            raise charts.Refused(404)
        days = [D(2021, 1, 4) + datetime.timedelta(days=k) for k in range(1800)]
        stamps = [int(datetime.datetime(d.year, d.month, d.day, 9, tzinfo=datetime.UTC).timestamp()) for d in days if d.weekday() < 5]
        close = [100 * math.exp(0.0002 * k + 0.01 * math.sin(k + len(symbol))) for k in range(len(stamps))]
        events = {"dividends": {"x": {"amount": 1.0, "date": stamps[500]}}} if symbol == "B.DE" else {}
        quote = {c: close for c in ("open", "high", "low", "close")} | {"volume": [1.0] * len(close)}
        return json.dumps({"chart": {"result": [{"meta": {"currency": "USD" if symbol == "B.DE" else "EUR", "exchangeTimezoneName": "Europe/Paris", "gmtoffset": 3600}, "timestamp": stamps, "indicators": {"quote": [quote]}, "events": events}]}})

    return payload


def test_build_and_resume(spark, tmp_path):
    root = str(tmp_path / "out")

    def one(spark):
        funds = [(A, "Fund A UCITS ETF", True), (B, "Fund B", None), (C, "No prices", None)]
        lines = [(A, "XPAR", "A"), (B, "XAMS", "B"), (B, "XETR", "B"), (C, "XPAR", "C")]
        return spark.createDataFrame(funds, "isin string, name string, ucits boolean"), spark.createDataFrame(lines, "isin string, exchange_mic string, ticker string")

    put(tmp_path, "ev/evidence/broker_lists.csv", f"isin,source_url\n{A},https://www.fortuneo.fr/a\n")
    rates = spark.createDataFrame([(D(2021, 1, 1) + datetime.timedelta(days=k), "USD", 1.25) for k in range(0, 1900, 3) if (D(2021, 1, 1) + datetime.timedelta(days=k)).weekday() < 5], "date date, currency string, rate_to_eur double")
    more = dict(sources=[adapters.Adapter("one", 90, one), adapters.Adapter("two", 10, lambda refresh: None)], transport=charts.Retrying(transport(), 2, 0.0), rates=rates, evidence=str(tmp_path / "ev"), benchmark=A, min_funds=2, tasks=2)
    with pytest.raises(ValueError, match="universe was passed over"):
        build.run(spark, build.Config(root, "2026-01-01", **more, runs=("resolve",)))
    report = build.run(spark, build.Config(root, "2026-01-01", **more))
    rows = {table: n for _, _, table, n in report.lines}
    assert rows["funds"] == rows["eligible"] == rows["screener"] == rows["performance"] == 3 and rows["manifest"] == 2 and rows["index"] > 400
    assert {s for s, *_ in report.sources if _[1]} == {"one"} and report.extrapolate(30) > 0 and "universe" in report.render()
    wide = {r["isin"]: r for r in spark.read.parquet(f"{root}/tables/screener").collect()}
    assert wide[A].pea_eligible and wide[A].pea_confidence == "low" and wide[B].pea_eligible is None
    assert wide[A].beta_vs_world == pytest.approx(1) and wide[B].ret_1y is not None and wide[C].ret_1y is None and not wide[C].has_index
    assert wide[B].primary_mic == "XAMS" and publish.read_json(spark, f"{root}/published/manifest.json")["tables"]["funds"] == 3
    first = {r["isin"]: r for r in spark.read.parquet(f"{root}/tables/adjusted").where("date = date'2021-01-04'").collect()}
    assert first[A].adj_close == first[A].close and first[B].adj_close < first[B].close < 100 / 1.25 * 1.02
    again = build.run(spark, build.Config(root, "2026-01-01", **more, runs=("stats", "write")))
    assert [s for s, *_ in again.lines] == ["stats"] * 4 + ["write"]
    with pytest.raises(ValueError, match="under 9"):
        build.run(spark, build.Config(root, "2026-01-01", **{**more, "min_funds": 9}, runs=("write",)))
    with pytest.raises(KeyError):
        build.run(spark, build.Config(root, "2026-01-01", **more, runs=("nothing",)))
