"""Files of every kind, written here, through their readers; the run of sources, and what is published."""

import datetime
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from fundlake.operators import adjust, eligibility, fold, publish, stats
from fundlake.plans import adapters
from fundlake.sources import charts, evidence, rates, registers, store, text, venues

D = datetime.date
# made-up identifiers with right check digits
A, B, C, U = "IE00AAAAAA17", "FR0000AAAA11", "LU0000BBBB14", "US0000CCCC16"


def digit(body):
    digits = "".join(str(int(c, 36)) for c in body)
    return str(-sum(sum(divmod(int(x) * (2 - i % 2), 10)) for i, x in enumerate(reversed(digits))) % 10)


A, B, C, U = (x[:11] + digit(x[:11]) for x in (A, B, C, U))
BAD = A[:11] + str((int(A[11]) + 1) % 10)


def put(folder, name, what, encoding="utf-8"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(what.encode(encoding))
    return str(path)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_register_and_regulated_markets(spark, tmp_path):
    head = "MIC,OPERATING MIC,OPRT/SGMT,MARKET NAME-INSTITUTION DESCRIPTION,MARKET CATEGORY CODE,ISO COUNTRY CODE (ISO 3166),STATUS\n"
    path = put(tmp_path, "mic.csv", head + '"XPAR","XPAR","OPRT","PARIS, MAIN","RMKT","FR","ACTIVE"\n"ETFP","XMIL","SGMT"," ETF PLUS ","RMKT","IT","ACTIVE"\n"XOLD","XOLD","OPRT","GONE","NSPD","GB","EXPIRED"\n"FRAA","XETR","SGMT","F","MLTF","DE","ACTIVE"\n')
    assert rows(venues.regulated_markets(spark, path), "mic", "venue_name", "venue_country") == [("ETFP", "ETF PLUS", "IT"), ("XPAR", "PARIS, MAIN", "FR")]
    register = registers.venues(spark, path)
    assert rows(register, "mic", "status") == [("ETFP", "ACTIVE"), ("FRAA", "ACTIVE"), ("XOLD", "EXPIRED"), ("XPAR", "ACTIVE")]
    aliases = {"ETFP": "XMIL", "FRAA": "XFRA", "XPAR": "XAMS", "AAA": "ETFP"}
    assert rows(registers.alias_problems(register, aliases), "alias", "problem") == [("AAA", "points at another alias"), ("FRAA", "is operated by XETR"), ("XPAR", "is a venue of its own")]
    assert rows(registers.unknown_aliases(register, aliases), "alias") == [("AAA",)]
    with pytest.raises(KeyError):
        registers.venues(spark, put(tmp_path, "other.csv", "A,B\n1,2\n"))


def test_firds(spark, tmp_path):
    def line(isin, name, cfi, mic, ccy="EUR", lei="L1", end=""):
        return f"<RefData><FinInstrmGnlAttrbts><Id>{isin}</Id><FullNm>{name}</FullNm><ShrtNm>S</ShrtNm><ClssfctnTp>{cfi}</ClssfctnTp><NtnlCcy>{ccy}</NtnlCcy></FinInstrmGnlAttrbts><Issr>{lei}</Issr><TradgVnRltdAttrbts><Id>{mic}</Id><FrstTradDt>2020-01-01</FrstTradDt><TermntnDt>{end}</TermntnDt></TradgVnRltdAttrbts></RefData>"

    xml = "<?xml version='1.0'?><Doc>" + "".join([line(A, "Fund A", "CEOGES", "XPAR"), line(A, "Fund A", "CEOGES", "XDRK"), line(B, "", "CEOIBS", "XAMS", lei=""), line(B, "Fund B", "CEOIBS", "XPAR", "USD"), line(BAD, "Bad", "CEOGES", "XPAR"), line(C, "A share", "ESVUFR", "XPAR")]) + "</Doc>"
    records = venues.firds_records(spark, put(tmp_path, "f.xml", xml))
    assert records.count() == 6
    markets = spark.createDataFrame([("XPAR", "Paris", "FR"), ("XAMS", "Amsterdam", "NL")], "mic string, venue_name string, venue_country string")
    funds, lines = venues.firds(records, markets)
    assert rows(funds, "isin", "name", "domicile", "distribution_policy", "asset_class") == sorted([(A, "Fund A", "IE", "accumulating", "equity"), (B, "Fund B", "FR", "distributing", "bond")])
    assert rows(lines, "isin", "exchange_mic", "trading_currency", "is_primary") == sorted([(A, "XPAR", "EUR", True), (B, "XAMS", "EUR", False), (B, "XPAR", "USD", True)])
    assert (A, "L1") in rows(venues.issuer_leis(records), "isin", "lei") and B in {x for x, _ in rows(venues.issuer_leis(records), "isin", "lei")}


def test_euronext_and_xetra(spark, tmp_path):
    lines = ["﻿\"Instrument Fullname\";\"ESG Classification\";Name;ISIN;Symbol;Market;Currency", '"European Trackers"', '"3 Feb 2026"', '"note"', f'"Fund A";"ESG ETF art. 8";FA;{A};AAA;"Euronext Paris";EUR', f'"Fund A";-;FA;{A};AAB;"Euronext Amsterdam, Brussels";USD', f'Bad;-;BAD;{BAD};X;"Euronext Paris";EUR', f'Other;-;O;{B};O;"Elsewhere";EUR']
    table = text.delimited(spark, put(tmp_path, "e.csv", "\n".join(lines)), ";", skip_after=3, needed=["ISIN", "Market"])
    funds, listed = venues.euronext(table, {"Euronext Paris": ["XPAR"], "Euronext Amsterdam, Brussels": ["XAMS", "XBRU"]})
    assert rows(funds, "isin", "name") == [(A, "Fund A")]
    assert rows(listed, "exchange_mic", "ticker", "is_primary") == [("XAMS", "AAB", False), ("XBRU", "AAB", False), ("XPAR", "AAA", True)]
    assert [r[0] for r in rows(text.split_valid(table, "ISIN")[1], "ISIN")] == [BAD]

    head = "Product Status;Instrument Status;Instrument;ISIN;Mnemonic;MIC Code;Product Assignment Group Description;Instrument Type;Primary Market MIC Code;Currency"
    body = [f"A;A;FUND A;{A};FA;XETR;EXCHANGE TRADED FUNDS - RENTEN;ETF;XETR;EUR", f"A;A;GOLD;{B};G;XETR;EXCHANGE TRADED COMMODITIES;ETC;XAMS;USD", f"A;A;ACTIVE;{C};AC;XETR;EXCHANGE TRADED FUNDS - AKTIV;ETF;;EUR", f"A;A;SHARE;{U};S;XETR;DAX;CS;XETR;EUR"]
    table = text.delimited(spark, put(tmp_path, "x.csv", "\n".join(["Market: XETR", "Date", head, *body])), ";", skip_before=2)
    funds, listed = venues.xetra(table)
    assert rows(funds, "isin", "asset_class", "strategy") == sorted([(A, "bond", "unknown"), (B, "commodity", "unknown"), (C, "unknown", "active")])
    assert rows(listed, "isin", "is_primary") == sorted([(A, True), (B, False), (C, False)])


def test_nested_pages_of_any_depth(spark, tmp_path):
    item = lambda isin, tidm, ccy: {"isin": isin, "tidm": tidm, "name": f"N {tidm}", "issuername": "I", "currency": ccy, "category": "ETF"}
    deep = {"rows": [item(B, "DEEP", "USD")]}
    for k in range(30):
        deep = {f"level{k}": [{"x": k}, deep]}
    page = {"components": [{"content": [{"value": {"content": [item(A, "AAA", "USD"), item(A, "ZZZ", "GBX"), item(BAD, "B", "GBP")]}}]}, deep]}
    found = venues.lse_rows(spark, put(tmp_path, "p.json", json.dumps(page, indent=1)))
    assert rows(found, "isin", "tidm") == sorted([(A, "AAA"), (A, "ZZZ"), (B, "DEEP"), (BAD, "B")])
    funds, lines = venues.lse(found)
    assert rows(lines, "isin", "ticker", "trading_currency") == sorted([(A, "ZZZ", "GBX"), (B, "DEEP", "USD")]) and funds.count() == 2


def test_six_and_us(spark, tmp_path):
    head = "ISIN;ValorSymbol;ShortName;FundLongName;IssuerNameFull;TradingCurrency;FundCurrency;ManagementFee;MarketCode"
    body = [f"{A};AU;S;Fünd A;Iss;USD;CHF;0.20;XSWX", f"{A};AC;S;Fünd A;Iss;CHF;CHF;0.20;XSWX", f"{B};B;S;Fund B;Iss;EUR;EUR;;XSWX"]
    table = text.delimited(spark, put(tmp_path, "s.csv", "\n".join([head, *body]), "latin-1"), ";", encoding="ISO-8859-1")
    funds, lines = venues.six(table)
    assert [(i, n, t and round(t, 6)) for i, n, t in rows(funds, "isin", "name", "ter")] == sorted([(A, "Fünd A", 0.002), (B, "Fund B", None)])
    assert rows(lines, "isin", "ticker") == sorted([(A, "AC"), (B, "B")])

    head = "Nasdaq Traded|Symbol|Security Name|Listing Exchange|Market Category|ETF|Round Lot Size|Test Issue|Financial Status|CQS Symbol|NASDAQ Symbol|NextShares"
    line = lambda sym, venue="P", etf="Y", test="N": f"Y|{sym}|{sym} Trust|{venue}| |{etf}|100|{test}||{sym}|{sym}|N"
    table = venues.us_directory(spark, put(tmp_path, "n.txt", "\n".join([head, line("AAA"), line("B.B", "Q"), line("CCC"), line("STK", etf="N"), line("TST", test="Y"), line("ODD", "?"), "torn|line", "File Creation Time: 1|||||||||||"])))
    sure = spark.createDataFrame([("aaa", U), ("CCC", B), ("B.B", BAD)], "ticker string, isin string")
    funds, lines = venues.us(table, sure)
    assert rows(lines, "isin", "yahoo_ticker") == sorted([(U, "AAA"), ("US:XNAS:B.B", "B-B"), ("US:ARCX:CCC", "CCC")])
    with pytest.raises(ValueError):
        venues.us_directory(spark, put(tmp_path, "bad.txt", "a|b\n1|2"))


def test_names_of_managers_listings_and_quotes(spark):
    leis = spark.createDataFrame([(A, "F1"), (B, "F2")], "isin string, lei string")
    relations = spark.createDataFrame([("F1", "M1", "IS_FUND-MANAGED_BY", "ACTIVE"), ("F1", "M2", "IS_FUND-MANAGED_BY", "ACTIVE"), ("F2", "M2", "IS_FUND-MANAGED_BY", "INACTIVE")], "fund_lei string, manager_lei string, relation string, status string")
    assert rows(venues.manager_names(leis, relations, spark.createDataFrame([("M1", "First"), ("M2", "Second")], "lei string, legal_name string")), "isin", "issuer") == [(A, "First")]
    mapped = spark.createDataFrame([(A, [("GY", "a"), ("GY", "b"), ("??", "c"), ("FP", "d")])], "isin string, records array<struct<exchCode:string,ticker:string>>")
    assert rows(venues.mapped_listings(mapped, {"GY": "XETR", "FP": "XPAR"}), "exchange_mic", "ticker") == [("XETR", "a"), ("XPAR", "d")]
    quotes = spark.createDataFrame([("A.PA", "A", "XPAR", 0, None, 5.0), ("X.DE", "X", "XETR", 1, 0.2, None), ("Z", "Z", "XETR", 2, 0.3, 1.0)], "symbol string, root string, mic string, seq int, ter double, aum double")
    symbols = spark.createDataFrame([("A.PA", A), ("X.DE", A), ("X.DE", B)], "yahoo_ticker string, isin string")
    listings = spark.createDataFrame([("x", "XETR", A)], "ticker string, exchange_mic string, isin string")
    found = venues.resolve_quotes(quotes, symbols, listings)
    assert rows(found, "symbol", "isin") == sorted([("A.PA", A), ("X.DE", A), ("Z", None)], key=repr)
    assert rows(registers.first_figures(found), "isin", "ter", "aum") == [(A, 0.2, 5.0)]
    assert [r[0] for r in spark.createDataFrame([("0.2",), ("0",), ("30",), ("x",)], "f string").select(venues.fee(F.col("f"))).collect()] == [0.002, None, None, None]


def test_caches_zips_and_listings(spark, tmp_path):
    path = put(tmp_path, "map.jsonl", f'{{"isin": "{A}", "records": [{{"exchCode": "GY", "ticker": "a"}}]}}\n{{"isin": "{B}", "records": []}}\n{{"isin": "{A}", "records": [{{"exchCode": "FP", "ticker": "b"}}]}}\n{{"isin": "{C}", "rec')
    cache = registers.mapping_cache(spark, path)
    assert {r["isin"]: sorted(x.ticker for x in r.records) for r in cache.collect()} == {A: ["a", "b"], B: []}
    assert rows(registers.unmapped(spark.createDataFrame([(A,), (B,), (C,), (C,)], "isin string"), cache), "isin") == [(C,)]
    with zipfile.ZipFile(tmp_path / "g.zip", "w") as z:
        z.writestr("golden.csv", "LEI,Legal Name,More\nL1,Name One,x\nL2,,y\n")
    assert rows(registers.zipped_csv(spark, str(tmp_path / "g.zip"), ["LEI", "Legal Name"], str(tmp_path / "un")), "LEI", "Legal Name") == [("L1", "Name One"), ("L2", None)]
    docs = [{"file_name": "FULINS_C_1", "publication_date": "2026-01-01", "download_link": "old"}, {"file_name": "FULINS_C_2", "publication_date": "2026-02-01", "download_link": "new"}, {"file_name": "FULINS_D_3", "publication_date": "2026-03-01", "download_link": "no"}]
    assert registers.newest(json.dumps({"response": {"docs": docs}})) == "new" and registers.newest("{}") is None


def test_rates_loader(spark, tmp_path):
    wide = put(tmp_path, "w.csv", "Date, USD, CYP,\n2024-01-02, 1.10, N/A,\n2024-01-03, 1.11, 0.58,\n")
    assert rows(rates.wide_file(spark, wide), "date", "currency", "rate_to_eur") == [(D(2024, 1, 2), "USD", 1.10), (D(2024, 1, 3), "CYP", 0.58), (D(2024, 1, 3), "USD", 1.11)]
    dated = put(tmp_path, "d.json", json.dumps({"rates": {"2024-01-02": {"usd": 1.1}, "2024-01-03": {"USD": 1.2, "GBP": 0.8}}}, indent=1))
    assert rows(rates.dated_json(spark, dated), "date", "currency", "rate_to_eur") == [(D(2024, 1, 2), "USD", 1.1), (D(2024, 1, 3), "GBP", 0.8), (D(2024, 1, 3), "USD", 1.2)]

    def down(spark):
        raise OSError("down")

    weekend = lambda s: s.createDataFrame([(D(2024, 1, 6), "USD", 1.0)], "date date, currency string, rate_to_eur double")
    cache = str(tmp_path / "cache")
    got = rates.load(spark, [down, weekend, lambda s: rates.dated_json(s, dated)], cache)
    assert (D(2024, 1, 3), "USD", 1.2) in rows(got, "date", "currency", "rate_to_eur") and got.where("currency = 'DEM'").count() == 1
    assert rows(rates.load(spark, [down], cache), "date", "currency") == rows(got, "date", "currency")
    assert [r for r in rows(rates.latest(got), "currency", "rate_to_eur") if r[0] == "USD"] == [("USD", 1.2)]
    with pytest.raises(ValueError, match="down.*weekend"):
        rates.load(spark, [down, weekend])


def test_evidence_files(spark, tmp_path):
    put(tmp_path, "evidence/euronext_pea_yes.csv", f'﻿"Instrument Fullname";ISIN;Symbol\n"European Trackers"\n"3 Feb 2026"\n"note"\n"Fund A";{A};AAA\n"Bad";{BAD};B\n')
    put(tmp_path, "evidence/ishares_pea.csv", f"isin,ticker,replication,source_url\n{A},X,Physique / totale,https://www.blackrock.com/1\n{B},Y,Indirect(Swap Based),https://www.blackrock.com/2\n")
    put(tmp_path, "evidence/broker_lists.csv", f"isin,source_url\n{C},https://www.fortuneo.fr/a\n{C},https://home.saxo/s\n")
    put(tmp_path, "evidence/community_lists.csv", f"isin,source_url\n{C},https://www.boursedirect.fr/b\n")
    put(tmp_path, "evidence/prospectus_pea.csv", f"isin,source_url,as_of\n{B},https://docs/1,2025-05-05\n")
    put(tmp_path, "evidence/dropped_not_etf.txt", f"{U} a certificate\nno code\n")
    put(tmp_path, "evidence/xtrackers_full_universe_no_pea_flag.csv", f"isin,source_url\n{U},https://etf.dws.com/x\n")
    D1, D2 = ("IE00DDDDDD1", "IE00EEEEEE1")
    D1, D2 = D1 + digit(D1), D2 + digit(D2)
    put(tmp_path, "pea_eligible.csv", f'isin,name,replication,source_url\n{D1},"One, two",Physical,https://a.blog.org/1\n# --- unverified below ---\nisin,name,replication,source_url\n{D2},Two,,https://a.blog.org/0\n# other remark\n')
    got = evidence.load(spark, str(tmp_path))
    assert rows(got.rejected, "isin") == [(BAD,)] and rows(got.not_etf, "isin") == [(U,)] and rows(got.unflagged, "isin") == [(U,)]
    told = {(r["isin"], r.provider): (r.kind, r.url, r.as_of) for r in got.rows.collect()}
    assert told[A, "euronext"] == ("venue", evidence.VENUE_URL, D(2026, 2, 3))
    assert told[A, "ishares"] == told[B, "ishares"] == ("issuer", "https://www.blackrock.com/1", D(2026, 8, 10))
    assert told[C, "saxo"] == ("stale", "https://home.saxo/s", D(2025, 3, 20)) and told[B, "prospectus"] == ("prospectus", "https://docs/1", D(2025, 5, 5))
    assert told[D1, "seed_verified"][0] == "seed_verified" and (D2, "seed_verified") not in told and told[D2, "blog-a.blog.org"][1] == "https://a.blog.org/1"
    assert rows(got.replication, "isin", "stated") == sorted([(A, "physical-full"), (B, "synthetic-swap"), (D1, "physical-full")])
    funds = spark.createDataFrame([(i, "Fund") for i in (A, B, C, D1, D2, U)], "isin string, name string")
    made = {r["isin"]: r for r in eligibility.verdicts(funds, got.rows, "2026-08-10", got.replication).collect()}
    assert [(made[i].pea_confidence, made[i].pea_reason, made[i].pea_mechanism) for i in (A, B, C, D1, D2, U)] == [("high", "venue_flag", "physical_eu"), ("highest", "prospectus_or_dic", "synthetic_swap"), ("medium", "brokers_corroborated", "unknown"), ("low", "seed_verified", "physical_eu"), ("hint", "seed_unverified", "unknown"), ("high", "domicile_outside_eea", "unknown")]
    assert made[C].pea_source == "https://www.boursedirect.fr/b"  # read on the same day as the other: by name
    assert "bought" in made[U].cto_note and made[D2].cto_note is None
    assert rows(evidence.load(spark, str(tmp_path / "nowhere")).rows, "isin") == []


def test_sources_run_in_order_and_fail_alone(spark, tmp_path):
    seen = []

    def source(name, **values):
        def fetch(spark, isins=None):
            seen.append((name, sorted(r["isin"] for r in isins.collect()) if isins is not None else None))
            funds = spark.createDataFrame([(A, values.get("funds", name), values.get("day"))], "isin string, name string, last_updated date")
            return funds, spark.createDataFrame([(A, values.get("mic", "XETA"), name)], "isin string, exchange_mic string, ticker string")

        return fetch

    def broken(refresh):
        raise OSError(f"down {refresh}")

    def late(spark):  # fails only when it is read
        bad = spark.createDataFrame([(A,)], "isin string").withColumn("name", F.raise_error(F.lit("torn")))
        return bad, spark.createDataFrame([], "isin string")

    registry = adapters.Registry()
    for a in (adapters.Adapter("late", 95, late), adapters.Adapter("weak", 10, source("weak", day=D(2026, 1, 2))), adapters.Adapter("strong", 90, source("strong", day=D(2026, 1, 1), mic="XETR")), adapters.Adapter("after", 50, source("after"), ("weak", "absent")), adapters.Adapter("broken", 99, broken)):
        registry.add(a)
    with pytest.raises(KeyError):
        registry.select(["nobody"])
    with pytest.raises(ValueError):
        registry.add(adapters.Adapter("weak", 1, broken))
    assert [[a.name for a in w] for w in adapters.plan(registry.select())] == [["broken", "late", "strong", "weak"], ["after"]]
    loop = [adapters.Adapter("x", 1, broken, ("y",)), adapters.Adapter("y", 2, broken, ("x",)), adapters.Adapter("z", 0, broken)]
    assert [[a.name for a in w] for w in adapters.plan(loop)] == [["z"], ["y", "x"]]
    results = adapters.run(spark, registry.select(), str(tmp_path), refresh=True)
    assert seen == [("strong", None), ("weak", None), ("after", [A])]
    assert {r.name: r.ok for r in results} == {"late": False, "broken": False, "strong": True, "weak": True, "after": True}
    assert [r.error for r in results if r.name == "broken"] == ["OSError: down True"]
    funds, listings, provenance = adapters.merge(spark, results)
    assert rows(funds, "isin", "name", "last_updated") == [(A, "strong", D(2026, 1, 2))]
    assert rows(listings, "exchange_mic", "ticker", "is_primary") == [("XETR", "strong", True)]
    assert [r.source for r in adapters.report(spark, results).collect()] == ["broken", "late", "strong", "after", "weak"]
    publish.write_provenance(provenance, adapters.report(spark, results), str(tmp_path / "out"))
    assert publish.read_json(spark, f"{tmp_path}/out/provenance.json")["fields_won"] == [{"source": "strong", "name": 1}]
    with pytest.raises(ValueError, match="broken: OSError"):
        adapters.merge(spark, [r for r in results if not r.ok])


def test_export(spark, tmp_path):
    root = str(tmp_path / "out")
    funds = spark.createDataFrame([(B, "b"), (A, "a")], "isin string, name string")
    index = spark.createDataFrame([(A, D(2024, 1, 5), 100.0), (A, D(2024, 1, 12), 101.0)], "isin string, date date, tr_index double")
    assert publish.export(spark, {"funds": funds}, root, "2026-01-01", index)["index"] == {"rows": 2, "funds": 1}
    assert publish.export(spark, {"funds": funds.limit(1)}, root, "2026-01-02") == {"as_of": "2026-01-02", "synthetic": False, "tables": {"funds": 1}, "index": {"rows": 2, "funds": 1}}
    assert publish.read_json(spark, f"{root}/manifest.json")["as_of"] == "2026-01-02" and publish.read_json(spark, f"{root}/none.json") is None
    with pytest.raises(ValueError):
        publish.export(spark, {}, root, "2026-01-01", index.withColumnRenamed("tr_index", "close"))
    bars = spark.createDataFrame([(A, D(2024, 1, k), 10.0) for k in (1, 2, 3)], "isin string, date date, close double")
    actions = spark.createDataFrame([(A, D(2024, 1, 3), "dividend", 1.0, None)], "isin string, date date, kind string, amount double, ratio double")
    publish.single_file(bars, f"{root}/bars", actions)
    assert [r.adj_close for r in spark.read.parquet(f"{root}/bars").orderBy("date").collect()] == pytest.approx([9.0, 9.0, 10.0])
    assert len([p for p in (tmp_path / "out" / "bars").iterdir() if p.suffix == ".parquet"]) == 1
    with pytest.raises(ValueError):
        publish.single_file(bars, f"{root}/bars")


def test_actions_rounds_and_retries(spark, tmp_path):
    make = lambda *r: spark.createDataFrame(r, "isin string, date date, kind string, amount double, ratio double")
    path = str(tmp_path / "actions")
    store.upsert_actions(spark, make((A, D(2024, 1, 1), "dividend", 1.0, None), (A, D(2024, 1, 1), "split", None, 2.0)), path)
    store.upsert_actions(spark, make((A, D(2024, 1, 1), "dividend", 3.0, None), (B, D(2024, 1, 2), "dividend", 1.0, None)), path)
    assert rows(spark.read.parquet(path), "isin", "kind", "amount") == sorted([(A, "dividend", 3.0), (A, "split", None), (B, "dividend", 1.0)], key=repr)
    candidates = spark.createDataFrame([(A, 0, "a0"), (B, 0, "b0"), (B, 1, "b1"), (C, 0, "c0"), (C, 1, "c1"), (C, 2, "c2")], "isin string, rank int, yahoo_ticker string")
    good = {"a0", "b1", "c2"}
    fetch = lambda c: c.where(F.col("yahoo_ticker").isin(*good)).select("isin", F.lit(D(2024, 1, 1)).alias("date"), F.lit(1.0).alias("close"))
    assert store.rounds(spark, candidates, fetch, str(tmp_path / "bars"), 9) == [3, 2, 1, 0]
    assert rows(store.read(spark, str(tmp_path / "bars")), "isin") == sorted([(A,), (B,), (C,)])
    asked = []

    def transport(symbol, start, end):
        asked.append(symbol)
        if symbol == "gone":
            raise charts.Refused(404)
        if len(asked) < 3:
            raise charts.Refused(503 if len(asked) == 1 else None)
        return "ok"

    again = charts.Retrying(transport, 3, 0.0)
    assert again("x", 0, 1) == "ok" and len(asked) == 3
    with pytest.raises(charts.Refused):
        again("gone", 0, 1)
    assert len(asked) == 4


def test_benchmark_of_the_panel(spark):
    panel = stats.clean(spark.createDataFrame([(i, D(2020, 1, 1) + datetime.timedelta(days=k), 10.0 + (k * 7 + len(i)) % 5, 10.0 + (k * 7 + len(i)) % 5) for i in ("W", "XX") for k in range(1300)], "isin string, date date, close double, adj_close double"))
    got = {r["isin"]: r for r in stats.performance(panel, stats.own_benchmark(panel, "W")).collect()}
    assert got["W"].beta_vs_world == pytest.approx(1) and got["W"].correlation_vs_world == pytest.approx(1) and got["XX"].beta_vs_world != pytest.approx(1)
    assert stats.performance(panel, stats.own_benchmark(panel, "none")).where("beta_vs_world IS NOT NULL").isEmpty()
    # two values a day count once, as their mean
    twice = stats.own_benchmark(panel, "W").unionByName(stats.own_benchmark(panel, "W"))
    assert {r["isin"]: r.history_days for r in stats.performance(panel, twice).collect()} == {"W": 1300, "XX": 1300}


def test_one_exchange_and_one_sort(spark):
    """The statistics' plan: what scale depends on."""
    bars = spark.range(10).select(F.col("id").cast("string").alias("isin"), F.current_date().alias("date"), F.lit(1.0).alias("close"), F.lit(1.0).alias("adj_close"), F.lit("EUR").alias("currency"))
    plan = stats.performance(stats.clean(bars))._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1 and "SortAggregate" not in plan
