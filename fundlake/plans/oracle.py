"""SQL that gives the rows of the driver queries, formulated on its own."""

from __future__ import annotations

BARS = """
raw AS (SELECT CAST(l_suppkey AS VARCHAR) AS isin, CAST(l_shipdate AS DATE) AS date, l_extendedprice / l_quantity AS close, l_quantity AS volume,
  CASE s_nationkey % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CHF' ELSE 'JPY' END AS currency,
  l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_returnflag, l_linestatus, l_tax
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
bars AS (SELECT isin, date, close, volume, currency FROM (SELECT *, row_number() OVER (PARTITION BY isin, date ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn FROM raw) WHERE rn = 1)
"""
PANEL = BARS + """,
panel AS (SELECT isin, date, close, ln(close) AS logp FROM bars),
ends AS (SELECT isin, min(date) AS d0, max(date) AS d1, count(*) AS n FROM panel GROUP BY isin)
"""
WINDOWS = {"1d": "d1 - INTERVAL 1 DAY", "1w": "d1 - INTERVAL 7 DAY", "1m": "d1 - INTERVAL 1 MONTH", "3m": "d1 - INTERVAL 3 MONTH", "6m": "d1 - INTERVAL 6 MONTH", "1y": "d1 - INTERVAL 12 MONTH", "3y": "d1 - INTERVAL 36 MONTH", "5y": "d1 - INTERVAL 60 MONTH", "10y": "d1 - INTERVAL 120 MONTH", "ytd": "date_trunc('year', d1) - INTERVAL 1 DAY"}


def _anchors(*names: str) -> str:
    """A CTE a_<w> (isin, day, logp) for each window: the last bar on or before its target."""
    return "".join(f""",
a_{w} AS (SELECT isin, date AS day, logp FROM (SELECT p.isin, p.date, p.logp, row_number() OVER (PARTITION BY p.isin ORDER BY p.date DESC) AS rn FROM panel p JOIN ends e ON e.isin = p.isin WHERE p.date <= CAST({WINDOWS[w]} AS DATE)) WHERE rn = 1)""" for w in names)


_LAST = """,
z AS (SELECT p.isin, p.logp AS l1, p.close AS c1 FROM panel p JOIN ends e ON e.isin = p.isin AND e.d1 = p.date),
f AS (SELECT p.isin, p.logp AS l0 FROM panel p JOIN ends e ON e.isin = p.isin AND e.d0 = p.date)"""


def _joins(*names: str) -> str:
    return "".join(f" LEFT JOIN a_{w} ON a_{w}.isin = ends.isin" for w in names)


ORACLE: dict[str, str] = {}
_W = ("1d", "1w", "1m", "3m", "6m", "ytd", "1y", "3y", "5y", "10y")
ORACLE["trailing_returns"] = f"WITH {PANEL}{_anchors(*_W)}{_LAST} SELECT ends.isin, " + ", ".join(f"round(exp(l1 - a_{w}.logp) - 1, 8) AS ret_{w}" for w in _W) + f", CASE WHEN n > 1 THEN round(exp(l1 - l0) - 1, 8) END AS ret_max FROM ends JOIN z ON z.isin = ends.isin JOIN f ON f.isin = ends.isin{_joins(*_W)}"
ORACLE["cagr"] = f"WITH {PANEL}{_anchors('3y', '5y', '10y')}{_LAST} SELECT ends.isin, round(exp((l1 - a_3y.logp) / 3) - 1, 8) AS cagr_3y, round(exp((l1 - a_5y.logp) / 5) - 1, 8) AS cagr_5y, round(exp((l1 - a_10y.logp) / 10) - 1, 8) AS cagr_10y, CASE WHEN datediff('day', d0, d1) / 365.25 >= 1 THEN round(exp((l1 - l0) / (datediff('day', d0, d1) / 365.25)) - 1, 8) END AS cagr_inception FROM ends JOIN z ON z.isin = ends.isin JOIN f ON f.isin = ends.isin{_joins('3y', '5y', '10y')}"
_RET = """,
r AS (SELECT isin, date, logp, logp - lag(logp) OVER (PARTITION BY isin ORDER BY date) AS r FROM panel)"""


def _vol(w: str) -> str:
    return f""",
v_{w} AS (SELECT r.isin, stddev_samp(r.r) * sqrt(252.0) AS vol, count(r.r) AS m, sqrt(avg(pow(least(r.r - ln(1.025) / 252, 0), 2))) * sqrt(252.0) AS down FROM r JOIN a_{w} ON a_{w}.isin = r.isin WHERE r.date > a_{w}.day GROUP BY r.isin)"""


_V = ("1y", "3y", "5y")
ORACLE["volatility"] = f"WITH {PANEL}{_anchors(*_V)}{_RET}{''.join(map(_vol, _V))} SELECT ends.isin, " + ", ".join(f"round(CASE WHEN v_{w}.m >= 2 THEN v_{w}.vol END, 8) AS vol_{w}" for w in _V) + " FROM ends" + "".join(f" LEFT JOIN v_{w} ON v_{w}.isin = ends.isin" for w in _V)
ORACLE["sharpe_sortino"] = f"WITH {PANEL}{_anchors(*_V)}{_RET}{''.join(map(_vol, _V))}{_LAST} SELECT ends.isin, " + ", ".join(f"round(CASE WHEN v_{w}.m >= 2 AND v_{w}.vol > 1e-5 THEN (exp((l1 - a_{w}.logp) / {w[0]}) - 1 - 0.025) / v_{w}.vol END, 8) AS sharpe_{w}" for w in _V) + ", round(CASE WHEN v_3y.m >= 2 AND v_3y.down > 1e-5 THEN (exp((l1 - a_3y.logp) / 3) - 1 - 0.025) / v_3y.down END, 8) AS sortino_3y FROM ends JOIN z ON z.isin = ends.isin" + _joins(*_V) + "".join(f" LEFT JOIN v_{w} ON v_{w}.isin = ends.isin" for w in _V)


def _dd(w: str) -> str:
    return f""",
d_{w} AS (SELECT isin, min(x) AS dd, count(*) AS m FROM (SELECT p.isin, exp(p.logp - max(p.logp) OVER (PARTITION BY p.isin ORDER BY p.date ROWS UNBOUNDED PRECEDING)) - 1 AS x FROM panel p JOIN a_{w} ON a_{w}.isin = p.isin WHERE p.date >= a_{w}.day) GROUP BY isin)"""


_ALL_DD = """,
dd AS (SELECT isin, date, exp(logp - max(logp) OVER (PARTITION BY isin ORDER BY date ROWS UNBOUNDED PRECEDING)) - 1 AS x FROM panel)"""
ORACLE["drawdown"] = f"WITH {PANEL}{_anchors(*_V)}{''.join(map(_dd, _V))}{_ALL_DD} SELECT ends.isin, " + ", ".join(f"round(d_{w}.dd, 8) AS max_drawdown_{w}" for w in _V) + ", round((SELECT min(x) FROM dd WHERE dd.isin = ends.isin), 8) AS max_drawdown_max, round(now.x, 8) AS current_drawdown FROM ends JOIN dd now ON now.isin = ends.isin AND now.date = ends.d1" + "".join(f" LEFT JOIN d_{w} ON d_{w}.isin = ends.isin" for w in _V)
ORACLE["full_history_shape"] = f"WITH {PANEL}{_ALL_DD}, top AS (SELECT isin, max(close) AS ath, max(logp) AS lt FROM panel GROUP BY isin), day AS (SELECT p.isin, min(p.date) AS ath_date FROM panel p JOIN top ON top.isin = p.isin AND p.logp = top.lt GROUP BY p.isin) SELECT ends.isin, CAST(n AS INTEGER) AS history_days, d0 AS history_start, d1 AS price_date, round(b.close, 8) AS price_last, round(ath, 8) AS ath, ath_date, round(now.x, 8) AS distance_from_ath, b.currency AS base_currency FROM ends JOIN top ON top.isin = ends.isin JOIN day ON day.isin = ends.isin JOIN dd now ON now.isin = ends.isin AND now.date = d1 JOIN bars b ON b.isin = ends.isin AND b.date = d1"
ORACLE["bars_clean"] = f"WITH {BARS} SELECT isin, date, round(close, 8) AS close, currency FROM bars"
ORACLE["thin_gate"] = f"WITH {PANEL}{_anchors('1y')}{_RET}{_vol('1y')}{_LAST} SELECT ends.isin, CAST(n AS INTEGER) AS history_days, d1 AS price_date, CASE WHEN n >= 550 THEN round(exp(l1 - a_1y.logp) - 1, 8) END AS ret_1y, CASE WHEN n >= 550 AND v_1y.m >= 2 THEN round(v_1y.vol, 8) END AS vol_1y FROM ends JOIN z ON z.isin = ends.isin LEFT JOIN a_1y ON a_1y.isin = ends.isin LEFT JOIN v_1y ON v_1y.isin = ends.isin"
ORACLE["beta_corr"] = f"""WITH {PANEL}{_anchors('3y')}, world AS (SELECT date, avg(logp) AS w FROM panel GROUP BY date),
s AS (SELECT p.isin, p.logp - lag(p.logp) OVER (PARTITION BY p.isin ORDER BY p.date) AS y, w - lag(w) OVER (PARTITION BY p.isin ORDER BY p.date) AS x FROM panel p JOIN a_3y ON a_3y.isin = p.isin JOIN world ON world.date = p.date WHERE p.date >= a_3y.day),
m AS (SELECT isin, count(*) AS n, covar_samp(y, x) AS c, var_samp(x) AS vx, var_samp(y) AS vy FROM s GROUP BY isin)
SELECT isin, CASE WHEN n > 60 AND vx > 0 THEN round(c / vx, 8) END AS beta_vs_world, CASE WHEN n > 60 AND vx > 0 AND sqrt(vy) * sqrt(252.0) > 1e-5 THEN round(c / sqrt(vx * vy), 8) END AS correlation_vs_world FROM m"""


def _periods(unit: str) -> str:
    return f""",
pe AS (SELECT isin, date_trunc('{unit}', date) AS start, max(date) AS e, min(date) AS b, count(*) AS k FROM panel GROUP BY isin, date_trunc('{unit}', date)),
pl AS (SELECT pe.isin, pe.start, pe.k, x.logp AS l, y.logp AS f FROM pe JOIN panel x ON x.isin = pe.isin AND x.date = pe.e JOIN panel y ON y.isin = pe.isin AND y.date = pe.b),
pr AS (SELECT isin, start, exp(l - CASE WHEN lag(l) OVER w IS NOT NULL THEN lag(l) OVER w WHEN k > 1 THEN f END) - 1 AS ret, row_number() OVER w = 1 OR row_number() OVER (PARTITION BY isin ORDER BY start DESC) = 1 AS partial FROM pl WINDOW w AS (PARTITION BY isin ORDER BY start))"""


ORACLE["monthly_returns"] = f"WITH {PANEL}{_periods('month')} SELECT isin, CAST(year(start) AS SMALLINT) AS year, CAST(month(start) AS TINYINT) AS month, round(ret, 8) AS ret, partial FROM pr"
ORACLE["yearly_returns"] = f"WITH {PANEL}{_periods('year')} SELECT isin, CAST(year(start) AS SMALLINT) AS year, round(ret, 8) AS ret, partial FROM pr"
ORACLE["monthly_distribution"] = f"WITH {PANEL}{_periods('month')} SELECT isin, round(max(ret), 8) AS best_month, round(min(ret), 8) AS worst_month, round(avg(CASE WHEN ret > 0 THEN 1.0 ELSE 0.0 END), 8) AS positive_months_pct FROM pr WHERE NOT partial AND ret IS NOT NULL GROUP BY isin"
ORACLE["monthly_grid"] = f"WITH {PANEL}{_periods('month')} SELECT isin, CAST(year(start) AS SMALLINT) AS year, " + ", ".join(f"round(max(CASE WHEN month(start) = {m} THEN ret END), 8) AS m{m}" for m in range(1, 13)) + " FROM pr GROUP BY isin, year(start)"
ORACLE["fund_detail"] = f"WITH {PANEL}{_periods('month')} SELECT isin, CAST(year(start) AS SMALLINT) AS year, CAST(month(start) AS TINYINT) AS month, round(ret, 8) AS ret, partial FROM pr WHERE isin = '7'"

RATES = """
rates AS (SELECT CAST(o_orderdate AS DATE) AS date, CASE o_custkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'GBP' WHEN 2 THEN 'CHF' ELSE 'JPY' END AS currency, avg(o_totalprice) / 100000 AS rate FROM orders GROUP BY 1, 2)
"""
# the last rate on or before the bar, by a running maximum of publication days
EUR = BARS + "," + RATES + """,
days AS (SELECT DISTINCT currency, date FROM bars UNION SELECT currency, date FROM rates),
seen AS (SELECT d.currency, d.date, max(r.date) OVER (PARTITION BY d.currency ORDER BY d.date ROWS UNBOUNDED PRECEDING) AS rate_date FROM days d LEFT JOIN rates r ON r.currency = d.currency AND r.date = d.date),
latest AS (SELECT s.currency, s.date, r.rate FROM seen s JOIN rates r ON r.currency = s.currency AND r.date = s.rate_date WHERE datediff('day', s.rate_date, s.date) <= 10)
"""
ORACLE["fx_melt"] = f"WITH {RATES} SELECT date, currency, round(rate, 12) AS rate_to_eur FROM rates"
ORACLE["fx_problems"] = f"WITH {RATES} SELECT 'published on a weekend' AS problem, count(*) AS n FROM rates WHERE isodow(date) >= 6"
ORACLE["fx_asof_convert"] = f"WITH {EUR} SELECT b.isin, b.date, CASE WHEN b.currency = 'EUR' THEN round(b.close, 7) ELSE round(b.close / a.rate, 5) END AS close, 'EUR' AS currency, round(CASE WHEN b.currency = 'EUR' THEN 1.0 ELSE a.rate END, 12) AS rate_to_eur FROM bars b LEFT JOIN latest a ON a.currency = b.currency AND a.date = b.date"
ORACLE["fx_missing_rates"] = f"WITH {EUR} SELECT b.isin, count(*) FILTER (WHERE b.currency <> 'EUR' AND a.rate IS NULL) AS rows_without_rate FROM bars b LEFT JOIN latest a ON a.currency = b.currency AND a.date = b.date GROUP BY b.isin"
ORACLE["fx_coverage"] = f"WITH {RATES}, q(quoted_as, currency, unit) AS (VALUES ('EUR', 'EUR', 1.0), ('usd', 'USD', 1.0), ('GBp', 'GBP', 0.01), ('GBP', 'GBP', 1.0), ('GBX', 'GBP', 0.01), ('JPY', 'JPY', 1.0), ('SEK', 'SEK', 1.0)) SELECT quoted_as, q.currency, CAST(unit AS DOUBLE) AS unit, q.currency = 'EUR' OR count(r.date) > 0 AS supported, min(r.date) AS first_rate, max(r.date) AS last_rate, count(r.date) AS observations FROM q LEFT JOIN rates r ON r.currency = q.currency GROUP BY quoted_as, q.currency, unit"
EVENTS = """,
events AS (SELECT isin, date, kind, amount, ratio FROM (SELECT *, row_number() OVER (PARTITION BY isin, date, kind ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn FROM (
  SELECT isin, date, 'dividend' AS kind, l_tax * 10 AS amount, CAST(NULL AS DOUBLE) AS ratio, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity FROM raw WHERE l_returnflag = 'R'
  UNION ALL SELECT isin, date, 'split', CAST(NULL AS DOUBLE), 2.0, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity FROM raw WHERE l_linestatus = 'O' AND l_quantity = 1)) WHERE rn = 1),
spans AS (SELECT isin, date, close, lead(date) OVER (PARTITION BY isin ORDER BY date) AS nxt FROM bars),
placed AS (SELECT e.*, s.date AS placed_at, s.close AS ref FROM events e LEFT JOIN spans s ON s.isin = e.isin AND s.date < e.date AND e.date <= s.nxt)
"""
ORACLE["dividends_in_eur"] = f"WITH {EUR}{EVENTS}, home AS (SELECT isin, max(currency) AS currency FROM bars GROUP BY isin), d2 AS (SELECT DISTINCT h.currency, e.date FROM events e JOIN home h ON h.isin = e.isin UNION SELECT currency, date FROM rates), s2 AS (SELECT d.currency, d.date, max(r.date) OVER (PARTITION BY d.currency ORDER BY d.date ROWS UNBOUNDED PRECEDING) AS rate_date FROM d2 d LEFT JOIN rates r ON r.currency = d.currency AND r.date = d.date), a2 AS (SELECT s.currency, s.date, r.rate FROM s2 s JOIN rates r ON r.currency = s.currency AND r.date = s.rate_date WHERE datediff('day', s.rate_date, s.date) <= 10) SELECT e.isin, e.date, e.kind, round(CASE WHEN h.currency = 'EUR' THEN e.amount ELSE e.amount / a2.rate END, 8) AS amount, 'EUR' AS currency FROM events e JOIN home h ON h.isin = e.isin LEFT JOIN a2 ON a2.currency = h.currency AND a2.date = e.date WHERE e.kind = 'dividend'"
ORACLE["total_return_adjust"] = f"WITH {BARS}{EVENTS}, lf AS (SELECT isin, placed_at AS date, sum(ln((ref - amount) / ref)) AS l FROM placed WHERE kind = 'dividend' AND placed_at IS NOT NULL AND amount < ref GROUP BY isin, placed_at) SELECT b.isin, b.date, round(exp(coalesce(sum(lf.l) OVER (PARTITION BY b.isin ORDER BY b.date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)), 8) AS adj_factor FROM bars b LEFT JOIN lf ON lf.isin = b.isin AND lf.date = b.date"
ORACLE["adjust_report"] = f"WITH {BARS}{EVENTS} SELECT CASE WHEN placed_at IS NULL THEN 'outside the fund''s price window' WHEN kind = 'dividend' AND amount >= ref THEN 'non-positive adjustment factor' ELSE 'applied' END AS status, count(*) AS n FROM placed GROUP BY 1"
ORACLE["split_factors"] = f"WITH {BARS}{EVENTS} SELECT isin, date, placed_at, round(1 / ratio, 8) AS factor FROM placed WHERE kind = 'split' AND placed_at IS NOT NULL"
INDEX = EUR + """,
wk AS (SELECT isin, date, close, currency FROM (SELECT *, row_number() OVER (PARTITION BY isin, date_trunc('week', date) ORDER BY date DESC) AS rn FROM bars) WHERE rn = 1),
eu AS (SELECT w.isin, w.date, CASE WHEN w.currency = 'EUR' THEN w.close ELSE w.close / a.rate END AS eur FROM wk w LEFT JOIN latest a ON a.currency = w.currency AND a.date = w.date WHERE w.currency = 'EUR' OR a.rate IS NOT NULL),
ix AS (SELECT isin, date, 100 * eur / first_value(eur) OVER (PARTITION BY isin ORDER BY date) AS tr_index FROM eu)
"""
ORACLE["weekly_index"] = f"WITH {INDEX} SELECT isin, date, round(tr_index, 4) AS tr_index FROM ix"
ORACLE["index_coverage"] = f"WITH {INDEX} SELECT isin, CAST(count(*) AS INTEGER) AS index_points, min(date) AS index_start FROM ix GROUP BY isin"
ORACLE["compare_pivot"] = f"""WITH {INDEX}, v AS (SELECT isin, date, tr_index / first_value(tr_index) OVER (PARTITION BY isin ORDER BY date) * 100 AS t FROM ix WHERE isin IN ('1', '5', '10') AND date >= DATE '1998-01-01') SELECT date, round(max(CASE WHEN isin = '1' THEN t END), 4) AS "1", round(max(CASE WHEN isin = '5' THEN t END), 4) AS "5", round(max(CASE WHEN isin = '10' THEN t END), 4) AS "10" FROM v GROUP BY date"""

SOURCES = """
src AS (SELECT CAST(n_nationkey AS VARCHAR) AS isin, CASE WHEN n_nationkey % 4 <> 0 THEN n_name END AS name, CAST(NULL AS DOUBLE) AS aum_eur, CAST(NULL AS VARCHAR) AS segment, 0 AS seq, 'nation' AS source, 100 AS trust FROM nation
 UNION ALL SELECT CAST(s_nationkey AS VARCHAR), s_name, CASE WHEN s_acctbal > 0 THEN s_acctbal END, NULL, s_suppkey, 'supplier', 80 FROM supplier
 UNION ALL SELECT CAST(c_nationkey AS VARCHAR), c_name, c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, c_custkey, 'customer', 40 FROM customer)
"""


def _won(field: str) -> str:
    return f"w_{field} AS (SELECT isin, {field}, source, trust, k FROM (SELECT isin, {field}, source, trust, count(*) OVER (PARTITION BY isin) AS k, row_number() OVER (PARTITION BY isin ORDER BY trust DESC, source, seq) AS rn FROM src WHERE {field} IS NOT NULL) WHERE rn = 1)"


_FIELDS = ("name", "aum_eur", "segment")
_WON = f"{SOURCES}, " + ", ".join(map(_won, _FIELDS))
_PROV = " UNION ALL ".join(f"SELECT isin, '{f}' AS field, source, trust, k AS contenders FROM w_{f}" for f in _FIELDS)
ORACLE["trust_fold"] = f"WITH {_WON} SELECT k.isin, name, aum_eur, segment, ds AS data_sources FROM (SELECT isin, string_agg(source, ',' ORDER BY source) AS ds FROM (SELECT DISTINCT isin, source FROM src) GROUP BY isin) k LEFT JOIN w_name ON w_name.isin = k.isin LEFT JOIN w_aum_eur ON w_aum_eur.isin = k.isin LEFT JOIN w_segment ON w_segment.isin = k.isin"
ORACLE["provenance"] = f"WITH {_WON} {_PROV}"
ORACLE["contested_fields"] = f"WITH {_WON} SELECT field, source, count(*) AS won FROM ({_PROV}) WHERE contenders > 1 GROUP BY field, source"
ORACLE["aum_bound"] = f"WITH {_WON} SELECT k.isin, name, CASE WHEN w_aum_eur.trust <= 40 AND (aum_eur > 1e12 OR aum_eur <= 0) THEN NULL ELSE aum_eur END AS aum_eur FROM (SELECT DISTINCT isin FROM src) k LEFT JOIN w_name ON w_name.isin = k.isin LEFT JOIN w_aum_eur ON w_aum_eur.isin = k.isin"
_MICS = ("XPAR", "XAMS", "XBRU", "XLIS", "XDUB", "XETR", "XMIL", "XSWX", "XLON", "XMAD", "XWBO", "XSTO", "XCSE", "XOSL", "XFRA", "XPMC", "XAMC", "ARCX", "XNAS", "XNYS", "BATS", "XASE", "IEXG")
_SUFFIX = (".PA", ".AS", ".BR", ".LS", ".IR", ".DE", ".MI", ".SW", ".L", ".MC", ".VI", ".ST", ".CO", ".OL", ".F", ".PA", ".AS", "", "", "", "", "", "")
LISTINGS = """
ll AS (SELECT l_partkey, s_nationkey % 23 AS pref, min(l_suppkey) AS sup, min(s_nationkey) AS nation FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2),
listings AS (SELECT CAST(l_partkey AS VARCHAR) AS isin, pref, """ + "CASE pref " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(_MICS)) + """ END AS exchange_mic, 'Venue ' || CAST(nation AS VARCHAR) AS exchange_name, CASE WHEN sup % 3 <> 0 THEN 'T' || CAST(sup AS VARCHAR) || '.A' END AS ticker, CASE WHEN sup % 7 = 0 THEN 'y' || CAST(sup AS VARCHAR) END AS yahoo_ticker,
 CASE nation % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CHF' ELSE 'JPY' END AS trading_currency, nation = l_partkey % 25 AS is_primary FROM ll)
"""
_PRIMARY = "pl AS (SELECT isin, ticker AS primary_ticker, exchange_mic AS primary_mic, exchange_name AS primary_exchange, trading_currency AS primary_currency FROM (SELECT *, row_number() OVER (PARTITION BY isin ORDER BY CASE WHEN is_primary THEN 0 ELSE 1 END, exchange_mic) AS rn FROM listings) WHERE rn = 1), pn AS (SELECT isin, CAST(count(*) AS SMALLINT) AS n_listings FROM listings GROUP BY isin), pt AS (SELECT isin, string_agg(ticker, ' ' ORDER BY ticker) AS all_tickers FROM (SELECT DISTINCT isin, ticker FROM listings WHERE ticker IS NOT NULL) GROUP BY isin)"
ORACLE["primary_listing"] = f"WITH {LISTINGS}, {_PRIMARY} SELECT pl.*, n_listings, coalesce(all_tickers, '') AS all_tickers FROM pl JOIN pn ON pn.isin = pl.isin LEFT JOIN pt ON pt.isin = pl.isin"
ORACLE["primary_flags"] = f"WITH {LISTINGS} SELECT isin, exchange_mic, row_number() OVER (PARTITION BY isin ORDER BY pref, exchange_mic) = 1 AS is_primary FROM listings"
_SYMBOLS = "sy AS (SELECT isin, exchange_mic, trading_currency, CASE WHEN is_primary THEN 0 ELSE 1 END AS np, pref, coalesce(upper(yahoo_ticker), replace(upper(ticker), '.', '-') || CASE pref " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_SUFFIX)) + " END) AS symbol FROM listings), s1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY isin, symbol ORDER BY np, pref, exchange_mic) AS rn FROM sy WHERE symbol IS NOT NULL) WHERE rn = 1), cand AS (SELECT isin, row_number() OVER (PARTITION BY isin ORDER BY np, pref, exchange_mic) - 1 AS rank, symbol AS yahoo_ticker, exchange_mic, trading_currency FROM s1)"
ORACLE["symbol_candidates"] = f"WITH {LISTINGS}, {_SYMBOLS} SELECT * FROM cand"
ORACLE["venue_fallback"] = f"WITH {LISTINGS}, {_SYMBOLS} SELECT isin, rank, yahoo_ticker FROM cand WHERE rank = 1 AND isin NOT IN (SELECT CAST(l_suppkey AS VARCHAR) FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)"
ORACLE["mic_rewrites"] = f"WITH {LISTINGS}, m AS (SELECT CAST(isin AS INTEGER) % 5 AS k FROM listings) SELECT CASE k WHEN 0 THEN 'ETFP->XMIL' WHEN 1 THEN 'XETA->XETR' WHEN 3 THEN 'FRAA->XFRA' ELSE 'XMSM->XDUB' END AS rewrite, count(*) AS n FROM m WHERE k <> 2 GROUP BY 1"
FUNDS = "funds AS (SELECT CAST(c_custkey AS VARCHAR) AS isin, c_name AS name, c_mktsegment AS asset_class, CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey AS VARCHAR) END AS domicile, CASE WHEN c_acctbal > -900 THEN c_acctbal END AS aum_eur, CASE WHEN c_acctbal > 0 THEN true WHEN c_acctbal < -500 THEN false END AS pea_eligible, CASE WHEN c_acctbal > 2000 THEN true WHEN c_acctbal < 1500 THEN false END AS cto_accessible, lower(c_name || ' ' || c_mktsegment) AS search_blob FROM customer)"
ORACLE["screener_table"] = f"WITH {INDEX}, panel AS (SELECT isin, date, close, ln(close) AS logp FROM bars), ends AS (SELECT isin, min(date) AS d0, max(date) AS d1, count(*) AS n FROM panel GROUP BY isin){_anchors('1y')}{_RET}{_vol('1y')}{_LAST}, {LISTINGS}, {_PRIMARY}, {FUNDS}, perf AS (SELECT ends.isin, exp(l1 - a_1y.logp) - 1 AS ret_1y, CASE WHEN v_1y.m >= 2 THEN v_1y.vol END AS vol_1y FROM ends JOIN z ON z.isin = ends.isin LEFT JOIN a_1y ON a_1y.isin = ends.isin LEFT JOIN v_1y ON v_1y.isin = ends.isin), cov AS (SELECT isin, CAST(count(*) AS INTEGER) AS index_points, min(date) AS index_start FROM ix GROUP BY isin) SELECT f.isin, name, asset_class, domicile, round(aum_eur, 8) AS aum_eur, pea_eligible, cto_accessible, primary_ticker, primary_mic, primary_exchange, primary_currency, CAST(coalesce(n_listings, 0) AS SMALLINT) AS n_listings, round(ret_1y, 8) AS ret_1y, round(vol_1y, 8) AS vol_1y, index_points, index_start, index_points IS NOT NULL AS has_index, lower(concat_ws(' ', name, f.isin, CASE WHEN pl.isin IS NOT NULL THEN coalesce(all_tickers, '') END)) AS search_blob FROM funds f LEFT JOIN pl ON pl.isin = f.isin LEFT JOIN pn ON pn.isin = f.isin LEFT JOIN pt ON pt.isin = f.isin LEFT JOIN perf ON perf.isin = f.isin LEFT JOIN cov ON cov.isin = f.isin"
ORACLE["screen_topk"] = f"WITH {FUNDS} SELECT isin, name, aum_eur FROM funds WHERE search_blob LIKE '%building%' AND pea_eligible IS TRUE AND aum_eur IS NOT NULL AND aum_eur >= 100 AND aum_eur <= 9000 ORDER BY aum_eur DESC NULLS LAST, isin LIMIT 300"
ORACLE["screen_matches"] = f"WITH {FUNDS} SELECT count(*) AS n_match FROM funds WHERE asset_class = 'MACHINERY' AND cto_accessible IS NULL"
ORACLE["facets"] = f"WITH {FUNDS} SELECT 'asset_class' AS facet, asset_class AS value, count(*) AS n FROM funds WHERE asset_class IS NOT NULL GROUP BY 2 UNION ALL SELECT 'domicile', domicile, count(*) FROM funds WHERE domicile IS NOT NULL GROUP BY 2"
ORACLE["tri_state_tally"] = f"WITH {FUNDS} SELECT 'pea_eligible' AS field, count(*) FILTER (WHERE pea_eligible) AS yes, count(*) FILTER (WHERE NOT pea_eligible) AS no, count(*) FILTER (WHERE pea_eligible IS NULL) AS unknown FROM funds UNION ALL SELECT 'cto_accessible', count(*) FILTER (WHERE cto_accessible), count(*) FILTER (WHERE NOT cto_accessible), count(*) FILTER (WHERE cto_accessible IS NULL) FROM funds"
# U and S are 30 and 28, so a body is 13 digits of which those at odd places are doubled: 3, 2 and the number's 1st, 3rd, ...
_DIGITS = [f"CAST(substr(b, {i}, 1) AS INTEGER)" for i in range(1, 10)]
_DOUBLED = [f"(({x} * 2) // 10 + ({x} * 2) % 10)" if i % 2 == 0 else x for i, x in enumerate(_DIGITS)]
ORACLE["isin_check"] = f"WITH o AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS b, o_custkey % 10 AS c FROM orders), t AS (SELECT b, c, (10 - (6 + 0 + 4 + 8 + {' + '.join(_DOUBLED)}) % 10) % 10 = c AS valid FROM o) SELECT 'us-' || b || CAST(c AS VARCHAR) AS raw, 'US' || b || CAST(c AS VARCHAR) AS isin, valid, CASE WHEN valid THEN 'US' END AS country FROM t"
ORACLE["currency_units"] = "WITH q AS (SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'GBp' WHEN 1 THEN 'GBX' WHEN 2 THEN 'gbx' WHEN 3 THEN 'ZAc' WHEN 4 THEN 'eur ' WHEN 5 THEN 'ILA' WHEN 6 THEN 'usd' ELSE '' END AS quoted FROM orders) SELECT o_orderkey, quoted, CASE quoted WHEN 'ZAc' THEN 'ZAR' WHEN 'eur ' THEN 'EUR' WHEN 'ILA' THEN 'ILS' WHEN 'usd' THEN 'USD' WHEN '' THEN NULL ELSE 'GBP' END AS currency, CAST(CASE WHEN quoted IN ('eur ', 'usd') THEN 1.0 WHEN quoted = '' THEN NULL ELSE 0.01 END AS DOUBLE) AS unit FROM q"
ORACLE["clean_name"] = "SELECT p_partkey, p_name || CASE p_partkey % 6 WHEN 0 THEN ' ETF' WHEN 1 THEN '' WHEN 2 THEN ' UCITS ETF' WHEN 3 THEN ' ETC' WHEN 4 THEN '' ELSE ' ETN' END AS name FROM part"
ORACLE["category_map"] = "WITH c AS (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'US Large Blend' WHEN 1 THEN 'Equity Precious Metals' WHEN 2 THEN 'Leveraged Commodities' WHEN 3 THEN 'High Yield Bond' WHEN 4 THEN '' WHEN 5 THEN 'Japan Stock' ELSE 'zzz' END AS category FROM part) SELECT p_partkey, category, CASE category WHEN 'US Large Blend' THEN 'equity' WHEN 'Equity Precious Metals' THEN 'equity' WHEN 'Leveraged Commodities' THEN 'commodity' WHEN 'High Yield Bond' THEN 'bond' WHEN 'Japan Stock' THEN 'equity' WHEN 'zzz' THEN 'unknown' END AS asset_class, CASE category WHEN 'US Large Blend' THEN 'broad-market' WHEN 'Equity Precious Metals' THEN 'sector' WHEN 'Leveraged Commodities' THEN 'leveraged' WHEN 'High Yield Bond' THEN 'unknown' WHEN 'Japan Stock' THEN 'country' WHEN 'zzz' THEN 'unknown' END AS strategy FROM c"
ORACLE["orphan_anti"] = f"WITH {LISTINGS} SELECT isin, exchange_mic FROM listings WHERE isin NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size > 10)"
ORACLE["tradable_semi"] = f"WITH {LISTINGS} SELECT CAST(p_partkey AS VARCHAR) AS isin, p_brand FROM part WHERE CAST(p_partkey AS VARCHAR) IN (SELECT isin FROM listings WHERE ticker IS NOT NULL)"
ORACLE["claim_uniqueness"] = "WITH c AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderkey AS VARCHAR) AS isin FROM orders) SELECT ticker, isin FROM (SELECT ticker, isin, count(*) OVER (PARTITION BY ticker) AS a, count(*) OVER (PARTITION BY isin) AS b FROM c) WHERE a = 1 AND b = 1"
_UPSERT = f"WITH {BARS} SELECT isin, date, round(CASE WHEN date >= DATE '1999-01-05' THEN close * 2 ELSE close END, 8) AS close, currency FROM bars"
ORACLE["price_upsert"] = ORACLE["stream_refresh"] = _UPSERT
ORACLE["store_manifest"] = f"WITH {BARS}, s AS (SELECT isin, min(date) AS first_date, max(date) AS last_date, count(*) AS bars FROM bars GROUP BY isin) SELECT s.*, b.currency, CASE WHEN s.isin = '1' THEN 'NEW' ELSE s_name END AS ticker FROM s JOIN bars b ON b.isin = s.isin AND b.date = s.last_date LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = s.isin"
ORACLE["refresh_requests"] = f"WITH {BARS}, m AS (SELECT isin, max(date) AS d FROM bars WHERE date < DATE '1999-01-10' AND isin <> '3' GROUP BY isin) SELECT 'S' || CAST(s_suppkey % 40 AS VARCHAR) AS symbol, min(CASE WHEN d IS NULL THEN DATE '1990-01-01' ELSE CAST(d - INTERVAL 5 DAY AS DATE) END) AS start FROM supplier LEFT JOIN m ON m.isin = CAST(s_suppkey AS VARCHAR) GROUP BY 1"
ORACLE["new_splits_anti"] = f"WITH {BARS} SELECT DISTINCT isin FROM raw WHERE l_linestatus = 'O' AND l_quantity = 1 AND date >= DATE '1999-01-01'"
ORACLE["replace_refetched"] = f"WITH {BARS} SELECT isin, date, round(CASE WHEN CAST(isin AS INTEGER) % 4 = 0 AND date >= DATE '1999-01-05' THEN close * 2 ELSE close END, 8) AS close, currency FROM bars WHERE CASE WHEN CAST(isin AS INTEGER) % 4 = 0 AND isin IN (SELECT isin FROM bars WHERE date >= DATE '1999-01-05') THEN date >= DATE '1999-01-05' ELSE date < DATE '1999-01-10' END"
_PANEL_PARTS = ("trailing_returns", "cagr", "volatility", "sharpe_sortino", "drawdown", "full_history_shape")
ORACLE["performance_panel"] = "SELECT * FROM " + " JOIN ".join(f"({ORACLE[k]}) AS {k}" if i == 0 else f"({ORACLE[k]}) AS {k} USING (isin)" for i, k in enumerate(_PANEL_PARTS)) + f" LEFT JOIN ({ORACLE['monthly_distribution']}) AS md USING (isin) LEFT JOIN ({ORACLE['beta_corr']}) AS bc USING (isin)"
# the shipped constants: more than 250 shared days, 30 bars
ORACLE["beta_corr_shipped"] = ORACLE["beta_corr"].replace("n > 60", "n > 250")
ORACLE["thin_gate_shipped"] = ORACLE["thin_gate"].replace("n >= 550", "n >= 30")


def _prefix_sum(prefix: str) -> int:
    """What a two-letter prefix adds to the check sum: four digits, the first and third doubled."""
    digits = [int(x) for c in prefix for x in str(int(c, 36))]
    return sum(sum(divmod(2 * x, 10)) if i % 2 == 0 else x for i, x in enumerate(digits))


_PREFIXES = ("IE", "FR", "US", "GB", "XS", "JE", "LU")
_CASE = lambda at, values: f"CASE {at} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"
_TEXT = lambda *values: [f"'{v}'" for v in values]
EVIDENCE = f"""
o AS (SELECT o_orderkey AS k, lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS b, {_CASE('o_custkey % 7', _TEXT(*_PREFIXES))} AS prefix, {_CASE('o_custkey % 7', map(_prefix_sum, _PREFIXES))} AS s FROM orders),
f AS (SELECT k, prefix, prefix || b || CAST((10 - (s + {' + '.join(_DOUBLED)}) % 10) % 10 AS VARCHAR) AS isin, {_CASE('k % 6', _TEXT('Core Equity UCITS ETF', 'Physical Gold ETC', 'Bond ETF', 'Swap World ETF', 'Short Certificate', 'Dividend ETF'))} AS name,
  CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS ucits, k % 13 = 0 AS unlisted, k % 17 = 0 AS foreign_kid, CASE WHEN k % 11 <> 0 AND k % 5 = 0 THEN 'DE' WHEN prefix <> 'XS' THEN prefix END AS d FROM o),
told AS (SELECT isin, k, unnest(list_distinct([k % 8, (k * 3 + 1) % 8, (k // 8) % 8])) AS e FROM f WHERE k % 3 <> 0),
seen AS (SELECT isin, k, e, {_CASE('e', _TEXT('https://live.euronext.com/x', 'https://www.amundietf.fr/y', 'https://www.boursedirect.fr/z', 'https://www.fortuneo.fr/q', 'https://home.saxo/w', 'https://www.justetf.com/v', 'https://www.someblog.org/u', 'https://etf.dws.com/t'))} || CAST(k % 4 AS VARCHAR) AS url, CAST(DATE '2024-01-01' + CAST(k % 7 + e % 2 AS INTEGER) AS DATE) AS day FROM told),
who AS (SELECT e, {_CASE('e', _TEXT('euronext', 'amundi', 'bourse-direct', 'fortuneo', 'saxo', 'justetf', 'blog-someblog.org', 'xtrackers'))} AS provider, {_CASE('e', _TEXT('venue', 'issuer', 'broker', 'broker', 'stale', 'screener', 'community', 'no_flag'))} AS kind, {_CASE('e', (1, 2, 3, 3, 4, 4, 4, 4))} AS tier, max(day) AS as_of, arg_min(url, k) AS url FROM seen GROUP BY e),
ev AS (SELECT t.isin, w.* FROM told t JOIN who w ON w.e = t.e),
best AS (SELECT isin, CASE tier WHEN 1 THEN 'high' WHEN 2 THEN 'high' WHEN 3 THEN CASE WHEN brokers > 1 THEN 'medium' ELSE 'low' END ELSE 'hint' END AS confidence, CASE tier WHEN 1 THEN 'venue_flag' WHEN 2 THEN 'issuer_flag' WHEN 3 THEN CASE WHEN brokers > 1 THEN 'brokers_corroborated' ELSE 'single_broker' END ELSE 'screener_or_community_only' END AS reason, url, as_of
  FROM (SELECT *, count(*) FILTER (WHERE kind = 'broker') OVER (PARTITION BY isin) AS brokers, row_number() OVER (PARTITION BY isin ORDER BY tier, as_of DESC, provider) AS rn FROM ev) WHERE rn = 1),
r AS (SELECT f.*, b.confidence, b.reason, b.url, b.as_of, CASE WHEN name LIKE '% ETC' OR name LIKE '%Certificate' THEN 'not_a_fund' WHEN d NOT IN ('IE', 'FR', 'LU', 'DE') THEN 'domicile_outside_eea' END AS blocked FROM f LEFT JOIN best b ON b.isin = f.isin),
v AS (SELECT *, blocked IS NULL AND coalesce(confidence IN ('high', 'medium', 'low'), false) AS yes, coalesce(d IN ('IE', 'FR', 'LU', 'DE'), false) AS eea FROM r),
pea AS (SELECT isin, CASE WHEN blocked IS NOT NULL THEN false WHEN yes THEN true END AS pea_eligible, CASE WHEN blocked IS NOT NULL THEN 'high' ELSE coalesce(confidence, 'none') END AS pea_confidence,
  CASE WHEN NOT yes THEN 'unknown' WHEN k % 4 = 0 THEN 'physical_eu' WHEN k % 4 < 3 OR name LIKE 'Swap%' THEN 'synthetic_swap' ELSE 'unknown' END AS pea_mechanism,
  CASE WHEN blocked IS NOT NULL THEN 'https://www.legifrance.gouv.fr/codes/article_lc/LEGIARTI000041467756' ELSE url END AS pea_source, CASE WHEN blocked IS NOT NULL THEN DATE '2026-08-01' WHEN yes THEN as_of END AS pea_as_of, coalesce(blocked, reason, 'no_positive_evidence') AS pea_reason FROM v),
cto AS (SELECT isin, c AS cto_reason, CASE WHEN c IN ('no_priips_kid', 'uk_ucits_is_third_country', 'not_passported_to_france') THEN false WHEN c = 'ucits_eea_with_kid' THEN true END AS cto_accessible,
  CASE WHEN d = 'US' THEN false WHEN d IS NOT NULL AND NOT eea THEN NULL WHEN eea AND ucits THEN true WHEN c IN ('kid_language_unconfirmed', 'not_passported_to_france') THEN NULL WHEN yes THEN true END AS has_priips_kid,
  CASE WHEN d = 'GB' THEN false WHEN unlisted THEN false WHEN (d IS NOT NULL AND NOT eea) OR c = 'kid_language_unconfirmed' THEN NULL WHEN yes THEN true END AS authorised_fr
  FROM (SELECT *, CASE WHEN d = 'US' THEN 'no_priips_kid' WHEN d = 'GB' THEN 'uk_ucits_is_third_country' WHEN NOT eea AND d IS NOT NULL THEN 'unknown' WHEN foreign_kid THEN 'kid_language_unconfirmed' WHEN unlisted THEN 'not_passported_to_france' WHEN yes OR (eea AND ucits) THEN 'ucits_eea_with_kid' ELSE 'unknown' END AS c FROM v))
"""
ORACLE["pea_verdict"] = f"WITH {EVIDENCE} SELECT * FROM pea"
ORACLE["cto_verdict"] = f"WITH {EVIDENCE} SELECT * FROM cto"
ORACLE["eligibility_violations"] = f"WITH {EVIDENCE} SELECT 'C1' AS rule, pea.isin FROM pea JOIN cto ON cto.isin = pea.isin WHERE pea_eligible AND (cto_accessible IS NOT TRUE OR pea.isin LIKE '%7')"
ORACLE["broker_availability"] = f"WITH {EVIDENCE} SELECT provider AS broker, isin, true AS available, 'pea' AS wrapper, url AS source_url, as_of FROM ev WHERE kind IN ('broker', 'stale') AND isin NOT IN (SELECT isin FROM f WHERE name LIKE '%Certificate')"
ORACLE["export_gate"] = "SELECT * FROM (VALUES ('bad', 'has raw price columns: adj_close, close, volume'), ('', 'no as_of date'), ('funds', 'has under 10000000 rows')) AS t(\"table\", problem)"
ORACLE["hash_sample"] = f"WITH {FUNDS} SELECT isin, name FROM funds ORDER BY isin <> '7', md5(isin), isin LIMIT 50"
_NAMED = "n AS (SELECT p_partkey, " + _CASE("p_partkey % 13", _TEXT("Gold Miners", "Euro Govt Bond 1-3", "MSCI World 2x", "Bitcoin", "Real Estate", "Money Market", "S&P 500 Equal Weight", "Covered Call", "Ultra Short", "Credit Suisse", "Monétaire", "Crude Oil", "plain")) + " || ' ' || p_name AS name, " + _CASE("p_partkey % 13", ["'equity'", "'bond'", "'equity'", "'crypto'", "'real-estate'", "'money-market'", "'equity'", "NULL", "NULL", "NULL", "'money-market'", "'commodity'", "NULL"]) + " AS asset, " + _CASE("p_partkey % 13", ["NULL", "NULL", "'leveraged'", "NULL", "NULL", "NULL", "'factor'", "'covered-call'", "'inverse'", "NULL", "NULL", "NULL", "NULL"]) + " AS how FROM part)"
ORACLE["classify_name"] = f"WITH {_NAMED} SELECT p_partkey, name, asset AS asset_class, how AS strategy FROM n"
ORACLE["fill_from_name"] = f"WITH {_NAMED} SELECT CAST(p_partkey AS VARCHAR) AS isin, name, CASE p_partkey % 3 WHEN 1 THEN 'equity' WHEN 0 THEN coalesce(asset, 'unknown') ELSE asset END AS asset_class, how AS strategy, CASE WHEN how IS NOT NULL OR (p_partkey % 3 <> 1 AND asset IS NOT NULL) THEN 'name-heuristic,xetra' ELSE 'xetra' END AS data_sources FROM n"
