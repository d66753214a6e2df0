"""The same queries in SQL, for an independent engine on the same tables.

The SQL follows the definitions directly: global windows, self-joins on row
numbers, as-of joins. ``printf`` rounds the exact binary value half to even.
"""

from __future__ import annotations

from verification.queries import PART, PRIORITY, SUPPLIER


def _cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


_WEEK = "CAST(date_trunc('week', l_shipdate) AS DATE)"

_SERIES = {
    (): f"""
fast AS (
  SELECT 0 AS k, CAST(o_orderdate AS DATE) AS date,
         sum({_cents('o_totalprice')}) / count(o_totalprice) / 100 AS price
  FROM orders GROUP BY ALL),
slow AS (
  SELECT 0 AS k, {_WEEK} AS week,
         sum({_cents('l_extendedprice')}) / count(l_extendedprice) / 100 AS price
  FROM lineitem GROUP BY ALL)""",
    PRIORITY: f"""
fast AS (
  SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS date,
         sum({_cents('o_totalprice')}) / count(o_totalprice) / 100 AS price
  FROM orders GROUP BY ALL),
slow AS (
  SELECT o_orderpriority AS k, {_WEEK} AS week,
         sum({_cents('l_extendedprice')}) / count(l_extendedprice) / 100 AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)""",
    **{key: f"""
fast AS (
  SELECT {key[0]} AS k, CAST(l_shipdate AS DATE) AS date,
         sum({_cents('l_extendedprice')}) / count(l_extendedprice) / 100 AS price
  FROM lineitem GROUP BY ALL),
slow AS (
  SELECT {key[0]} AS k, {_WEEK} AS week,
         sum({_cents('l_extendedprice')}) / sum(CAST(l_quantity AS BIGINT)) / 100 AS price
  FROM lineitem GROUP BY ALL)""" for key in (SUPPLIER, PART)},
}

_TIMELINE = """,
timeline AS (
  SELECT f.k, f.date, f.price AS fast, s.price AS slow, s.week
  FROM fast f ASOF LEFT JOIN slow s ON f.k = s.k AND f.date >= s.week),
num AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY date) - 1 AS pos,
         count(*) OVER (PARTITION BY k) AS n
  FROM timeline)"""

_SWEEP = _TIMELINE + """,
sweep_raw AS (
  SELECT b.k, l.lag, corr(a.fast, b.slow) AS c
  FROM num b CROSS JOIN (SELECT CAST(range AS INTEGER) AS lag FROM range(0, 91)) l
  LEFT JOIN num a ON a.k = b.k AND a.pos = b.pos - l.lag
  GROUP BY b.k, l.lag),
sweep AS (
  SELECT k, lag, CASE WHEN isnan(c) THEN NULL ELSE c END AS c FROM sweep_raw),
flagged AS (
  SELECT k, lag AS lag_days, c AS correlation,
         c = max(c) OVER (PARTITION BY k) AS is_optimal
  FROM sweep)"""

_SHOCKS = _TIMELINE + """,
started AS (
  SELECT *, lag(slow, 28) OVER (PARTITION BY k ORDER BY pos) AS start_price FROM num),
changes AS (
  SELECT *, (slow / start_price - 1) * 100 AS pct FROM started WHERE start_price IS NOT NULL),
rising AS (
  SELECT *, max(pct) OVER (PARTITION BY k ORDER BY date
                           ROWS BETWEEN 14 PRECEDING AND 14 FOLLOWING) AS peak
  FROM changes WHERE pct > 0),
firsts AS (
  SELECT * FROM rising WHERE pct = peak
  QUALIFY row_number() OVER (PARTITION BY k, pct ORDER BY date) = 1),
shocks AS (
  SELECT k, row_number() OVER (PARTITION BY k ORDER BY pct DESC) AS rank, * EXCLUDE (k)
  FROM firsts QUALIFY rank <= 10)"""

_FEATURES = _TIMELINE + """,
returns AS (
  SELECT *,
    CASE WHEN pos = 0 THEN 0.0 ELSE (slow - lag(slow) OVER w) / lag(slow) OVER w * 100 END AS ret,
    (slow - lag(slow, 28) OVER w) / lag(slow, 28) OVER w * 100 AS mom
  FROM num WINDOW w AS (PARTITION BY k ORDER BY pos)),
vols AS (
  SELECT *, CASE WHEN count(ret) OVER w >= 10 THEN stddev_samp(ret) OVER w END AS vol
  FROM returns
  WINDOW w AS (PARTITION BY k ORDER BY pos ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
feat AS (
  SELECT *, round(vol * 1048577.0 - (vol * 1048577.0 - vol), 9) AS volkey FROM vols)"""

_REGIMES = _FEATURES + """,
lists AS (
  SELECT k, list(slow ORDER BY pos) AS slows, list(volkey ORDER BY pos) AS vols FROM feat GROUP BY k),
rolled AS (
  SELECT k, pos,
    len(list_filter(slows[greatest(1, pos - 1258):pos + 1], lambda x: x < slow))
      / least(pos + 1, 1260) * 100 AS price_pct
  FROM feat JOIN lists USING (k)),
expanded AS (
  SELECT k, pos,
    len(list_filter(vols[1:pos + 1], lambda x: x < volkey))
      / len(list_filter(vols[1:pos + 1], lambda x: x IS NOT NULL)) * 100 AS vol_rank
  FROM feat JOIN lists USING (k) WHERE volkey IS NOT NULL),
daily AS (
  SELECT f.*, r.price_pct, coalesce(e.vol_rank, 50.0) AS vol_rank,
    CASE WHEN r.price_pct > 80 OR coalesce(e.vol_rank, 50.0) > 75 THEN 'extreme'
         WHEN r.price_pct < 50 AND coalesce(e.vol_rank, 50.0) < 50 THEN 'calm'
         ELSE 'elevated' END AS regime
  FROM feat f JOIN rolled r USING (k, pos) LEFT JOIN expanded e USING (k, pos)),
edges AS (
  SELECT *, CASE WHEN regime = lag(regime) OVER (PARTITION BY k ORDER BY pos)
                 THEN 0 ELSE 1 END AS edge
  FROM daily WHERE n >= 60),
runs AS (
  SELECT *, sum(edge) OVER (PARTITION BY k ORDER BY pos) AS run FROM edges),
segments AS (
  SELECT k, run, min(date) AS start, max(date) AS "end", any_value(regime) AS regime
  FROM runs GROUP BY k, run)"""

_STATUS = """,
latest AS (
  SELECT k, n, date AS as_of, slow AS price, vol, volkey, mom FROM feat
  WHERE pos = n - 1 AND n >= 60),
counted AS (
  SELECT l.*,
    max(f.slow) FILTER (WHERE f.pos = f.n - 6) AS week_price,
    max(f.slow) FILTER (WHERE f.pos = f.n - 253) AS year_price,
    count(*) FILTER (WHERE f.slow < l.price) / count(*) * 100 AS pct_all,
    count(*) FILTER (WHERE f.slow < l.price AND f.pos >= f.n - 1260)
      / least(any_value(f.n), 1260) * 100 AS pct_rolling,
    CASE WHEN count(f.vol) = 0 THEN 50.0
         ELSE count(*) FILTER (WHERE f.volkey < l.volkey) / count(f.vol) * 100 END AS vol_rank,
    avg(f.slow) FILTER (WHERE f.pos < f.n - 730) AS price_mean,
    stddev_pop(f.slow) FILTER (WHERE f.pos < f.n - 730) AS price_std,
    avg(f.vol) FILTER (WHERE f.pos < f.n - 730) AS vol_mean,
    stddev_pop(f.vol) FILTER (WHERE f.pos < f.n - 730) AS vol_std,
    avg(f.mom) FILTER (WHERE f.pos < f.n - 730) AS mom_mean,
    stddev_pop(f.mom) FILTER (WHERE f.pos < f.n - 730) AS mom_std
  FROM latest l JOIN feat f USING (k) GROUP BY ALL),
state AS (
  SELECT *,
    CASE WHEN n >= 6 THEN (price - week_price) / week_price * 100 ELSE 0.0 END AS week_change,
    CASE WHEN n >= 253 THEN (price - year_price) / year_price * 100 ELSE 0.0 END AS year_change,
    CASE WHEN pct_rolling > 80 OR vol_rank > 75 THEN 'extreme'
         WHEN pct_rolling < 50 AND vol_rank < 50 THEN 'calm' ELSE 'elevated' END AS regime
  FROM counted),
kpis AS (
  SELECT *, strftime(as_of, '%Y-%m-%d') AS as_of_date,
    CAST(printf('%.3f', price) AS DOUBLE) AS current_price_usd_gal,
    CAST(printf('%.2f', week_change) AS DOUBLE) AS delta_1w_pct,
    CAST(printf('%.1f', year_change) AS DOUBLE) AS delta_yoy_pct,
    CAST(printf('%.1f', pct_all) AS DOUBLE) AS percentile_25y,
    CAST(printf('%.1f', pct_rolling) AS DOUBLE) AS percentile_5y,
    printf('%.2f', price) AS headline_price,
    printf('%.1f', pct_all) AS headline_pct,
    printf('%+.0f', year_change) AS headline_yoy,
    CASE WHEN regime = 'extreme' AND vol_rank > 90 THEN 'extreme_volatility'
         WHEN regime = 'extreme' AND pct_all > 95 THEN 'extreme_high'
         WHEN regime = 'extreme' THEN 'extreme_general'
         WHEN regime = 'elevated' AND year_change > 20 THEN 'elevated_rising'
         WHEN regime = 'elevated' AND year_change < -20 THEN 'elevated_falling'
         WHEN regime = 'elevated' THEN 'elevated_general'
         WHEN pct_all < 25 THEN 'calm_low' ELSE 'calm_general' END AS context_clause_key
  FROM state),
distances AS (
  SELECT s.k, f.date, f.slow,
    round(sqrt(
        pow((f.slow - s.price) / CASE s.price_std WHEN 0 THEN 1 ELSE s.price_std END, 2)
      + pow((f.vol - s.vol) / CASE s.vol_std WHEN 0 THEN 1 ELSE s.vol_std END, 2)
      + pow((f.mom - s.mom) / CASE s.mom_std WHEN 0 THEN 1 ELSE s.mom_std END, 2)), 9) AS dist
  FROM state s JOIN feat f USING (k)
  WHERE f.pos < f.n - 730 AND f.n - 730 > 28 AND s.mom IS NOT NULL
    AND f.vol IS NOT NULL AND f.mom IS NOT NULL),
nearest AS (
  SELECT * FROM distances WHERE dist IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY dist, date) = 1),
analogue AS (
  SELECT k, strftime(date, '%Y-%m-%d') AS week, CAST(printf('%.3f', slow) AS DOUBLE) AS price_then,
    CAST(printf('%.3f', 1 / (1 + dist)) AS DOUBLE) AS similarity_score,
    CASE WHEN year(date) = 2008 THEN 'analogue_2008_crisis'
         WHEN year(date) = 2005 THEN 'analogue_2005_katrina'
         WHEN date BETWEEN DATE '2022-02-01' AND DATE '2022-07-31' THEN 'analogue_2022_invasion'
         WHEN year(date) = 2020 THEN 'analogue_2020_covid'
         WHEN year(date) = 2009 THEN 'analogue_2009_recovery'
         WHEN year(date) BETWEEN 2014 AND 2016 THEN 'analogue_2014_oil_crash'
         ELSE 'analogue_generic' END AS narrative_key
  FROM nearest)"""


def _differs(left: str, right: str) -> str:
    """Whether two sets of rows differ, repeats counted."""
    sides = [(left, right), (right, left)]
    return " OR ".join(f"EXISTS (({a}) EXCEPT ALL ({b}))" for a, b in sides)


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _over(keys: tuple[str, ...], parts: str, select: str, source: str) -> str:
    """Query over the series of ``keys``; the key is selected under its own name."""
    key = f"k AS {keys[0]}, " if keys else ""
    return f"WITH {_SERIES[keys]}{parts}\nSELECT {key}{select} FROM {source}"


def _timeline(keys: tuple[str, ...] = ()) -> str:
    return _over(
        keys,
        _TIMELINE,
        f"{_day('date')} AS date, fast AS wti_usd_bbl, "
        f"slow AS diesel_usd_gal, {_day('week')} AS diesel_week_ending",
        "timeline",
    )


def _sweep(keys: tuple[str, ...] = ()) -> str:
    return _over(
        keys, _SWEEP, "lag_days, round(correlation, 6) AS correlation, is_optimal", "flagged"
    )


def _optimal(keys: tuple[str, ...] = ()) -> str:
    return _over(
        keys,
        _SWEEP,
        "lag_days, round(correlation, 6) AS correlation",
        "flagged WHERE is_optimal QUALIFY row_number() OVER (PARTITION BY k ORDER BY lag_days) = 1",
    )


def _shocks(keys: tuple[str, ...] = (), rows: int = 10) -> str:
    return _over(
        keys,
        _SHOCKS,
        f"CAST(rank AS INTEGER) AS rank, {_day('date')} AS peak_date, "
        f"{_day('date - 28')} AS period_start_date, pct AS pct_change_28d, "
        "start_price AS diesel_start_usd_gal, slow AS diesel_peak_usd_gal, "
        "fast AS wti_at_peak_usd_bbl",
        f"shocks WHERE rank <= {rows}",
    )


def _volatility(keys: tuple[str, ...] = ()) -> str:
    return _over(
        keys,
        _FEATURES,
        f"{_day('date')} AS date, ret AS daily_return, round(vol, 6) AS volatility",
        "feat",
    )


def _daily(keys: tuple[str, ...] = ()) -> str:
    return _over(
        keys,
        _REGIMES,
        f"{_day('date')} AS date, price_pct AS price_pct, "
        "round(vol, 6) AS volatility, vol_rank AS volatility_rank, regime",
        "daily",
    )


def _history(keys: tuple[str, ...] = ()) -> str:
    return _over(
        keys,
        _REGIMES,
        f"""{_day('start')} AS start, {_day('"end"')} AS "end", regime""",
        "segments",
    )


_KPIS = (
    "as_of_date, regime, current_price_usd_gal, delta_1w_pct, delta_yoy_pct, "
    "percentile_25y, percentile_5y"
)
_ANALOGUE = "week, price_then, similarity_score, narrative_key"


def _kpis(keys: tuple[str, ...] = ()) -> str:
    return _over(keys, _FEATURES + _STATUS, _KPIS, "kpis")


def _sparkline(keys: tuple[str, ...] = ()) -> str:
    return _over(
        keys,
        _TIMELINE,
        "CAST(least(12, (n - 1) // 5 + 1) - 1 - (n - 1 - pos) // 5 AS INTEGER) AS point, "
        "CAST(printf('%.3f', slow) AS DOUBLE) AS price",
        "num WHERE n >= 60 AND (n - 1 - pos) % 5 = 0 AND n - 1 - pos < 60",
    )


def _analogue(keys: tuple[str, ...] = ()) -> str:
    return _over(keys, _FEATURES + _STATUS, _ANALOGUE, "analogue")


def _snapshot(keys: tuple[str, ...] = ()) -> str:
    return _over(
        keys,
        _FEATURES + _STATUS,
        f"{_KPIS}, headline_price, headline_pct, headline_yoy, context_clause_key, {_ANALOGUE}",
        "kpis LEFT JOIN analogue USING (k)",
    )


_SINGLE = _SERIES[()]
_STAMP = (
    "'2024-06-30 12:00:00.000000' AS ingestion_timestamp, '2024-06-30' AS ingestion_date"
)

ORACLE: dict[str, str] = {
    "price_timeline": _timeline(),
    "price_timeline_by_priority": _timeline(PRIORITY),
    "price_timeline_by_supplier": _timeline(SUPPLIER),
    "lag_sweep": _sweep(),
    "lag_sweep_by_priority": _sweep(PRIORITY),
    "lag_sweep_by_supplier": _sweep(SUPPLIER),
    "optimal_lag": _optimal(),
    "optimal_lag_by_supplier": _optimal(SUPPLIER),
    "shock_ranking": _shocks(),
    "shock_ranking_by_priority": _shocks(PRIORITY),
    "shock_ranking_by_supplier": _shocks(SUPPLIER),
    "rises": _over(
        (),
        _SHOCKS,
        f"{_day('date')} AS date, start_price AS diesel_start_usd_gal, "
        "slow AS diesel_usd_gal, pct AS pct_change_28d",
        "rising",
    ),
    "local_peaks": _over(
        (), _SHOCKS, f"{_day('date')} AS date, pct AS pct_change_28d", "rising WHERE pct = peak"
    ),
    "shock_preview": _shocks(rows=5),
    "latest_per_key": """
SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value AS value
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1""",
    "cleansed_events": """
WITH newest AS (
  SELECT user_id AS account, event_type AS kind, value AS amount
  FROM events WHERE event_type <> 'error'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1)
SELECT account, kind, amount AS amount FROM newest
WHERE amount IS NOT NULL AND NOT isnan(amount) AND amount > 0""",
    "clean_daily": f"""
WITH landed AS (
  SELECT {_day('l_shipdate')} AS date, l_extendedprice AS open_usd_bbl,
    l_extendedprice * (1 + l_tax) AS high_usd_bbl,
    l_extendedprice * (1 - l_discount) AS low_usd_bbl,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) AS price_usd_bbl,
    CAST(l_quantity AS BIGINT) AS volume
  FROM lineitem),
newest AS (
  SELECT * FROM landed
  QUALIFY row_number() OVER (PARTITION BY date ORDER BY
    price_usd_bbl, open_usd_bbl, high_usd_bbl, low_usd_bbl, volume) = 1)
SELECT * FROM newest WHERE price_usd_bbl > 0""",
    "clean_weekly": f"""
SELECT {_day('ts')} AS week_ending, min(value) AS price_usd_gal FROM events
GROUP BY ALL HAVING min(value) > 0""",
    "ingest_daily_batch": f"""
SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, l_extendedprice AS open,
  l_extendedprice * (1 + l_tax) AS high,
  l_extendedprice * (1 - l_discount) AS low,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS close,
  l_extendedprice AS adj_close, CAST(l_quantity AS BIGINT) AS volume,
  l_discount AS dividends, l_tax AS stock_splits, {_STAMP}
FROM lineitem""",
    "ingest_api_pages": f"""
SELECT strftime(ts, '%Y-%m-%d') AS period, 'NUS' AS duoarea, 'U.S.' AS area_name,
  event_type AS product, upper(event_type) AS product_name,
  CAST(user_id AS VARCHAR) AS process, props AS process_name, value AS value,
  'USD' AS units, {_STAMP}
FROM events""",
    "select_series": """
SELECT strftime(ts, '%Y-%m-%d') AS period, event_type AS product,
  CAST(user_id AS VARCHAR) AS process, value AS value
FROM events WHERE event_type = 'purchase'""",
    "page_completeness": """
SELECT count(DISTINCT event_id // 5000) AS pages, count(*) AS records, count(*) AS total,
  0 AS repeated, 0 AS breaks, true AS complete FROM events""",
    "partition_replace": """
SELECT event_id, value AS value, '2024-06-29' AS ingestion_date FROM events
UNION ALL
SELECT event_id, value + 1 AS value, '2024-06-30' AS ingestion_date FROM events""",
    "table_overwrite": "SELECT event_id, value + 1 AS value FROM events",
    "table_summary": f"""
SELECT 'orders' AS "table", count(*) AS "rows", {_day('min(o_orderdate)')} AS min_date,
  {_day('max(o_orderdate)')} AS max_date FROM orders
UNION ALL
SELECT 'lineitem', count(*), {_day('min(l_shipdate)')}, {_day('max(l_shipdate)')} FROM lineitem
UNION ALL
SELECT 'events', count(*), {_day('min(ts)')}, {_day('max(ts)')} FROM events""",
    "rolling_volatility": _volatility(),
    "rolling_volatility_by_supplier": _volatility(SUPPLIER),
    "momentum": _over((), _FEATURES, f"{_day('date')} AS date, mom AS momentum", "feat"),
    "rolling_percentile_5y": _over(
        (), _REGIMES, f"{_day('date')} AS date, price_pct AS price_pct", "daily"
    ),
    "expanding_vol_rank": _over(
        (), _REGIMES, f"{_day('date')} AS date, vol_rank AS volatility_rank", "daily"
    ),
    "regime_daily": _daily(),
    "regime_daily_by_supplier": _daily(SUPPLIER),
    "regime_history": _history(),
    "regime_history_by_priority": _history(PRIORITY),
    "regime_history_by_supplier": _history(SUPPLIER),
    "status_kpis": _kpis(),
    "status_kpis_by_priority": _kpis(PRIORITY),
    "sparkline": _sparkline(),
    "sparkline_by_supplier": _sparkline(SUPPLIER),
    "historical_analogue": _analogue(),
    "historical_analogue_by_priority": _analogue(PRIORITY),
    "status_snapshot": _snapshot(),
    "status_snapshot_by_priority": _snapshot(PRIORITY),
    "status_snapshot_by_supplier": _snapshot(SUPPLIER),
    "rejected_series_by_supplier": _over(
        SUPPLIER, _TIMELINE, "n AS n_rows", "num WHERE pos = 0 AND n < 60"
    ),
    "rejected_series_by_part": _over(
        PART, _TIMELINE, "n AS n_rows", "num WHERE pos = 0 AND n < 30"
    ),
    "historical_analogue_by_supplier": _analogue(SUPPLIER).replace("730", "100"),
    "export_stats": f"""
WITH {_SINGLE}{_REGIMES}{_STATUS}{_SWEEP.removeprefix(_TIMELINE)}{_SHOCKS.removeprefix(_TIMELINE)},
best AS (SELECT * FROM flagged WHERE is_optimal ORDER BY lag_days LIMIT 1)
SELECT 'price_timeline' AS "table", 'rows' AS stat, CAST(count(*) AS VARCHAR) AS value
FROM timeline
UNION ALL SELECT 'price_timeline', 'min_date', {_day('min(date)')} FROM timeline
UNION ALL SELECT 'price_timeline', 'max_date', {_day('max(date)')} FROM timeline
UNION ALL SELECT 'wti_diesel_lag', 'rows', CAST(count(*) AS VARCHAR) FROM flagged
UNION ALL SELECT 'wti_diesel_lag', 'optimal_lag_days', CAST(lag_days AS VARCHAR) FROM best
UNION ALL SELECT 'wti_diesel_lag', 'optimal_correlation',
  printf('%.4f', correlation) FROM best
UNION ALL SELECT 'fuel_shocks', 'rows', CAST(count(*) AS VARCHAR) FROM shocks
UNION ALL SELECT 'fuel_shocks', 'top_event_pct_change',
  printf('%.2f', pct) FROM shocks WHERE rank = 1
UNION ALL SELECT 'fuel_shocks', 'top_event_date', {_day('date')} FROM shocks WHERE rank = 1
UNION ALL SELECT 'diesel_status', 'as_of_date', as_of_date FROM kpis
UNION ALL SELECT 'diesel_status', 'regime', regime FROM kpis
UNION ALL SELECT 'diesel_status', 'regime_segments', CAST(count(*) AS VARCHAR) FROM segments""",
    "export_roundtrip": _timeline(),
    "export_lag_roundtrip": _sweep(),
    "export_shocks_roundtrip": _shocks(),
    "export_status_roundtrip": f"""
WITH {_SINGLE}{_REGIMES}{_STATUS},
points AS (
  SELECT CAST(printf('%.3f', min_by(slow, pos)) AS DOUBLE) AS first_point,
         CAST(printf('%.3f', max_by(slow, pos)) AS DOUBLE) AS last_point
  FROM num WHERE (n - 1 - pos) % 5 = 0 AND n - 1 - pos < 60)
SELECT as_of_date, current_price_usd_gal AS price, context_clause_key AS clause,
  first_point, last_point, week,
  {_day('s.start')} AS start, {_day('s."end"')} AS "end", s.regime
FROM kpis LEFT JOIN analogue USING (k) JOIN segments s USING (k) CROSS JOIN points""",
    "quality_checks": f"""
WITH {_SINGLE}{_TIMELINE}
SELECT 'fresh' AS "check", date_diff('day', max(date), DATE '2001-08-08') <= 7 AS passed
FROM timeline
UNION ALL SELECT 'fresh_in_2002', date_diff('day', max(date), DATE '2002-01-01') <= 7 FROM timeline
UNION ALL SELECT 'output', count(*) > 0 FROM timeline
UNION ALL SELECT 'changed_by_export', {_differs("SELECT * FROM timeline", "SELECT * FROM timeline")}
UNION ALL SELECT 'changed_by_move', {_differs(
    "SELECT * FROM timeline", "SELECT * REPLACE (slow + 1 AS slow) FROM timeline"
)}
UNION ALL SELECT 'changed_by_two_days', {_differs(
    "SELECT * FROM num",
    "SELECT * REPLACE (CASE pos WHEN 0 THEN lead(fast) OVER (ORDER BY date) "
    "WHEN 1 THEN lag(fast) OVER (ORDER BY date) ELSE fast END AS fast) FROM num",
)}""",
}

ORACLE |= {
    "lag_sweep_lead": _sweep().replace("range(0, 91)", "range(-30, 31)"),
    "price_timeline_chunked": _timeline(),
    "lag_sweep_chunked": _sweep(),
    "shock_ranking_chunked": _shocks(),
    "regime_daily_chunked": ORACLE["regime_daily"],
    "regime_history_chunked": ORACLE["regime_history"],
    "regime_history_by_priority_chunked": ORACLE["regime_history_by_priority"],
    "status_snapshot_chunked": ORACLE["status_snapshot"],
    "export_keyed_roundtrip": _timeline(SUPPLIER),
    "export_order": f"""
SELECT CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER) AS line, date, diesel_usd_gal
FROM ({_timeline()})""",
    "manifest": f"""
SELECT '2024-06-30T12:00:00Z' AS generated_at, max(date) AS data_through,
  count(*) AS rows, min(date) AS min_date FROM ({_timeline()})""",
    "changed_null_move": f"""
WITH gold AS ({_timeline()}),
old AS (
  SELECT * REPLACE (CASE WHEN date = '1996-01-01' THEN NULL ELSE diesel_usd_gal END AS diesel_usd_gal)
  FROM gold),
moved AS (
  SELECT * REPLACE (
    CASE WHEN diesel_usd_gal IS NULL THEN NULL ELSE wti_usd_bbl END AS wti_usd_bbl,
    CASE WHEN diesel_usd_gal IS NULL THEN wti_usd_bbl ELSE diesel_usd_gal END AS diesel_usd_gal)
  FROM old)
SELECT 'changed' AS "check", {_differs("SELECT * FROM old", "SELECT * FROM moved")} AS passed""",
    "page_gaps": """
WITH sizes AS (SELECT event_id // 5000 AS page, count(*) AS n FROM events GROUP BY ALL),
cases AS (
  SELECT 'whole' AS landed, true AS placed, page, n FROM sizes
  UNION ALL SELECT 'first for second', true, page, n FROM sizes WHERE page <> 1
  UNION ALL SELECT 'first for second', true, page, n FROM sizes WHERE page = 0
  UNION ALL SELECT 'second missing', true, page, n FROM sizes WHERE page <> 1
  UNION ALL SELECT 'first twice', true, page, n FROM sizes
  UNION ALL SELECT 'first twice', true, page, n FROM sizes WHERE page = 0
  UNION ALL SELECT 'no offsets', false, page, n FROM sizes
  UNION ALL SELECT 'no offsets, first for second', false, page, n FROM sizes WHERE page <> 1
  UNION ALL SELECT 'no offsets, first for second', false, page, n FROM sizes WHERE page = 0),
-- The second page ends the table at small scales, so that nothing begins behind the gap.
last AS (SELECT max(page) AS page, (SELECT count(*) FROM events) AS total FROM sizes),
summed AS (
  SELECT landed, bool_and(placed) AS placed, count(*) AS pages, sum(n)::BIGINT AS records,
    count(*) - count(DISTINCT c.page) AS equal FROM cases c GROUP BY landed)
SELECT landed, pages, records, total,
  CASE WHEN NOT placed THEN equal
       WHEN landed IN ('first for second', 'first twice') THEN 2
       ELSE 0 END AS repeated,
  CASE WHEN NOT placed THEN NULL
       WHEN landed = 'whole' THEN 0
       WHEN landed = 'second missing' THEN CASE WHEN page = 0 THEN 0 WHEN page = 1 THEN 1 ELSE 2 END
       WHEN landed = 'first for second' THEN CASE WHEN page = 0 THEN 0 WHEN page = 1 THEN 1 ELSE 2 END
       ELSE CASE WHEN page = 0 THEN 0 ELSE 1 END END AS breaks,
  landed IN ('whole', 'no offsets') OR (landed = 'second missing' AND page = 0) AS complete
FROM summed, last""",
    "publish_on_change": f"""
WITH days AS (SELECT count(*) AS n FROM ({_timeline()})),
turns AS (SELECT unnest([1, 2, 3])::INTEGER AS turn)
SELECT turn, 'price_timeline' AS "table", turn = 1 AS published, n AS rows, NULL::DOUBLE AS total
FROM turns, days
UNION ALL
SELECT turn, 'events', turn <> 2, (SELECT count(*) FROM events),
  (SELECT round(sum(CASE WHEN event_id % 100 = 7 THEN value * 2 ELSE value END), 2) FROM events)
FROM turns""",
    "event_keys": f"""
WITH moved AS (
  SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE)
    + to_months(CAST(12 * (9 + o_orderkey % 14) AS INTEGER)) AS DATE) AS date FROM orders),
periods AS (SELECT * FROM (VALUES
  (DATE '2005-01-01', DATE '2005-12-31', 'analogue_2005_katrina'),
  (DATE '2008-01-01', DATE '2008-12-31', 'analogue_2008_crisis'),
  (DATE '2009-01-01', DATE '2009-12-31', 'analogue_2009_recovery'),
  (DATE '2014-01-01', DATE '2016-12-31', 'analogue_2014_oil_crash'),
  (DATE '2020-01-01', DATE '2020-12-31', 'analogue_2020_covid'),
  (DATE '2022-02-01', DATE '2022-07-31', 'analogue_2022_invasion')) p(a, b, key))
SELECT o_orderkey, {_day('date')} AS date, coalesce(key, 'analogue_generic') AS narrative_key
FROM moved LEFT JOIN periods ON date BETWEEN a AND b""",
    "event_keys_given": f"""
WITH days AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders),
periods AS (
  SELECT o_orderstatus AS key, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b
  FROM orders WHERE o_totalprice > 400000 GROUP BY ALL)
SELECT o_orderkey, {_day('date')} AS date, coalesce(key, 'none') AS narrative_key
FROM days LEFT JOIN periods ON date BETWEEN a AND b
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY a, b, key) = 1""",
    "catalog_tables": f"""
WITH daily AS (SELECT CAST(l_shipdate AS DATE) AS day FROM lineitem),
kept AS (
  SELECT day FROM (
    SELECT CAST(l_shipdate AS DATE) AS day,
      min(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS price FROM lineitem GROUP BY ALL)
  WHERE price > 0),
weeks AS (
  SELECT CAST(ts AS DATE) AS day FROM events
  GROUP BY ALL HAVING min(value) > 0)
SELECT 'daily_raw' AS "table", 2 * count(*) AS rows, {_day('min(day)')} AS min_date, {_day('max(day)')} AS max_date FROM daily
UNION ALL SELECT 'weekly_raw', count(*), {_day('min(ts)')}, {_day('max(ts)')} FROM events
UNION ALL SELECT 'daily_clean', count(*), {_day('min(day)')}, {_day('max(day)')} FROM kept
UNION ALL SELECT 'weekly_clean', count(*), {_day('min(day)')}, {_day('max(day)')} FROM weeks
UNION ALL SELECT 'timeline', count(*), {_day('min(day)')}, {_day('max(day)')} FROM kept""",
}
