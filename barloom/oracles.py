"""Equivalent SQL for DuckDB, written from the meaning of each query."""

from __future__ import annotations

BARS = """
bars AS (
    SELECT 'S' || l_suppkey AS symbol, l_returnflag,
           CAST(l_shipdate AS date) AS date,
           CAST(epoch(l_shipdate) AS bigint) AS epoch,
           l_extendedprice AS open,
           l_extendedprice * (1 + l_tax) AS high,
           l_extendedprice * (1 - l_discount) AS low,
           l_extendedprice * (1 - l_discount) * (1 + l_tax) AS close,
           CAST(l_quantity AS bigint) AS volume
    FROM lineitem)"""

DAY_BARS = (
    BARS
    + """,
day_bars AS (
    SELECT symbol, date, min(open) AS open, max(high) AS high, min(low) AS low,
           max(close) AS close, CAST(sum(volume) AS bigint) AS volume,
           min(l_returnflag) AS grade
    FROM bars GROUP BY symbol, date)"""
)

PRICES = "open, high, low, close, volume"


def _mean(column: str) -> str:
    """Exact sum, then one division."""
    return f"CAST(sum(CAST({column} AS decimal(18, 6))) AS double) / count({column})"


def _daily(source: str) -> str:
    return f"""
daily AS (
    SELECT symbol, date, {_mean("open")} AS avg_open, {_mean("close")} AS avg_close,
           max(high) AS max_high, min(low) AS min_low,
           CAST(sum(volume) AS bigint) AS total_volume, count(*) AS data_points
    FROM {source} GROUP BY symbol, date)"""


def _market(source: str) -> str:
    return f"""
market AS (
    SELECT date, {_mean("close")} AS market_avg_close,
           CAST(sum(volume) AS double) / count(volume) AS market_avg_volume,
           count(symbol) AS symbols_count, count(DISTINCT symbol) AS distinct_symbols
    FROM {source} GROUP BY date)"""


def _symbol(source: str) -> str:
    return f"""
per_symbol AS (
    SELECT symbol, {_mean("close")} AS avg_close, max(high) AS max_high_all_time,
           min(low) AS min_low_all_time,
           CAST(sum(volume) AS double) / count(volume) AS avg_volume,
           count(*) AS total_data_points
    FROM {source} GROUP BY symbol)"""


def _resampled(bucket: str) -> str:
    return f"""
SELECT event_type AS symbol, {bucket} AS bar_start,
       first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
       last(value ORDER BY ts, event_id) AS close, count(*) AS ticks
FROM events GROUP BY 1, 2"""


ORACLES: dict[str, str] = {
    "daily_metrics": f"WITH {BARS}, {_daily('bars')} SELECT * FROM daily",
    "symbol_metrics": f"WITH {BARS}, {_symbol('bars')} SELECT * FROM per_symbol",
    "market_metrics": f"WITH {BARS}, {_market('bars')} SELECT * FROM market",
    "mean_of_daily_close": f"""
WITH {BARS}, {_daily('bars')}
SELECT symbol,
       CAST(sum(CAST(avg_close AS decimal(38, 15))) AS double) / count(avg_close) AS avg_close
FROM daily GROUP BY symbol""",
    "weighted_close": f"""
WITH {BARS}
SELECT symbol, {_mean('close')} AS weighted_close, count(close) AS n_close
FROM bars GROUP BY symbol""",
    "silver_count": f"WITH {BARS} SELECT count(*) AS rows FROM bars",
    "symbol_series": f"""
WITH {BARS}, {_daily('bars')}
SELECT symbol, date, avg_close FROM daily WHERE symbol = 'S1' ORDER BY date""",
    "symbol_day_lookup": f"""
WITH {BARS}, {_daily('bars')}
SELECT * FROM daily WHERE symbol = 'S1' AND date = DATE '1998-01-05'""",
    "date_lookup": f"""
WITH {BARS} SELECT symbol, date, {PRICES} FROM bars WHERE date = DATE '1998-01-05'""",
    "top5_preview": f"""
WITH {BARS} SELECT symbol, date, {PRICES} FROM bars
ORDER BY close DESC, symbol, date, open, high, low, volume LIMIT 5""",
    "trailing_range": """
SELECT event_type AS symbol, ts, event_id, value AS price
FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
    "latest_bar": """
WITH copies AS (
    SELECT event_type AS symbol, ts, event_id, value AS price, 1 AS version FROM events
    UNION ALL
    SELECT event_type, ts, event_id, value * 2, 2 FROM events)
SELECT symbol, ts, event_id, price, version FROM copies
QUALIFY row_number() OVER (
    PARTITION BY symbol, ts ORDER BY version DESC, event_id DESC, price DESC) = 1""",
    "bars_hourly": _resampled("time_bucket(INTERVAL 1 HOUR, ts)"),
    "bars_daily": _resampled("time_bucket(INTERVAL 1 DAY, ts)"),
    "bars_weekly": _resampled("CAST(date_trunc('week', ts) AS timestamp)"),
    "bars_from_hourly": f"""
SELECT '1d' AS interval, * FROM ({_resampled("time_bucket(INTERVAL 1 DAY, ts)")})
UNION ALL
SELECT '1wk', * FROM ({_resampled("CAST(date_trunc('week', ts) AS timestamp)")})""",
    "local_trade_date": """
WITH zoned AS (
    SELECT ts, ['America/New_York', 'Europe/London', 'Asia/Tokyo', 'Australia/Sydney']
               [CAST(user_id % 4 + 1 AS int)] AS exchange_timezone
    FROM events)
SELECT exchange_timezone, CAST(ts AS date) AS date,
       CAST(timezone(exchange_timezone, timezone('UTC', ts)) AS date) AS local_date,
       count(*) AS bars
FROM zoned GROUP BY 1, 2, 3""",
    "bronze_roundtrip": f"""
WITH {BARS}
SELECT symbol, date, epoch, strftime(make_timestamp(epoch * 1000000), '%Y-%m-%d %H:%M:%S')
       AS datetime_text, close AS adjclose, {PRICES}
FROM bars""",
    "bronze_metadata": f"""
WITH {BARS}
SELECT symbol, 'USD' AS currency, 'X' || right(symbol, 1) AS exchange,
       'America/New_York' AS exchange_timezone, epoch AS "timestamp", true AS has_source
FROM bars""",
    "bronze_listing": """
SELECT strftime(date_trunc('month', l_shipdate), '%Y%m%d_%H%M%S') AS run, true AS complete
FROM lineitem GROUP BY 1""",
    "quarantine": f"""
WITH {DAY_BARS}
SELECT symbol, 'malformed' AS reason, CAST(0 AS bigint) AS bars
FROM day_bars WHERE grade = 'A' AND symbol NOT LIKE '%0' GROUP BY symbol
UNION ALL
SELECT symbol, 'length', 0 FROM day_bars WHERE grade = 'R' GROUP BY symbol
UNION ALL
SELECT symbol, CASE WHEN right(symbol, 1) IN ('0', '2', '4', '6', '8') THEN 'value'
                    ELSE 'timestamp' END, 0
FROM day_bars WHERE grade = 'N' GROUP BY symbol
UNION ALL
SELECT 'S' || s_suppkey, 'error', 0 FROM supplier GROUP BY 1
UNION ALL
SELECT symbol, 'none', count(*) FROM day_bars WHERE grade <> 'A' OR symbol LIKE '%0'
GROUP BY symbol""",
    "silver_append": f"""
WITH {BARS}
SELECT symbol, date, CAST(date_trunc('month', date) AS date) AS month, {PRICES} FROM bars""",
    "incremental_ingest": f"""
WITH {DAY_BARS}
SELECT symbol, date, {PRICES} FROM day_bars
UNION ALL
SELECT 'L' || symbol, date, {PRICES} FROM day_bars""",
    "silver_date_lookup": f"""
WITH {DAY_BARS}
SELECT symbol, date, {PRICES} FROM day_bars WHERE date = DATE '1998-01-05'""",
    "gold_partition_overwrite": f"WITH {DAY_BARS}, {_daily('day_bars')} SELECT * FROM daily",
    "medallion": f"""
WITH {DAY_BARS}, {_symbol('day_bars')}, {_market('day_bars')}
SELECT 'symbol' AS level, symbol AS key, avg_close, avg_volume FROM per_symbol
UNION ALL
SELECT 'date', CAST(date AS varchar), market_avg_close, market_avg_volume FROM market""",
    "gold_replace": f"WITH {BARS}, {_symbol('bars')} SELECT * FROM per_symbol",
    "gold_sql_view": f"""
WITH {BARS}, {_daily('bars')}, {_market('bars')}
SELECT d.symbol, d.date, d.avg_close, m.market_avg_close
FROM daily d JOIN market m ON d.date = m.date
WHERE d.avg_close > m.market_avg_close""",
}
