"""Building blocks of the checking SQL, written independently of the Spark plans.

Rounding goes through text, because Spark rounds the decimal text of a double half up. Sliding
means add their frame in row order, as Spark's sliding frames do.
"""

from __future__ import annotations

_PRICE = "l_extendedprice / l_quantity"
_TRADE = "row(l_orderkey, l_linenumber, l_extendedprice, l_quantity)"

BRONZE = f"""
bars AS (
  SELECT l_returnflag AS symbol_raw, CAST(l_shipdate AS DATE) AS d, l_linestatus = 'F' AS is_closed,
         arg_min({_PRICE}, {_TRADE}) AS open, max({_PRICE}) AS high, min({_PRICE}) AS low,
         arg_max({_PRICE}, {_TRADE}) AS close, sum(l_quantity) AS volume,
         CAST(count(*) AS BIGINT) AS num_trades, max(l_orderkey) AS last_order
  FROM lineitem GROUP BY l_returnflag, CAST(l_shipdate AS DATE), l_linestatus = 'F'),
bronze AS (
  SELECT CAST(d AS TIMESTAMP) AS open_time,
         CAST(d AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND AS close_time,
         open, high, low, close, volume, num_trades, is_closed,
         strftime(CAST(d AS TIMESTAMP) + to_seconds(last_order), '%Y-%m-%dT%H:%M:%S+00:00')
           AS ingest_ts_utc, symbol_raw
  FROM bars)"""

_N = "(date_diff('day', DATE '1995-01-01', CAST(open_time AS DATE)) % 101)"

# Replaces the bronze step by the same candles with one fault per rule.
FAULTY = BRONZE.replace("bronze AS (", "sound AS (") + f""",
bronze AS (
  SELECT open_time,
         CASE WHEN {_N} = 5 THEN open_time ELSE close_time END AS close_time,
         CASE WHEN {_N} IN (1, 6) THEN 0.0 ELSE open END AS open,
         CASE WHEN {_N} = 2 THEN low / 2 ELSE high END AS high,
         CASE WHEN {_N} = 3 THEN high * 2 ELSE low END AS low,
         close,
         CASE WHEN {_N} IN (4, 6) THEN -1.0 ELSE volume END AS volume,
         num_trades, is_closed, ingest_ts_utc,
         CASE WHEN {_N} = 0 AND symbol_raw = 'A' THEN NULL ELSE symbol_raw END AS symbol_raw
  FROM sound)"""


def rounded(value: str, digits: int) -> str:
    return f"CAST(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,{digits})) AS DOUBLE)"


def _dec(col: str, digits: int) -> str:
    return f"CAST(CAST({col} AS VARCHAR) AS DECIMAL(28,{digits})) AS {col}"


TYPED = f"""
typed AS (
  SELECT upper(trim(symbol_raw)) AS symbol, open_time, close_time,
         {_dec('open', 2)}, {_dec('high', 2)}, {_dec('low', 2)}, {_dec('close', 2)},
         {_dec('volume', 8)}, num_trades, coalesce(is_closed, false) AS is_closed,
         strptime(ingest_ts_utc, '%Y-%m-%dT%H:%M:%S+00:00') AS ingest_ts
  FROM bronze)"""

# What each rule forbids, in the rules' order; a NULL operand forbids nothing.
_FORBIDDEN = {
    "null key": "NOT (symbol IS NOT NULL AND open_time IS NOT NULL)",
    "non-positive price": "least(open, high, low, close) <= 0",
    "high below open/close": "high < open OR high < close",
    "low above open/close": "low > open OR low > close",
    "negative volume or trades": "volume < 0 OR num_trades < 0",
    "close before open time": "date_diff('microsecond', open_time, close_time) <= 0",
}
_JUDGED = ", ".join(f"{{'reason': '{name}', 'broken': {test}}}" for name, test in _FORBIDDEN.items())
REASON = f"list_filter([{_JUDGED}], lambda r: r.broken)[1].reason"

CLEANED = f"""
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, open_time
                   ORDER BY is_closed DESC, ingest_ts DESC NULLS LAST) AS rn FROM typed) WHERE rn = 1),
cleaned AS (SELECT * EXCLUDE (rn), {REASON} AS reason FROM latest)"""

_SILVER = """
silver AS (
  SELECT symbol, CAST(open_time AS DATE) AS day, open_time, close_time, open, high, low, close,
         volume, num_trades, is_closed, ingest_ts
  FROM cleaned WHERE reason IS NULL)"""

SILVER = ",".join([BRONZE, TYPED, CLEANED, _SILVER])

CLOSED = SILVER + """,
base AS (
  SELECT symbol, day, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
         CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close,
         CAST(volume AS DOUBLE) AS volume, num_trades
  FROM silver WHERE is_closed)"""


def doubles(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


AMOUNTS = doubles("open", "high", "low", "close", "volume")


def mean(col: str, n: int, by: str = "symbol", on: str = "day") -> str:
    w = f"OVER (PARTITION BY {by} ORDER BY {on} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"(list_sum(list({col}) {w}) / count({col}) {w})"


def deviation(col: str, n: int, by: str = "symbol", on: str = "day") -> str:
    return (f"stddev_samp({col}) OVER (PARTITION BY {by} ORDER BY {on} "
            f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)")




def tail_mean(col: str, n: int) -> str:
    """Mean of the last ``n`` entries of a list, added from its front."""
    last = f"{col}[greatest(len({col}) - {n - 1}, 1):]"
    return f"(list_sum({last}) / len({last}))"


# Raw indicators of every closed candle, before rounding and gates. Frames are lists gathered by a
# join on row numbers; there is no sliding window.
RAW = CLOSED + f""",
counted AS (
  SELECT a.symbol, a.day, count(*) AS n, max(b.close) AS top
  FROM base a JOIN base b ON b.symbol = a.symbol AND b.day <= a.day GROUP BY a.symbol, a.day),
placed AS (SELECT base.*, n, top FROM base JOIN counted USING (symbol, day)),
stepped AS (
  SELECT p.*, q.close AS prev_close, ln(p.close / q.close) AS log_return
  FROM placed p LEFT JOIN placed q ON q.symbol = p.symbol AND q.n = p.n - 1),
frames AS (
  SELECT a.symbol, a.day, list(b.close ORDER BY b.n) AS cs, list(b.volume ORDER BY b.n) AS vs,
         list(b.log_return ORDER BY b.n) AS rs
  FROM stepped a JOIN stepped b ON b.symbol = a.symbol AND b.n BETWEEN a.n - 199 AND a.n
  GROUP BY a.symbol, a.day),
raw AS (
  SELECT stepped.*, {tail_mean('cs', 7)} AS m7, {tail_mean('cs', 30)} AS m30, {tail_mean('cs', 50)} AS m50,
         {tail_mean('cs', 200)} AS m200, {tail_mean('vs', 30)} AS vm,
         list_stddev_samp(rs[greatest(len(rs) - 29, 1):]) AS sd
  FROM stepped JOIN frames USING (symbol, day))"""

CHANGES = (f"{rounded('close - prev_close', 2)} AS change_abs, "
           f"{rounded('(close / prev_close - 1) * 100', 4)} AS change_pct")
RANGE = f"{rounded('(high - low) / open * 100', 4)} AS range_pct"
QUOTE = "volume * (high + low + close) / 3 AS quote_volume_est"
PER_TRADE = "volume / nullif(num_trades, 0) AS volume_per_trade"
KIND = "CASE WHEN close >= open THEN 'up' ELSE 'down' END AS candle_type"
AVERAGES = (f"{rounded('m7', 2)} AS ma7, CASE WHEN n >= 30 THEN {rounded('m30', 2)} END AS ma30, "
            f"CASE WHEN n >= 50 THEN {rounded('m50', 2)} END AS ma50, "
            f"CASE WHEN n >= 200 THEN {rounded('m200', 2)} END AS ma200")
TREND = ("CASE WHEN n >= 200 THEN ['down', 'up'][1 + CAST(m50 > m200 AS INTEGER)] END "
         "AS trend_ma50_ma200")
VOLATILITY = f"CASE WHEN n >= 31 THEN {rounded('sd * sqrt(365) * 100', 2)} END AS vol_30d_annual_pct"
DRAWDOWN = (f"{rounded('top', 2)} AS running_max_close, "
            f"{rounded('(close / top - 1) * 100', 2)} AS drawdown_pct")
REL_VOLUME = (f"{rounded('vm', 4)} AS volume_ma30, "
              f"{rounded('volume / nullif(vm, 0)', 2)} AS relative_volume")
CALENDAR = """CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter,
         CAST(month(day) AS INTEGER) AS month, strftime(day, '%Y-%m') AS year_month,
         CAST(dayofweek(day) + 1 AS INTEGER) AS weekday_num,
         ['Sun','Mon','Tue','Wed','Thu','Fri','Sat'][dayofweek(day) + 1] AS weekday"""

DAILY = RAW + f""",
daily AS (
  SELECT symbol, day, {CALENDAR}, open, high, low, close, volume, {QUOTE}, num_trades, {PER_TRADE},
         prev_close, {CHANGES}, log_return, {RANGE}, {KIND}, {AVERAGES}, {TREND}, {VOLATILITY},
         {DRAWDOWN}, {REL_VOLUME}
  FROM raw)"""

# The same loads that the Spark side reads out of the events.
LOADS = """
loads AS (
  SELECT CASE event_type WHEN 'view' THEN 'silver' WHEN 'click' THEN 'daily'
           WHEN 'purchase' THEN 'monthly' WHEN 'signup' THEN 'weekday' WHEN 'error' THEN 'kpi' END
           AS tbl,
         ts AS executed_at,
         CASE WHEN event_type = 'view' THEN 'MERGE'
              WHEN event_type = 'signup' THEN 'CREATE TABLE AS SELECT'
              WHEN event_type = 'error' AND user_id % 2 = 0 THEN 'OPTIMIZE'
              ELSE 'CREATE OR REPLACE TABLE AS SELECT' END AS operation,
         user_id AS moved, event_id % 7 AS updated,
         CAST(CAST(CAST(value * 1000 AS VARCHAR) AS DECIMAL(38,0)) AS BIGINT) AS ms
  FROM events),
silver_loads AS (
  SELECT executed_at, operation, moved AS rows_inserted, updated AS rows_updated,
         CAST(0 AS BIGINT) AS rows_deleted, ms / 1000.0 AS duration_s
  FROM loads WHERE tbl = 'silver' AND operation = 'MERGE'),
gold_loads AS (
  SELECT tbl AS "table", executed_at, operation, moved AS rows, ms / 1000.0 AS duration_s
  FROM loads
  WHERE tbl IN ('daily', 'monthly', 'weekday', 'kpi')
    AND operation IN ('CREATE OR REPLACE TABLE AS SELECT', 'CREATE TABLE AS SELECT'))"""

# Every event is a load of one layer, except those that only rewrote files.
VOLUMES = LOADS + f""",
volumes AS (
  SELECT CAST(date_trunc('day', executed_at) AS DATE) AS day, if(tbl = 'silver', tbl, 'gold') AS layer,
         count(*) AS runs, CAST(sum(moved) AS BIGINT) AS rows_inserted,
         CAST(sum(if(tbl = 'silver', updated, NULL)) AS BIGINT) AS rows_updated,
         {rounded('avg(ms / 1000.0)', 1)} AS mean_duration_s
  FROM loads WHERE operation <> 'OPTIMIZE' GROUP BY ALL)"""


def select(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"
