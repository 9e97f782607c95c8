"""Queries of the indicators and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline import schemas
from wickline.operators import indicators, series, summaries
from wickline.operators.quantile import exact_median
from wickline.operators.quality import clean_candles, silver_rows
from wickline.registry import sql as S
from wickline.registry.book import query
from wickline.session import fresh_folder, staged
from wickline.sources import glossary, market, tables

# A series counts as long above this many rows in the queries that show the cut plans.
SHORT_PIECE = 1000


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    """Stored silver: the indicators read it more than once, as they would a table."""
    return staged(silver_rows(clean_candles(market.bronze_candles(spark, folder))), "silver")


def _closed(spark: SparkSession, folder: str) -> DataFrame:
    return indicators.closed_candles(_silver(spark, folder))


def _closed_once(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows, not stored: for row-level operators, which read them once."""
    return indicators.closed_candles(silver_rows(clean_candles(market.bronze_candles(spark, folder))))


def _steady(df: DataFrame) -> DataFrame:
    """Logarithms and sums differ between engines in the last bits; compare ten digits."""
    return df.withColumn("log_return", F.round("log_return", 10))


_LOG = f"{S.rounded('log_return', 10)} AS log_return"
_KEY = "symbol, day"


@query("lag_previous", S.select(S.RAW, f"SELECT {_KEY}, close, prev_close FROM stepped"))
def lag_previous(spark, folder):
    return series.lag_previous(_closed(spark, folder)).select("symbol", "day", "close", "prev_close")


@query("row_index", S.select(S.RAW, f"SELECT {_KEY}, n AS row_index FROM stepped"))
def row_index(spark, folder):
    return series.row_index(_closed(spark, folder)).select("symbol", "day", "row_index")


@query("moving_average", S.select(S.CLOSED, f"SELECT {_KEY}, {S.mean('close', 20)} AS close_ma20 FROM base"))
def moving_average(spark, folder):
    return series.moving_average(_closed(spark, folder), "close", 20).select(
        "symbol", "day", "close_ma20")


@query("rolling_stddev", S.select(S.CLOSED, f"""
SELECT {_KEY}, {S.rounded(S.deviation('close', 30), 6)} AS close_sd30 FROM base"""))
def rolling_stddev(spark, folder):
    return series.rolling_stddev(_closed(spark, folder), "close", 30).select(
        "symbol", "day", F.round("close_sd30", 6).alias("close_sd30"))


@query("running_max", S.select(S.RAW, f"SELECT {_KEY}, top AS close_max FROM raw"))
def running_max(spark, folder):
    return series.running_max(_closed(spark, folder), "close").select("symbol", "day", "close_max")


@query("long_series_windows", S.select(S.RAW, f"""
SELECT {_KEY}, n AS row_index, prev_close, top AS close_max, m200 AS close_ma200 FROM raw"""))
def long_series_windows(spark, folder):
    """The window primitives on series cut into pieces."""
    return series.on_series(
        _closed(spark, folder),
        lambda f, s: f.withColumns({
            "row_index": s.position, "prev_close": s.previous("close"),
            "close_max": s.running_max("close"), "close_ma200": s.mean("close", 200)}),
        halo=199, carry=["close"], max_rows=SHORT_PIECE,
    ).select("symbol", "day", "row_index", "prev_close", "close_max", "close_ma200")


@query("change", S.select(S.RAW, f"SELECT {_KEY}, close, prev_close, {S.CHANGES} FROM stepped"))
def change(spark, folder):
    return indicators.change(_closed(spark, folder)).select(
        "symbol", "day", "close", "prev_close", "change_abs", "change_pct")


@query("log_return", S.select(S.RAW, f"SELECT {_KEY}, {_LOG} FROM stepped"))
def log_return(spark, folder):
    return _steady(indicators.log_return(_closed(spark, folder)).select("symbol", "day", "log_return"))


@query("range_pct", S.select(S.CLOSED, f"SELECT {_KEY}, {S.RANGE} FROM base"))
def range_pct(spark, folder):
    return indicators.range_pct(_closed_once(spark, folder)).select("symbol", "day", "range_pct")


@query("quote_volume_est", S.select(S.CLOSED, f"SELECT {_KEY}, {S.QUOTE} FROM base"))
def quote_volume_est(spark, folder):
    return indicators.quote_volume_est(_closed_once(spark, folder)).select(
        "symbol", "day", "quote_volume_est")


@query("volume_per_trade", S.select(S.CLOSED, f"SELECT {_KEY}, {S.PER_TRADE} FROM base"))
def volume_per_trade(spark, folder):
    return indicators.volume_per_trade(_closed_once(spark, folder)).select(
        "symbol", "day", "volume_per_trade")


@query("candle_type", S.select(S.CLOSED, f"SELECT {_KEY}, {S.KIND} FROM base"))
def candle_type(spark, folder):
    return indicators.candle_type(_closed_once(spark, folder)).select("symbol", "day", "candle_type")


@query("calendar_columns", S.select(S.CLOSED, f"SELECT {_KEY}, {S.CALENDAR} FROM base"))
def calendar_columns(spark, folder):
    return indicators.calendar_columns(_closed_once(spark, folder).select("symbol", "day"))


@query("moving_averages", S.select(S.RAW, f"SELECT {_KEY}, {S.AVERAGES} FROM raw"))
def moving_averages(spark, folder):
    return indicators.moving_averages(_closed(spark, folder)).select(
        "symbol", "day", "ma7", "ma30", "ma50", "ma200")


@query("trend_cross", S.select(S.RAW, f"SELECT {_KEY}, {S.TREND} FROM raw"))
def trend_cross(spark, folder):
    return indicators.trend_cross(_closed(spark, folder)).select("symbol", "day", "trend_ma50_ma200")


@query("volatility_annualized", S.select(S.RAW, f"SELECT {_KEY}, {S.VOLATILITY} FROM raw"))
def volatility_annualized(spark, folder):
    return indicators.volatility_annualized(_closed(spark, folder)).select(
        "symbol", "day", "vol_30d_annual_pct")


@query("drawdown", S.select(S.RAW, f"SELECT {_KEY}, {S.DRAWDOWN} FROM raw"))
def drawdown(spark, folder):
    return indicators.drawdown(_closed(spark, folder)).select(
        "symbol", "day", "running_max_close", "drawdown_pct")


@query("relative_volume", S.select(S.RAW, f"SELECT {_KEY}, {S.REL_VOLUME} FROM raw"))
def relative_volume(spark, folder):
    return indicators.relative_volume(_closed(spark, folder)).select(
        "symbol", "day", "volume_ma30", "relative_volume")


_DAILY = S.select(S.DAILY, f"SELECT * REPLACE ({S.rounded('log_return', 10)} AS log_return) FROM daily")


@query("daily_indicators", _DAILY)
def daily_indicators(spark, folder):
    return _steady(indicators.daily_indicators(_silver(spark, folder)))


@query("daily_indicators_long_series", _DAILY)
def daily_indicators_long_series(spark, folder):
    """The same table with every series cut into pieces, as for series too long for one task."""
    return _steady(indicators.daily_indicators(_silver(spark, folder), max_rows=SHORT_PIECE))


@query("daily_tail", S.select(S.DAILY + """,
changed AS (SELECT symbol, max(day) - 60 AS since FROM silver GROUP BY symbol)""", f"""
SELECT daily.* REPLACE ({S.rounded('log_return', 10)} AS log_return)
FROM daily JOIN changed USING (symbol) WHERE day >= since"""))
def daily_tail(spark, folder):
    """The last 60 days of every series, recomputed from the stored daily table and silver."""
    silver, stored = _stored_daily(spark, folder)
    since = silver.groupBy("symbol").agg(F.date_sub(F.max("day"), 60).alias("since"))
    return _steady(indicators.daily_tail(silver, stored, since))


@query("filter_not_null", S.select(S.DAILY, f"""
SELECT {_KEY}, change_pct FROM daily WHERE change_pct IS NOT NULL"""))
def filter_not_null(spark, folder):
    return indicators.change(_closed(spark, folder)).where(F.col("change_pct").isNotNull()).select(
        "symbol", "day", "change_pct")


_INTRADAY = f"""SELECT event_type, event_id, ts, {S.mean('value', 50, 'event_type', 'ts')} AS value_ma50,
       max(value) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS value_max,
       row_number() OVER (PARTITION BY event_type ORDER BY ts) AS row_index
FROM events"""


@query("intraday_windows", _INTRADAY)
def intraday_windows(spark, folder):
    """Row frames over irregular intraday series, cut into pieces where they are long."""
    events = market.table(spark, folder, "events").select("event_type", "event_id", "ts", "value")
    return series.on_series(
        events, lambda f, s: f.withColumns({
            "value_ma50": s.mean("value", 50), "value_max": s.running_max("value"),
            "row_index": s.position}),
        by="event_type", on="ts", ties=["event_id"], halo=49, carry=["value"], max_rows=SHORT_PIECE).drop("value")


_MONTHLY = S.select(S.DAILY + """,
dated AS (
  SELECT *, day - CAST(dayofmonth(day) - 1 AS INTEGER) AS month_start,
         rank() OVER (PARTITION BY symbol, year, month ORDER BY day) AS nth,
         rank() OVER (PARTITION BY symbol, year, month ORDER BY day DESC) AS nth_last FROM daily),
months AS (
  SELECT symbol, month_start, max(high) AS high_m, min(low) AS low_m, sum(volume) AS volume,
         sum(quote_volume_est) AS quoted, sum(num_trades) AS trades, count(*) AS days,
         sum(CAST(change_pct > 0 AS INTEGER)) AS ups, sum(CAST(change_pct < 0 AS INTEGER)) AS downs,
         stddev_samp(log_return) AS sd, min(drawdown_pct) AS worst
  FROM dated GROUP BY symbol, month_start)""", f"""
SELECT m.symbol, m.month_start, f.year, f.month, f.year_month, f.open AS open_m, l.close AS close_m,
       high_m, low_m, {S.rounded('(l.close / f.open - 1) * 100', 2)} AS return_pct,
       {S.rounded('(high_m - low_m) / f.open * 100', 2)} AS range_pct, m.volume,
       {S.rounded('quoted', 2)} AS quote_volume_est, CAST(trades AS BIGINT) AS num_trades, m.days,
       CAST(coalesce(ups, 0) AS BIGINT) AS up_days, CAST(coalesce(downs, 0) AS BIGINT) AS down_days,
       {S.rounded('m.sd * sqrt(365) * 100', 2)} AS vol_annual_pct, worst AS worst_drawdown_pct
FROM months m JOIN dated f ON f.nth = 1 AND (f.symbol, f.month_start) = (m.symbol, m.month_start)
JOIN dated l ON l.nth_last = 1 AND (l.symbol, l.month_start) = (m.symbol, m.month_start)""")


@query("monthly_summary", _MONTHLY)
def monthly_summary(spark, folder):
    daily = indicators.daily_indicators(_silver(spark, folder))
    return summaries.monthly_summary(daily).withColumn(
        "quote_volume_est", F.round("quote_volume_est", 2))


_WEEKDAY = S.select(S.DAILY + """,
sorted AS (
  SELECT symbol, weekday_num, any_value(weekday) AS weekday, list(change_pct ORDER BY change_pct) AS moves,
         avg(change_pct) AS mean_move, avg(range_pct) AS mean_range, avg(volume) AS mean_vol
  FROM daily WHERE change_pct = change_pct GROUP BY symbol, weekday_num)""", f"""
SELECT symbol, weekday_num, weekday, len(moves) AS days, {S.rounded('mean_move', 3)} AS mean_return_pct,
       {S.rounded('0.5::DOUBLE * moves[(len(moves) + 1) // 2] + 0.5::DOUBLE * moves[len(moves) // 2 + 1]', 3)}
         AS median_return_pct,
       {S.rounded('CAST(len(list_filter(moves, lambda x: x > 0)) AS DOUBLE) / len(moves) * 100', 1)}
         AS up_days_pct,
       {S.rounded('mean_range', 3)} AS mean_range_pct, {S.rounded('mean_vol', 2)} AS mean_volume
FROM sorted""")


def _stored_daily(spark: SparkSession, folder: str, **options) -> tuple[DataFrame, DataFrame]:
    """(silver, daily), both stored: the summaries read the stored daily table."""
    silver = _silver(spark, folder)
    return silver, staged(indicators.daily_indicators(silver, **options), "daily")


@query("weekday_seasonality", _WEEKDAY)
def weekday_seasonality(spark, folder):
    return summaries.weekday_seasonality(_stored_daily(spark, folder)[1])


@query("weekday_seasonality_long_groups", _WEEKDAY)
def weekday_seasonality_long_groups(spark, folder):
    """The same with medians ranked by a range layout, as for groups too large for a buffer."""
    return summaries.weekday_seasonality(_stored_daily(spark, folder)[1], buffer_rows=100)


@query("exact_median", """
SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS median_price
FROM lineitem GROUP BY l_returnflag""")
def median_price(spark, folder):
    """Median over three groups that hold the whole table."""
    items = market.table(spark, folder, "lineitem")
    return exact_median(
        items, "l_returnflag", "l_extendedprice", "median_price", ["l_orderkey", "l_linenumber"],
        buffer_rows=SHORT_PIECE)


_REF = """,
newest AS (FROM daily QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY day DESC) = 1),
unfinished AS (
  SELECT symbol, CAST(close AS DOUBLE) AS partial_price, ingest_ts AS partial_price_at FROM silver
  WHERE is_closed = false QUALIFY rank() OVER (PARTITION BY symbol ORDER BY day DESC) = 1),
asked AS (
  SELECT symbol, close AS now_close, unnest(['7', '30', '365', 'ytd']) AS label,
         unnest([day - 7, day - 30, day - 365, make_date(year(day), 1, 1) - 1]) AS target FROM newest),
then_closes AS (
  SELECT a.symbol, a.label, a.now_close, d.close
  FROM asked a ASOF LEFT JOIN daily d ON a.symbol = d.symbol AND a.target >= d.day)"""


def _then(label: str) -> str:
    return f"max(close) FILTER (WHERE label = '{label}')"


def _since(label: str) -> str:
    return S.rounded(f"(any_value(now_close) / {_then(label)} - 1) * 100", 2)


_KPI = S.select(S.DAILY + _REF + f""",
peaks AS (FROM daily QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY high DESC, day) = 1),
year_bounds AS (
  SELECT n.symbol, max(d.high) AS high_52w, min(d.low) AS low_52w
  FROM newest n JOIN daily d ON d.symbol = n.symbol AND d.day BETWEEN n.day - 364 AND n.day GROUP BY n.symbol),
month_volumes AS (
  SELECT n.symbol, avg(d.volume) AS mean_volume
  FROM newest n JOIN daily d ON d.symbol = n.symbol AND d.day BETWEEN n.day - 29 AND n.day GROUP BY n.symbol),
changes AS (
  SELECT symbol, {_since('7')} AS change_7d_pct, {_since('30')} AS change_30d_pct,
         {_since('365')} AS change_12m_pct, {_since('ytd')} AS change_ytd_pct
  FROM then_closes GROUP BY symbol)""", f"""
SELECT symbol, n.day AS last_close_day, n.close AS last_close, {S.rounded('n.change_pct', 2)} AS change_1d_pct,
       change_7d_pct, change_30d_pct, change_12m_pct, change_ytd_pct, p.high AS all_time_high,
       p.day AS all_time_high_day, high_52w, low_52w, n.drawdown_pct, n.vol_30d_annual_pct, n.ma50, n.ma200,
       n.trend_ma50_ma200, {S.rounded('mean_volume', 2)} AS mean_volume_30d, partial_price, partial_price_at
FROM newest n JOIN peaks p USING (symbol) JOIN year_bounds USING (symbol) JOIN month_volumes USING (symbol)
JOIN changes USING (symbol) LEFT JOIN unfinished USING (symbol)""")


@query("kpi_snapshot", _KPI)
def kpi_snapshot(spark, folder):
    silver, daily = _stored_daily(spark, folder)
    return summaries.kpi_snapshot(daily, silver)


@query("join_ref_date", S.select(S.DAILY + _REF, """
SELECT daily.symbol, daily.day, daily.close, newest.day AS ref_day FROM daily JOIN newest USING (symbol)"""))
def join_ref_date(spark, folder):
    return summaries.join_ref_date(_closed(spark, folder).select("symbol", "day", "close"))


@query("asof_lookback", S.select(S.DAILY + _REF, f"""
SELECT newest.symbol, any_value(newest.day) AS ref_day, any_value(now_close) AS close,
       {_then('7').replace('close', 't.close')} AS close_7d_ago,
       {_then('30').replace('close', 't.close')} AS close_30d_ago,
       {_then('365').replace('close', 't.close')} AS close_365d_ago
FROM then_closes t JOIN newest USING (symbol) GROUP BY newest.symbol"""))
def asof_lookback(spark, folder):
    return summaries.asof_lookback(_closed(spark, folder), "close", [7, 30, 365])


@query("asof_lookback_orders", """
WITH bars AS (
  SELECT o_orderstatus AS symbol, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS top_price
  FROM orders GROUP BY ALL),
ends AS (FROM bars QUALIFY day = max(day) OVER (PARTITION BY symbol))
SELECT e.symbol, e.day AS ref_day, e.top_price, b.top_price AS top_price_30d_ago
FROM ends e ASOF LEFT JOIN bars b ON e.symbol = b.symbol AND e.day - 30 >= b.day""")
def asof_lookback_orders(spark, folder):
    """As-of look-back over the highest order of each day, per order status."""
    bars = market.table(spark, folder, "orders").groupBy(
        F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("symbol")
    ).agg(F.max("o_totalprice").alias("top_price"))
    return summaries.asof_lookback(staged(bars), "top_price", 30)


@query("join_partial_price", S.select(S.DAILY + _REF, """
SELECT newest.symbol, newest.day AS ref_day, partial_price, partial_price_at
FROM newest LEFT JOIN unfinished USING (symbol)"""))
def join_partial_price(spark, folder):
    silver = _silver(spark, folder)
    last = indicators.closed_candles(silver).groupBy("symbol").agg(F.max("day").alias("ref_day"))
    return summaries.join_partial_price(last, silver)


_REPORT = ["symbol", "day", "close", "change_pct", "ma7", "ma30", "ma200", "vol_30d_annual_pct",
           "drawdown_pct", "relative_volume"]


@query("top_k", S.select(S.DAILY, f"""
SELECT {', '.join(_REPORT)} FROM daily ORDER BY day DESC, symbol LIMIT 15"""))
def top_k(spark, folder):
    """Report of the last 15 rows of the daily table."""
    daily = indicators.daily_indicators(_silver(spark, folder)).select(*_REPORT)
    return summaries.top_k(daily, [F.col("day").desc(), F.col("symbol").asc()], 15)


@query("sort_asc", S.select(S.CLOSED, "SELECT symbol, day, close FROM base ORDER BY day, symbol"))
def sort_asc(spark, folder):
    return _closed_once(spark, folder).select("symbol", "day", "close").orderBy("day", "symbol")


@query("replace_table", S.select(S.DAILY, f"""
SELECT {', '.join(_REPORT)} FROM daily"""))
def replace_table(spark, folder):
    """The daily table rebuilt into a fresh folder, clustered by symbol and day, and read back."""
    daily = indicators.daily_indicators(_silver(spark, folder))
    written = tables.replace_table(daily, fresh_folder(spark, "gold"), "run", ["symbol", "day"])
    return spark.read.parquet(written).select(*_REPORT)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_COUNTED = " UNION ALL ".join(
    f"SELECT {row[0]} AS position, " + ", ".join(
        f"{_text(value)} AS {name}" for name, value in zip(schemas.GLOSSARY.fieldNames()[1:], row[1:]))
    + f", count({row[5].split('.')[1]}) AS filled_rows FROM {row[5].split('.')[0]}_table"
    for row in glossary.ROWS)


@query("glossary", f"""
WITH daily_table AS ({_DAILY}), monthly_table AS ({_MONTHLY}), weekday_table AS ({_WEEKDAY}),
kpi_table AS ({_KPI})
{_COUNTED}""")
def glossary_terms(spark, folder):
    """Every term with how often its source column is filled in the gold tables."""
    silver, daily = _stored_daily(spark, folder)
    gold = {
        "daily": daily,
        "monthly": summaries.monthly_summary(daily),
        "weekday": summaries.weekday_seasonality(daily),
        "kpi": summaries.kpi_snapshot(daily, silver),
    }
    return glossary.check_glossary(glossary.glossary(spark), gold)
