"""Queries of the streaming loads: each runs its stream to the end and returns the stored table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from wickline import schemas
from wickline.plans.lake import Lake
from wickline.operators import states
from wickline.plans import refresh
from wickline.plans.refresh import read_gold
from wickline.registry import sql as S
from wickline.registry.book import query
from wickline.registry.gold import _KPI, _MONTHLY, _stored_daily
from wickline.registry.silver import _CLOSED_SILVER, _SPINE
from wickline.session import configure, fresh_folder, staged
from wickline.sources import landing, market, tables
from wickline.streaming import loads

NOW = datetime(2002, 1, 1, tzinfo=timezone.utc)


def _landed_lake(spark, folder) -> Lake:
    lake = Lake(fresh_folder(spark, "lake"))
    track = F.when(F.col("is_closed"), landing.CONFIRMED).otherwise(landing.OPEN)
    market.bronze_candles(spark, folder).withColumns(
        {"track": track, "ingest_date": F.lit(NOW).cast("date")}
    ).write.partitionBy("track", "ingest_date").parquet(lake.landing)
    return lake


def _half(spark, lake: Lake) -> int:
    """Files of a micro-batch, so that the landed files make two or three."""
    return max(1, len(spark.read.parquet(lake.landing).inputFiles()) // 2)


@query("stream_landing_to_bronze", S.select(S.BRONZE, """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol_raw, open_time
           ORDER BY is_closed DESC, ingest_ts_utc DESC) AS rn FROM bronze) WHERE rn = 1"""))
def stream_landing_to_bronze(spark, folder):
    lake = _landed_lake(spark, folder)
    loads.stream_landing_to_bronze(
        spark, lake, f"{lake.root}/checkpoint", "b", NOW).awaitTermination()
    return tables.read_table(spark, lake.bronze, schemas.BRONZE)


@query("stream_late_updates", S.select(S.SILVER, f"""
SELECT symbol, day, open_time, close_time, {S.AMOUNTS}, num_trades, is_closed, ingest_ts
FROM silver"""))
def stream_late_updates(spark, folder):
    """Several micro-batches; the versions of a day arrive in any order, which the table does not show."""
    lake = _landed_lake(spark, folder)
    loads.stream_late_updates(
        spark, lake, f"{lake.root}/checkpoint", "s", NOW, files_per_batch=_half(spark, lake)).awaitTermination()
    return tables.read_table(spark, lake.silver, schemas.SILVER).drop("transformed_at")


def _two_loads(spark, folder, views: str | None = None) -> Lake:
    """Gold after a first load up to 1999 and a load of what came later and of days left out."""
    lake = Lake(fresh_folder(spark, "lake"))
    candles = staged(market.bronze_candles(spark, folder))
    year = F.year("open_time")
    late = (year >= 2000) | ((year == 1999) & (F.dayofmonth("open_time") < 3))
    for n, part in enumerate((~late, late)):
        rows = staged(candles.where(part))
        refresh.refresh_bronze(spark, lake, rows, str(n), NOW, "year")
        refresh.refresh_silver(spark, lake, str(n), NOW, refresh.landed_days(spark, lake, rows, "year"), grain="year")
        refresh.refresh_gold(spark, lake, str(n), NOW, refresh.touched_days(rows), "year", views)
    return lake


@query("gold_incremental", S.select(S.DAILY, f"SELECT * REPLACE ({S.rounded('log_return', 10)} AS log_return) FROM daily"))
def gold_incremental(spark, folder):
    """The daily table after the two loads."""
    return read_gold(spark, _two_loads(spark, folder), "daily").drop("transformed_at").withColumn(
        "log_return", F.round("log_return", 10))


@query("summary_incremental", _MONTHLY)
def summary_incremental(spark, folder):
    """The monthly table after the two loads, of which the second renews the touched periods' states only."""
    return read_gold(spark, _two_loads(spark, folder), "monthly").withColumn(
        "quote_volume_est", F.round("quote_volume_est", 2))


@query("kpi_incremental", _KPI)
def kpi_incremental(spark, folder):
    """The KPI table after the two loads, from month states and a few months of the daily table."""
    return read_gold(spark, _two_loads(spark, folder), "kpi").drop("transformed_at")


@query("yearly_summary", S.select(S.DAILY + """,
in_year AS (
  SELECT *, rank() OVER (PARTITION BY symbol, year ORDER BY day) AS nth,
         rank() OVER (PARTITION BY symbol, year ORDER BY day DESC) AS nth_last FROM daily),
years AS (
  SELECT symbol, year, max(high) AS high_m, min(low) AS low_m, sum(volume) AS volume,
         sum(quote_volume_est) AS quoted, sum(num_trades) AS trades, count(*) AS days,
         count(*) FILTER (change_pct > 0) AS ups, count(*) FILTER (change_pct < 0) AS downs,
         stddev_samp(log_return) AS sd, min(drawdown_pct) AS worst FROM in_year GROUP BY symbol, year)""", f"""
SELECT y.symbol, y.year, f.open AS open_m, l.close AS close_m, high_m, low_m,
       {S.rounded('(l.close / f.open - 1) * 100', 2)} AS return_pct,
       {S.rounded('(high_m - low_m) / f.open * 100', 2)} AS range_pct, y.volume,
       {S.rounded('quoted', 2)} AS quote_volume_est, CAST(trades AS BIGINT) AS num_trades, y.days,
       ups AS up_days, downs AS down_days, {S.rounded('y.sd * sqrt(365) * 100', 2)} AS vol_annual_pct,
       worst AS worst_drawdown_pct
FROM years y JOIN in_year f ON f.nth = 1 AND (f.symbol, f.year) = (y.symbol, y.year)
JOIN in_year l ON l.nth_last = 1 AND (l.symbol, l.year) = (y.symbol, y.year)"""))
def yearly_summary(spark, folder):
    """Years merged from the states of their months."""
    months = states.month_states(_stored_daily(spark, folder)[1])
    return states.yearly_of_states(staged(months, "months")).withColumn(
        "quote_volume_est", F.round("quote_volume_est", 2))


@query("gold_views", _MONTHLY)
def gold_views(spark, folder):
    """The monthly table by its name in the catalog, read by another session after the second load."""
    schema = "wickline_views_" + fresh_folder(spark, "v").rsplit("-", 1)[1]
    _two_loads(spark, folder, schema)
    other = spark.newSession()
    seen = fresh_folder(spark, "seen")
    configure(other).table(f"{schema}.gold_monthly").write.parquet(seen)
    spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return spark.read.parquet(seen).withColumn("quote_volume_est", F.round("quote_volume_est", 2))


@query("land_by_marks", S.select(S.BRONZE, """
SELECT symbol_raw, open_time, close_time, open, high, low, close, volume, num_trades, is_closed
FROM bronze WHERE is_closed"""))
def land_by_marks(spark, folder):
    """Closed candles: the first years merged at once, the rest landed behind the marks of bronze's period
    summaries, of which the lowest is a literal in the scan."""
    lake = Lake(fresh_folder(spark, "lake"))
    src = staged(market.bronze_candles(spark, folder).where("is_closed"))
    refresh.refresh_bronze(spark, lake, src.where("open_time < TIMESTAMP '1998-06-01'"), "0", NOW, "year")
    refresh.land(spark, lake, src.drop("is_closed", "ingest_ts_utc"), NOW, new_series=False)
    refresh.refresh_bronze(spark, lake, landing.read_landing(spark, lake.landing), "1", NOW, "year")
    return tables.read_table(spark, lake.bronze, schemas.BRONZE).drop("ingest_ts_utc")


@query("missing_days_of_periods", S.select(f"{_CLOSED_SILVER},{_SPINE}", """
SELECT symbol, day FROM spine ANTI JOIN silver USING (symbol, day)"""))
def missing_days_of_periods(spark, folder):
    """Days without a closed candle, from the masks that the silver load left beside the table."""
    lake = Lake(fresh_folder(spark, "lake"))
    refresh.refresh_bronze(spark, lake, market.bronze_candles(spark, folder).where("is_closed"), "0", NOW, "year")
    refresh.refresh_silver(spark, lake, "0", NOW, grain="year")
    return refresh.check_silver(spark, lake)[1]


@query("stream_bronze_to_gold", _MONTHLY)
def stream_bronze_to_gold(spark, folder):
    lake = _landed_lake(spark, folder)
    loads.stream_bronze_to_gold(
        spark, lake, f"{lake.root}/checkpoint", "g", NOW).awaitTermination()
    return read_gold(spark, lake, "monthly").withColumn(
        "quote_volume_est", F.round("quote_volume_est", 2))
