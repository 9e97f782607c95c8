"""Queries of the load-monitoring operators; the events serve as past loads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from wickline.operators import monitor
from wickline.registry import sql as S
from wickline.registry.book import query
from wickline.session import fresh_folder
from wickline.sources import history, market

TODAY = date(2024, 2, 10)

_FLAT = ("tbl AS \"table\", executed_at, operation, "
         "CASE WHEN tbl = 'silver' THEN moved END AS inserted, "
         "CASE WHEN tbl = 'silver' THEN updated END AS updated, "
         "CASE WHEN tbl <> 'silver' THEN moved END AS written, ms AS duration_ms")


def _flat(history):
    """Metrics by name; a name that a load lacks is NULL."""
    names = {"inserted": monitor.INSERTED, "updated": monitor.UPDATED,
             "written": monitor.OUTPUT_ROWS, "duration_ms": monitor.DURATION_MS}
    return history.select("table", "executed_at", "operation", *[
        F.col("metrics")[key].cast("bigint").alias(name) for name, key in names.items()])


@query("load_history", S.select(S.LOADS, f"SELECT {_FLAT} FROM loads"))
def load_history(spark, folder):
    """The events stored as a history and read back."""
    path = fresh_folder(spark, "history")
    history.append_loads(market.load_events(spark, folder), path)
    return _flat(history.load_history(spark, path))


@query("union_history", S.select(S.LOADS, f"SELECT {_FLAT} FROM loads"))
def union_history(spark, folder):
    """One history put together from a history per table."""
    loads = market.load_events(spark, folder)
    tables = (monitor.SILVER_TABLE, *monitor.GOLD_TABLES)
    return _flat(monitor.union_history({t: loads.where(F.col("table") == t) for t in tables}))


@query("filter_operation", S.select(S.LOADS, """
SELECT tbl AS "table", operation, count(*) AS loads FROM loads
WHERE operation = 'MERGE' OR operation IN ('CREATE OR REPLACE TABLE AS SELECT', 'CREATE TABLE AS SELECT')
GROUP BY tbl, operation"""))
def filter_operation(spark, folder):
    operation = F.col("operation")
    kept = (operation == monitor.MERGE_OPERATION) | operation.isin(*monitor.REBUILD_OPERATIONS)
    return market.load_events(spark, folder).where(kept).groupBy("table", "operation").agg(
        F.count("*").alias("loads"))


@query("history_silver", S.select(S.LOADS, "SELECT * FROM silver_loads"))
def history_silver(spark, folder):
    return monitor.history_silver(market.load_events(spark, folder))


@query("history_gold", S.select(S.LOADS, "SELECT * FROM gold_loads"))
def history_gold(spark, folder):
    return monitor.history_gold(market.load_events(spark, folder))


@query("volume_daily", S.select(S.VOLUMES, "SELECT * FROM volumes"))
def volume_daily(spark, folder):
    return monitor.volume_daily(market.load_events(spark, folder))


@query("union_layers", S.select(S.VOLUMES, "SELECT * FROM volumes"))
def union_layers(spark, folder):
    loads = market.load_events(spark, folder)
    return monitor.union_layers(monitor.history_silver(loads), monitor.history_gold(loads))


@query("volume_monthly", S.select(S.VOLUMES, f"""
SELECT CAST(date_trunc('month', day) AS DATE) AS month_start, layer,
       CAST(sum(runs) AS BIGINT) AS runs, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
       CAST(sum(rows_updated) AS BIGINT) AS rows_updated,
       {S.rounded('avg(mean_duration_s)', 1)} AS mean_duration_s,
       {S.rounded('sum(mean_duration_s * runs) / sum(runs)', 1)} AS run_mean_duration_s
FROM volumes GROUP BY ALL"""))
def volume_monthly(spark, folder):
    return monitor.volume_monthly(monitor.volume_daily(market.load_events(spark, folder)))


@query("sort_multi", S.select(S.VOLUMES, "SELECT * FROM volumes ORDER BY day DESC, layer"))
def latest_volumes(spark, folder):
    """All daily volumes, the newest first."""
    return monitor.latest_volumes(monitor.volume_daily(market.load_events(spark, folder)))


@query("missing_loads", S.select(S.LOADS, """
SELECT CAST(d AS DATE) AS day
FROM generate_series(DATE '2024-02-10' - INTERVAL 30 DAY, DATE '2024-02-10', INTERVAL 1 DAY) AS g(d)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(executed_at AS DATE) FROM gold_loads)"""))
def missing_loads(spark, folder):
    return monitor.missing_loads(market.load_events(spark, folder), TODAY)
