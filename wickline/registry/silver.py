"""Queries of the typing, quality and series-check operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from wickline.operators import ingest, merge, quality
from wickline.operators.ingest import BRONZE_KEYS, BRONZE_ORDER
from wickline.registry import sql as S
from wickline.registry.book import query
from wickline.session import fresh_folder, staged
from wickline.sources import market, tables
from wickline import schemas

_ROW = (f"symbol, open_time, close_time, {S.AMOUNTS}, num_trades, is_closed, ingest_ts")
_FAULTY_TYPED = ",".join([S.FAULTY, S.TYPED])
_FAULTY_CLEANED = ",".join([S.FAULTY, S.TYPED, S.CLEANED])


def _faulty(spark, folder):
    return market.with_faults(market.bronze_candles(spark, folder))


def _silver(spark, folder):
    return quality.silver_rows(quality.clean_candles(market.bronze_candles(spark, folder)))


@query("typed_candles", S.select(",".join([S.BRONZE, S.TYPED]), f"SELECT {_ROW} FROM typed"))
def typed_candles(spark, folder):
    return quality.typed_candles(market.bronze_candles(spark, folder)).drop(
        "payload", "_unrepresentable")


@query("dedup_latest", S.select(S.BRONZE, """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol_raw, open_time
           ORDER BY is_closed DESC, ingest_ts_utc DESC) AS rn FROM bronze) WHERE rn = 1"""))
def dedup_latest(spark, folder):
    return merge.dedup_latest(market.bronze_candles(spark, folder), BRONZE_KEYS, BRONZE_ORDER)


@query("quality_reason", S.select(_FAULTY_TYPED, f"SELECT {_ROW}, {S.REASON} AS reason FROM typed"))
def quality_reason(spark, folder):
    """Every version of every candle, faults included, with its first failing rule."""
    typed = quality.typed_candles(_faulty(spark, folder))
    return quality.quality_reason(typed).drop("payload", "_unrepresentable")


@query("clean_candles", S.select(_FAULTY_CLEANED, f"SELECT {_ROW}, reason FROM cleaned"))
def clean_candles(spark, folder):
    return quality.clean_candles(_faulty(spark, folder)).drop("payload", "_unrepresentable")


@query("split_valid_rejected", S.select(_FAULTY_CLEANED, """
SELECT coalesce(reason, 'valid') AS outcome, count(*) AS candles, min(open_time) AS first_open
FROM cleaned GROUP BY 1"""))
def split_valid_rejected(spark, folder):
    valid, rejected = quality.split_valid_rejected(
        staged(quality.clean_candles(_faulty(spark, folder)).drop("payload")))
    both = valid.withColumn("outcome", F.lit("valid")).unionByName(
        rejected.withColumn("outcome", F.col("reason")))
    return both.groupBy("outcome").agg(
        F.count("*").alias("candles"), F.min("open_time").alias("first_open"))


@query("silver_candles", S.select(S.SILVER, f"""
SELECT symbol, day, open_time, close_time, {S.AMOUNTS}, num_trades, is_closed, ingest_ts
FROM silver"""))
def silver_candles(spark, folder):
    return _silver(spark, folder).drop("transformed_at")


_STORED = _FAULTY_CLEANED + f""",
stored AS (
  SELECT symbol, open_time, ingest_ts FROM (SELECT *, {S.REASON} AS reason FROM typed
                                            WHERE NOT is_closed)
  WHERE reason IS NOT NULL),
new AS (
  SELECT symbol, open_time, reason, ingest_ts FROM cleaned c
  WHERE reason IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM stored r
    WHERE r.symbol IS NOT DISTINCT FROM c.symbol AND r.open_time IS NOT DISTINCT FROM c.open_time
      AND r.ingest_ts IS NOT DISTINCT FROM c.ingest_ts))"""


def _stored_and_cleaned(spark, folder):
    """(rejects of an earlier load that saw only open versions, all cleaned candles)."""
    faulty = staged(_faulty(spark, folder))
    earlier = quality.clean_candles(faulty.where(~F.col("is_closed")))
    return staged(quality.reject_rows(earlier)), staged(quality.clean_candles(faulty))


@query("store_rejects", S.select(_STORED, "SELECT * FROM new"))
def store_rejects(spark, folder):
    stored, cleaned = _stored_and_cleaned(spark, folder)
    return quality.store_rejects(stored, cleaned).drop("payload", "rejected_at")


@query("not_exists_null_safe", S.select(_STORED, """
SELECT symbol, open_time, reason, ingest_ts FROM cleaned c
WHERE NOT EXISTS (
  SELECT 1 FROM stored r
  WHERE r.symbol IS NOT DISTINCT FROM c.symbol AND r.open_time IS NOT DISTINCT FROM c.open_time)"""))
def not_exists_null_safe(spark, folder):
    """Cleaned candles whose (symbol, open time), NULL symbols included, was never rejected."""
    stored, cleaned = _stored_and_cleaned(spark, folder)
    return merge.new_rows(stored, cleaned, ["symbol", "open_time"]).select(
        "symbol", "open_time", "reason", "ingest_ts")


@query("reject_payload", S.select(_FAULTY_CLEANED, """
SELECT symbol, open_time, reason, CAST(open AS DOUBLE) AS open, CAST(volume AS DOUBLE) AS volume
FROM (SELECT c.symbol, c.open_time, c.reason, b.open, b.volume FROM cleaned c
      JOIN bronze b ON b.symbol_raw IS NOT DISTINCT FROM c.symbol AND b.open_time = c.open_time
       AND b.is_closed = c.is_closed
      WHERE c.reason IS NOT NULL)"""))
def reject_payload(spark, folder):
    """Received amounts, read back out of the JSON kept with each rejected row."""
    _, rejected = quality.split_valid_rejected(quality.clean_candles(_faulty(spark, folder)))
    payload = F.from_json("payload", "open double, volume double")
    return rejected.withColumn("_p", payload).select(
        "symbol", "open_time", "reason", "_p.open", "_p.volume")


@query("filter_closed", S.select(S.SILVER, f"""
SELECT symbol, day, {S.AMOUNTS}, num_trades FROM silver WHERE is_closed"""))
def filter_closed(spark, folder):
    return _silver(spark, folder).where("is_closed").select(
        "symbol", "day", "open", "high", "low", "close", "volume", "num_trades")


@query("filter_open", S.select(S.SILVER, f"""
SELECT symbol, day, {S.AMOUNTS}, num_trades FROM silver WHERE NOT is_closed"""))
def filter_open(spark, folder):
    return _silver(spark, folder).where(~F.col("is_closed")).select(
        "symbol", "day", "open", "high", "low", "close", "volume", "num_trades")


@query("load_check", S.select(S.BRONZE, """
SELECT count(*) AS total, min(open_time) AS first_open, max(open_time) AS last_open,
       CAST(sum(CASE WHEN is_closed THEN 0 ELSE 1 END) AS BIGINT) AS open_candles
FROM bronze"""))
def load_check(spark, folder):
    return quality.load_check(market.bronze_candles(spark, folder))


@query("series_completeness", S.select(S.SILVER, """
SELECT symbol, min(day) AS first_day, max(day) AS last_day, count(*) AS days_loaded,
       CAST(date_diff('day', min(day), max(day)) + 1 AS INTEGER) AS days_expected,
       count(*) FILTER (WHERE NOT is_closed) AS open_candles
FROM silver GROUP BY symbol"""))
def series_completeness(spark, folder):
    return quality.series_completeness(_silver(spark, folder))


_SPINE = """
spans AS (SELECT symbol, min(day) AS first_day, max(day) AS last_day FROM silver GROUP BY symbol),
spine AS (
  SELECT symbol, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS day
  FROM spans)"""


@query("date_spine", S.select(f"{S.SILVER},{_SPINE}", "SELECT symbol, day FROM spine"))
def date_spine(spark, folder):
    spans = _silver(spark, folder).groupBy("symbol").agg(
        F.min("day").alias("first"), F.max("day").alias("last"))
    return quality.date_spine(spans, "first", "last")


_CLOSED_SILVER = S.SILVER.replace("WHERE reason IS NULL)", "WHERE reason IS NULL AND is_closed)")


@query("missing_days", S.select(f"{_CLOSED_SILVER},{_SPINE}", """
SELECT symbol, day FROM spine
WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.symbol = spine.symbol AND s.day = spine.day)"""))
def missing_days(spark, folder):
    """Days without a closed candle, per symbol."""
    return quality.missing_days(staged(_silver(spark, folder).where("is_closed")))


@query("declare_table", S.select(S.SILVER, """
SELECT symbol, count(*) AS candles, min(day) AS first_day, max(day) AS last_day
FROM silver GROUP BY symbol"""))
def declare_table(spark, folder):
    """Silver rows inserted into a declared table and read back by name."""
    path = fresh_folder(spark, "declared")
    name = "wickline_" + path.rsplit("-", 1)[1]
    tables.declare_table(spark, name, schemas.SILVER, "cleaned candles", path)
    tables.conform(_silver(spark, folder), schemas.SILVER).write.insertInto(name)
    counted = staged(spark.table(name).groupBy("symbol").agg(
        F.count("*").alias("candles"), F.min("day").alias("first_day"),
        F.max("day").alias("last_day")), "counted")
    spark.sql(f"DROP TABLE {name}")
    return counted


@query("create_schema", S.select(S.SILVER, "SELECT count(*) AS candles FROM silver"))
def create_schema(spark, folder):
    """Silver rows stored in a table of a schema of its own, counted by their full name."""
    path = fresh_folder(spark, "declared")
    schema = "wickline_" + path.rsplit("-", 1)[1]
    tables.create_schema(spark, schema, "candles")
    tables.declare_table(spark, f"{schema}.silver", schemas.SILVER, "cleaned candles", path)
    tables.conform(_silver(spark, folder), schemas.SILVER).write.insertInto(f"{schema}.silver")
    counted = staged(spark.table(f"{schema}.silver").agg(F.count("*").alias("candles")), "counted")
    spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return counted


@query("insert_literals", """
SELECT n_nationkey AS id, n_name AS name FROM nation UNION ALL SELECT * FROM (VALUES (900, 'Nowhere'), (901, NULL))""")
def insert_literals(spark, folder):
    """Two rows of literals appended to the nations."""
    nations = market.table(spark, folder, "nation").selectExpr(
        "CAST(n_nationkey AS INT) AS id", "n_name AS name")
    return tables.insert_literals(nations, [(900, "Nowhere"), (901, None)])


# Every fifth month's page is cut short, every third candle day of a month has a price that is no number.
_FAULTY_PAGES = S.BRONZE + """,
paged AS (
  SELECT *, month(open_time) % 5 = 0 AS cut, dayofmonth(open_time) % 3 = 0 AS worded FROM bronze)"""


@query("faulty_klines", S.select(_FAULTY_PAGES, """
SELECT symbol_raw, is_closed, 'unreadable page' AS fault, count(DISTINCT date_trunc('month', open_time)) AS faults
FROM paged WHERE cut GROUP BY symbol_raw, is_closed
UNION ALL
SELECT symbol_raw, is_closed, 'unreadable value', count(*) FROM paged WHERE worded AND NOT cut
GROUP BY symbol_raw, is_closed"""))
def faulty_klines(spark, folder):
    """Pages that are no JSON and klines with an unreadable value, counted by their fault."""
    text = F.col("close").cast("string")
    worded = market.bronze_candles(spark, folder).withColumn("close", F.when(
        F.dayofmonth("open_time") % 3 == 0, F.lit("none")).otherwise(text))
    pages = market.kline_pages(worded)
    page = F.col("page")
    cut = F.when(F.month("page_month") % 5 == 0, F.substring("page", 1, 9)).otherwise(page)
    faults = ingest.faulty_klines(pages.withColumn("page", cut), "page")
    return faults.groupBy("symbol_raw", "is_closed", "fault").agg(F.count("*").alias("faults"))
