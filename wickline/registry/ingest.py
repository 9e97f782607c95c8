"""Queries of the ingest, merge and append operators."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline import schemas
from wickline.functions.clock import INTERVAL_SECONDS, safe_cutoff
from wickline.operators import ingest, merge
from wickline.operators.quality import silver_rows, clean_candles
from wickline.registry import sql as S
from wickline.registry.book import query
from wickline.session import fresh_folder, staged
from wickline.sources import landing, market, tables

# Scenario: the load runs during the last day of the candles; those before MARK_DAY are loaded already.
# Every candle is in the source.
MARK_DAY = "1998-07-01"
CLOCK = timedelta(hours=13, minutes=47, seconds=31)
# The time at which the stamps of the landing and lineage queries are set.
NOW = datetime(2000, 6, 15, 13, 47, 31, tzinfo=timezone.utc)
EARLIER = datetime(2000, 6, 14, 12, 0, 0, tzinfo=timezone.utc)
_NOW_TEXT = "2000-06-15T13:47:31+00:00"

_EXCHANGE = S.BRONZE + """,
best AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol_raw, open_time
           ORDER BY is_closed DESC, ingest_ts_utc DESC) AS rn FROM bronze) WHERE rn = 1),
src AS (SELECT * FROM best),
clock AS (SELECT max(open_time) + INTERVAL '13:47:31' AS t FROM best),
loaded AS (SELECT * FROM best WHERE open_time < TIMESTAMP '1998-07-01'),
marks AS (SELECT symbol_raw, coalesce(max(close_time) FILTER (WHERE is_closed),
                 TIMESTAMP '2017-08-17') AS mark FROM loaded GROUP BY symbol_raw),
confirmed AS (
  SELECT s.* REPLACE (true AS is_closed, strftime(t, '%Y-%m-%dT%H:%M:%S+00:00') AS ingest_ts_utc)
  FROM clock, src s LEFT JOIN marks m USING (symbol_raw)
  WHERE open_time >= coalesce(mark, TIMESTAMP '2017-08-17') AND open_time < date_trunc('day', t)),
running AS (
  SELECT * EXCLUDE (rn, t) REPLACE (false AS is_closed, strftime(t, '%Y-%m-%dT%H:%M:%S+00:00') AS ingest_ts_utc)
  FROM clock, (SELECT *, row_number() OVER (PARTITION BY symbol_raw ORDER BY open_time DESC) AS rn FROM src)
  WHERE rn = 1 AND close_time > t)"""

_BRONZE_COLUMNS = ("open_time, close_time, open, high, low, close, volume, num_trades, is_closed, "
                   "ingest_ts_utc, symbol_raw")


def _exchange(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, datetime]:
    """(all candles of the exchange, candles loaded so far, time of the load)."""
    best = staged(merge.dedup_latest(
        market.bronze_candles(spark, folder), ingest.BRONZE_KEYS, ingest.BRONZE_ORDER))
    last = best.agg(F.unix_seconds(F.max("open_time"))).first()[0]
    return (best, best.where(F.col("open_time") < F.lit(MARK_DAY).cast("timestamp")),
            datetime.fromtimestamp(last, timezone.utc) + CLOCK)


@query("normalize_klines", S.select(S.BRONZE, """
SELECT open_time, close_time, open, high, low, close, volume, num_trades, symbol_raw FROM bronze"""))
def normalize_klines(spark, folder):
    pages = market.kline_pages(market.bronze_candles(spark, folder))
    return ingest.normalize_klines(pages, "page", "symbol_raw")


@query("read_landing", S.select(S.BRONZE, """
SELECT open_time, close_time, open, high, low, close, volume, num_trades, is_closed,
       CASE WHEN is_closed THEN '2000-06-14T12:00:00+00:00' ELSE '2000-06-15T13:47:31+00:00' END
         AS ingest_ts_utc, symbol_raw,
       CASE WHEN is_closed THEN 'confirmed' ELSE 'open' END AS track,
       CASE WHEN is_closed THEN DATE '2000-06-14' ELSE DATE '2000-06-15' END AS ingest_date
FROM bronze"""))
def read_landing(spark, folder):
    """Both tracks written and read back; the open track's earlier state of the day is replaced."""
    bronze = staged(market.bronze_candles(spark, folder))
    path = fresh_folder(spark, "landing")
    running = bronze.where(~F.col("is_closed"))
    landing.write_landing_confirmed(
        ingest.stamp_lineage(bronze.where("is_closed"), EARLIER, True), path)
    landing.write_landing_open(
        ingest.stamp_lineage(running.withColumn("close", F.lit(1.0)), NOW, False), path)
    landing.write_landing_open(ingest.stamp_lineage(running, NOW, False), path)
    return landing.read_landing(spark, path)


@query("high_water_mark", S.select(S.BRONZE, """
SELECT symbol_raw, max(CASE WHEN is_closed THEN close_time ELSE TIMESTAMP '1000-01-01' END) AS mark
FROM bronze GROUP BY symbol_raw"""))
def high_water_mark(spark, folder):
    """Marks of all candles."""
    return ingest.high_water_mark(market.bronze_candles(spark, folder))


@query("safe_cutoff", "SELECT event_id, " + ", ".join(
    f"make_timestamp(CAST(floor(epoch(ts) / {n}) * {n} AS BIGINT) * 1000000) AS cutoff_{i}"
    for i, n in INTERVAL_SECONDS.items()) + " FROM events")
def cutoffs(spark, folder):
    ts = F.col("ts").cast("timestamp")
    return market.table(spark, folder, "events").select(
        "event_id", *[safe_cutoff(ts, i).alias(f"cutoff_{i}") for i in INTERVAL_SECONDS])


@query("confirmed_slice", S.select(_EXCHANGE, f"SELECT {_BRONZE_COLUMNS} FROM confirmed"))
def confirmed_slice(spark, folder):
    src, loaded, now = _exchange(spark, folder)
    rows = ingest.confirmed_slice(
        src, staged(ingest.high_water_mark(loaded), "marks"), safe_cutoff(F.lit(now), "1d"))
    return ingest.stamp_lineage(rows, now, True)


@query("open_slice", S.select(_EXCHANGE, f"SELECT {_BRONZE_COLUMNS} FROM running"))
def open_slice(spark, folder):
    src, _, now = _exchange(spark, folder)
    return ingest.stamp_lineage(ingest.open_slice(src, now), now, False)


@query("stamp_lineage", S.select(S.BRONZE, f"""
SELECT {_BRONZE_COLUMNS.replace('is_closed', 'true AS is_closed')
        .replace('ingest_ts_utc', f"'{_NOW_TEXT}' AS ingest_ts_utc")} FROM bronze"""))
def stamp_lineage(spark, folder):
    return ingest.stamp_lineage(market.bronze_candles(spark, folder), NOW, True, F.col("symbol_raw"))


@query("incremental_load", S.select(_EXCHANGE, f"""
, landed AS (SELECT {_BRONZE_COLUMNS} FROM confirmed UNION ALL SELECT {_BRONZE_COLUMNS} FROM running)
SELECT {_BRONZE_COLUMNS}, 'unchanged' AS _change FROM loaded l
WHERE NOT EXISTS (SELECT 1 FROM landed n WHERE n.symbol_raw = l.symbol_raw AND n.open_time = l.open_time)
UNION ALL
SELECT {_BRONZE_COLUMNS},
       CASE WHEN EXISTS (SELECT 1 FROM loaded l WHERE l.symbol_raw = n.symbol_raw
                         AND l.open_time = n.open_time) THEN 'updated' ELSE 'inserted' END
FROM landed n""".lstrip()))
def incremental_load(spark, folder):
    src, loaded, now = _exchange(spark, folder)
    return ingest.incremental_load(src, loaded, now)


# Merging the closed versions into a table of the open versions.
_VERSIONS = S.BRONZE + """,
t AS (SELECT * FROM bronze WHERE NOT is_closed),
s AS (SELECT * FROM bronze WHERE is_closed)"""


def _merged_sql(columns: str, keys: tuple[str, ...], update: str) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    first = keys[0]
    takes = f"s.{first} IS NOT NULL AND (t.{first} IS NULL OR coalesce({update}, false))"
    picked = ", ".join(f"CASE WHEN {takes} THEN s.{c} ELSE t.{c} END AS {c}"
                       for c in columns.split(", "))
    return f"""SELECT {picked},
       CASE WHEN t.{first} IS NULL THEN 'inserted' WHEN {takes} THEN 'updated' ELSE 'unchanged' END
         AS _change
FROM t FULL JOIN s ON {on}"""


_MERGED = _merged_sql(_BRONZE_COLUMNS, ("symbol_raw", "open_time"), "true")


def _versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    bronze = staged(market.bronze_candles(spark, folder))
    return bronze.where(~F.col("is_closed")), bronze.where("is_closed")


@query("merge_upsert", S.select(_VERSIONS, _MERGED))
def merge_upsert(spark, folder):
    target, source = _versions(spark, folder)
    return merge.merge_upsert(target, source, ingest.BRONZE_KEYS)


@query("merge_upsert_large_source", S.select(_VERSIONS, _MERGED))
def merge_upsert_large_source(spark, folder):
    """The same merge in the shape for a source too large to broadcast."""
    target, source = _versions(spark, folder)
    return merge.merge_upsert(target, source, ingest.BRONZE_KEYS, small_source=False)


@query("merge_counts", S.select(_VERSIONS, f"""
SELECT count(*) FILTER (WHERE _change = 'inserted') AS numTargetRowsInserted,
       count(*) FILTER (WHERE _change = 'updated') AS numTargetRowsUpdated,
       CAST(0 AS BIGINT) AS numTargetRowsDeleted, count(*) AS numOutputRows
FROM ({_MERGED})"""))
def merge_counts(spark, folder):
    target, source = _versions(spark, folder)
    return merge.merge_counts(merge.merge_upsert(target, source, ingest.BRONZE_KEYS))


_SILVER_COLUMNS = ("symbol, day, open_time, close_time, open, high, low, close, volume, num_trades, "
                   "is_closed, ingest_ts")
_SILVER_DOUBLES = (f"symbol, day, open_time, close_time, {S.AMOUNTS}, num_trades, is_closed, "
                   "ingest_ts")
# Target: the open versions. Source: the winning version of every day.
_SILVER_VERSIONS = ",".join([S.BRONZE, S.TYPED]) + f""",
rows AS (SELECT *, CAST(open_time AS DATE) AS day FROM typed),
s AS (SELECT {_SILVER_DOUBLES} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, day ORDER BY is_closed DESC) AS rn FROM rows)
  WHERE rn = 1),
t AS (SELECT {_SILVER_DOUBLES} FROM rows WHERE NOT is_closed)"""


@query("merge_upsert_when", S.select(_SILVER_VERSIONS, _merged_sql(
    _SILVER_COLUMNS, ("symbol", "day"),
    "s.ingest_ts > t.ingest_ts OR (s.is_closed AND NOT t.is_closed)")))
def merge_upsert_when(spark, folder):
    bronze = staged(market.bronze_candles(spark, folder))
    target = silver_rows(clean_candles(bronze.where(~F.col("is_closed")))).drop("transformed_at")
    source = silver_rows(clean_candles(bronze)).drop("transformed_at")
    return merge.merge_upsert_when(
        staged(target), staged(source), ["symbol", "day"], merge.newer_or_closing())


# Merging open versions, some with a later ingest, into a table of closed ones.
_REOPENED = ",".join([S.BRONZE, S.TYPED]) + f""",
rows AS (SELECT {_SILVER_DOUBLES.replace('symbol, day', 'symbol, CAST(open_time AS DATE) AS day')}
         FROM typed),
t AS (SELECT * FROM rows WHERE is_closed),
s AS (SELECT * FROM rows WHERE NOT is_closed)"""


def _reopened(spark: SparkSession, folder: str, rule) -> DataFrame:
    bronze = staged(market.bronze_candles(spark, folder))
    target = silver_rows(clean_candles(bronze.where("is_closed"))).drop("transformed_at")
    source = silver_rows(clean_candles(bronze.where(~F.col("is_closed")))).drop("transformed_at")
    return merge.merge_upsert_when(staged(target), staged(source), ["symbol", "day"], rule)


@query("merge_newer_open_over_closed", S.select(_REOPENED, _merged_sql(
    _SILVER_COLUMNS, ("symbol", "day"),
    "s.ingest_ts > t.ingest_ts OR (s.is_closed AND NOT t.is_closed)")))
def merge_newer_open_over_closed(spark, folder):
    return _reopened(spark, folder, merge.newer_or_closing())


@query("merge_protect_closed", S.select(_REOPENED, _merged_sql(
    _SILVER_COLUMNS, ("symbol", "day"),
    "(s.ingest_ts > t.ingest_ts OR (s.is_closed AND NOT t.is_closed)) "
    "AND NOT (t.is_closed AND NOT s.is_closed)")))
def merge_protect_closed(spark, folder):
    return _reopened(spark, folder, merge.newer_or_closing_protected())


@query("merge_into_table", S.select(_EXCHANGE, f"SELECT {_BRONZE_COLUMNS} FROM best"))
def merge_into_table(spark, folder):
    """Two merges into a stored table (open versions, then closed ones), read back."""
    bronze = staged(market.bronze_candles(spark, folder))
    path = fresh_folder(spark, "table")
    rule = merge.later_version(ingest.BRONZE_ORDER, schemas.BRONZE.fieldNames())
    for rows in (bronze.where(~F.col("is_closed")), bronze.where("is_closed")):
        tables.merge_into(
            spark, path, rows, schemas.BRONZE, keys=ingest.BRONZE_KEYS, time_col="open_time",
            update_when=rule, grain="year")
    return tables.read_table(spark, path, schemas.BRONZE)


@query("merge_rerun", S.select(_EXCHANGE, f"SELECT {_BRONZE_COLUMNS} FROM best"))
def merge_rerun(spark, folder):
    """Loads repeated in another order (first, second, first again) give the single deduplication."""
    bronze = staged(market.bronze_candles(spark, folder))
    path = fresh_folder(spark, "table")
    rule = merge.later_version(ingest.BRONZE_ORDER, schemas.BRONZE.fieldNames())
    running, closed = bronze.where(~F.col("is_closed")), bronze.where("is_closed")
    for rows in (running, closed, running):
        tables.merge_into(
            spark, path, rows, schemas.BRONZE, keys=ingest.BRONZE_KEYS, time_col="open_time",
            update_when=rule, grain="year")
    return tables.read_table(spark, path, schemas.BRONZE)


@query("merge_into_buckets", S.select(_EXCHANGE, f"SELECT {_BRONZE_COLUMNS} FROM best"))
def merge_into_buckets(spark, folder):
    """The same three loads into a bucketed table, whose stored rows are not shuffled."""
    bronze = staged(market.bronze_candles(spark, folder))
    path = fresh_folder(spark, "table")
    table = "wickline_" + path.rsplit("-", 1)[1]
    tables.declare_buckets(spark, table, path, schemas.BRONZE, ingest.BRONZE_KEYS, buckets=8)
    rule = merge.later_version(ingest.BRONZE_ORDER, schemas.BRONZE.fieldNames())
    running, closed = bronze.where(~F.col("is_closed")), bronze.where("is_closed")
    for rows in (running, closed, running):
        tables.merge_into(
            spark, path, rows, schemas.BRONZE, keys=ingest.BRONZE_KEYS, time_col="open_time",
            update_when=rule, grain="year", table=table)
    # Only the name goes; the files stay, as those of every staged table do.
    spark.sql(f"DROP TABLE {table}")
    return tables.read_table(spark, path, schemas.BRONZE)


@query("append_new_only", """
SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS price FROM orders
UNION ALL
SELECT l_orderkey, NULL, l_extendedprice FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def append_new_only(spark, folder):
    """Line items whose order is unknown, appended to the orders."""
    orders = market.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"),
        F.col("o_totalprice").alias("price"))
    items = market.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.lit(None).cast("bigint").alias("c"),
        F.col("l_extendedprice").alias("price"))
    return merge.append_new_only(orders, items, "k")


@query("append_with_next_sequence", """
SELECT o_orderkey AS seq, o_orderpriority AS description FROM orders
UNION ALL
SELECT (SELECT coalesce(max(o_orderkey), 0) FROM orders)
         + row_number() OVER (ORDER BY kind, l_orderkey, l_linenumber, l_extendedprice,
                                       l_quantity, l_partkey, l_suppkey),
       kind
FROM (SELECT *, l_returnflag || l_linestatus AS kind FROM lineitem)""")
def append_with_next_sequence(spark, folder):
    """Line items numbered after the highest order, by kind (six values) and then by the rest."""
    target = market.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("description"))
    rows = market.table(spark, folder, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("description"), "l_orderkey", "l_linenumber",
        "l_extendedprice", "l_quantity", "l_partkey", "l_suppkey")
    return merge.append_with_next_sequence(target, rows, "seq", "description")
