"""Candles derived from the star-schema test tables (which hold no candles).

``lineitem``: symbol = return flag, day = ship date, price = extended price / quantity. Rows of
line status F form the closed version of a day's candle, rows of status O the open version.
``events``: past loads, one per event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.operators.merge import DELETED, DURATION_MS, INSERTED, OUTPUT_ROWS, UPDATED

# ISO text of an ingest time, and the first day of the fault calendar.
ISO_TEXT = "yyyy-MM-dd'T'HH:mm:ssxxx"
FAULT_ORIGIN = "1995-01-01"
FAULT_CYCLE = 101


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _trade_order() -> Column:
    """Order of the trades of a day: (order key, line number, extended price, quantity).

    One decimal instead of a struct: the aggregate then has fixed-width buffers and stays a hash
    aggregate, where a struct would sort every input row by group first.
    """
    cents = (F.col("l_extendedprice") * 100 + 0.5).cast("bigint")
    within = F.col("l_linenumber") * F.lit(10**14) + cents * 1000 + F.col("l_quantity").cast("bigint")
    return F.col("l_orderkey").cast("decimal(20,0)") * F.lit(10**16).cast(
        "decimal(17,0)") + within.cast("decimal(18,0)")


def bronze_candles(spark: SparkSession, folder: str) -> DataFrame:
    """One candle version per (symbol, day, line status), in the bronze schema."""
    trades = table(spark, folder, "lineitem").select(
        F.to_date("l_shipdate").alias("_day"),
        F.col("l_returnflag").alias("symbol_raw"),
        (F.col("l_linestatus") == "F").alias("is_closed"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("_price"),
        _trade_order().alias("_order"),
        "l_quantity", "l_orderkey",
    )
    bars = trades.groupBy("_day", "symbol_raw", "is_closed").agg(
        F.min_by("_price", "_order").alias("open"),
        F.max("_price").alias("high"),
        F.min("_price").alias("low"),
        F.max_by("_price", "_order").alias("close"),
        F.sum("l_quantity").alias("volume"),
        F.count("*").alias("num_trades"),
        F.max("l_orderkey").alias("_last_order"),
    )
    opened = F.unix_date("_day").cast("bigint") * 86400
    return bars.select(
        F.timestamp_seconds(opened).alias("open_time"),
        F.timestamp_millis((opened + 86400) * 1000 - 1).alias("close_time"),
        "open", "high", "low", "close", "volume", "num_trades", "is_closed",
        F.date_format(F.timestamp_seconds(opened + F.col("_last_order")), ISO_TEXT)
        .alias("ingest_ts_utc"),
        "symbol_raw",
    )


def with_faults(bronze: DataFrame) -> DataFrame:
    """The same candles with one fault per quality rule on chosen days of a 101-day cycle."""
    n = F.pmod(F.datediff(F.to_date("open_time"), F.to_date(F.lit(FAULT_ORIGIN))), F.lit(FAULT_CYCLE))

    def broken(on: Column, value: Column | float, col: str) -> Column:
        value = value if isinstance(value, Column) else F.lit(value)
        return F.when(on, value).otherwise(F.col(col)).alias(col)

    lost_symbol = (n == 0) & (F.col("symbol_raw") == "A")
    broken_columns = {
        "symbol_raw": broken(lost_symbol, F.lit(None).cast("string"), "symbol_raw"),
        "open": broken(n.isin(1, 6), 0.0, "open"),
        "high": broken(n == 2, F.col("low") / 2, "high"),
        "low": broken(n == 3, F.col("high") * 2, "low"),
        "volume": broken(n.isin(4, 6), -1.0, "volume"),
        "close_time": broken(n == 5, F.col("open_time"), "close_time"),
    }
    return bronze.select(*[broken_columns.get(c, F.col(c)) for c in bronze.columns])


def kline_pages(bronze: DataFrame) -> DataFrame:
    """Candles as an exchange sends them: JSON pages, here one per symbol, month and flag."""
    text = [F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")]
    zero = F.lit("0")
    kline = F.array(
        F.unix_millis("open_time").cast("string"), *text,
        F.unix_millis("close_time").cast("string"), zero,
        F.col("num_trades").cast("string"), zero, zero, zero)
    # At most 31 candles per page, so the collected group is bounded by the calendar.
    return bronze.groupBy(
        "symbol_raw", "is_closed", F.trunc(F.to_date("open_time"), "month").alias("page_month")
    ).agg(F.to_json(F.collect_list(kline)).alias("page"))


def load_events(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` read as load history: the event type names the written table."""
    written = F.create_map(*[F.lit(x) for pair in [
        ("view", "silver"), ("click", "daily"), ("purchase", "monthly"), ("signup", "weekday"),
        ("error", "kpi")] for x in pair])
    kind = F.col("event_type")
    operation = (
        F.when(kind == "view", "MERGE")
        .when(kind == "signup", "CREATE TABLE AS SELECT")
        .when((kind == "error") & (F.col("user_id") % 2 == 0), "OPTIMIZE")
        .otherwise("CREATE OR REPLACE TABLE AS SELECT"))
    duration = F.round(F.col("value") * 1000).cast("bigint").cast("string")
    merge_metrics = F.create_map(
        F.lit(INSERTED), F.col("user_id").cast("string"),
        F.lit(UPDATED), (F.col("event_id") % 7).cast("string"),
        F.lit(DELETED), F.lit("0"),
        F.lit(DURATION_MS), duration)
    rebuild_metrics = F.create_map(
        F.lit(OUTPUT_ROWS), F.col("user_id").cast("string"), F.lit(DURATION_MS), duration)
    return table(spark, folder, "events").select(
        written[kind].alias("table"),
        F.col("ts").cast("timestamp").alias("executed_at"),
        operation.alias("operation"),
        F.when(kind == "view", merge_metrics).otherwise(rebuild_metrics).alias("metrics"),
    )
