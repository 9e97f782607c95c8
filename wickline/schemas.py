"""Fixed schemas. Column comments travel as field metadata into the catalog."""

from __future__ import annotations

from pyspark.sql import types as T


def _col(name: str, kind: T.DataType, comment: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, kind, nullable, {"comment": comment})


PRICE = T.DecimalType(18, 2)
VOLUME = T.DecimalType(28, 8)

BRONZE = T.StructType([
    _col("open_time", T.TimestampType(), "candle open, UTC"),
    _col("close_time", T.TimestampType(), "candle close, UTC"),
    _col("open", T.DoubleType(), "first price"),
    _col("high", T.DoubleType(), "highest price"),
    _col("low", T.DoubleType(), "lowest price"),
    _col("close", T.DoubleType(), "last price"),
    _col("volume", T.DoubleType(), "traded base quantity"),
    _col("num_trades", T.LongType(), "number of trades"),
    _col("is_closed", T.BooleanType(), "false while the period is still running"),
    _col("ingest_ts_utc", T.StringType(), "ingest time as ISO text"),
    _col("symbol_raw", T.StringType(), "symbol as received"),
])

LANDING = T.StructType([
    *BRONZE.fields,
    _col("track", T.StringType(), "confirmed or open"),
    _col("ingest_date", T.DateType(), "day of the load"),
])

SILVER = T.StructType([
    _col("symbol", T.StringType(), "traded pair, trimmed upper case", nullable=False),
    _col("day", T.DateType(), "candle day, UTC", nullable=False),
    _col("open_time", T.TimestampType(), "candle open, UTC"),
    _col("close_time", T.TimestampType(), "candle close, UTC"),
    _col("open", PRICE, "first price"),
    _col("high", PRICE, "highest price"),
    _col("low", PRICE, "lowest price"),
    _col("close", PRICE, "last price"),
    _col("volume", VOLUME, "traded base quantity"),
    _col("num_trades", T.LongType(), "number of trades"),
    _col("is_closed", T.BooleanType(), "false while the day is still running"),
    _col("ingest_ts", T.TimestampType(), "ingest time of the winning version"),
    _col("transformed_at", T.TimestampType(), "time of the load that wrote this row"),
])

REJECT = T.StructType([
    _col("symbol", T.StringType(), "traded pair"),
    _col("open_time", T.TimestampType(), "candle open, UTC"),
    _col("reason", T.StringType(), "first failing rule"),
    _col("payload", T.StringType(), "received row as JSON"),
    _col("ingest_ts", T.TimestampType(), "ingest time"),
    _col("rejected_at", T.TimestampType(), "time of the load that rejected it"),
])

LOAD_HISTORY = T.StructType([
    _col("table", T.StringType(), "written table"),
    _col("executed_at", T.TimestampType(), "time of the write"),
    _col("operation", T.StringType(), "kind of write"),
    _col("metrics", T.MapType(T.StringType(), T.StringType()), "counts and duration as text"),
])

GLOSSARY = T.StructType([
    _col("position", T.IntegerType(), "display order"),
    _col("category", T.StringType(), "group of indicators"),
    _col("indicator", T.StringType(), "display name"),
    _col("definition", T.StringType(), "plain explanation"),
    _col("formula", T.StringType(), "how it is computed"),
    _col("source_column", T.StringType(), "table.column it comes from"),
])
