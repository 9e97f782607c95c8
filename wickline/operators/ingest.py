"""Raw kline pages to candle rows, and the two-track incremental load."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline import schemas
from wickline.functions.clock import safe_cutoff
from wickline.operators.keys import attach, names
from wickline.operators.merge import dedup_latest, merge_upsert, split_null_keys
from wickline.session import staged

# Field order of one kline array.
KLINE_FIELDS = (
    "open_time", "open", "high", "low", "close", "volume", "close_time",
    "quote_asset_volume", "num_trades", "taker_buy_base", "taker_buy_quote", "ignore",
)
# Fixed value: where a load starts when nothing has been confirmed yet.
BOOTSTRAP = datetime(2017, 8, 17, tzinfo=timezone.utc)

_KINDS = {
    "open_time": "bigint", "close_time": "bigint", "num_trades": "bigint",
    "open": "double", "high": "double", "low": "double", "close": "double", "volume": "double",
}


def _klines(pages: DataFrame, json_col: str) -> DataFrame:
    rows = F.from_json(json_col, "array<array<string>>")
    page = pages.withColumn("_rows", rows)
    kline = page.select("*", F.explode_outer("_rows").alias("_k"))
    typed = {n: F.get("_k", F.lit(i)).try_cast(_KINDS[n])
             for i, n in enumerate(KLINE_FIELDS) if n in _KINDS}
    unread = F.lit(False)
    for value in typed.values():
        unread = unread | value.isNull()
    fault = (
        F.when(F.col("_rows").isNull(), "unreadable page")
        .when(F.col("_k").isNull() & (F.size("_rows") > 0), "unreadable row")
        .when(F.col("_k").isNotNull() & (F.size("_k") != len(KLINE_FIELDS)), "wrong field count")
        .when(F.col("_k").isNotNull() & unread, "unreadable value")
    )
    return kline.withColumn("fault", fault), typed


def normalize_klines(pages: DataFrame, json_col: str, symbol: Column | str) -> DataFrame:
    """JSON pages (arrays of 12-element arrays) to candle rows.

    Epoch milliseconds become UTC timestamps, texts doubles; the four unused fields are dropped.
    Pages and rows that cannot be read are left to ``faulty_klines``.
    """
    symbol = F.col(symbol) if isinstance(symbol, str) else symbol
    rows, typed = _klines(pages, json_col)
    return rows.where(F.col("fault").isNull() & F.col("_k").isNotNull()).select(
        F.timestamp_millis(typed["open_time"]).alias("open_time"),
        F.timestamp_millis(typed["close_time"]).alias("close_time"),
        *[typed[c].alias(c) for c in ("open", "high", "low", "close", "volume", "num_trades")],
        symbol.alias("symbol_raw"),
    )


def faulty_klines(pages: DataFrame, json_col: str) -> DataFrame:
    """Pages that are not JSON arrays, and their rows that cannot be typed, each with its fault."""
    rows, _ = _klines(pages, json_col)
    return rows.where(F.col("fault").isNotNull()).select(
        *pages.columns, "fault", F.to_json("_k").alias("kline"))


def high_water_mark(
    bronze: DataFrame, default: datetime = BOOTSTRAP, by: str | Sequence[str] = "symbol_raw"
) -> DataFrame:
    """Latest close time of a closed candle per series, or ``default`` where none is closed."""
    closed_time = F.when(F.col("is_closed"), F.col("close_time"))
    return bronze.groupBy(*names(by)).agg(
        F.coalesce(F.max(closed_time), F.lit(default)).alias("mark"))


def period_marks(bronze: DataFrame, *period: str) -> DataFrame:
    """One row per series and ``period`` columns: what load checks and marks need of these rows."""
    return bronze.groupBy(*period, "symbol_raw").agg(
        F.max(F.when(F.col("is_closed"), F.col("close_time"))).alias("closed_until"), F.count("*").alias("rows"),
        F.min("open_time").alias("first_open"), F.max("open_time").alias("last_open"),
        F.sum(F.when(F.col("is_closed"), 0).otherwise(1)).alias("open_rows"))


def marks_of_periods(periods: DataFrame, default: datetime = BOOTSTRAP) -> DataFrame:
    """``high_water_mark`` from the summaries of the stored periods, without reading the table."""
    return periods.groupBy("symbol_raw").agg(F.coalesce(F.max("closed_until"), F.lit(default)).alias("mark"))


def confirmed_slice(
    src: DataFrame, mark: DataFrame, cutoff: Column, default: datetime = BOOTSTRAP,
    by: str | Sequence[str] = "symbol_raw",
) -> DataFrame:
    """Closed candles not loaded yet: open time in [mark, cutoff).

    ``mark`` has one row per series; a series unknown to it starts at ``default``.
    """
    marked = attach(src, mark, by, F.col("open_time"), "left")
    start = F.coalesce("mark", F.lit(default))
    return marked.where((F.col("open_time") >= start) & (F.col("open_time") < cutoff)).drop("mark")


def open_slice(src: DataFrame, as_of: datetime, by: str | Sequence[str] = "symbol_raw") -> DataFrame:
    """The most recent candle of each series, if it has not closed at ``as_of``.

    The latest open time needs two columns of ``src``; the candles themselves are read with the
    closing time pushed into the scan.
    """
    by = names(by)
    latest = src.groupBy(*by).agg(F.max("open_time").alias("_latest"))
    running = src.where(F.col("close_time") > F.lit(as_of))
    running = attach(running, latest, by, F.col("open_time"))
    running = running.where(F.col("open_time") == F.col("_latest")).drop("_latest")
    return dedup_latest(running, by, ["open_time"])


def stamp_lineage(
    df: DataFrame, as_of: datetime, is_closed: bool, symbol: Column | None = None
) -> DataFrame:
    """Add ingest time (ISO text), source symbol and closed flag, in the bronze schema."""
    stamped = df.withColumns({
        "ingest_ts_utc": F.lit(as_of.astimezone(timezone.utc).isoformat()),
        "is_closed": F.lit(is_closed),
    })
    if symbol is not None:
        stamped = stamped.withColumn("symbol_raw", symbol)
    return stamped.select(*schemas.BRONZE.fieldNames())


BRONZE_KEYS = ("symbol_raw", "open_time")
BRONZE_ORDER = ("is_closed", "ingest_ts_utc")


def both_tracks(
    src: DataFrame, bronze: DataFrame | None, as_of: datetime, interval: str, marks: DataFrame | None = None,
    new_series: bool = True,
) -> DataFrame:
    """Rows to land: newly confirmed candles and the running candle.

    ``marks`` (of ``marks_of_periods``) spare a scan of ``bronze``. Where the caller knows that ``src`` has no
    series that is new, the lowest mark goes into the scan of ``src`` as a literal; candles of a new series may
    be older than that.
    """
    cutoff = safe_cutoff(F.lit(as_of), interval)
    # One row per series; staged, so that Spark knows its size when it joins.
    marks = staged(high_water_mark(bronze) if marks is None else marks, "marks")
    fresh = src
    if not new_series:
        lowest = marks.agg(F.min("mark")).first()[0]
        fresh = src.where(F.col("open_time") >= F.lit(BOOTSTRAP if lowest is None else lowest))
    confirmed = confirmed_slice(fresh, marks, cutoff)
    return stamp_lineage(confirmed, as_of, True).unionByName(
        stamp_lineage(open_slice(src, as_of), as_of, False))


def incremental_load(
    src: DataFrame, bronze: DataFrame, as_of: datetime, interval: str = "1d",
    small_source: bool | None = None,
) -> DataFrame:
    """New state of ``bronze`` (with ``_change``) after loading both tracks of ``src``.

    Running it again with the same input changes no value except the stamp of the open candle's
    reload.
    """
    rows, _ = split_null_keys(both_tracks(src, bronze, as_of, interval), BRONZE_KEYS)
    source = staged(dedup_latest(rows, BRONZE_KEYS, BRONZE_ORDER), "load")
    return merge_upsert(bronze, source, BRONZE_KEYS, small_source)
