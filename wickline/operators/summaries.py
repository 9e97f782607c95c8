"""Monthly, weekday and per-symbol summaries of the daily table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.functions import candle as C
from wickline.operators.keys import attach, join_null_safe
from wickline.operators.quantile import BUFFER_ROWS, selected_median
from wickline.operators.series import split_by_size
from wickline.operators.states import month_states, monthly_of_states
from wickline.session import staged


def monthly_summary(daily: DataFrame) -> DataFrame:
    """One row per symbol and month. Returns compare the last close with the month's first open."""
    return monthly_of_states(month_states(daily))


def weekday_seasonality(daily: DataFrame, buffer_rows: int = BUFFER_ROWS) -> DataFrame:
    """Behaviour per symbol and weekday over the whole history, without each series' first row."""
    by = ["symbol", "weekday_num", "weekday"]
    up = F.try_divide(F.count_if(F.col("change_pct") > 0), F.count("*")) * 100
    measures = [
        F.count("*").alias("days"),
        F.round(F.avg("change_pct"), 3).alias("mean_return_pct"),
        F.round(up, 1).alias("up_days_pct"),
        F.round(F.avg("range_pct"), 3).alias("mean_range_pct"),
        F.round(F.avg("volume"), 2).alias("mean_volume"),
    ]
    rows = daily.where(F.col("change_pct").isNotNull())
    small, large = split_by_size(rows, by, buffer_rows)
    result = small.groupBy(*by).agg(*measures, F.percentile("change_pct", 0.5).alias("_median"))
    if large is not None:
        medians = selected_median(large, by, "change_pct", "_median", ["day"])
        result = result.unionByName(
            join_null_safe(large.groupBy(*by).agg(*measures), medians, by, "left"))
    return result.select(
        *by, "days", "mean_return_pct", F.round("_median", 3).alias("median_return_pct"),
        "up_days_pct", "mean_range_pct", "mean_volume")


def join_ref_date(daily: DataFrame, *extra: Column) -> DataFrame:
    """Attach each symbol's last day, ``ref_day`` (and further per-symbol aggregates), to its rows."""
    ref = daily.groupBy("symbol").agg(F.max("day").alias("ref_day"), *extra)
    # One row per symbol; staged, so that Spark knows its size when it chooses the join.
    return attach(daily, staged(ref, "ref"), "symbol", F.col("day"))


def _last_until(col: str, reached: Column) -> Column:
    """Value of ``col`` on the latest day for which ``reached`` holds; NULL when there is none."""
    return F.max_by(col, F.when(reached, F.col("day")))


def asof_lookback(daily: DataFrame, col: str, days: int | Sequence[int]) -> DataFrame:
    """Per symbol: ``col`` on the last day, and as of that day minus each of ``days``."""
    spans = [days] if isinstance(days, int) else list(days)
    rows = join_ref_date(daily.select("symbol", "day", col))
    return rows.groupBy("symbol").agg(
        F.max("ref_day").alias("ref_day"),
        F.max_by(col, "day").alias(col),
        *[_last_until(col, F.col("day") <= F.date_sub("ref_day", n)).alias(f"{col}_{n}d_ago")
          for n in spans],
    )


def partial_prices(silver: DataFrame) -> DataFrame:
    """Latest open candle per symbol."""
    return silver.where(~F.col("is_closed")).groupBy("symbol").agg(
        F.max_by("close", "day").cast("double").alias("partial_price"),
        F.max_by("ingest_ts", "day").alias("partial_price_at"),
    )


def join_partial_price(kpi: DataFrame, silver: DataFrame) -> DataFrame:
    return kpi.join(partial_prices(silver), "symbol", "left")


def kpi_snapshot(
    daily: DataFrame,
    silver: DataFrame,
    as_of: datetime | None = None,
    labels: tuple[str, str] = C.UP_DOWN,
) -> DataFrame:
    """One row per symbol. Look-backs are as-of and calendar-based, unlike the daily row frames."""
    day, ref = F.col("day"), F.col("ref_day")
    last_year, last_30 = day > F.date_sub(ref, 365), day > F.date_sub(ref, 30)
    rows = join_ref_date(
        daily.select(
            "symbol", "day", "close", "high", "low", "volume", "change_pct", "drawdown_pct",
            "vol_30d_annual_pct", "ma50", "ma200",
            # A boolean keeps the aggregate below on fixed-width buffers (hash, not sort).
            (F.col("trend_ma50_ma200") == labels[0]).alias("_rising")),
        F.max("high").alias("_top"))
    kpi = rows.groupBy("symbol").agg(
        F.max("ref_day").alias("last_close_day"),
        F.max_by("close", "day").alias("last_close"),
        F.max_by("change_pct", "day").alias("_change_1d"),
        _last_until("close", day <= F.date_sub(ref, 7)).alias("_close_7d"),
        _last_until("close", day <= F.date_sub(ref, 30)).alias("_close_30d"),
        _last_until("close", day <= F.date_sub(ref, 365)).alias("_close_365d"),
        _last_until("close", day < F.trunc(ref, "year")).alias("_close_last_year"),
        F.max("_top").alias("all_time_high"),
        F.min(F.when(F.col("high") == F.col("_top"), day)).alias("all_time_high_day"),
        F.max(F.when(last_year, F.col("high"))).alias("high_52w"),
        F.min(F.when(last_year, F.col("low"))).alias("low_52w"),
        F.max_by("drawdown_pct", "day").alias("drawdown_pct"),
        F.max_by("vol_30d_annual_pct", "day").alias("vol_30d_annual_pct"),
        F.max_by("ma50", "day").alias("ma50"),
        F.max_by("ma200", "day").alias("ma200"),
        F.max_by("_rising", "day").alias("_rising"),
        F.avg(F.when(last_30, F.col("volume"))).alias("_volume_30d"),
    )

    def since(base: str) -> Column:
        return F.round(C.pct_change(F.col("last_close"), F.col(base)), 2)

    result = join_partial_price(kpi, silver).select(
        "symbol", "last_close_day", "last_close",
        F.round("_change_1d", 2).alias("change_1d_pct"),
        since("_close_7d").alias("change_7d_pct"),
        since("_close_30d").alias("change_30d_pct"),
        since("_close_365d").alias("change_12m_pct"),
        since("_close_last_year").alias("change_ytd_pct"),
        "all_time_high", "all_time_high_day", "high_52w", "low_52w",
        "drawdown_pct", "vol_30d_annual_pct", "ma50", "ma200",
        F.when(F.col("_rising"), labels[0]).when(~F.col("_rising"), labels[1])
        .alias("trend_ma50_ma200"),
        F.round("_volume_30d", 2).alias("mean_volume_30d"),
        "partial_price", "partial_price_at",
    )
    return result if as_of is None else result.withColumn("transformed_at", F.lit(as_of))


def top_k(df: DataFrame, order: Column | Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of an explicit order (each task keeps only its own k)."""
    return df.orderBy(*([order] if isinstance(order, Column) else order)).limit(k)
