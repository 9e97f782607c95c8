"""Mergeable states of the months of a series, and the summaries made from them.

A month's state is small and depends on its own daily rows only. When days change, the states of
their months are made anew and all others stay; the summaries read states instead of days.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.functions import candle as C
from wickline.functions.clock import month_start
from wickline.operators.keys import attach
from wickline.session import staged

MONTH_KEYS = ("symbol", "month_start")


def month_states(daily: DataFrame) -> DataFrame:
    """One row per symbol and month: first and last values, extremes, sums, counts, and the moments of
    the returns (count, mean, deviation), from which states of longer spans follow."""
    states = daily.groupBy("symbol", month_start(F.col("day")).alias("month_start"), "year", "month", "year_month").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.min_by("open", "day").alias("open_m"), F.max_by("close", "day").alias("close_m"),
        F.max("high").alias("high_m"), F.min("low").alias("low_m"),
        # The earliest day of the greatest high; days count down, so the greatest pair has it.
        F.max(F.when(F.col("high").isNotNull(), F.struct("high", -F.unix_date("day")))).alias("_peak"),
        F.sum("volume").alias("volume"), F.sum("quote_volume_est").alias("quote_volume_est"),
        F.sum("num_trades").alias("num_trades"), F.count("*").alias("days"),
        F.count_if(F.col("change_pct") > 0).alias("up_days"),
        F.count_if(F.col("change_pct") < 0).alias("down_days"),
        F.count("log_return").alias("returns"), F.avg("log_return").alias("return_mean"),
        F.stddev_samp("log_return").alias("return_sd"), F.min("drawdown_pct").alias("worst_drawdown_pct"))
    return states.withColumn("high_day", F.date_from_unix_date(-F.col("_peak")["col2"])).drop("_peak")


def merged_states(states: DataFrame, by: list[str]) -> DataFrame:
    """States of longer spans (``by``: symbol and, say, year) from those of their months."""
    n, mean, sd = F.col("returns"), F.col("return_mean"), F.coalesce("return_sd", F.lit(0.0))
    merged = states.groupBy(*by).agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"),
        F.min_by("open_m", "first_day").alias("open_m"), F.max_by("close_m", "last_day").alias("close_m"),
        F.max("high_m").alias("high_m"), F.min("low_m").alias("low_m"),
        F.max(F.when(F.col("high_m").isNotNull(), F.struct("high_m", -F.unix_date("high_day")))).alias("_peak"),
        *[F.sum(c).alias(c) for c in ("volume", "quote_volume_est", "num_trades", "days", "up_days", "down_days")],
        F.sum(n).alias("returns"), F.sum(n * mean).alias("_sum"),
        F.sum(sd * sd * (n - 1) + n * mean * mean).alias("_squares"),
        F.min("worst_drawdown_pct").alias("worst_drawdown_pct"))
    n, total = F.col("returns"), F.col("_sum")
    spread = F.greatest(F.col("_squares") - F.try_divide(total * total, n), F.lit(0.0))
    return merged.withColumns({
        "high_day": F.date_from_unix_date(-F.col("_peak")["col2"]),
        "return_mean": F.try_divide(total, n),
        "return_sd": F.when(n > 1, F.sqrt(spread / (n - 1))),
    }).drop("_peak", "_sum", "_squares")


def summary_columns() -> list[Column]:
    """What a summary shows of a state. Returns compare the last close with the first open."""
    first, last, high, low = (F.col(c) for c in ("open_m", "close_m", "high_m", "low_m"))
    return [
        first, last, high, low,
        F.round(C.pct_change(last, first), 2).alias("return_pct"),
        F.round(C.range_pct(high, low, first), 2).alias("range_pct"),
        F.col("volume"), F.col("quote_volume_est"), F.col("num_trades"), F.col("days"), F.col("up_days"),
        F.col("down_days"),
        F.round(C.annualized_pct(F.col("return_sd")), 2).alias("vol_annual_pct"),
        F.col("worst_drawdown_pct"),
    ]


def monthly_of_states(states: DataFrame) -> DataFrame:
    """The monthly summary: a projection of the states."""
    return states.select("symbol", "month_start", "year", "month", "year_month", *summary_columns())


def yearly_of_states(states: DataFrame) -> DataFrame:
    """The same summary per symbol and year, merged from the months."""
    return merged_states(states, ["symbol", "year"]).select("symbol", "year", *summary_columns())


def _month(day: Column) -> Column:
    return F.trunc(day, "month")


def references(states: DataFrame) -> DataFrame:
    """(symbol, ref_day): the last day of each symbol; staged."""
    return staged(states.groupBy("symbol").agg(F.max("last_day").alias("ref_day")), "ref")


def asked_months(refs: DataFrame) -> list[date]:
    """The months of which a snapshot needs days: those of the look-backs and of the last 30 days.

    Distinct months over all symbols: the calendar bounds them, whatever the number of rows.
    """
    ref = F.col("ref_day")
    asked = F.array(*[_month(F.date_sub(ref, n)) for n in (0, 29, 30, 364, 365)])
    return sorted(r[0] for r in refs.select(F.explode(asked)).distinct().collect())


def kpi_of_states(
    states: DataFrame, recent: DataFrame, silver: DataFrame, refs: DataFrame, as_of: datetime | None = None,
    labels: tuple[str, str] = C.UP_DOWN,
) -> DataFrame:
    """The KPI snapshot of each symbol. ``recent`` has the daily rows of the ``asked_months`` (others do no harm).

    A look-back to a day takes the last row of that day's month up to the day, if there is one, else the
    last value of the latest earlier month. Extremes come from whole months and the rows of the one that
    the 52 weeks cut.
    """
    from wickline.operators.summaries import join_partial_price

    day, ref, last = F.col("day"), F.col("ref_day"), F.col("last_day")
    months = attach(states, refs, "symbol", F.col("month_start"))
    targets = {"7d": F.date_sub(ref, 7), "30d": F.date_sub(ref, 30), "365d": F.date_sub(ref, 365)}
    first_whole = F.date_sub(ref, 364)
    whole = F.col("month_start") >= first_whole
    from_months = months.groupBy("symbol").agg(
        F.max("ref_day").alias("last_close_day"),
        F.max(F.when(F.col("high_m").isNotNull(), F.struct("high_m", -F.unix_date("high_day")))).alias("_peak"),
        F.max(F.when(whole, F.col("high_m"))).alias("_high"), F.min(F.when(whole, F.col("low_m"))).alias("_low"),
        F.max_by("close_m", F.when(last < F.trunc(ref, "year"), last)).alias("_close_last_year"),
        *[F.max_by("close_m", F.when(F.col("month_start") < _month(t), last)).alias(f"_m_{k}")
          for k, t in targets.items()])
    rows = recent.select(
        "symbol", "day", "close", "high", "low", "volume", "change_pct", "drawdown_pct", "vol_30d_annual_pct",
        "ma50", "ma200", (F.col("trend_ma50_ma200") == labels[0]).alias("_rising"))
    rows = attach(rows, refs, "symbol", day)
    cut = (day >= first_whole) & (_month(day) < first_whole)

    def until(target: Column) -> Column:
        return F.when((day <= target) & (_month(day) == _month(target)), day)

    from_rows = rows.groupBy("symbol").agg(
        F.max_by("close", "day").alias("last_close"), F.max_by("change_pct", "day").alias("_change_1d"),
        F.max_by("drawdown_pct", "day").alias("drawdown_pct"),
        F.max_by("vol_30d_annual_pct", "day").alias("vol_30d_annual_pct"),
        F.max_by("ma50", "day").alias("ma50"), F.max_by("ma200", "day").alias("ma200"),
        F.max_by("_rising", "day").alias("_rising"),
        F.avg(F.when(day > F.date_sub(ref, 30), F.col("volume"))).alias("_volume_30d"),
        F.max(F.when(cut, F.col("high"))).alias("_cut_high"), F.min(F.when(cut, F.col("low"))).alias("_cut_low"),
        *[F.max(until(t)).isNotNull().alias(f"_met_{k}") for k, t in targets.items()],
        *[F.max_by("close", until(t)).alias(f"_r_{k}") for k, t in targets.items()])
    kpi = join_partial_price(from_months.join(from_rows, "symbol"), silver)

    def since(base: Column) -> Column:
        return F.round(C.pct_change(F.col("last_close"), base), 2)

    def then(k: str) -> Column:
        return F.when(F.col(f"_met_{k}"), F.col(f"_r_{k}")).otherwise(F.col(f"_m_{k}"))

    result = kpi.select(
        "symbol", "last_close_day", "last_close", F.round("_change_1d", 2).alias("change_1d_pct"),
        since(then("7d")).alias("change_7d_pct"), since(then("30d")).alias("change_30d_pct"),
        since(then("365d")).alias("change_12m_pct"), since(F.col("_close_last_year")).alias("change_ytd_pct"),
        F.col("_peak")["high_m"].alias("all_time_high"),
        F.date_from_unix_date(-F.col("_peak")["col2"]).alias("all_time_high_day"),
        F.greatest("_high", "_cut_high").alias("high_52w"), F.least("_low", "_cut_low").alias("low_52w"),
        "drawdown_pct", "vol_30d_annual_pct", "ma50", "ma200",
        F.when(F.col("_rising"), labels[0]).when(~F.col("_rising"), labels[1]).alias("trend_ma50_ma200"),
        F.round("_volume_30d", 2).alias("mean_volume_30d"), "partial_price", "partial_price_at")
    return result if as_of is None else result.withColumn("transformed_at", F.lit(as_of))
