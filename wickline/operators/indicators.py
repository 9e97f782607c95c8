"""Daily indicators over closed candles."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickline.functions import candle as C
from wickline.functions.clock import WEEKDAYS_EN, calendar
from wickline.operators.keys import attach
from wickline.operators.series import Series, on_series

# Spans in rows, and the history each gated value needs.
MA_SPANS = (7, 30, 50, 200)
GATED_SPANS = (30, 50, 200)
TREND_FAST, TREND_SLOW = 50, 200
VOLATILITY_ROWS = 30
VOLUME_ROWS = 30
# Earlier rows that the widest frame reaches.
HALO = max(MA_SPANS) - 1


def closed_candles(silver: DataFrame) -> DataFrame:
    """Closed candles with prices and volume as doubles: the input of every indicator."""
    amounts = ["open", "high", "low", "close", "volume"]
    return silver.where("is_closed").select(
        "symbol", "day", *[F.col(c).cast("double").alias(c) for c in amounts], "num_trades")


def _changes() -> dict[str, Column]:
    close, prev = F.col("close"), F.col("prev_close")
    return {
        "change_abs": F.round(close - prev, 2),
        "change_pct": F.round(C.pct_change(close, prev), 4),
    }


def _with_log_return(frame: DataFrame, s: Series) -> DataFrame:
    frame = frame.withColumn("prev_close", s.previous("close"))
    return frame.withColumn("log_return", C.log_return(F.col("close"), F.col("prev_close")))


def _average(s: Series, col: str, n: int, gated: bool) -> Column:
    mean = F.round(s.mean(col, n), 2)
    return C.after_rows(s.position, n, mean) if gated else mean


def _trend(s: Series, fast: int, slow: int, labels: tuple[str, str]) -> Column:
    return C.after_rows(s.position, slow, C.trend(s.mean("close", fast), s.mean("close", slow), labels))


def _volatility(s: Series, n: int, periods: int) -> Column:
    # The first return is NULL, so n returns need n + 1 rows.
    return C.after_rows(
        s.position, n + 1, F.round(C.annualized_pct(s.stddev("log_return", n), periods), 2))


def _drawdowns(top: Column) -> dict[str, Column]:
    return {
        "running_max_close": F.round(top, 2),
        "drawdown_pct": F.round(C.pct_change(F.col("close"), top), 2),
    }


def _relative_volume(mean: Column) -> dict[str, Column]:
    return {
        "volume_ma30": F.round(mean, 4),
        "relative_volume": F.round(F.try_divide(F.col("volume"), mean), 2),
    }


def change(df: DataFrame, **series) -> DataFrame:
    """Previous close of the series, absolute and percentage change against it."""
    return on_series(
        df, lambda f, s: f.withColumn("prev_close", s.previous("close")), halo=1, **series
    ).withColumns(_changes())


def log_return(df: DataFrame, **series) -> DataFrame:
    return on_series(df, _with_log_return, halo=1, **series)


def range_pct(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "range_pct", F.round(C.range_pct(F.col("high"), F.col("low"), F.col("open")), 4))


def quote_volume_est(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "quote_volume_est",
        C.quote_volume(F.col("volume"), F.col("high"), F.col("low"), F.col("close")))


def volume_per_trade(df: DataFrame) -> DataFrame:
    return df.withColumn("volume_per_trade", F.try_divide(F.col("volume"), F.col("num_trades")))


def candle_type(df: DataFrame, labels: tuple[str, str] = C.UP_DOWN) -> DataFrame:
    return df.withColumn("candle_type", C.candle_type(F.col("open"), F.col("close"), labels))


def moving_averages(
    df: DataFrame, spans: Sequence[int] = MA_SPANS, gated: Sequence[int] = GATED_SPANS, **series
) -> DataFrame:
    """``ma<n>`` of the close over the last n rows; gated spans are NULL until n rows exist."""
    return on_series(
        df,
        lambda f, s: f.withColumns({f"ma{n}": _average(s, "close", n, n in gated) for n in spans}),
        halo=max(spans) - 1, **series)


def trend_cross(
    df: DataFrame, fast: int = TREND_FAST, slow: int = TREND_SLOW,
    labels: tuple[str, str] = C.UP_DOWN, **series
) -> DataFrame:
    """Fast against slow average, compared before rounding."""
    return on_series(
        df, lambda f, s: f.withColumn(f"trend_ma{fast}_ma{slow}", _trend(s, fast, slow, labels)),
        halo=max(fast, slow) - 1, **series)


def volatility_annualized(
    df: DataFrame, n: int = VOLATILITY_ROWS, periods: int = C.DAYS_PER_YEAR, **series
) -> DataFrame:
    """Annualised standard deviation, in per cent, of the last ``n`` log returns."""
    return on_series(
        df,
        lambda f, s: _with_log_return(f, s).withColumn(
            f"vol_{n}d_annual_pct", _volatility(s, n, periods)),
        halo=n, **series)


def drawdown(df: DataFrame, **series) -> DataFrame:
    """Distance, in per cent, from the highest close so far."""
    return on_series(
        df, lambda f, s: f.withColumn("_top", s.running_max("close")), halo=0, carry=["close"],
        **series
    ).withColumns(_drawdowns(F.col("_top"))).drop("_top")


def relative_volume(df: DataFrame, n: int = VOLUME_ROWS, **series) -> DataFrame:
    """Volume against its mean over the last ``n`` rows; above 1.5 counts as unusual."""
    return on_series(
        df, lambda f, s: f.withColumn("_mean", s.mean("volume", n)), halo=n - 1, **series
    ).withColumns(_relative_volume(F.col("_mean"))).drop("_mean")


def calendar_columns(df: DataFrame, labels: tuple[str, ...] = WEEKDAYS_EN) -> DataFrame:
    return df.withColumns(calendar(F.col("day"), labels))


DAILY_COLUMNS = (
    "symbol", "day", "year", "quarter", "month", "year_month", "weekday_num", "weekday",
    "open", "high", "low", "close", "volume", "quote_volume_est", "num_trades", "volume_per_trade",
    "prev_close", "change_abs", "change_pct", "log_return", "range_pct", "candle_type",
    "ma7", "ma30", "ma50", "ma200", "trend_ma50_ma200",
    "vol_30d_annual_pct", "running_max_close", "drawdown_pct", "volume_ma30", "relative_volume",
)


def _daily(
    rows: DataFrame, weekdays: tuple[str, ...], labels: tuple[str, str], **series
) -> DataFrame:
    """Daily columns of ``rows``, whose ``_seen`` is the highest close known at each row."""

    def build(frame: DataFrame, s: Series) -> DataFrame:
        return _with_log_return(frame, s).withColumns({
            **{f"ma{n}": _average(s, "close", n, n in GATED_SPANS) for n in MA_SPANS},
            f"trend_ma{TREND_FAST}_ma{TREND_SLOW}": _trend(s, TREND_FAST, TREND_SLOW, labels),
            "vol_30d_annual_pct": _volatility(s, VOLATILITY_ROWS, C.DAYS_PER_YEAR),
            "_top": s.running_max("_seen"),
            "_volume_mean": s.mean("volume", VOLUME_ROWS),
        })

    wide = on_series(rows, build, halo=HALO, carry=["_seen"], **series)
    wide = wide.withColumns({
        **_changes(),
        **_drawdowns(F.col("_top")),
        **_relative_volume(F.col("_volume_mean")),
    })
    return calendar_columns(
        candle_type(volume_per_trade(quote_volume_est(range_pct(wide))), labels), weekdays)


def _stamped(daily: DataFrame, as_of: datetime | None) -> DataFrame:
    daily = daily.select(*DAILY_COLUMNS)
    return daily if as_of is None else daily.withColumn("transformed_at", F.lit(as_of))


def daily_indicators(
    silver: DataFrame,
    as_of: datetime | None = None,
    weekdays: tuple[str, ...] = WEEKDAYS_EN,
    labels: tuple[str, str] = C.UP_DOWN,
    **series,
) -> DataFrame:
    """Every indicator of every closed candle: one shuffle and one sort for all the windows."""
    rows = closed_candles(silver).withColumn("_seen", F.col("close"))
    return _stamped(_daily(rows, weekdays, labels, **series), as_of)


def daily_tail(
    silver: DataFrame,
    stored: DataFrame,
    since: DataFrame,
    as_of: datetime | None = None,
    weekdays: tuple[str, ...] = WEEKDAYS_EN,
    labels: tuple[str, str] = C.UP_DOWN,
    **series,
) -> DataFrame:
    """The rows of ``daily_indicators`` from ``since`` on, computed from those rows only.

    ``since`` has (symbol, since): the first changed day of each changed symbol; earlier rows do
    not change. ``stored`` is the daily table before the change. Its last rows before ``since``
    fill the frames (each map task sends at most that many per symbol), and its running maximum
    stands for all the history before them.
    """
    day = F.col("day")
    new = attach(closed_candles(silver), since, "symbol", day).where(day >= F.col("since"))
    latest = Window.partitionBy("symbol").orderBy(day.desc())
    context = attach(stored, since, "symbol", day).where(day < F.col("since"))
    context = context.withColumn("_back", F.row_number().over(latest)).where(F.col("_back") <= HALO)
    inputs = ["symbol", "day", "open", "high", "low", "close", "volume", "num_trades"]
    rows = new.select(*inputs, F.col("close").alias("_seen"), F.lit(True).alias("_new")).unionByName(
        context.select(*inputs, F.col("running_max_close").alias("_seen"), F.lit(False).alias("_new")))
    return _stamped(_daily(rows, weekdays, labels, **series).where("_new"), as_of)
