"""Row-level candle arithmetic. A zero divisor gives NULL instead of an ANSI error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UP_DOWN = ("up", "down")
DAYS_PER_YEAR = 365


def pct_change(value: Column, base: Column) -> Column:
    return (F.try_divide(value, base) - 1) * 100


def log_return(value: Column, base: Column) -> Column:
    return F.ln(F.try_divide(value, base))


def range_pct(high: Column, low: Column, base: Column) -> Column:
    return F.try_divide(high - low, base) * 100


def quote_volume(volume: Column, high: Column, low: Column, close: Column) -> Column:
    """Traded value estimated at the typical price."""
    return volume * (high + low + close) / 3


def candle_type(open_: Column, close: Column, labels: tuple[str, str] = UP_DOWN) -> Column:
    return F.when(close >= open_, labels[0]).otherwise(labels[1])


def trend(fast: Column, slow: Column, labels: tuple[str, str] = UP_DOWN) -> Column:
    """Strictly above is up; a tie is down."""
    return F.when(fast > slow, labels[0]).otherwise(labels[1])


def annualized_pct(deviation: Column, periods: int = DAYS_PER_YEAR) -> Column:
    return deviation * F.sqrt(F.lit(float(periods))) * 100


def after_rows(position: Column, rows: int, value: Column) -> Column:
    """``value`` once the series has ``rows`` rows, NULL before."""
    return F.when(position >= rows, value)
