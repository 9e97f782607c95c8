"""Time and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Candle intervals and their length in seconds.
INTERVAL_SECONDS = {"1m": 60, "5m": 300, "15m": 900, "1h": 3600, "4h": 14400, "1d": 86400}

# Weekday labels, Sunday first.
WEEKDAYS_EN = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
WEEKDAYS_PT = ("Dom", "Seg", "Ter", "Qua", "Qui", "Sex", "Sáb")


def safe_cutoff(ts: Column, interval: str) -> Column:
    """Start of the running period: everything that opened before it has closed. NULL stays NULL."""
    seconds = INTERVAL_SECONDS[interval]
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / seconds) * seconds)


def weekday_label(day: Column, labels: tuple[str, ...] = WEEKDAYS_EN) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in labels]), F.dayofweek(day))


def calendar(day: Column, labels: tuple[str, ...] = WEEKDAYS_EN) -> dict[str, Column]:
    """Calendar columns of a day; weekdays count from Sunday = 1."""
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "year_month": F.date_format(day, "yyyy-MM"),
        "weekday_num": F.dayofweek(day),
        "weekday": weekday_label(day, labels),
    }


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")
