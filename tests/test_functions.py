from datetime import datetime

import pytest
from pyspark.sql import functions as F

from build import UTC
from wickline.functions import candle as C
from wickline.functions.clock import WEEKDAYS_PT, calendar, safe_cutoff


@pytest.mark.parametrize("interval, hour, minute", [
    ("1m", 13, 47), ("5m", 13, 45), ("15m", 13, 45), ("1h", 13, 0), ("4h", 12, 0), ("1d", 0, 0)])
def test_cutoff_floors_to_the_interval(spark, interval, hour, minute):
    now = datetime(2024, 5, 3, 13, 47, 31, tzinfo=UTC)
    row = spark.range(1).select(
        safe_cutoff(F.lit(now), interval).cast("timestamp_ntz").alias("c"),
        safe_cutoff(F.lit(None).cast("timestamp"), interval).alias("none")).first()
    assert row.c == datetime(2024, 5, 3, hour, minute)
    assert row.none is None


def test_calendar_counts_from_sunday(spark):
    day = F.to_date(F.lit("2024-02-04"))
    row = spark.range(1).select(*[c.alias(n) for n, c in calendar(day, WEEKDAYS_PT).items()]).first()
    assert tuple(row) == (2024, 1, 2, "2024-02", 1, "Dom")


def test_zero_divisors_give_null(spark):
    zero, one = F.lit(0.0), F.lit(1.0)
    row = spark.range(1).select(
        C.pct_change(one, zero), C.log_return(one, zero), C.range_pct(one, zero, zero),
        C.log_return(zero, one)).first()
    assert tuple(row) == (None, None, None, None)


def test_flat_candle_is_up_and_equal_averages_are_down(spark):
    one = F.lit(1.0)
    row = spark.range(1).select(C.candle_type(one, one), C.trend(one, one)).first()
    assert tuple(row) == ("up", "down")
