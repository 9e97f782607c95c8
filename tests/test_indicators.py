import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from build import column, silver
from wickline.operators import indicators as I
from wickline.operators import series as S


def closed(spark, closes, **options):
    return I.closed_candles(silver(spark, closes, **options))


def test_only_closed_candles_count(spark):
    rows = silver(spark, [1, 2], days=[0, 2]).unionByName(silver(spark, [9], days=[1], closed=False))
    assert column(I.change(I.closed_candles(rows)), "prev_close") == [None, 1.0]


def test_changes(spark):
    df = I.log_return(I.change(closed(spark, [100, 101, 100])).drop("prev_close"))
    assert column(df, "change_abs") == [None, 1.0, -1.0]
    assert column(df, "change_pct") == [None, 1.0, -0.9901]
    assert column(df, "log_return")[1] == pytest.approx(math.log(1.01))


@pytest.mark.parametrize("rows", [29, 30, 49, 50, 199, 200])
def test_history_gates(spark, rows):
    last = {n: column(I.moving_averages(closed(spark, [5.0] * rows)), f"ma{n}")[-1]
            for n in (7, 30, 50, 200)}
    assert last == {n: 5.0 if n == 7 or rows >= n else None for n in (7, 30, 50, 200)}


def test_ma7_needs_no_history_and_frames_count_rows_not_days(spark):
    df = I.moving_averages(closed(spark, [1, 2, 3, 4, 5, 6, 7, 8], days=[0, 3, 6, 9, 12, 15, 18, 30]))
    assert column(df, "ma7") == [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0]


def test_volatility_needs_thirty_returns(spark):
    closes = [100 + (i % 3) for i in range(31)]
    got = column(I.volatility_annualized(closed(spark, closes)), "vol_30d_annual_pct")
    returns = [math.log(b / a) for a, b in zip(closes, closes[1:])]
    assert got[:30] == [None] * 30
    assert got[30] == round(statistics.stdev(returns) * math.sqrt(365) * 100, 2)


def test_trend_of_equal_averages_is_down(spark):
    got = column(I.trend_cross(closed(spark, [5.0] * 201)), "trend_ma50_ma200")
    assert got[198:] == [None, "down", "down"]


def test_drawdown_uses_closes(spark):
    df = I.drawdown(closed(spark, [10, 8, 12, 6], highs=[50, 50, 50, 50]))
    assert column(df, "drawdown_pct") == [0.0, -20.0, 0.0, -50.0]


def test_zero_volume_and_zero_trades(spark):
    df = closed(spark, [1, 1], volume=0.0, trades=0)
    assert column(I.relative_volume(df), "relative_volume") == [None, None]
    assert column(I.volume_per_trade(df), "volume_per_trade") == [None, None]


def test_missing_close_is_carried_as_missing(spark):
    df = I.change(closed(spark, [1, None, 3]))
    assert column(df, "prev_close") == [None, 1.0, None]
    assert column(S.running_max(df, "close"), "close_max") == [1.0, 1.0, 3.0]


def test_daily_table_has_its_columns(spark):
    daily = I.daily_indicators(silver(spark, [1, 2, 3]))
    assert tuple(daily.columns) == I.DAILY_COLUMNS and len(daily.columns) == 32


closes = st.lists(
    st.one_of(st.none(), st.integers(1, 500).map(lambda n: n / 4)), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(long=closes, short=closes, piece=st.integers(6, 40))
def test_cut_series_give_the_plain_windows(spark, long, short, piece):
    rows = closed(spark, long).unionByName(closed(spark, short, symbol="BBB"))

    def build(f, s):
        return f.withColumns({
            "n": s.position, "prev": s.previous("close"), "top": s.running_max("close"),
            "mean": s.mean("close", 5), "sd": s.stddev("close", 4)})

    def run(size):
        made = S.on_series(rows, build, halo=5, carry=["close"], max_rows=size)
        return sorted(map(tuple, made.collect()), key=lambda r: (r[0], r[1]))

    assert run(piece) == run(10_000)


def test_one_hot_series_among_many_short_ones(spark):
    hot = spark.range(5000).select(F.lit("hot").alias("symbol"), "id")
    cold = spark.range(10000).select(F.concat(F.lit("s"), F.col("id") % 500).alias("symbol"), "id")
    rows = hot.unionByName(cold)
    made = S.row_index(rows, on="id", max_rows=300)
    got = made.groupBy("symbol").agg(F.count("*").alias("n"), F.sum("row_index").alias("t"))
    assert got.where("t <> n * (n + 1) / 2").count() == 0
    assert made.where("symbol = 'hot' AND row_index <> id + 1").count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(start=st.integers(0, 259), peak=st.integers(0, 259))
def test_tail_equals_the_full_rebuild(spark, start, peak):
    closes = [100 + (i * 7) % 13 / 4 + (50 if i == peak else 0) for i in range(260)]
    rows = silver(spark, closes).unionByName(silver(spark, closes[:40], symbol="BBB"))
    day = rows.where("symbol = 'AAA'").orderBy("day").collect()[start].day
    since = spark.createDataFrame([("AAA", day)], "symbol string, since date")
    full = I.daily_indicators(rows)
    tail = I.daily_tail(rows, full, since)
    expected = full.where((F.col("symbol") == "AAA") & (F.col("day") >= F.lit(day)))
    assert sorted(map(tuple, tail.collect())) == sorted(map(tuple, expected.collect()))
