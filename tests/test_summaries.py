import statistics
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from build import START, at, column, silver
from wickline.operators import indicators as I
from wickline.operators import summaries as S
from wickline.operators.quantile import exact_median
from wickline.sources import glossary as G


def daily(spark, closes, **options):
    return I.daily_indicators(silver(spark, closes, **options))


def kpi(spark, closes, **options):
    rows = silver(spark, closes, **options)
    return S.kpi_snapshot(I.daily_indicators(rows), rows).first()


def test_short_history_has_no_lookbacks(spark):
    row = kpi(spark, [1, 2, 3])
    assert (row.last_close, row.change_1d_pct) == (3.0, 50.0)
    assert (row.change_7d_pct, row.change_30d_pct, row.change_12m_pct, row.change_ytd_pct) == (None,) * 4
    assert row.ma200 is None and row.trend_ma50_ma200 is None


def test_lookbacks_take_the_last_row_before(spark):
    row = kpi(spark, [10, 20, 40], days=[0, 5, 13])
    assert row.change_7d_pct == 100.0
    assert S.asof_lookback(daily(spark, [10, 20, 40], days=[0, 5, 13]), "close", [7, 10]).first()[
        "close_10d_ago"] == 10.0


def test_year_to_date_base_is_before_january(spark):
    assert kpi(spark, [10, 20, 30], days=[-5, 3, 9]).change_ytd_pct == 200.0


def test_52_weeks_are_calendar_days(spark):
    row = kpi(spark, [500, 400, 100], days=[0, 1, 365])
    assert (row.high_52w, row.low_52w, row.all_time_high) == (400.0, 100.0, 500.0)


def test_first_of_equal_highs(spark):
    row = kpi(spark, [1, 2, 1, 2], highs=[5, 9, 9, 3])
    assert (row.all_time_high, row.all_time_high_day) == (9.0, date(2024, 1, 2))


def test_partial_price_is_the_latest_open_candle(spark):
    rows = silver(spark, [1, 2]).unionByName(silver(spark, [7], days=[2], closed=False))
    row = S.kpi_snapshot(I.daily_indicators(rows), rows).select(
        "partial_price", F.col("partial_price_at").cast("timestamp_ntz").alias("t")).first()
    assert (row.partial_price, row.t) == (7.0, at(2, 1).replace(tzinfo=None))
    assert kpi(spark, [1, 2]).partial_price is None


def test_lookback_join_survives_without_broadcast(spark):
    rows = daily(spark, [float(n) for n in range(1, 80)])
    expected = S.asof_lookback(rows, "close", [7, 30]).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert S.asof_lookback(rows, "close", [7, 30]).collect() == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_month(spark):
    row = S.monthly_summary(daily(spark, [10, 12, 9], highs=[11, 15, 10])).first()
    assert (row.month_start, row.open_m, row.close_m) == (START, 10.0, 9.0)
    assert (row.return_pct, row.range_pct) == (-10.0, 60.0)
    assert (row.days, row.up_days, row.down_days, row.num_trades) == (3, 1, 1, 6)
    assert S.monthly_summary(daily(spark, [10, 12])).first().vol_annual_pct is None


def test_tiny_change_is_neither_up_nor_down(spark):
    row = S.monthly_summary(daily(spark, ["30000000.00", "30000000.01"])).first()
    assert (row.up_days, row.down_days) == (0, 0)


def test_weekday_drops_the_first_row(spark):
    rows = S.weekday_seasonality(daily(spark, [10, 11, 12])).collect()
    assert sorted(r.weekday for r in rows) == ["Tue", "Wed"]


def test_weekday_labels_are_a_parameter(spark):
    from wickline.functions.clock import WEEKDAYS_PT

    rows = I.daily_indicators(silver(spark, [1]), weekdays=WEEKDAYS_PT, labels=("Alta", "Baixa"))
    assert rows.select("weekday", "candle_type").first() == ("Seg", "Alta")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=40))
def test_median_of_large_groups_is_exact(spark, values):
    rows = spark.createDataFrame(
        [("a", i, None if v is None else v / 8) for i, v in enumerate(values)] + [("b", 0, 1.5)],
        "g string, i int, v double")
    got = {r.g: r.m for r in exact_median(rows, "g", "v", "m", ["i"], buffer_rows=3).collect()}
    kept = [v / 8 for v in values if v is not None]
    assert got.pop("b") == 1.5
    assert got == ({"a": statistics.median(kept)} if kept else {})


def test_top_k(spark):
    assert column(S.top_k(daily(spark, [1, 2, 3]), F.col("day").desc(), 2), "close") == [2.0, 3.0]


def test_glossary_terms_exist_in_gold(spark):
    rows = silver(spark, [1, 2, 3])
    d = I.daily_indicators(rows)
    tables = {"daily": d, "monthly": S.monthly_summary(d), "weekday": S.weekday_seasonality(d),
              "kpi": S.kpi_snapshot(d, rows)}
    checked = G.check_glossary(G.glossary(spark), tables)
    assert column(checked, "position", "position") == list(range(1, 17))
    assert checked.where("filled_rows IS NULL").count() == 0
    from wickline.sources.tables import insert_literals

    more = insert_literals(G.glossary(spark), [(17, "New", "n", "d", "f", "daily.unknown")])
    assert G.check_glossary(more, tables).where("filled_rows IS NULL").first().position == 17


@pytest.mark.parametrize("as_of", [at(5)])
def test_stamp_is_an_argument(spark, as_of):
    assert I.daily_indicators(silver(spark, [1]), as_of).columns[-1] == "transformed_at"
