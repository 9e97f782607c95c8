import json
from datetime import timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from build import at, bronze, bronze_row, silver
from wickline import schemas
from wickline.operators import quality as Q
from wickline.sources.tables import conform


def reasons(spark, *rows):
    cleaned = Q.quality_reason(Q.typed_candles(bronze(spark, list(rows))))
    return [r.reason for r in cleaned.select("reason").collect()]


@pytest.mark.parametrize("change, expected", [
    ({}, None),
    ({"symbol": None}, "null key"),
    ({"open_time": None}, "null key"),
    ({"open": 0.0}, "non-positive price"),
    ({"low": -1.0}, "non-positive price"),
    ({"close": 0.004}, "non-positive price"),
    ({"high": 10.5}, "high below open/close"),
    ({"low": 10.5}, "low above open/close"),
    ({"volume": -1.0}, "negative volume or trades"),
    ({"num_trades": -1}, "negative volume or trades"),
    ({"close_time": at(0)}, "close before open time"),
    ({"open": 0.0, "volume": -1.0}, "non-positive price"),
    ({"open": None}, None),
    ({"volume": None, "close_time": None}, None),
    ({"symbol": ""}, None),
    ({"high": 1e17}, "unrepresentable value"),
    ({"high": float("inf")}, "unrepresentable value"),
    ({"volume": float("nan")}, "unrepresentable value"),
])
def test_first_failing_rule(spark, change, expected):
    assert reasons(spark, bronze_row(**change)) == [expected]


def test_optional_not_null_rules(spark):
    typed = Q.typed_candles(bronze(spark, [bronze_row(open=None)]))
    row = Q.quality_reason(typed, [*Q.quality_rules(), *Q.not_null_rules()]).first()
    assert row.reason == "missing open"


def clean(spark, *rows):
    return Q.clean_candles(bronze(spark, list(rows)))


def test_closed_beats_a_later_open_version(spark):
    row = clean(spark, bronze_row(closed=True, ingest=at(1, 10), close=11.0),
                bronze_row(closed=False, ingest=at(1, 11), close=12.0)).collect()
    assert [(r.is_closed, float(r.close)) for r in row] == [(True, 11.0)]


def test_latest_open_version_wins_and_bad_ingest_text_is_last(spark):
    rows = clean(spark, bronze_row(closed=False, ingest=at(0, 5), close=9.5),
                 bronze_row(closed=None, ingest=at(0, 6), close=10.5),
                 bronze_row(closed=False, ingest="xx", close=11.5)).collect()
    assert [(r.is_closed, float(r.close)) for r in rows] == [(False, 10.5)]


def test_full_ties_are_deterministic(spark):
    a, b = bronze_row(close=10.5), bronze_row(close=11.5)
    assert clean(spark, a, b).first().close == clean(spark, b, a).first().close


def test_two_symbols_at_one_time_are_both_kept(spark):
    rows = clean(spark, bronze_row(symbol=" aaa "), bronze_row(symbol="BBB"))
    assert sorted(r.symbol for r in rows.collect()) == ["AAA", "BBB"]


def test_two_open_times_of_one_day_give_one_silver_row(spark):
    rows = Q.silver_rows(clean(spark, bronze_row(hour=0, ingest=at(1)), bronze_row(hour=12, ingest=at(1))))
    assert [r.open_time for r in rows.select(F.col("open_time").cast("timestamp_ntz")).collect()] == [
        at(0, 12).replace(tzinfo=None)]


def test_payload_is_the_received_row_without_nulls(spark):
    row = clean(spark, bronze_row(open=0.0, volume=None)).first()
    payload = json.loads(row.payload)
    assert payload["open"] == 0.0 and payload["symbol_raw"] == "AAA" and "volume" not in payload
    assert payload["open_time"] == "2024-01-01T00:00:00.000Z"


def test_rejects_are_stored_once_also_with_nulls(spark):
    cleaned = clean(spark, bronze_row(symbol=None, ingest="xx"), bronze_row(day=1, open=0.0), bronze_row(day=2))
    first = Q.store_rejects(spark.createDataFrame([], schemas.REJECT), cleaned, at(9))
    assert first.count() == 2
    assert Q.store_rejects(first, cleaned, at(10)).count() == 0


def test_every_version_is_valid_rejected_or_superseded(spark):
    rows = [bronze_row(day=d, closed=c, **({"open": 0.0} if d == 3 else {}))
            for d in range(6) for c in (True, False)]
    cleaned = clean(spark, *rows)
    valid, rejected = Q.split_valid_rejected(cleaned)
    assert (valid.count(), rejected.count()) == (5, 1)


def test_missing_days_per_symbol(spark):
    both = silver(spark, [1, 1, 1], days=[0, 1, 3]).unionByName(
        silver(spark, [1, 1], symbol="BBB", days=[2, 3]))
    found = [(r.symbol, r.day) for r in Q.missing_days(both).collect()]
    assert found == [("AAA", (at(2)).date())]


def test_spine_crosses_months_and_years(spark):
    spans = spark.sql("SELECT DATE'2023-12-30' AS a, DATE'2024-03-01' AS b, 'x' AS symbol")
    days = [r.day for r in Q.date_spine(spans, "a", "b").orderBy("day").collect()]
    assert days == [at(n).date() for n in range(-2, 61)]


def test_completeness_and_load_check(spark):
    both = silver(spark, [1, 1], days=[0, 4]).unionByName(silver(spark, [1], days=[5], closed=False))
    row = Q.series_completeness(both).first()
    assert (row.days_loaded, row.days_expected, row.open_candles) == (3, 6, 1)
    row = Q.load_check(bronze(spark, [bronze_row(), bronze_row(1, closed=None), bronze_row(2, closed=False)])).first()
    assert (row.total, row.open_candles) == (3, 2)
    assert row.last_open - row.first_open == timedelta(days=2)


def test_not_null_columns_and_types_are_enforced(spark):
    rows = silver(spark, [1])
    with pytest.raises(TypeError):
        conform(rows.withColumn("close", F.lit(1.0)), schemas.SILVER)
    with pytest.raises(PySparkException, match="NOT NULL"):
        conform(rows.withColumn("symbol", F.lit(None).cast("string")), schemas.SILVER).collect()
