"""Stored tables and streams, end to end on small landings."""

import json
from itertools import permutations

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from build import at, bronze, bronze_row, column
from wickline import schemas
from wickline.operators.indicators import daily_indicators
from wickline.operators.merge import INSERTED, UPDATED
from wickline.plans import refresh as R
from wickline.plans import views
from wickline.plans.lake import Lake
from wickline.sources.history import load_history
from wickline.sources.landing import read_landing, write_landing_confirmed, write_landing_open
from wickline.sources.tables import read_table
from wickline.streaming import loads

NOW = at(60)


def rows(spark, lake):
    stored = read_table(spark, lake.silver, schemas.SILVER).orderBy("symbol", "day")
    return [(r.symbol, r.day, float(r.close), r.is_closed) for r in stored.collect()]


def test_three_refreshes(spark, tmp_path):
    lake = Lake(str(tmp_path))
    days = [bronze_row(d, close=10.0 + d / 4) for d in range(5)]
    bad = [bronze_row(5, low=50.0), bronze_row(6, symbol=None)]
    landed = bronze(spark, days + bad + [bronze_row(7, closed=False)])
    assert R.refresh_bronze(spark, lake, landed, "1", NOW)[INSERTED] == 7
    assert R.refresh_silver(spark, lake, "1", NOW)[INSERTED] == 6
    gold = R.refresh_gold(spark, lake, "1", NOW)
    assert gold["daily"].count() == 5 and gold["kpi"].first().partial_price == 11.0
    reasons = sorted(r.reason for r in spark.read.parquet(lake.rejects).collect())
    assert reasons == ["low above open/close", "null key"]

    # The same landing again: nothing new anywhere.
    counts = R.refresh_bronze(spark, lake, landed, "2", NOW)
    assert counts[INSERTED] == 0
    counts = R.refresh_silver(spark, lake, "2", NOW)
    assert (counts[INSERTED], counts[UPDATED]) == (0, 0)
    assert spark.read.parquet(lake.rejects).count() == 2

    # The open candle closes late, with an older ingest than its open version.
    late = bronze(spark, [bronze_row(7, close=11.5, ingest=at(7))])
    R.refresh_bronze(spark, lake, late, "3", NOW)
    assert R.refresh_silver(spark, lake, "3", NOW)[UPDATED] == 1
    R.refresh_gold(spark, lake, "3", at(61))
    assert R.read_gold(spark, lake, "daily").count() == 6
    operations = {(r.table, r.operation) for r in load_history(spark, lake.history).collect()}
    assert ("silver", "MERGE") in operations and ("kpi", "CREATE OR REPLACE TABLE AS SELECT") in operations


def test_a_lake_of_buckets(spark, tmp_path):
    """Bronze and silver as bucketed tables of the catalog: the same rows, by path and by name."""
    lake = Lake(str(tmp_path), "lake_of_buckets", 4)
    try:
        for run, day in (("1", 1), ("2", 2)):
            landed = bronze(spark, [bronze_row(d, close=10.0 + d / 20, closed=d < day) for d in (0, 1, 40)])
            R.refresh_bronze(spark, lake, landed, run, NOW)
            counts = R.refresh_silver(spark, lake, run, NOW)
        assert (counts[INSERTED], counts[UPDATED]) == (0, 1)
        assert [(float(r.close), r.is_closed) for r in spark.table("lake_of_buckets.stored_silver").orderBy(
            "day").collect()] == [r[2:] for r in rows(spark, lake)] == [(10.0, True), (10.05, True), (12.0, False)]
    finally:
        spark.sql("DROP SCHEMA IF EXISTS lake_of_buckets CASCADE")


def test_land_writes_both_tracks(spark, tmp_path):
    lake = Lake(str(tmp_path))
    src = bronze(spark, [bronze_row(d) for d in range(4)])
    R.land(spark, lake, src, at(3, 9))
    landed = read_landing(spark, lake.landing)
    assert column(landed, "is_closed", "open_time") == [True, True, True, False]
    R.refresh_bronze(spark, lake, landed, "1", at(3, 9))
    R.land(spark, lake, src, at(4, 9))
    R.refresh_bronze(spark, lake, read_landing(spark, lake.landing), "2", at(4, 9))
    assert column(read_table(spark, lake.bronze, schemas.BRONZE), "is_closed", "open_time") == [True] * 4


def test_refresh_repeated(spark, tmp_path):
    """The same load again changes nothing."""
    lake = Lake(str(tmp_path))
    landed = bronze(spark, [bronze_row(d) for d in range(3)])
    R.refresh_bronze(spark, lake, landed, "1", NOW)
    again = R.refresh_bronze(spark, lake, landed, "1", NOW)
    assert again["numTargetRowsInserted"] == 0 and again["numOutputRows"] == 3
    assert read_table(spark, lake.bronze, schemas.BRONZE).count() == 3


def test_stream_equals_batch_when_an_open_version_follows_a_closed_one(spark, tmp_path):
    """Two micro-batches; the second brings a newer open version of a closed candle."""
    batches = [[bronze_row(2), bronze_row(3, closed=True, ingest=at(4, 1), close=11.5)],
               [bronze_row(3, closed=False, ingest=at(4, 9), close=9.5), bronze_row(4, symbol="BBB")]]
    got = []
    for mode in ("stream", "batch"):
        lake = Lake(str(tmp_path / mode))
        for part in batches:
            rows_ = bronze(spark, part)
            write_landing_confirmed(rows_.where("is_closed"), lake.landing)
            write_landing_open(rows_.where("NOT is_closed"), lake.landing)
            if mode == "stream":
                loads.stream_bronze_to_gold(
                    spark, lake, str(tmp_path / "checkpoint"), "g", NOW).awaitTermination()
        if mode == "batch":
            R.refresh_bronze(spark, lake, read_landing(spark, lake.landing), "1", NOW)
            R.refresh_silver(spark, lake, "1", NOW)
            R.refresh_gold(spark, lake, "1", NOW)
        got.append((rows(spark, lake), sorted(R.read_gold(spark, lake, "daily").select("symbol", "day", "close").collect())))
    assert got[0] == got[1] and len(got[0][1]) == 3
    assert 11.5 in [r.close for r in got[0][1]]


def test_reset_checkpoint_loses_nothing(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for n, day in enumerate((0, 1, 2)):
        write_landing_confirmed(bronze(spark, [bronze_row(day)]), lake.landing)
        loads.stream_landing_to_bronze(spark, lake, str(tmp_path / f"c{n % 2}"), "b", NOW).awaitTermination()
    assert read_table(spark, lake.bronze, schemas.BRONZE).count() == 3


def test_different_rows_without_a_key_are_all_kept(spark, tmp_path):
    lake = Lake(str(tmp_path))
    keyless = [bronze_row(0, symbol=None, close=10.0 + i / 8, ingest=at(2)) for i in range(5)]
    for _ in range(2):
        R.refresh_bronze(spark, lake, bronze(spark, keyless + keyless[:2]), "1", NOW)
    assert spark.read.parquet(lake.rejects).count() == 5


def test_open_landing_keeps_other_symbols(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for symbol, close in (("AAA", 10.0), ("BBB", 10.5), (None, 9.5), ("AAA", 11.0)):
        write_landing_open(bronze(spark, [bronze_row(0, symbol=symbol, closed=False, close=close)]), lake.landing)
    landed = read_landing(spark, lake.landing).collect()
    assert sorted(((r.symbol_raw, r.close) for r in landed), key=str) == [("AAA", 11.0), ("BBB", 10.5), (None, 9.5)]


def test_from_pages_to_gold(spark, tmp_path):
    """JSON pages, some of them broken, to gold, with the checks and views after the loads."""
    lake = Lake(str(tmp_path))
    start = 1704067200000

    def kline(d, close="11.0"):
        opened = start + d * 86_400_000
        return [opened, "10.0", "12.0", "9.0", close, "5.0", opened + 86_399_999, "0", 3, "0", "0", "0"]

    pages = spark.createDataFrame(
        [(json.dumps([kline(d) for d in (0, 1, 3, 4)]), "AAA"), ("no json", "AAA"),
         (json.dumps([kline(5, "x")]), "AAA")], "page string, symbol_raw string")
    R.land_pages(spark, lake, pages, "page", "symbol_raw", at(4, 9))
    assert sorted(r.fault for r in spark.read.parquet(lake.faults).collect()) == ["unreadable page", "unreadable value"]
    R.refresh_bronze(spark, lake, read_landing(spark, lake.landing), "1", at(4, 9))
    R.refresh_silver(spark, lake, "1", at(4, 9))
    R.refresh_gold(spark, lake, "1", at(4, 9))
    assert R.check_bronze(spark, lake).first()[0] == 4
    completeness, gaps = R.check_silver(spark, lake)
    assert completeness.count() == 1 and [r.day.day for r in gaps.collect()] == [3]
    views.create_views(spark, lake)
    assert spark.sql("SELECT count(*) FROM gold_daily").first()[0] == 3
    assert {r.layer for r in spark.sql("SELECT * FROM volume_daily").collect()} == {"silver", "gold"}
    assert spark.sql("SELECT * FROM history_gold").count() == 4
    assert [r.position for r in spark.sql("SELECT * FROM glossary").collect()] == list(range(1, 17))


VERSIONS = [bronze_row(3, closed=False, ingest=at(3, 5), close=10.5),
            bronze_row(3, closed=True, ingest=at(4, 1), close=11.5),
            bronze_row(3, closed=False, ingest=at(3, 9), close=9.5)]


@pytest.mark.parametrize("order", list(permutations(range(3)))[::2])
def test_late_updates_end_alike_in_any_order(spark, tmp_path, order):
    lake = Lake(str(tmp_path))
    checkpoint = str(tmp_path / "checkpoint")
    for n, i in enumerate(order):
        rows_ = bronze(spark, [VERSIONS[i], bronze_row(10 + n)])
        write_landing_confirmed(rows_.where("is_closed"), lake.landing)
        write_landing_open(rows_.where("NOT is_closed"), lake.landing)
        loads.stream_late_updates(spark, lake, checkpoint, "s", NOW).awaitTermination()
    got = rows(spark, lake)
    assert [(c, f) for _, _, c, f in got] == [(11.5, True)] + [(11.0, True)] * 3


def test_stream_to_gold_equals_batch_and_restarts(spark, tmp_path):
    lake = Lake(str(tmp_path))
    checkpoint = str(tmp_path / "checkpoint")
    all_rows = [bronze_row(d, close=10.0 + d % 7 / 4) for d in range(45)]
    write_landing_open(bronze(spark, [bronze_row(45, closed=False)]), lake.landing)
    for part in (all_rows[:20], all_rows[20:]):
        write_landing_confirmed(bronze(spark, part), lake.landing)
        loads.stream_bronze_to_gold(spark, lake, checkpoint, "g", NOW).awaitTermination()
    silver = R.silver_of(bronze(spark, all_rows))
    expected = sorted(map(tuple, daily_indicators(silver).collect()))
    daily = R.read_gold(spark, lake, "daily").drop("transformed_at")
    assert sorted(map(tuple, daily.collect())) == expected
    batches = load_history(spark, lake.history).where("table = 'bronze'").count()
    loads.stream_bronze_to_gold(spark, lake, checkpoint, "g", NOW).awaitTermination()
    assert load_history(spark, lake.history).where("table = 'bronze'").count() == batches == 2


def test_failing_silver_stops_the_batch(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    write_landing_open(bronze(spark, [bronze_row(9, closed=False)]), lake.landing)
    write_landing_confirmed(bronze(spark, [bronze_row(0)]), lake.landing)

    def broken(*_args, **_options):
        raise ValueError("silver is broken")

    monkeypatch.setattr(loads, "refresh_silver", broken)
    with pytest.raises((StreamingQueryException, PySparkException)):
        loads.stream_bronze_to_gold(
            spark, lake, str(tmp_path / "checkpoint"), "g", NOW).awaitTermination()
    tables = {r.table for r in load_history(spark, lake.history).select(F.col("table")).collect()}
    assert tables == {"bronze"}


def test_stream_waits_for_folders_that_do_not_exist_yet(spark, tmp_path):
    lake = Lake(str(tmp_path))
    checkpoint = str(tmp_path / "checkpoint")
    write_landing_confirmed(bronze(spark, [bronze_row(0)]), lake.landing)
    loads.stream_landing_to_bronze(spark, lake, checkpoint, "b", NOW).awaitTermination()
    write_landing_open(bronze(spark, [bronze_row(1, closed=False)]), lake.landing)
    loads.stream_landing_to_bronze(spark, lake, checkpoint, "b", NOW).awaitTermination()
    assert column(read_table(spark, lake.bronze, schemas.BRONZE), "is_closed", "open_time") == [True, False]
