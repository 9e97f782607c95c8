import json
from datetime import datetime, timedelta

import pytest

from build import UTC, at, bronze, bronze_row, column
from wickline import schemas
from wickline.functions.clock import safe_cutoff
from wickline.operators import ingest as N
from wickline.sources import landing as L
from wickline.sources.history import current_location, load_history, record_load
from wickline.sources.tables import cluster_layout, create_schema, declare_table
from pyspark.sql import functions as F


def kline(day=0, **over):
    opened = int(at(day).timestamp() * 1000)
    row = [opened, "1.5", "2.5", "0.5", "2.0", "10", opened + 86_399_999, "0", 7, "0", "0", "0"]
    for i, value in over.items():
        row[int(i[1:])] = value
    return row


def pages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "page string")


def test_klines_are_typed(spark):
    df = N.normalize_klines(pages(spark, json.dumps([kline(), kline(1)]), "[]"), "page", F.lit("AAA"))
    assert df.count() == 2
    row = df.withColumn("t", F.col("close_time").cast("timestamp_ntz")).orderBy("open_time").first()
    assert (row.open, row.high, row.low, row.close, row.volume, row.num_trades) == (1.5, 2.5, 0.5, 2.0, 10.0, 7)
    assert row.t == datetime(2024, 1, 1, 23, 59, 59, 999000)
    assert N.faulty_klines(pages(spark, "[]"), "page").count() == 0


def test_faulty_klines_are_kept_apart(spark):
    df = pages(spark, "not json", json.dumps([kline(), kline(1, _1="abc"), kline(2)[:5]]), json.dumps([None]))
    faults = sorted(r.fault for r in N.faulty_klines(df, "page").collect())
    assert faults == ["unreadable page", "unreadable row", "unreadable value", "wrong field count"]
    assert N.normalize_klines(df, "page", F.lit("AAA")).count() == 1


def test_mark_is_per_symbol_and_ignores_open_candles(spark):
    df = bronze(spark, [bronze_row(0), bronze_row(1, closed=False), bronze_row(0, symbol="BBB", closed=None)])
    marks = {r.symbol_raw: r.mark for r in N.high_water_mark(df).select(
        "symbol_raw", F.col("mark").cast("timestamp_ntz").alias("mark")).collect()}
    assert marks == {"AAA": datetime(2024, 1, 1, 23, 59, 59, 999000), "BBB": datetime(2017, 8, 17)}


def source(spark, days, symbol="AAA"):
    return bronze(spark, [bronze_row(d, symbol=symbol) for d in days]).drop("is_closed", "ingest_ts_utc")


def test_slices_are_half_open(spark):
    src = source(spark, range(5))
    mark = N.high_water_mark(bronze(spark, [bronze_row(0), bronze_row(1)]))
    now = at(4, 13)
    confirmed = N.confirmed_slice(src, mark, safe_cutoff(F.lit(now), "1d"))
    assert [t.day for t in column(confirmed, F.to_date("open_time"), "open_time")] == [3, 4]
    assert N.open_slice(src, now).count() == 1
    assert N.open_slice(src, at(6)).count() == 0
    nothing = N.confirmed_slice(src, N.high_water_mark(bronze(spark, [bronze_row(3)])),
                                safe_cutoff(F.lit(now), "1d"))
    assert nothing.count() == 0


def test_a_symbol_without_history_starts_at_the_bootstrap(spark):
    src = source(spark, range(2)).unionByName(source(spark, range(2), "BBB"))
    mark = N.high_water_mark(bronze(spark, [bronze_row(0)]))
    got = N.confirmed_slice(src, mark, F.lit(at(9)))
    assert sorted(r.symbol_raw for r in got.collect()) == ["AAA", "BBB", "BBB"]


def test_incremental_load_is_idempotent(spark):
    src, now = source(spark, range(5)), at(4, 13)
    empty = spark.createDataFrame([], schemas.BRONZE)
    once = N.incremental_load(src, empty, now)
    assert {r._change for r in once.collect()} == {"inserted"} and once.count() == 5
    again = N.incremental_load(src, once.drop("_change"), now)
    assert sorted(map(tuple, again.drop("_change").collect())) == sorted(map(tuple, once.drop("_change").collect()))
    closed = N.incremental_load(src, once.drop("_change"), at(5, 1)).where("_change = 'updated'").first()
    assert closed.is_closed is True


def test_landing_tracks(spark, tmp_path):
    path = str(tmp_path / "landing")
    assert L.read_landing(spark, path).count() == 0
    L.write_landing_confirmed(bronze(spark, [bronze_row(0, ingest=at(1))]), path)
    L.write_landing_confirmed(bronze(spark, [bronze_row(1, ingest=at(2))]), path)
    for close in (10.5, 11.5):
        L.write_landing_open(bronze(spark, [bronze_row(2, closed=False, ingest=at(2), close=close)]), path)
    L.write_landing_open(bronze(spark, [bronze_row(3, closed=False, ingest=at(3))]), path)
    rows = L.read_landing(spark, path)
    assert column(rows, "close", "open_time") == [11.0, 11.0, 11.5, 11.0]
    assert L.read_landing(spark, path, since=at(3).date()).count() == 1
    scan = L.read_landing(spark, path, since=at(3).date())._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in scan


def test_only_a_missing_folder_counts_as_empty(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="not a Parquet file"):
        L.read_or_empty(spark, str(tmp_path / "bad"), schemas.BRONZE).count()


def test_declared_table_keeps_comments(spark, tmp_path):
    create_schema(spark, "declared", "test tables")
    for _ in range(2):
        table = declare_table(spark, "declared.silver", schemas.SILVER, "cleaned candles", str(tmp_path / "t"))
    comments = {c.name: c.description for c in spark.catalog.listColumns("declared.silver")}
    assert comments["day"] == "candle day, UTC" and table.count() == 0
    spark.sql("DROP SCHEMA declared CASCADE")


def test_layout_sorts_files(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("id"))
    cluster_layout(rows, "id").write.parquet(str(tmp_path / "t"))
    ranges = spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).agg(
        F.min("id").alias("a"), F.max("id").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a for x, y in zip(ranges, ranges[1:]))


def test_history_points_to_the_latest_rebuild(spark, tmp_path):
    path = str(tmp_path / "h")
    assert current_location(spark, path, "daily") is None
    for n in range(3):
        record_load(spark, path, "daily", "CREATE TABLE AS SELECT", {"location": f"v{n}"}, at(n))
    assert current_location(spark, path, "daily") == "v2"
    assert load_history(spark, path).count() == 3
    assert timedelta(0) < at(1) - datetime(2024, 1, 1, tzinfo=UTC)
