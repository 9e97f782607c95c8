"""What the plans must show: filters in the scans, declared types, spread of hot series."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from build import at, bronze, bronze_row, silver
from wickline import schemas
from wickline.operators import monitor
from wickline.operators.ingest import open_slice
from wickline.operators.quality import clean_candles, silver_rows
from wickline.operators.series import on_series
from wickline.sources import history, tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_load_time_and_table_reach_the_scan(spark, tmp_path):
    path = str(tmp_path)
    for table in ("daily", "kpi"):
        history.record_load(spark, path, table, "MERGE", {history.LOCATION: table}, at(3))
    stored = history.load_history(spark, path)
    shown = plan(monitor.missing_loads(stored, date(2024, 1, 20)))
    assert "LessThan(executed" in shown
    assert history.current_location(spark, path, "kpi") == "kpi"
    part = plan(history._read(spark, path).where("for_table = 'kpi'"))
    assert "PartitionFilters: [isnotnull(for_table" in part


def test_closing_time_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "b")
    bronze(spark, [bronze_row(d) for d in range(4)]).write.parquet(path)
    assert "GreaterThan(close_time" in plan(open_slice(spark.read.parquet(path), at(3, 5)))


def test_only_touched_partitions_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.merge_into(spark, path, silver(spark, [1, 2, 3], days=[0, 40, 80]), schemas.SILVER,
                      keys=["symbol", "day"], time_col="day")
    days = spark.createDataFrame([("AAA", date(2024, 2, 10), date(2024, 2, 1))], "symbol string, day date, part date")
    rows = tables.rows_of_days(spark, path, schemas.SILVER, days, {"symbol": F.col("symbol"), "day": F.col("day")}, "day")
    assert "PartitionFilters: [isnotnull(part" in plan(rows) or "PartitionFilters: [(part" in plan(rows)
    assert [float(r.close) for r in rows.collect()] == [2.0]


def test_declared_types(spark):
    """The registered queries show amounts as doubles; the tables hold decimals."""
    rows = silver_rows(clean_candles(bronze(spark, [bronze_row(0)])), at(3))
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in schemas.SILVER]


@pytest.mark.parametrize("limit", [8, 10_000])
def test_ties_are_numbered_alike(spark, limit):
    """Equal times, in series below and above the threshold, ordered by the tie-break."""
    rows = [(s, t, i) for s in ("a", "b") for t in range(4) for i in range(5)]
    df = spark.createDataFrame(rows, "symbol string, day int, id int")
    got = on_series(df, lambda f, s: f.withColumn("n", s.position), halo=2, max_rows=limit, ties=["id"])
    assert all(r.n == r.day * 5 + r.id + 1 for r in got.collect())


def test_long_series_are_not_shuffled_by_their_symbol(spark):
    """With broadcasts off, the rows of a long series meet its entry by (symbol, salt)."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from wickline.operators.series import split_by_size

        df = spark.createDataFrame([("hot", i) for i in range(200)] + [("cold", 1)], "symbol string, day int")
        short, long = split_by_size(df, ["symbol"], 20)
        assert "_salt" in plan(long) and "hashpartitioning(coalesce(symbol" in plan(long)
        exchange = [x for x in plan(long).splitlines() if "Exchange hashpartitioning" in x]
        assert exchange and all("_salt" in x for x in exchange)
        assert short.count() == 1 and long.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
