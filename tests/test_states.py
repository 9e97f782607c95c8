"""Month states, period summaries, exact selection: against rebuilds and plain Python."""

import random
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from build import START, UTC, at, bronze, bronze_row, silver
from test_plans import plan
from wickline import schemas
from wickline.operators import indicators as I
from wickline.operators import ingest, quality, states
from wickline.operators import summaries as S
from wickline.operators.quantile import selected_median
from wickline.plans import refresh as R
from wickline.plans.lake import Lake
from wickline.sources import history, tables

NOW = datetime(2026, 1, 1, tzinfo=UTC)


def walk(spark, seed, days, symbol="AAA"):
    pick = random.Random(seed)
    closes = [round(10 + pick.random() * 5, 2) for _ in days]
    highs = [c + round(pick.random(), 2) for c in closes]
    return silver(spark, closes, symbol=symbol, days=days, highs=highs, volume=[float(i % 7) for i in range(len(days))])


def lakes(spark):
    """Series with gaps of several kinds: long, short, ending on a first or last day of a month."""
    pick = random.Random(7)
    parts = [walk(spark, 1, sorted(pick.sample(range(900), 300)), "GAP"), walk(spark, 2, range(0, 500), "ALL"),
             walk(spark, 3, [0, 1, 400, 401, 799], "FEW"), walk(spark, 4, [5], "ONE"),
             walk(spark, 5, range(366, 366 + 366), "YEAR")]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def test_kpi_of_states_equals_the_rebuild(spark, tmp_path):
    rows = lakes(spark)
    rows.write.parquet(str(tmp_path / "s"))
    rows = spark.read.parquet(str(tmp_path / "s"))
    I.daily_indicators(rows).write.parquet(str(tmp_path / "d"))
    daily = spark.read.parquet(str(tmp_path / "d"))
    months = states.month_states(daily)
    refs = states.references(months)
    asked = states.asked_months(refs)
    recent = daily.where(F.trunc("day", "month").isin(asked))
    assert recent.count() < daily.count()
    got = states.kpi_of_states(months, recent, rows, refs)
    want = S.kpi_snapshot(daily, rows)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_states_merge_like_one_aggregate(spark):
    daily = I.daily_indicators(lakes(spark))
    whole = daily.groupBy("symbol").agg(
        F.count("log_return").alias("n"), F.avg("log_return").alias("mean"), F.stddev_samp("log_return").alias("sd"),
        F.max("high").alias("high"), F.min_by("open", "day").alias("open")).collect()
    merged = {r.symbol: r for r in states.merged_states(states.month_states(daily), ["symbol"]).collect()}
    for r in whole:
        m = merged[r.symbol]
        assert (m.returns, m.high_m, m.open_m) == (r.n, r.high, r.open)
        for a, b in ((m.return_mean, r.mean), (m.return_sd, r.sd)):
            assert a == b or a == pytest.approx(b, rel=1e-9)


@pytest.mark.parametrize("cells,keep", [(4, 1), (16, 5), (1024, 3)])
def test_selection_finds_the_medians(spark, cells, keep):
    pick = random.Random(cells)
    groups = {
        "even": [pick.random() for _ in range(200)], "odd": [pick.gauss(0, 1e6) for _ in range(201)],
        "same": [4.5] * 90, "two": [1.0] * 50 + [2.0] * 50, "far": [-1e308] * 40 + [1e308] * 41,
        "wide": [2.0**i for i in range(-400, 400, 5)], "zeros": [0.0, -0.0] * 30, "one": [3.0],
        None: [1.0, 2.0, 2.0, 7.0]}
    rows = [(g, v, i) for g, vs in groups.items() for i, v in enumerate(vs)] + [("one", None, 1)]
    df = spark.createDataFrame(rows, "g string, v double, i int")
    got = {r.g: r.m for r in selected_median(df, ["g"], "v", "m", ["i"], keep, cells, 6).collect()}
    for g, vs in groups.items():
        ordered = sorted(vs)
        low, high = ordered[(len(vs) - 1) // 2], ordered[len(vs) // 2]
        assert got[g] == low * 0.5 + high * 0.5, g
    assert statistics.median(groups["odd"]) == got["odd"]


def test_selection_moves_no_values(spark, tmp_path):
    """The plan has no range exchange; values are joined with the bounds, then only the last few collected."""
    spark.range(5000).selectExpr("id % 2 AS g", "CAST(id * 7919 % 5003 AS DOUBLE) AS v").write.parquet(str(tmp_path / "v"))
    shown = plan(selected_median(spark.read.parquet(str(tmp_path / "v")), ["g"], "v", "m", keep=10))
    assert "rangepartitioning" not in shown


def test_missing_days_by_masks(spark):
    pick = random.Random(11)
    rows = []
    for symbol in ("A", "B", None):
        days = sorted(pick.sample(range(1500), pick.randrange(2, 120)))
        rows += [(symbol, START + timedelta(days=d)) for d in days for _ in range(pick.randrange(1, 3))]
    rows += [("C", date(2024, 2, 29)), ("D", None)]
    found = sorted(map(tuple, quality.missing_days(spark.createDataFrame(rows, "symbol string, day date")).collect()), key=str)
    want = []
    for symbol in ("A", "B", "C", None):
        held = {d for s, d in rows if s == symbol and d}
        day = min(held)
        while day < max(held):
            want += [] if day in held else [(symbol, day)]
            day += timedelta(days=1)
    assert found == sorted(want, key=str)


def test_missing_days_need_no_join(spark):
    shown = plan(quality.missing_days(silver(spark, [1, 2], days=[0, 9])))
    assert "Join" not in shown and shown.count("Exchange hashpartitioning") <= 2


def test_only_touched_periods_are_read(spark, tmp_path):
    lake = Lake(str(tmp_path))
    first = bronze(spark, [bronze_row(d, close=10.0 + d % 5) for d in range(0, 200, 3)])
    R.refresh_bronze(spark, lake, first, "0", NOW)
    R.refresh_silver(spark, lake, "0", NOW)
    R.refresh_gold(spark, lake, "0", NOW)
    late = bronze(spark, [bronze_row(190), bronze_row(199, close=11.5)])
    R.refresh_bronze(spark, lake, late, "1", NOW)
    R.refresh_silver(spark, lake, "1", NOW, R.landed_days(spark, lake, late))
    built = R.refresh_gold(spark, lake, "1", NOW, R.touched_days(late))
    daily = built["daily"]
    want = S.monthly_summary(daily)
    assert sorted(map(tuple, built["monthly"].select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    stored = R._partitions(spark, R._daily_path(lake), R._plain(daily.schema))
    since = START + timedelta(days=190)
    assert "PartitionFilters: [isnotnull(part" in plan(states.month_states(R.stale_daily(stored, since, "month")))
    asked = states.asked_months(states.references(states.month_states(daily)))
    assert len(asked) <= 5 and "PartitionFilters: [part" in plan(R.recent_daily(stored, asked, "month"))
    assert not tables.exists(spark, f"{lake.gold('daily')}/behind")
    # The checks of every load, from the summaries of the periods.
    checks = R.read_checks(spark, lake, "bronze").orderBy("run_id").collect()
    assert [c.total for c in checks] == [first.count(), first.count() + 2]
    assert [c.total for c in R.check_bronze(spark, lake).collect()] == [
        quality.load_check(tables.read_table(spark, lake.bronze, schemas.BRONZE)).first().total]
    silver_now = tables.read_table(spark, lake.silver, schemas.SILVER)
    completeness, missing = R.check_silver(spark, lake)
    assert completeness.collect() == quality.series_completeness(silver_now).collect()
    assert sorted(missing.collect()) == sorted(quality.missing_days(silver_now).collect())
    assert {c.days_missing for c in R.read_checks(spark, lake, "silver").where("run_id = '1'").collect()} == {missing.count()}


def test_states_left_behind_are_made_good(spark, tmp_path, monkeypatch):
    """A run that dies between the daily table and the states; the next one changes later days only."""
    lake = Lake(str(tmp_path))
    every = [bronze_row(d) for d in range(100)]

    def load(run, rows):
        landed = bronze(spark, rows)
        R.refresh_bronze(spark, lake, landed, run, NOW)
        R.refresh_silver(spark, lake, run, NOW, R.landed_days(spark, lake, landed))
        return R.refresh_gold(spark, lake, run, NOW, R.touched_days(landed))

    load("0", every)
    with monkeypatch.context() as patched:
        patched.setattr(R, "_refresh_months", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load("1", [bronze_row(3, close=11.5, ingest=at(150))])
    built = load("2", [bronze_row(99, close=11.75, ingest=at(150))])
    want = S.monthly_summary(built["daily"])
    assert sorted(map(tuple, built["monthly"].select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_marks_of_periods_and_the_pushed_literal(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    rows = bronze(spark, [bronze_row(d, symbol=s, closed=d < 70) for s in ("A", "B") for d in range(60 if s == "A" else 75)])
    R.refresh_bronze(spark, lake, rows, "0", NOW)
    table = tables.read_table(spark, lake.bronze, schemas.BRONZE)
    marks = ingest.marks_of_periods(tables.read_periods(spark, lake.bronze, schemas.BRONZE, R.bronze_periods))
    assert sorted(marks.collect()) == sorted(ingest.high_water_mark(table).collect())
    rows.write.parquet(str(tmp_path / "src"))
    src = spark.read.parquet(str(tmp_path / "src")).drop("is_closed", "ingest_ts_utc")
    known = ingest.both_tracks(src, None, NOW, "1d", marks, new_series=False)
    assert "GreaterThanOrEqual(open_time" in plan(known)
    assert sorted(known.collect(), key=str) == sorted(ingest.both_tracks(src, table, NOW, "1d").collect(), key=str)


def test_compaction_keeps_the_rows(spark, tmp_path):
    path = str(tmp_path)
    for n in range(7):
        history.record_load(spark, path, "daily" if n % 2 else "kpi", "MERGE", {"numOutputRows": n}, at(n * 12))
    before = sorted(history.load_history(spark, path).collect(), key=str)
    assert history.compact_history(spark, path, date(2024, 3, 1)) == 1
    assert sorted(history.load_history(spark, path).collect(), key=str) == before
    files = history._read(spark, path).select("for_table", "month", F.input_file_name().alias("f")).where("month < '2024-03'")
    assert files.groupBy("for_table", "month").agg(F.countDistinct("f").alias("n")).where("n > 1").isEmpty()
    assert history.compact_history(spark, path, date(2024, 3, 1)) == 0


def test_views_outlive_the_session_that_made_them(spark, tmp_path):
    lake = Lake(str(tmp_path))
    schema = "views_of_a_test"
    for run, days in (("0", range(40)), ("1", range(40, 45))):
        R.refresh_bronze(spark, lake, bronze(spark, [bronze_row(d) for d in days]), run, NOW)
        R.refresh_silver(spark, lake, run, NOW)
        R.refresh_gold(spark, lake, run, NOW, views=schema)
    other = spark.newSession()
    assert other.sql(f"SELECT last_close_day FROM {schema}.gold_kpi").first()[0] == START + timedelta(days=44)
    assert other.table(f"{schema}.silver").count() == 45 and other.table(f"{schema}.gold_monthly").count() == 2
    spark.sql(f"DROP SCHEMA {schema} CASCADE")
