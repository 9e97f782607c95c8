from datetime import timedelta

from build import START, at
from wickline import schemas
from wickline.operators import monitor as M


def history(spark, *rows):
    return spark.createDataFrame(
        [(t, at(d, h), op, {k: str(v) for k, v in m.items()}) for t, d, h, op, m in rows],
        schemas.LOAD_HISTORY)


REBUILD, FIRST = M.REBUILD_OPERATIONS


def sample(spark):
    return history(
        spark,
        ("silver", 0, 1, "MERGE", {"numTargetRowsInserted": 3, "numTargetRowsUpdated": 1, "executionTimeMs": 1500}),
        ("silver", 0, 2, "MERGE", {"numTargetRowsInserted": 1, "executionTimeMs": 500}),
        ("silver", 0, 3, "OPTIMIZE", {}),
        ("daily", 0, 2, REBUILD, {"numOutputRows": 10, "executionTimeMs": 2000}),
        ("kpi", 1, 2, FIRST, {"numOutputRows": 1, "executionTimeMs": 100}),
        ("kpi", 1, 3, "WRITE", {"numOutputRows": 99}),
    )


def test_typed_histories(spark):
    silver = M.history_silver(sample(spark)).orderBy("executed_at").collect()
    assert [(r.rows_inserted, r.rows_updated, r.rows_deleted, r.duration_s) for r in silver] == [
        (3, 1, None, 1.5), (1, None, None, 0.5)]
    assert sorted(r.table for r in M.history_gold(sample(spark)).collect()) == ["daily", "kpi"]


def test_volumes(spark):
    volumes = M.volume_daily(sample(spark))
    got = [tuple(r) for r in M.latest_volumes(volumes).collect()]
    assert got == [
        (START + timedelta(days=1), "gold", 1, 1, None, 0.1),
        (START, "gold", 1, 10, None, 2.0),
        (START, "silver", 2, 4, 1, 1.0)]
    parts = M.union_layers(M.history_silver(sample(spark)), M.history_gold(sample(spark)))
    assert sorted(map(str, parts.collect())) == sorted(map(str, volumes.collect()))
    month = M.latest_volumes(M.volume_monthly(volumes), "month_start").collect()
    assert [tuple(r) for r in month] == [(START, "gold", 2, 11, None, 1.1, 1.1), (START, "silver", 2, 4, 1, 1.0, 1.0)]


def test_missing_loads_cover_31_days(spark):
    today = START + timedelta(days=1)
    days = sorted(r.day for r in M.missing_loads(sample(spark), today).collect())
    assert len(days) == 29 and START not in days and today not in days
    assert days[0] == today - timedelta(days=30)
