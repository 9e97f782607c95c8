import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from build import at, bronze, bronze_row, column, silver
from wickline import schemas
from wickline.operators import merge as M
from wickline.operators.ingest import BRONZE_KEYS, BRONZE_ORDER
from wickline.session import fits
from wickline.sources import tables as T
from wickline.sources.tables import merge_into, read_table

SHAPES = (True, False)


def stamped(df, hours):
    return df.withColumn("ingest_ts", F.lit(at(0, hours)))


def merged(target, source, rule, small):
    return M.merge_upsert_when(target, source, ["symbol", "day"], rule, small).orderBy("day").collect()


def test_update_rule(spark):
    for small in SHAPES:
        old_open = stamped(silver(spark, [1], closed=False), 5)
        old_closed = stamped(silver(spark, [1]), 5)
        late_close = stamped(silver(spark, [2]), 1)
        newer_open = stamped(silver(spark, [2], closed=False), 9)
        older_open = stamped(silver(spark, [2], closed=False), 1)
        unknown = silver(spark, [2], closed=False).withColumn("ingest_ts", F.lit(None).cast("timestamp"))
        rule, protected = M.newer_or_closing(), M.newer_or_closing_protected()
        cases = [
            (old_open, late_close, rule, "updated"),
            (old_closed, newer_open, rule, "updated"),
            (old_closed, newer_open, protected, "unchanged"),
            (old_open, newer_open, protected, "updated"),
            (old_open, older_open, rule, "unchanged"),
            (old_open, unknown, rule, "unchanged"),
        ]
        for target, source, when, expected in cases:
            (row,) = merged(target, source, when, small)
            assert (row._change, float(row.close)) == (expected, 2.0 if expected == "updated" else 1.0)


def test_both_shapes_agree_and_count(spark):
    target = silver(spark, [1, 2, 3], days=[0, 1, 2])
    source = stamped(silver(spark, [9, 9], days=[2, 3]), 1000)
    results = [merged(target, source, M.newer_or_closing(), small) for small in SHAPES]
    assert results[0] == results[1]
    counts = M.merge_counts(M.merge_upsert(target, source, ["symbol", "day"])).first().asDict()
    assert counts == {M.INSERTED: 1, M.UPDATED: 1, M.DELETED: 0, M.OUTPUT_ROWS: 4}


def test_merging_again_changes_nothing(spark):
    target = silver(spark, [1, 2], days=[0, 1])
    source = stamped(silver(spark, [5, 6], days=[1, 2]), 1000)
    once = M.merge_upsert_when(target, source, ["symbol", "day"], M.newer_or_closing()).drop("_change")
    again = M.merge_upsert_when(once, source, ["symbol", "day"], M.newer_or_closing())
    assert {r._change for r in again.collect()} == {"unchanged"}


def test_null_keys_never_enter_a_merge(spark):
    rows = bronze(spark, [bronze_row(), bronze_row(symbol=None), bronze_row(open_time=None)])
    keyed, keyless = M.split_null_keys(rows, BRONZE_KEYS)
    assert (keyed.count(), keyless.count()) == (1, 2)


def test_a_nearly_constant_key_is_deduplicated(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"), "id")
    best = M.dedup_latest(rows, "k", ["id"])
    assert best.where("k IS NULL").first().id == 19998
    assert best.count() == 13334


def test_append_new_only_matches_nulls(spark):
    target = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    source = spark.createDataFrame([(None, 3), ("b", 4)], "k string, v int")
    assert sorted(r.v for r in M.append_new_only(target, source, "k").collect()) == [1, 2, 4]


def test_sequence_continues_and_starts_at_one(spark):
    empty = spark.createDataFrame([], "seq bigint, description string")
    rows = spark.createDataFrame([("c",), ("a",), ("b",)], "description string")
    first = M.append_with_next_sequence(empty, rows, "seq", "description")
    assert column(first, "description", "seq") == ["a", "b", "c"]
    assert column(first, "seq", "seq") == [1, 2, 3]
    gaps = spark.createDataFrame([(1, "x"), (2, "y"), (7, "z")], "seq bigint, description string")
    assert column(M.append_with_next_sequence(gaps, rows, "seq", "description"), "seq", "seq") == [
        1, 2, 7, 8, 9, 10]


def test_sequence_over_one_repeated_value(spark):
    rows = spark.range(3000).select(F.lit("same").alias("description"), "id")
    empty = spark.createDataFrame([], "seq bigint, description string")
    numbered = M.append_with_next_sequence(empty, rows, "seq", "description")
    assert column(numbered, "seq", "seq") == list(range(1, 3001))


versions = st.lists(
    st.tuples(st.integers(0, 3), st.booleans(), st.integers(0, 5)), min_size=1, max_size=8)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=versions, cut=st.integers(0, 8))
def test_stored_merges_do_not_depend_on_arrival(spark, tmp_path_factory, rows, cut):
    """Two merges of any split of the versions store what one deduplication would choose."""
    made = [bronze_row(day=40 * d, closed=c, ingest=at(200, i), close=10.0 + i / 8) for d, c, i in rows]
    path = str(tmp_path_factory.mktemp("t") / "table")
    rule = M.later_version(BRONZE_ORDER, schemas.BRONZE.fieldNames())
    for part in (made[cut:], made[:cut], made[cut:]):
        source = M.dedup_latest(bronze(spark, part), BRONZE_KEYS, BRONZE_ORDER)
        for _ in range(2):
            merge_into(spark, path, source, schemas.BRONZE, keys=BRONZE_KEYS, time_col="open_time",
                       update_when=rule)
    stored = read_table(spark, path, schemas.BRONZE)
    wanted = M.dedup_latest(bronze(spark, made), BRONZE_KEYS, BRONZE_ORDER)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, wanted.collect()))


def test_only_touched_periods_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "table")
    options = dict(keys=["symbol", "day"], time_col="day", update_when=M.newer_or_closing())
    merge_into(spark, path, silver(spark, [1, 2], days=[0, 40]), schemas.SILVER, **options)
    before = {f.name for f in (tmp_path / "table" / "part=2024-01-01").iterdir()}
    counts = merge_into(
        spark, path, stamped(silver(spark, [3], days=[41]), 2000), schemas.SILVER, **options)
    assert counts[M.INSERTED] == 1 and counts[M.OUTPUT_ROWS] == 2
    assert {f.name for f in (tmp_path / "table" / "part=2024-01-01").iterdir()} == before
    assert read_table(spark, path, schemas.SILVER).count() == 3


def _merge(spark, path, rows):
    return merge_into(spark, path, bronze(spark, rows), schemas.BRONZE, keys=BRONZE_KEYS, time_col="open_time",
                      update_when=M.later_version(BRONZE_ORDER, schemas.BRONZE.fieldNames()))


def _days(spark, path):
    return sorted(r.open_time.date().day for r in read_table(spark, path, schemas.BRONZE).collect())


@pytest.mark.parametrize("left", ["_temporary/0/x", "part-00000.parquet"])
def test_incomplete_pending_content_is_dropped(spark, tmp_path, left):
    """A job that died while writing, or while committing its files, has not touched the table."""
    path = str(tmp_path / "table")
    _merge(spark, path, [bronze_row(0)])
    pending = tmp_path / "table-pending"
    (pending / left).parent.mkdir(parents=True)
    (pending / left).write_text("half a file")
    counts = _merge(spark, path, [bronze_row(1)])
    assert counts[M.INSERTED] == 1 and _days(spark, path) == [1, 2] and not pending.exists()


def test_complete_pending_content_is_stored_first(spark, tmp_path, monkeypatch):
    """A job that died while replacing partitions is finished by the next merge."""
    path = str(tmp_path / "table")
    _merge(spark, path, [bronze_row(0), bronze_row(1)])

    def dies(*_args):
        for file in (tmp_path / "table").rglob("*.parquet"):
            file.unlink()
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(T, "_store", dies)
        with pytest.raises(RuntimeError):
            _merge(spark, path, [bronze_row(2)])
    _merge(spark, path, [bronze_row(3)])
    assert _days(spark, path) == [1, 2, 3, 4]


def test_repeating_an_older_load_keeps_later_ones(spark, tmp_path):
    path = str(tmp_path / "table")
    first, second = [bronze_row(0, close=10.0)], [bronze_row(0, close=10.5, ingest=at(9)), bronze_row(1)]
    for rows in (first, second, first):
        _merge(spark, path, rows)
    stored = read_table(spark, path, schemas.BRONZE).orderBy("open_time").collect()
    assert [r.close for r in stored] == [10.5, 11.0]


def test_repeated_target_keys_insert_nothing_new(spark):
    target = bronze(spark, [bronze_row(0)] * 5)
    merged = M.merge_upsert(target, bronze(spark, [bronze_row(0), bronze_row(1)]), BRONZE_KEYS, True)
    assert merged.where("_change = 'inserted'").count() == 1


def _rule():
    return M.later_version(BRONZE_ORDER, schemas.BRONZE.fieldNames())


def _bucketed(spark, path, name, rows):
    return merge_into(spark, path, bronze(spark, rows), schemas.BRONZE, keys=BRONZE_KEYS, time_col="open_time",
                      update_when=_rule(), table=name)


@pytest.fixture
def buckets(spark, tmp_path):
    """(path, name) of a bucketed table of four buckets."""
    path = str(tmp_path / "table")
    name = "b_" + uuid.uuid4().hex
    yield path, T.declare_buckets(spark, name, path, schemas.BRONZE, BRONZE_KEYS, 4)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("shuffle_partitions", [3, 64])
def test_a_merge_into_buckets_leaves_the_target_where_it_is(spark, buckets, shuffle_partitions):
    """One exchange, which is the source's."""
    path, name = buckets
    _bucketed(spark, path, name, [bronze_row(d) for d in range(60)])
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    try:
        source = T._parted(bronze(spark, [bronze_row(d, close=11.5, ingest=at(200)) for d in range(50, 70)]),
                           "open_time", "month")
        target = spark.table(name)
        merged = T.merge_in_buckets(target, source, BRONZE_KEYS, _rule())
        shown = merged._jdf.queryExecution().executedPlan().toString()
        exchanges = [x for x in shown.splitlines() if "Exchange" in x]
        assert len(exchanges) == 1 and "hashpartitioning" in exchanges[0] and ", 4)" in exchanges[0], shown
        assert "Bucketed: true" in shown and "SelectedBucketsCount: 4 out of 4" in shown, shown
        # The branch of the stored rows ends in the scan without an exchange above it.
        scan = next(i for i, x in enumerate(shown.splitlines()) if "FileScan" in x)
        exchange = next(i for i, x in enumerate(shown.splitlines()) if "Exchange" in x)
        assert scan < exchange, shown
        assert {r._change: r["count"] for r in merged.groupBy("_change").count().collect()} == {
            "unchanged": 50, "updated": 10, "inserted": 10}
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=versions, cut=st.integers(0, 8))
def test_buckets_do_not_depend_on_arrival(spark, tmp_path_factory, rows, cut):
    made = [bronze_row(day=40 * d, closed=c, ingest=at(200, i), close=10.0 + i / 8) for d, c, i in rows]
    path, name = str(tmp_path_factory.mktemp("t") / "table"), "b_" + uuid.uuid4().hex
    T.declare_buckets(spark, name, path, schemas.BRONZE, BRONZE_KEYS, 3)
    for part in (made[cut:], made[:cut], made[cut:]):
        source = M.dedup_latest(bronze(spark, part), BRONZE_KEYS, BRONZE_ORDER)
        merge_into(spark, path, source, schemas.BRONZE, keys=BRONZE_KEYS, time_col="open_time",
                   update_when=_rule(), table=name)
    wanted = M.dedup_latest(bronze(spark, made), BRONZE_KEYS, BRONZE_ORDER)
    named = spark.table(name).drop("part")
    for stored in (read_table(spark, path, schemas.BRONZE), named):
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, wanted.collect()))
    spark.sql(f"DROP TABLE {name}")


def test_only_touched_periods_of_buckets_are_rewritten(spark, buckets, tmp_path):
    path, name = buckets
    _bucketed(spark, path, name, [bronze_row(0), bronze_row(40)])
    january = tmp_path / "table" / "part=2024-01-01"
    before = {f.name for f in january.iterdir()}
    counts = _bucketed(spark, path, name, [bronze_row(41)])
    assert counts[M.INSERTED] == 1 and counts[M.OUTPUT_ROWS] == 2
    assert {f.name for f in january.iterdir()} == before
    assert read_table(spark, path, schemas.BRONZE).count() == 3
    # A bucket of a period stays one file, however often it is merged.
    _bucketed(spark, path, name, [bronze_row(d) for d in range(60)])
    for month in (tmp_path / "table").glob("part=*"):
        assert 1 <= len(list(month.glob("*.parquet"))) <= 4


def test_a_died_merge_into_buckets_is_finished_by_the_next(spark, buckets, tmp_path, monkeypatch):
    path, name = buckets
    _bucketed(spark, path, name, [bronze_row(0), bronze_row(1)])

    def dies(*_args):
        for file in (tmp_path / "table").rglob("*.parquet"):
            file.unlink()
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(T, "_store", dies)
        with pytest.raises(RuntimeError):
            _bucketed(spark, path, name, [bronze_row(2)])
    _bucketed(spark, path, name, [bronze_row(3)])
    assert _days(spark, path) == [1, 2, 3, 4]


def test_buckets_are_found_again_by_a_new_catalog_entry(spark, buckets):
    path, name = buckets
    _bucketed(spark, path, name, [bronze_row(0), bronze_row(40)])
    spark.sql(f"DROP TABLE {name}")
    T.declare_buckets(spark, name, path, schemas.BRONZE, BRONZE_KEYS, 4)
    assert spark.table(name).count() == 2
    counts = _bucketed(spark, path, name, [bronze_row(40, close=11.5, ingest=at(300)), bronze_row(41)])
    assert (counts[M.INSERTED], counts[M.UPDATED]) == (1, 1)
    assert sorted(r.close for r in read_table(spark, path, schemas.BRONZE).collect()) == [11.0, 11.0, 11.5]


def test_a_source_is_small_by_rows_and_by_bytes(spark):
    """Few but wide rows are not broadcast; a column of any type counts."""
    few = spark.range(100).withColumn("payload", F.repeat(F.lit("x"), 10_000))
    assert fits(few, 100, 2 << 20) and not fits(few, 99, 2 << 20) and not fits(few, 100, 1_000_000)
    nested = spark.range(100).select(F.array_repeat("id", 5_000).alias("a.b"), F.lit(None).alias("none"))
    assert not fits(nested, 1000, 1 << 20) and fits(nested, 1000, 64 << 20)
    assert fits(few.limit(0), 0, 0)


def test_empty_source_into_buckets(spark, buckets):
    path, name = buckets
    _bucketed(spark, path, name, [bronze_row(0)])
    assert _bucketed(spark, path, name, [])[M.OUTPUT_ROWS] == 0
    assert _days(spark, path) == [1]
