"""The three refreshes. Each is idempotent and leaves one row per written table in the history.

Times stored in the tables are arguments; only the load history takes its times from the clock.
"""

from __future__ import annotations

import time
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline import schemas
from wickline.operators.indicators import HALO, daily_indicators, daily_tail
from wickline.operators.ingest import (
    BRONZE_KEYS, BRONZE_ORDER, both_tracks, faulty_klines, marks_of_periods, normalize_klines, period_marks,
)
from wickline.operators.merge import (
    DURATION_MS, OUTPUT_ROWS, dedup_latest, later_version, newer_or_closing,
    newer_or_closing_protected, split_null_keys,
)
from wickline.operators.keys import attach
from wickline.operators.monitor import GOLD_TABLES, MERGE_OPERATION, REBUILD_OPERATIONS, SILVER_TABLE
from wickline.operators.quality import (
    check_of_periods, clean_candles, clean_symbol, completeness_of_masks, day_masks, latest_versions,
    missing_of_masks, new_rejects, quality_reason, reject_rows, silver_rows, split_valid_rejected, typed_candles,
)
from wickline.operators.states import (
    MONTH_KEYS, asked_months, kpi_of_states, month_states, monthly_of_states, references,
)
from wickline.operators.summaries import weekday_seasonality
from wickline.plans.lake import Lake
from wickline.session import staged
from wickline.sources.history import LOCATION, current_location, record_load
from wickline.sources.landing import (
    read_or_empty, write_landing_confirmed, write_landing_open,
)
from wickline.sources.tables import (
    PART, create_schema, declare_buckets, exists, finish_merge, merge_into, read_periods, read_table, remove,
    replace_periods, replace_table, rows_of_days,
)


SILVER_KEYS = ["symbol", "day"]
# Total order of the valid versions of a day; the columns that are no part of a version's value.
SILVER_ORDER = ("is_closed", "ingest_ts", "open_time")
SILVER_STAMPS = ("symbol", "day", "transformed_at")


def _milliseconds(since: float) -> int:
    return int((time.monotonic() - since) * 1000)


def bronze_periods(rows: DataFrame) -> DataFrame:
    return period_marks(rows, PART)


def silver_periods(rows: DataFrame) -> DataFrame:
    return day_masks(rows, "symbol", PART)


def _bucketed(
    spark: SparkSession, lake: Lake, name: str, path: str, schema: T.StructType, keys: list[str]
) -> str | None:
    """The catalog's bucketed table over ``path``, if the lake has such tables."""
    if lake.catalog is None:
        return None
    create_schema(spark, lake.catalog, "stored candles")
    return declare_buckets(spark, f"{lake.catalog}.stored_{name}", path, schema, keys, lake.buckets)


def land(
    spark: SparkSession, lake: Lake, src: DataFrame, as_of: datetime, interval: str = "1d", new_series: bool = True
) -> None:
    """Write the newly confirmed candles and the running candles of ``src`` to the landing folder.

    The marks come from the summaries of bronze's periods. See ``both_tracks`` for ``new_series``.
    """
    marks = marks_of_periods(read_periods(spark, lake.bronze, schemas.BRONZE, bronze_periods))
    rows = staged(both_tracks(src, None, as_of, interval, marks, new_series), "tracks")
    write_landing_confirmed(rows.where("is_closed"), lake.landing)
    write_landing_open(rows.where("NOT is_closed"), lake.landing)


def land_pages(
    spark: SparkSession, lake: Lake, pages: DataFrame, json_col: str, symbol: str, as_of: datetime,
    interval: str = "1d",
) -> None:
    """From JSON pages to the landing folder. Unreadable pages and rows are stored with their fault."""
    pages = staged(pages, "pages")
    faults = faulty_klines(pages, json_col).withColumn("found_at", F.lit(as_of).cast("timestamp"))
    faults.write.mode("append").parquet(lake.faults)
    land(spark, lake, normalize_klines(pages, json_col, symbol), as_of, interval)


def _day() -> dict[str, Column]:
    return {"symbol": clean_symbol(), "day": F.to_date("open_time")}


def touched_days(landed: DataFrame) -> DataFrame:
    """Distinct (symbol, day) of bronze rows, as silver names them."""
    return landed.where(F.col("open_time").isNotNull()).select(
        *[value.alias(name) for name, value in _day().items()]).distinct()


def landed_days(spark: SparkSession, lake: Lake, landed: DataFrame, grain: str = "month") -> DataFrame:
    """The bronze rows of every symbol and day that ``landed`` touches.

    Bronze has the winning versions: silver fed with these gets what a refresh from all of bronze gives.
    """
    days = staged(touched_days(landed).withColumn(
        PART, F.to_date(F.date_trunc(grain, "day"))), "days")
    return rows_of_days(spark, lake.bronze, schemas.BRONZE, days, _day(), "open_time", grain)


def check_bronze(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows, first and last open time and open rows of bronze, from the summaries of its periods."""
    return check_of_periods(read_periods(spark, lake.bronze, schemas.BRONZE, bronze_periods))


def check_silver(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    """(completeness of every series, days without a candle), from the months' masks of silver."""
    masks = read_periods(spark, lake.silver, schemas.SILVER, silver_periods)
    return completeness_of_masks(masks), missing_of_masks(masks)


def _record_check(rows: DataFrame, lake: Lake, table: str, run_id: str, as_of: datetime) -> None:
    rows.withColumns({"run_id": F.lit(run_id), "checked_at": F.lit(as_of).cast("timestamp")}).coalesce(1).write.mode(
        "append").parquet(lake.checks(table))


def read_checks(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """The checks that the refreshes of ``table`` (bronze, silver) have left, one set of rows per run."""
    return spark.read.parquet(lake.checks(table))


def refresh_bronze(
    spark: SparkSession, lake: Lake, landed: DataFrame, run_id: str, as_of: datetime,
    grain: str = "month",
) -> dict[str, int]:
    """Upsert landed rows: the closed and then latest version wins, in whatever order they land.

    Rows with a NULL key can match nothing and go to the rejects.
    """
    began = time.monotonic()
    landed = staged(landed.select(*schemas.BRONZE.fieldNames()), "landed")
    keyed, keyless = split_null_keys(landed, BRONZE_KEYS)
    _append_rejects(spark, lake, quality_reason(typed_candles(keyless)), as_of)
    counts = merge_into(
        spark, lake.bronze, dedup_latest(keyed, BRONZE_KEYS, BRONZE_ORDER), schemas.BRONZE,
        keys=BRONZE_KEYS, time_col="open_time", grain=grain,
        update_when=later_version(BRONZE_ORDER, schemas.BRONZE.fieldNames()), summary=bronze_periods,
        table=_bucketed(spark, lake, "bronze", lake.bronze, schemas.BRONZE, list(BRONZE_KEYS)))
    _record_check(check_bronze(spark, lake), lake, "bronze", run_id, as_of)
    record_load(spark, lake.history, "bronze", MERGE_OPERATION,
                {**counts, DURATION_MS: _milliseconds(began)})
    return counts


def _append_rejects(spark: SparkSession, lake: Lake, cleaned: DataFrame, as_of: datetime) -> None:
    if split_valid_rejected(cleaned)[1].isEmpty():
        return
    rejected = staged(reject_rows(cleaned, as_of).withColumn(PART, _reject_period()), "rejected")
    # Calendar months of one load's rejects; rows without an open time have a partition of their own.
    parts = [row[0] for row in rejected.select(PART).distinct().collect()]
    kept = F.col(PART).isin([p for p in parts if p is not None])
    kept = (kept | F.col(PART).isNull()) if None in parts else kept
    stored = _partitions(spark, lake.rejects, schemas.REJECT).where(kept)
    # Staged: the rejects folder cannot be read and appended to in one plan.
    new = staged(new_rejects(stored.drop(PART), rejected.drop(PART)), "rejects")
    new.withColumn(PART, _reject_period()).write.mode("append").partitionBy(PART).parquet(lake.rejects)


def _reject_period() -> Column:
    return F.trunc("open_time", "month")


def refresh_silver(
    spark: SparkSession, lake: Lake, run_id: str, as_of: datetime,
    changed: DataFrame | None = None, protect_closed: bool = False, grain: str = "month", any_order: bool = False,
) -> dict[str, int]:
    """Clean bronze rows, store the rejected ones, merge the valid ones.

    ``any_order``: the loads may bring versions of a candle in any order and grouping. Every version is then
    judged for itself, and the greatest valid one by a total order (closed, ingest time, open time, values)
    stays, whatever was stored before; the table is the state of the comparison.

    ``changed`` limits the work to the bronze rows of one load; by default all of bronze is
    cleaned again, which gives the same table. The cleaned rows are staged once, so rejects and
    merge see the same input.
    """
    began = time.monotonic()
    bronze = read_table(spark, lake.bronze, schemas.BRONZE) if changed is None else changed
    # Staged as received: the JSON payload is built on the rejected rows only.
    winners = staged(bronze if any_order else latest_versions(bronze), "winners")
    cleaned = quality_reason(typed_candles(winners))
    _append_rejects(spark, lake, cleaned, as_of)
    rule = newer_or_closing_protected() if protect_closed else newer_or_closing()
    if any_order:
        rule = later_version(SILVER_ORDER, [c for c in schemas.SILVER.fieldNames() if c not in SILVER_STAMPS])
    counts = merge_into(
        spark, lake.silver, silver_rows(cleaned, as_of), schemas.SILVER,
        keys=SILVER_KEYS, time_col="day", update_when=rule, grain=grain, summary=silver_periods,
        table=_bucketed(spark, lake, "silver", lake.silver, schemas.SILVER, SILVER_KEYS))
    _check_silver(spark, lake, run_id, as_of)
    record_load(spark, lake.history, SILVER_TABLE, MERGE_OPERATION,
                {**counts, DURATION_MS: _milliseconds(began)})
    return counts


def _check_silver(spark: SparkSession, lake: Lake, run_id: str, as_of: datetime) -> None:
    """Completeness per series with the number of days that are missing."""
    completeness, _ = check_silver(spark, lake)
    missing = (F.col("days_expected") - F.col("days_loaded")).alias("days_missing")
    _record_check(completeness.select("*", missing), lake, "silver", run_id, as_of)


def _daily_path(lake: Lake) -> str:
    return f"{lake.gold('daily')}/table"


def _first_context(stored: DataFrame, since: DataFrame, grain: str) -> date | None:
    """First stored period that a recomputation from ``since`` on may need, over all its symbols.

    Counts rows per symbol and period (two columns are read) and goes back, period by period, until
    ``HALO`` rows lie before the period of the first change.
    """
    month = F.trunc("since", grain)
    counts = stored.groupBy("symbol", PART).agg(F.count("*").alias("rows"))
    before = counts.join(since, "symbol").where(F.col(PART) < month)
    later = Window.partitionBy("symbol").orderBy(F.col(PART).desc())
    needed = before.withColumn("_newer", F.sum("rows").over(later) - F.col("rows")).where(
        F.col("_newer") < HALO)
    first = needed.select(F.col(PART).alias("m")).unionByName(since.select(month.alias("m")))
    return first.agg(F.min("m")).first()[0]


def _refresh_daily(
    spark: SparkSession, lake: Lake, silver: DataFrame, as_of: datetime, changed: DataFrame | None,
    grain: str,
) -> DataFrame:
    """Store the daily table and return it: whole, or from the first changed period on."""
    path = _daily_path(lake)
    recipe = daily_indicators(silver, as_of)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in recipe.schema])
    options = dict(keys=["symbol", "day"], time_col="day", grain=grain)
    finish_merge(spark, path, schema, options["keys"])
    if changed is None or not exists(spark, path):
        replace_periods(spark, path, recipe, schema, **options)
    else:
        since = staged(changed.where("symbol IS NOT NULL AND day IS NOT NULL").groupBy("symbol").agg(
            F.min("day").alias("since")), "since")
        start = since.agg(F.min("since")).first()[0]
        if start is not None:
            stored = read_or_empty(spark, path, T.StructType([*schema.fields, T.StructField(PART, T.DateType())]))
            context = stored.where(F.col(PART) >= F.lit(_first_context(stored, since, grain)))
            tail = daily_tail(silver.where(F.col("day") >= F.lit(start)), context.drop(PART), since, as_of)
            touched = stored.where(F.col(PART) >= F.trunc(F.lit(start), grain)).drop(PART)
            kept = attach(touched, since, "symbol", F.col("day"), "left").where(
                F.col("since").isNull() | (F.col("day") < F.col("since"))).drop("since")
            rows = staged(kept.unionByName(tail.select(*kept.columns)), "tail")
            replace_periods(spark, path, rows, schema, since=start, **options)
    return read_table(spark, path, schema)


def _first_day(changed: DataFrame) -> date | None:
    return changed.where("symbol IS NOT NULL").agg(F.min("day")).first()[0]


def _partitions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_or_empty(spark, path, T.StructType([*schema.fields, T.StructField(PART, T.DateType())]))


def _plain(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def stale_daily(stored: DataFrame, since: date | None, grain: str) -> DataFrame:
    """Rows of the stored daily table of which the states are not known: the periods from ``since`` on."""
    return stored if since is None else stored.where(F.col(PART) >= F.trunc(F.lit(since), grain))


def recent_daily(stored: DataFrame, months: list[date], grain: str) -> DataFrame:
    """Rows of the stored daily table in the periods of ``months``."""
    return stored.where(F.col(PART).isin([date(m.year, 1 if grain == "year" else m.month, 1) for m in months]))


def _refresh_months(
    spark: SparkSession, lake: Lake, daily: DataFrame, since: date | None, grain: str
) -> tuple[DataFrame, DataFrame]:
    """Renew the states and the monthly rows of the periods from ``since`` on (all, if None): (states, monthly)."""
    states_path, monthly_path = (f"{lake.gold(name)}/table" for name in ("states", "monthly"))
    schema, whole = _plain(month_states(daily).schema), _partitions(spark, _daily_path(lake), _plain(daily.schema))
    states = month_states(stale_daily(whole, since, grain))
    options = dict(keys=list(MONTH_KEYS), time_col="month_start", since=since, grain=grain)
    replace_periods(spark, states_path, states, schema, **options)
    states = read_table(spark, states_path, schema)
    fresh = stale_daily(_partitions(spark, states_path, schema), since, grain)
    monthly_schema = _plain(monthly_of_states(states).schema)
    replace_periods(spark, monthly_path, monthly_of_states(fresh), monthly_schema, **options)
    return states, read_table(spark, monthly_path, monthly_schema)


def refresh_gold(
    spark: SparkSession, lake: Lake, run_id: str, as_of: datetime, changed: DataFrame | None = None,
    grain: str = "month", views: str | None = None,
) -> dict[str, DataFrame]:
    """Refresh daily, monthly, weekday and KPI tables.

    ``changed`` has the (symbol, day) pairs of silver that may have changed since the last refresh.
    The daily table is then recomputed from each symbol's first changed day on, and only its periods
    from the first of them are read and rewritten; without it, all of it is. The rows kept bear the
    time of the refresh that computed them. The states of the months and the monthly table follow for the
    same periods; the KPI table reads the states and a few months of the daily table. Weekdays span the
    whole history and are rebuilt. ``views`` names a schema of the catalog whose views of the tables are made
    to show this refresh. Until the states are stored, a mark beside the daily table
    says from which day on they are behind it.
    """
    silver = read_table(spark, lake.silver, schemas.SILVER)
    behind = f"{lake.gold('daily')}/behind"
    marks = read_or_empty(spark, behind, T.StructType([T.StructField("since", T.DateType())])).collect()
    incremental = changed is not None and exists(spark, f"{lake.gold('monthly')}/table")
    first = _first_day(changed) if incremental else None
    incremental = incremental and all(row["since"] is not None for row in marks)
    since = min([row["since"] for row in marks] + [first] * (first is not None), default=None) if incremental else None
    if since is not None or not incremental:
        spark.createDataFrame([(since,)], "since date").coalesce(1).write.mode("append").parquet(behind)

    def recorded(name: str, began: float, table: DataFrame, folder: str) -> DataFrame:
        record_load(spark, lake.history, name, REBUILD_OPERATIONS[0],
                    {OUTPUT_ROWS: table.count(), DURATION_MS: _milliseconds(began), LOCATION: folder})
        return table

    began = time.monotonic()
    daily = _refresh_daily(spark, lake, silver, as_of, changed, grain)
    built = {"daily": recorded("daily", began, daily, _daily_path(lake))}
    began = time.monotonic()
    if since is not None or not incremental:
        states, monthly = _refresh_months(spark, lake, daily, since, grain)
        remove(spark, behind)
    else:
        states = month_states(daily)
        states = read_table(spark, f"{lake.gold('states')}/table", _plain(states.schema))
        monthly = read_table(spark, f"{lake.gold('monthly')}/table", _plain(monthly_of_states(states).schema))
    built["monthly"] = recorded("monthly", began, monthly, f"{lake.gold('monthly')}/table")

    def kpi() -> DataFrame:
        refs = references(states)
        stored = _partitions(spark, _daily_path(lake), _plain(daily.schema))
        return kpi_of_states(states, recent_daily(stored, asked_months(refs), grain), silver, refs, as_of)

    for name, recipe in (("weekday", lambda: weekday_seasonality(daily)), ("kpi", kpi)):
        began = time.monotonic()
        folder = replace_table(recipe(), lake.gold(name), run_id)
        built[name] = recorded(name, began, spark.read.parquet(folder), folder)
    if views is not None:
        publish_tables(spark, lake, views)
    return built


def publish_tables(spark: SparkSession, lake: Lake, schema: str) -> None:
    """Create or replace the catalog's views of the stored tables. Unlike a session's they outlive it, as long
    as the catalog does; a refresh that is given the schema points them to what it built."""
    create_schema(spark, schema, "views of the stored candles")
    folders = {"bronze": (lake.bronze, schemas.BRONZE.fieldNames()), "silver": (lake.silver, schemas.SILVER.fieldNames()),
               "load_history": (lake.history, schemas.LOAD_HISTORY.fieldNames())}
    for name in GOLD_TABLES:
        folder = current_location(spark, lake.history, name)
        if folder is not None:
            folders[f"gold_{name}"] = (folder, spark.read.parquet(folder).drop(PART).columns)
    for name, (folder, columns) in folders.items():
        if exists(spark, folder):
            listed = ", ".join(f"`{c}`" for c in columns)
            spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS SELECT {listed} FROM parquet.`{folder}`")


def read_gold(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    folder = current_location(spark, lake.history, table)
    if folder is None:
        raise LookupError(f"no {table} table has been built in {lake.root}")
    return spark.read.parquet(folder).drop(PART)


def silver_of(bronze: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Silver rows of a first load, without storing anything."""
    return silver_rows(clean_candles(bronze), as_of)
