"""Volumes, durations and gaps of past loads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.functions.clock import month_start
from wickline.operators.merge import DELETED, DURATION_MS, INSERTED, OUTPUT_ROWS, UPDATED

# Kinds of write that count as a load of each layer.
MERGE_OPERATION = "MERGE"
REBUILD_OPERATIONS = ("CREATE OR REPLACE TABLE AS SELECT", "CREATE TABLE AS SELECT")
SILVER_TABLE = "silver"
GOLD_TABLES = ("daily", "monthly", "weekday", "kpi")
ALERT_DAYS = 30


def _metric(name: str) -> Column:
    return F.col("metrics")[name].cast("bigint")


def _duration() -> Column:
    return (_metric(DURATION_MS).cast("double") / 1000.0).alias("duration_s")


def history_silver(history: DataFrame, table: str = SILVER_TABLE) -> DataFrame:
    """One row per merge into the silver table."""
    merges = history.where((F.col("table") == table) & (F.col("operation") == MERGE_OPERATION))
    return merges.select(
        "executed_at", "operation",
        _metric(INSERTED).alias("rows_inserted"),
        _metric(UPDATED).alias("rows_updated"),
        _metric(DELETED).alias("rows_deleted"),
        _duration(),
    )


def history_gold(history: DataFrame, tables: tuple[str, ...] = GOLD_TABLES) -> DataFrame:
    """One row per rebuild of any gold table. All tables share one history, so no union is needed."""
    rebuilds = history.where(
        F.col("table").isin(*tables) & F.col("operation").isin(*REBUILD_OPERATIONS))
    return rebuilds.select(
        "table", "executed_at", "operation", _metric(OUTPUT_ROWS).alias("rows"), _duration())


def union_history(histories: dict[str, DataFrame]) -> DataFrame:
    """Histories kept per table, as one history with the table's name."""
    tagged = [h.select(F.lit(t).alias("table"), "executed_at", "operation", "metrics")
              for t, h in histories.items()]
    result = tagged[0]
    for other in tagged[1:]:
        result = result.unionByName(other)
    return result


def _per_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.to_date("executed_at").alias("day"), "layer").agg(
        F.count("*").alias("runs"),
        F.sum("rows_inserted").alias("rows_inserted"),
        F.sum("rows_updated").alias("rows_updated"),
        F.round(F.avg("duration_s"), 1).alias("mean_duration_s"),
    )


def union_layers(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Daily volumes of two separate layer histories; gold has no updates (NULL)."""
    layers = silver.withColumn("layer", F.lit("silver")).unionByName(
        gold.withColumnRenamed("rows", "rows_inserted").withColumn("layer", F.lit("gold")),
        allowMissingColumns=True)
    return _per_day(layers)


def volume_daily(history: DataFrame, silver: str = SILVER_TABLE, gold: tuple[str, ...] = GOLD_TABLES):
    """Runs, rows and mean duration per day and layer, in one pass over the common history."""
    table, operation = F.col("table"), F.col("operation")
    merged = (table == silver) & (operation == MERGE_OPERATION)
    rebuilt = table.isin(*gold) & operation.isin(*REBUILD_OPERATIONS)
    layers = history.where(merged | rebuilt).select(
        "executed_at",
        F.when(merged, "silver").otherwise("gold").alias("layer"),
        F.when(merged, _metric(INSERTED)).otherwise(_metric(OUTPUT_ROWS)).alias("rows_inserted"),
        F.when(merged, _metric(UPDATED)).alias("rows_updated"),
        _duration(),
    )
    return _per_day(layers)


def volume_monthly(daily: DataFrame) -> DataFrame:
    """Rollup of ``volume_daily``. ``mean_duration_s`` is the mean of the daily means;
    ``run_mean_duration_s`` weighs each day by its runs."""
    weighted = F.sum(F.col("mean_duration_s") * F.col("runs"))
    return daily.groupBy(month_start(F.col("day")).alias("month_start"), "layer").agg(
        F.sum("runs").alias("runs"),
        F.sum("rows_inserted").alias("rows_inserted"),
        F.sum("rows_updated").alias("rows_updated"),
        F.round(F.avg("mean_duration_s"), 1).alias("mean_duration_s"),
        F.round(F.try_divide(weighted, F.sum("runs")), 1).alias("run_mean_duration_s"),
    )


def latest_volumes(volumes: DataFrame, period: str = "day") -> DataFrame:
    """Reading order of both volume tables: newest first, then layer."""
    return volumes.orderBy(F.col(period).desc(), F.col("layer").asc())


def missing_loads(history: DataFrame, today: date, days: int = ALERT_DAYS) -> DataFrame:
    """Days from ``today - days`` to ``today`` without a gold load.

    The calendar side has ``days + 1`` rows; only the days loaded in that range are compared.
    """
    end = F.lit(today)
    spark = history.sparkSession
    spine = spark.range(days + 1).select(F.date_sub(end, F.col("id").cast("int")).alias("day"))
    # A range of the stored time itself, which the scan can use.
    first, after = F.date_sub(end, days).cast("timestamp"), F.date_add(end, 1).cast("timestamp")
    recent = history.where((F.col("executed_at") >= first) & (F.col("executed_at") < after))
    loaded = history_gold(recent).select(F.to_date("executed_at").alias("day")).distinct()
    return spine.join(loaded, "day", "left_anti")
