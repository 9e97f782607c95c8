"""Load history: one appended row per written table."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline import schemas
from wickline.session import staged
from wickline.sources.landing import read_or_empty
from wickline.sources.tables import exists, remove

LOCATION = "location"


# Folder level below which the rows lie; readers of one table or time prune by it.
MONTH = "month"


def append_loads(rows: DataFrame, path: str) -> None:
    """Append loads in the history's schema, by table and month."""
    rows.select(*schemas.LOAD_HISTORY.fieldNames()).withColumns({
        "for_table": F.col("table"), MONTH: F.date_format("executed_at", "yyyy-MM")}).write.mode(
        "append").partitionBy("for_table", MONTH).parquet(path)


def record_load(
    spark: SparkSession, path: str, table: str, operation: str, metrics: dict[str, object],
    executed_at: datetime | None = None,
) -> None:
    """Append one row. The time of the write is the clock's unless given: it orders the rebuilds."""
    executed_at = executed_at or datetime.now(timezone.utc)
    row = (table, executed_at, operation, {k: str(v) for k, v in metrics.items()})
    append_loads(spark.createDataFrame([row], schemas.LOAD_HISTORY).coalesce(1), path)


def load_history(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path).select(*schemas.LOAD_HISTORY.fieldNames())


def _read(spark: SparkSession, path: str) -> DataFrame:
    parts = [T.StructField("for_table", T.StringType()), T.StructField(MONTH, T.StringType())]
    return read_or_empty(spark, path, T.StructType([*schemas.LOAD_HISTORY.fields, *parts]))


def current_location(spark: SparkSession, path: str, table: str) -> str | None:
    """Folder of the latest rebuild of ``table``; only that table's part of the history is read."""
    latest = _read(spark, path).where(F.col("for_table") == table).agg(
        F.max_by(F.col("metrics")[LOCATION], "executed_at").alias("location"))
    return latest.first()["location"]


def _pending(path: str) -> str:
    return f"{path}-compaction"


def _swap(spark: SparkSession, path: str) -> None:
    _read(spark, _pending(path)).repartition("for_table", MONTH).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("for_table", MONTH).parquet(path)
    remove(spark, _pending(path))


def compact_history(spark: SparkSession, path: str, before: date) -> int:
    """Rewrite the months before the one of ``before`` that have several files as one file a table and month.

    Loads are recorded when they happen, so no row is added to such a month any more. The content is written
    whole to a pending folder first; a run that dies is put right by the next. Returns the partitions rewritten.
    """
    if exists(spark, f"{_pending(path)}/_SUCCESS"):
        _swap(spark, path)
    elif exists(spark, _pending(path)):
        remove(spark, _pending(path))
    closed = _read(spark, path).where(F.col(MONTH) < F.lit(f"{before:%Y-%m}"))
    parts = ["for_table", MONTH]
    files = closed.select(*parts, F.input_file_name().alias("file")).distinct().groupBy(*parts).count()
    scattered = staged(files.where("count > 1").select(*parts), "scattered")
    rewritten = scattered.count()
    if rewritten:
        rows = closed.join(scattered, parts, "left_semi")
        rows.repartition(*parts).write.partitionBy(*parts).parquet(_pending(path))
        _swap(spark, path)
    return rewritten
