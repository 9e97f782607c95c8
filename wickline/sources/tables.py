"""Table declarations, rebuilds, layout and merges into stored Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline.operators.keys import names
from wickline.operators.merge import SMALL_SOURCE_BYTES, SMALL_SOURCE_ROWS, merge_counts, merge_upsert_when
from wickline.session import fits, staged
from wickline.sources.landing import read_or_empty, read_or_none

# Folder names of the stored partitions.
PART = "part"


def create_schema(spark: SparkSession, name: str, comment: str = "") -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT '{comment}'")


def declare_table(
    spark: SparkSession, name: str, schema: T.StructType, comment: str, path: str | None = None
) -> DataFrame:
    """Create the table unless it exists, with table and column comments; return it."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema, description=comment)
    return spark.table(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema``, by name and in order; another type is an error, not a cast.

    Parquet tables accept NULL in NOT NULL columns, so such rows are refused here when written.
    """
    for f in schema.fields:
        if df.schema[f.name].dataType != f.dataType:
            raise TypeError(f"{f.name}: expected {f.dataType}, got {df.schema[f.name].dataType}")

    def checked(f: T.StructField) -> Column:
        value = F.col(f.name)
        if f.nullable:
            return value
        return F.when(value.isNotNull(), value).otherwise(
            F.raise_error(F.lit(f"NULL in NOT NULL column {f.name}")).cast(f.dataType)).alias(f.name)

    return df.select(*[checked(f) for f in schema.fields])


def cluster_layout(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Range-partition and sort, so that file statistics let readers skip row groups."""
    cols = names(cols)
    return df.repartitionByRange(*cols).sortWithinPartitions(*cols)


def replace_table(df: DataFrame, path: str, run_id: str, layout: Sequence[str] | None = None) -> str:
    """Write a full rebuild to a fresh folder of ``path`` and return that folder.

    Readers move to it through the load history, so they see the old or the new table whole.
    """
    folder = f"{path}/{run_id}"
    laid = df if layout is None else cluster_layout(df, layout)
    laid.write.mode("overwrite").parquet(folder)
    return folder


def literal_table(spark: SparkSession, rows: Sequence[tuple[Any, ...]], schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def insert_literals(target: DataFrame, rows: Sequence[tuple[Any, ...]]) -> DataFrame:
    return target.unionByName(literal_table(target.sparkSession, rows, target.schema))


def declare_buckets(
    spark: SparkSession, name: str, path: str, schema: T.StructType, keys: Sequence[str], buckets: int
) -> str:
    """Create a catalog table over ``path`` unless it exists, for merges that leave the stored rows in place;
    return its name.

    It is partitioned by ``PART`` and bucketed by ``keys``, so a merge on the keys reads a bucket of the
    touched periods in one task and needs no exchange of stored rows. The number of buckets stays as first
    declared; choose it so that a bucket of a period is a file of some 100 MB. Files that are there already
    must have been written through a table of the same declaration.
    """
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _stored(schema))
        clustered = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"""CREATE TABLE {name} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic')
            PARTITIONED BY ({PART}) CLUSTERED BY ({clustered}) SORTED BY ({clustered}) INTO {buckets} BUCKETS
            LOCATION '{path}'""")
        if exists(spark, path):
            # Partitions that an earlier catalog knew.
            spark.catalog.recoverPartitions(name)
    return name


def merge_in_buckets(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_when: Column | None = None
) -> DataFrame:
    """``merge_upsert_when`` of a bucketed ``target`` (``declare_buckets``): the source alone is dealt out, into
    the target's buckets, and each task merges one bucket.

    The join is on the keys alone: they determine the period, and only a join on just the bucketed columns
    takes the buckets as they are.
    """
    return merge_upsert_when(target, source, keys, update_when, small_source=False)


def _parted(df: DataFrame, time_col: str, grain: str) -> DataFrame:
    return df.withColumn(PART, F.to_date(F.date_trunc(grain, time_col)))


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(PART, T.DateType())])


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_or_empty(spark, path, _stored(schema)).select(*schema.fieldNames())


def _files(spark: SparkSession, path: str):
    """(file system, path) of a folder, asked from the driver; every store that Spark writes to has one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _files(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


def _pending(path: str) -> str:
    return f"{path}-pending"


#: Makes one row per series and period (``PART``) of the rows of whole periods.
Summary = Callable[[DataFrame], DataFrame]


def _periods(path: str) -> str:
    return f"{path}-periods"


def _write_periods(rows: DataFrame, path: str, summary: Summary) -> None:
    # Few rows: one per series and period. One file per period is enough.
    summary(rows).repartition(PART).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(_periods(path))


def read_periods(spark: SparkSession, path: str, schema: T.StructType, summary: Summary) -> DataFrame:
    """The summary of every stored period: as the merges left it, or made from the table where none did."""
    shape = summary(spark.createDataFrame([], _stored(schema))).schema
    rows = read_or_none(spark, _periods(path), T.StructType([f for f in shape.fields]))
    return summary(read_or_empty(spark, path, _stored(schema))) if rows is None else rows.select(*shape.fieldNames())


def _store(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], summary: Summary | None = None,
    table: str | None = None,
) -> None:
    """Replace the partitions of the table by the pending content, and the summaries of these periods; then
    forget the pending content."""
    rows = spark.read.schema(_stored(schema)).parquet(_pending(path))
    if summary is not None and not exists(spark, _periods(path)):
        # Periods stored before there were summaries.
        _write_periods(read_or_empty(spark, path, _stored(schema)), path, summary)
    if table is not None:
        # A pending file holds one bucket; it is written as it is read, sorted within the task.
        rows.write.insertInto(table, overwrite=True)
    else:
        # The range layout spreads a big period over many tasks and sorts it for skipping.
        cluster_layout(rows, [PART, *keys]).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    if summary is not None:
        _write_periods(rows, path, summary)
    remove(spark, _pending(path))


def finish_merge(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], summary: Summary | None = None,
    table: str | None = None,
) -> None:
    """Put right what a merge that died has left.

    Pending content with Spark's completion marker is stored: as there is one writer and every merge
    begins here, no later merge can have been stored since. Content without the marker is dropped;
    the table was not touched yet.
    """
    if exists(spark, f"{_pending(path)}/_SUCCESS"):
        _store(spark, path, schema, keys, summary, table)
    elif exists(spark, _pending(path)):
        remove(spark, _pending(path))


def merge_into(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    schema: T.StructType,
    *,
    keys: Sequence[str],
    time_col: str,
    update_when: Column | None = None,
    grain: str = "month",
    summary: Summary | None = None,
    table: str | None = None,
) -> dict[str, int]:
    """Upsert ``source`` (one row per key, no NULL keys) into the table at ``path``; counts.

    The table is partitioned by ``grain`` of ``time_col``, which the keys determine. Only
    partitions present in the source are read and rewritten. Their new content is first written
    whole to a pending folder beside the table; then it replaces those partitions. A job that dies
    in between is put right by the next merge (``finish_merge``). Every merge is computed against
    the table as it is, so repeating one, also an older one, gives what its rule says and never
    brings old content back. One writer at a time. ``summary`` keeps one row per series and period
    beside the table (``read_periods``), renewed for the touched periods under the same protocol.
    ``table`` names a bucketed table over ``path`` (``declare_buckets``, bucketed by ``keys``); stored rows are
    then neither shuffled by the merge nor laid out anew.
    """
    finish_merge(spark, path, schema, keys, summary, table)
    stored = _stored(schema)
    changed = T.StructType([*stored.fields, T.StructField("_change", T.StringType())])
    source = staged(_parted(conform(source, schema), time_col, grain), "source")
    # One value per calendar period of the source: small whatever the number of rows.
    parts = [row[0] for row in source.select(PART).distinct().collect()]
    if table is not None:
        # Another session may have changed the files since this one listed them.
        spark.catalog.refreshTable(table)
        held = spark.table(table).where(F.col(PART).isin(parts))
        merged = merge_in_buckets(held, source, keys, update_when)
    else:
        held = read_or_empty(spark, path, stored).where(F.col(PART).isin(parts))
        small = fits(source, SMALL_SOURCE_ROWS, SMALL_SOURCE_BYTES)
        merged = merge_upsert_when(held, source, [*keys, PART], update_when, small)
    merged.write.parquet(_pending(path))
    merged = spark.read.schema(changed).parquet(_pending(path))
    counts = merge_counts(merged).first().asDict()
    _store(spark, path, schema, keys, summary, table)
    return counts


def replace_periods(
    spark: SparkSession, path: str, rows: DataFrame, schema: T.StructType, *, keys: Sequence[str],
    time_col: str, since: date | None = None, grain: str = "month",
) -> None:
    """Replace the periods from the one of ``since`` on (all, if None) by ``rows``, which hold them whole.

    Same protocol as a merge: the content is pending until it is stored. Periods left without a row
    are removed.
    """
    finish_merge(spark, path, schema, keys)
    _parted(conform(rows, schema), time_col, grain).write.parquet(_pending(path))
    written = spark.read.schema(_stored(schema)).parquet(_pending(path)).select(PART).distinct()
    # Calendar periods: few, whatever the number of rows.
    present = {row[0] for row in written.collect()}
    held = read_or_empty(spark, path, _stored(schema)).select(PART).distinct()
    if since is not None:
        held = held.where(F.col(PART) >= F.date_trunc(grain, F.lit(since)).cast("date"))
    gone = [row[0] for row in held.collect() if row[0] not in present]
    # Emptied periods go first: a death before the content is stored leaves it pending, complete, and the
    # next run stores it.
    for part in gone:
        remove(spark, f"{path}/{PART}={part}")
    _store(spark, path, schema, keys)


def rows_of_days(
    spark: SparkSession, path: str, schema: T.StructType, days: DataFrame, by: dict[str, Column],
    time_col: str, grain: str = "month",
) -> DataFrame:
    """Stored rows whose values of the expressions ``by`` occur in ``days`` (distinct rows of the same
    names, with ``PART``): only the partitions named there are read."""
    parts = [row[0] for row in days.select(PART).distinct().collect()]
    rows = read_or_empty(spark, path, _stored(schema)).where(F.col(PART).isin(parts))
    marked = rows.withColumns({f"_{name}": value for name, value in by.items()})
    wanted = days.select(*[F.col(name).alias(f"_{name}") for name in by]).distinct()
    return marked.join(wanted, [f"_{name}" for name in by], "left_semi").select(*schema.fieldNames())
