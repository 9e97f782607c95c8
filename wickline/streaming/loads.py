"""File streams that keep the stored tables current.

Lateness has no bound (an open candle may be corrected at any time), so the state lives in the
tables: each micro-batch is an idempotent upsert keyed by its batch id, and no watermark drops
rows. The checkpoint takes the place of a high-water mark over landed files.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wickline import schemas
from wickline.plans.lake import Lake
from wickline.plans.refresh import (
    landed_days, refresh_bronze, refresh_gold, refresh_silver, touched_days,
)
from wickline.session import staged


def _landed(spark: SparkSession, lake: Lake, files_per_batch: int) -> DataFrame:
    """Landed files as a stream. An open file that was replaced before it was read may be missing;
    its replacement is a new file of the stream."""
    return (
        spark.readStream.schema(schemas.LANDING).option("maxFilesPerTrigger", files_per_batch)
        .option("ignoreMissingFiles", "true").parquet(lake.landing)
    )


def _run(
    rows: DataFrame, checkpoint: str, name: str, load: Callable[[DataFrame, str], None]
) -> StreamingQuery:
    def batch(df: DataFrame, batch_id: int) -> None:
        load(df, f"{name}-{batch_id}")

    return (
        rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_landing_to_bronze(
    spark: SparkSession, lake: Lake, checkpoint: str, name: str, as_of: datetime,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Upsert newly landed files into bronze. ``name`` tells the runs of different streams apart."""
    return _run(
        _landed(spark, lake, files_per_batch), checkpoint, name,
        lambda df, run: refresh_bronze(df.sparkSession, lake, df, run, as_of))


def stream_late_updates(
    spark: SparkSession, lake: Lake, checkpoint: str, name: str, as_of: datetime,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Carry landed versions of candles straight to silver. The table does not depend on the order or grouping
    of the files: of all valid versions of a day the greatest by a total order stays, a closed one first."""
    return _run(
        _landed(spark, lake, files_per_batch), checkpoint, name,
        lambda df, run: refresh_silver(
            df.sparkSession, lake, run, as_of, df.select(*schemas.BRONZE.fieldNames()), any_order=True))


def stream_bronze_to_gold(
    spark: SparkSession, lake: Lake, checkpoint: str, name: str, as_of: datetime,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Per batch of landed files: bronze, then silver, then gold. A failing step stops the batch.

    Silver reads the winning bronze versions of the days that the batch touches, so it is the table
    that the batch refreshes give.
    """

    def load(df: DataFrame, run: str) -> None:
        session = df.sparkSession
        landed = staged(df, "batch")
        refresh_bronze(session, lake, landed, run, as_of)
        refresh_silver(session, lake, run, as_of, landed_days(session, lake, landed))
        refresh_gold(session, lake, run, as_of, touched_days(landed))

    return _run(_landed(spark, lake, files_per_batch), checkpoint, name, load)
