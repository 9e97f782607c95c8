"""Landing folder: Parquet partitioned by track and ingest date.

The confirmed track only grows. The open track holds the current state of the running candles:
a symbol's candles of an ingest date are replaced as a whole.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline import schemas
from wickline.operators.keys import join_null_safe
from wickline.session import staged

CONFIRMED, OPEN = "confirmed", "open"


def read_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Parquet at ``path``, or None when nothing was written there yet. Other failures raise."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    found = read_or_none(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def _landed(df: DataFrame, track: str) -> DataFrame:
    day = F.to_date(F.try_to_timestamp("ingest_ts_utc"))
    return df.select(*schemas.BRONZE.fieldNames()).withColumns(
        {"track": F.lit(track), "ingest_date": day})


def write_landing_confirmed(df: DataFrame, path: str) -> None:
    """Append closed candles under their ingest date."""
    _landed(df, CONFIRMED).write.mode("append").option("compression", "snappy").partitionBy(
        "track", "ingest_date").parquet(path)


def write_landing_open(df: DataFrame, path: str) -> None:
    """Replace the open candles of the symbols and ingest dates present in ``df``; all others stay."""
    new = staged(_landed(df, OPEN), "open")
    dates = [row[0] for row in new.select("ingest_date").distinct().collect()]
    stored = read_or_empty(df.sparkSession, path, schemas.LANDING).where(
        (F.col("track") == OPEN) & (F.col("ingest_date").isin([d for d in dates if d is not None])
                                    | (F.col("ingest_date").isNull() & F.lit(None in dates))))
    others = join_null_safe(
        stored, new.select("symbol_raw", "ingest_date").distinct(), ["symbol_raw", "ingest_date"], "left_anti")
    # Staged: the folder cannot be read and overwritten in one plan.
    staged(others.select(*new.columns).unionByName(new), "open").write.mode("overwrite").option("compression", "snappy").option(
        "partitionOverwriteMode", "dynamic").partitionBy("track", "ingest_date").parquet(path)


def read_landing(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """Both tracks in the bronze schema plus the partitions; ``since`` prunes ingest dates."""
    rows = read_or_empty(spark, path, schemas.LANDING)
    return rows if since is None else rows.where(F.col("ingest_date") >= F.lit(since))
