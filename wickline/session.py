"""Session settings, the shared work folder, and size checks used to choose a plan."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings on which results depend (ANSI casts, UTC days, microsecond files), adaptive plans."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_local_folder: str | None = None


def work_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, named by the cluster in ``spark.checkpoint.dir`` (or set
    with ``setCheckpointDir``).

    Only a ``local`` master may fall back to a folder of this machine; elsewhere a missing
    setting is an error, because staged tables must survive the loss of an executor.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="wickline-")
    return _local_folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the work folder and read it back.

    Cuts the lineage with a table that outlives executors. Unlike a checkpoint it stays
    columnar, so later readers still prune columns, push filters and know its size.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a fixed-width value, and what a value of another type has besides its characters.
_VALUE_BYTES = 16


def _width(df: DataFrame) -> Column:
    """Upper estimate of the bytes of a row in memory: text and binary by their length, nested values by their
    JSON, whose numbers may be as short as one digit."""
    widths: list[Column] = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            widths.append(F.coalesce(F.octet_length(value), F.lit(0)) + _VALUE_BYTES)
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            json = F.octet_length(F.to_json(F.struct(value)))
            widths.append(F.coalesce(json, F.lit(0)) * _VALUE_BYTES + _VALUE_BYTES)
        else:
            widths.append(F.lit(_VALUE_BYTES))
    return reduce(add, widths, F.lit(_VALUE_BYTES)).cast("bigint")


def fits(df: DataFrame, rows: int, size: int) -> bool:
    """True when ``df`` has at most ``rows`` rows and ``size`` bytes (pre-aggregated, cheap on staged tables).

    Both are counted over all rows, so wide rows are not broadcast for being few.
    """
    counted, held = df.agg(F.count("*"), F.coalesce(F.sum(_width(df)), F.lit(0))).first()
    return counted <= rows and held <= size
