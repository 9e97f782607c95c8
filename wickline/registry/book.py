"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickline.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types that every engine's client reads alike: decimals as doubles, UTC times without zone."""

    def plain(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.col(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(function(configure(spark), folder))

        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return function

    return register
