"""Optional JDBC exchange of sequence tables; needs the database's driver on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], **partitioning
) -> DataFrame:
    """``partitioning``: column, lowerBound, upperBound and numPartitions of a parallel read."""
    return spark.read.jdbc(url, table, properties=properties, **partitioning)


def append_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    rows.write.jdbc(url, table, mode="append", properties=properties)
