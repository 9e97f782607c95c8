"""Indicator glossary: static rows, traceable to the gold columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline import schemas
from wickline.sources.tables import literal_table

# Fixed values: (position, category, indicator, definition, formula, source column).
ROWS = (
    (1, "Price", "Last close", "Close of the latest candle that has already closed.",
     "close of the latest closed candle", "kpi.last_close"),
    (2, "Price", "Partial price", "Price of the running candle; it may still change.",
     "close of the latest open candle", "kpi.partial_price"),
    (3, "Change", "1-day change", "Change against the previous closed candle.",
     "(close / previous close - 1) x 100", "kpi.change_1d_pct"),
    (4, "Change", "30-day change", "Change against the latest close at least 30 days old.",
     "(close / close 30 days ago - 1) x 100", "kpi.change_30d_pct"),
    (5, "Change", "Year to date", "Change against the latest close before 1 January.",
     "(close / last close of the previous year - 1) x 100", "kpi.change_ytd_pct"),
    (6, "Risk", "Drawdown", "Distance from the highest close so far; never above zero.",
     "(close / highest close so far - 1) x 100", "daily.drawdown_pct"),
    (7, "Risk", "Annualised volatility", "How much the last 30 returns vary.",
     "sample deviation of the last 30 log returns x sqrt(365) x 100", "daily.vol_30d_annual_pct"),
    (8, "Price", "MA7", "Very short trend.", "mean of the last 7 closes", "daily.ma7"),
    (9, "Price", "MA30", "Medium trend.", "mean of the last 30 closes", "daily.ma30"),
    (10, "Price", "MA200", "Long trend.", "mean of the last 200 closes", "daily.ma200"),
    (11, "Price", "Trend", "Whether the medium average is above the long one.",
     "up if MA50 > MA200, else down; after 200 rows", "daily.trend_ma50_ma200"),
    (12, "Price", "Daily range", "Distance between the day's extremes.",
     "(high - low) / open x 100", "daily.range_pct"),
    (13, "Volume", "Volume", "Base quantity traded in the day.", "volume of the candle", "daily.volume"),
    (14, "Volume", "Relative volume", "Volume against normal; above 1.5 is unusual.",
     "volume / mean of the last 30 volumes", "daily.relative_volume"),
    (15, "Seasonality", "Monthly return", "Change from the month's first open to its last close.",
     "(last close / first open - 1) x 100", "monthly.return_pct"),
    (16, "Seasonality", "Weekday mean return", "Usual change on each weekday.",
     "mean of the daily change, by weekday", "weekday.mean_return_pct"),
)


def glossary(spark: SparkSession) -> DataFrame:
    return literal_table(spark, ROWS, schemas.GLOSSARY)


def check_glossary(terms: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Each term with the filled rows of its source column, or NULL if no table has that column.

    Only the columns that the terms name are read. The glossary is a short static table; its column
    names are looked at when the plan is built.
    """
    asked = {row[0] for row in terms.select("source_column").distinct().collect()}
    known = terms.sparkSession.createDataFrame([], "source_column string, filled_rows bigint")
    for name, df in tables.items():
        columns = [c for c in df.columns if f"{name}.{c}" in asked]
        if columns:
            known = known.unionByName(
                df.agg(*[F.count(c).alias(c) for c in columns])
                .unpivot([], columns, "_column", "filled_rows")
                .select(F.concat(F.lit(f"{name}."), "_column").alias("source_column"), "filled_rows"))
    # One row per column of the checked tables.
    return terms.join(F.broadcast(known), "source_column", "left").select(*terms.columns, "filled_rows")
