"""Typing, quality rules, rejects and series checks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickline import schemas
from wickline.operators.keys import join_null_safe, names
from wickline.operators.merge import dedup_latest, new_rows

Rule = tuple[str, Column]
_PRICES = ("open", "high", "low", "close")


def clean_symbol() -> Column:
    return F.upper(F.trim("symbol_raw"))


def _closed() -> Column:
    return F.coalesce("is_closed", F.lit(False))


def _ingest_time() -> Column:
    return F.try_to_timestamp("ingest_ts_utc")


def typed_candles(bronze: DataFrame) -> DataFrame:
    """Bronze rows with clean symbol, decimal amounts, parsed ingest time and a JSON payload.

    Amounts that the target type cannot hold (overflow, NaN, infinity) become NULL and set
    ``_unrepresentable``, so that they are rejected rather than failing the load.
    """
    kinds = {**dict.fromkeys(_PRICES, schemas.PRICE), "volume": schemas.VOLUME}
    amounts = {c: F.col(c).try_cast(t) for c, t in kinds.items()}
    amounts["num_trades"] = F.col("num_trades").try_cast("bigint")
    lost = F.lit(False)
    for name, value in amounts.items():
        lost = lost | (F.col(name).isNotNull() & value.isNull())
    return bronze.select(
        clean_symbol().alias("symbol"),
        F.col("open_time").cast("timestamp").alias("open_time"),
        F.col("close_time").cast("timestamp").alias("close_time"),
        *[value.alias(name) for name, value in amounts.items()],
        _closed().alias("is_closed"),
        _ingest_time().alias("ingest_ts"),
        F.to_json(F.struct("*")).alias("payload"),
        lost.alias("_unrepresentable"),
    )


def quality_rules() -> list[Rule]:
    """Ordered rules; a row is rejected for the first that holds. NULL operands never fail one."""
    open_, high, low, close = (F.col(c) for c in _PRICES)
    return [
        ("null key", F.col("symbol").isNull() | F.col("open_time").isNull()),
        ("non-positive price", (open_ <= 0) | (close <= 0) | (high <= 0) | (low <= 0)),
        ("high below open/close", high < F.greatest(open_, close)),
        ("low above open/close", low > F.least(open_, close)),
        ("negative volume or trades", (F.col("volume") < 0) | (F.col("num_trades") < 0)),
        ("close before open time", F.col("close_time") <= F.col("open_time")),
        ("unrepresentable value", F.col("_unrepresentable")),
    ]


def not_null_rules(columns: Sequence[str] = (*_PRICES, "volume", "close_time")) -> list[Rule]:
    """Optional rules for callers who do not accept missing amounts."""
    return [(f"missing {c}", F.col(c).isNull()) for c in columns]


def quality_reason(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add ``reason``: the first failing rule, or NULL."""
    reason = F.lit(None).cast("string")
    for name, failed in reversed(quality_rules() if rules is None else list(rules)):
        reason = F.when(failed, F.lit(name)).otherwise(reason)
    return df.withColumn("reason", reason)


def split_valid_rejected(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col("reason").isNull()), df.where(F.col("reason").isNotNull())


def latest_versions(bronze: DataFrame) -> DataFrame:
    """The winning bronze row per (clean symbol, open time): closed first, then latest ingest.

    Runs on the received columns, before typing: casts and JSON are then made for winners only,
    and a reader who does not use the payload never builds it.
    """
    keyed = bronze.withColumns({
        "_symbol": clean_symbol(), "_open_time": F.col("open_time"),
        "_closed": _closed(), "_ingest": _ingest_time(),
    })
    best = dedup_latest(keyed, ["_open_time", "_symbol"], ["_closed", "_ingest"])
    return best.select(*bronze.columns)


def clean_candles(bronze: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Typed rows, the winning version per (symbol, open time), and the reason it fails, if any."""
    return quality_reason(typed_candles(latest_versions(bronze)), rules)


def silver_rows(cleaned: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Valid rows in the silver schema, one per (symbol, day).

    Two open times on one day would be two sources for one target row; the usual order and then
    the later open time decide.
    """
    valid, _ = split_valid_rejected(cleaned)
    stamp = F.lit(as_of).cast("timestamp")
    rows = valid.withColumns({"day": F.to_date("open_time"), "transformed_at": stamp}).select(
        *schemas.SILVER.fieldNames())
    return dedup_latest(rows, ["symbol", "day"], ["is_closed", "ingest_ts", "open_time"])


def reject_rows(cleaned: DataFrame, as_of: datetime | None = None) -> DataFrame:
    _, rejected = split_valid_rejected(cleaned)
    return rejected.withColumn("rejected_at", F.lit(as_of).cast("timestamp")).select(
        *schemas.REJECT.fieldNames())


def store_rejects(rejects: DataFrame, cleaned: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Rejected rows not stored yet: one per (symbol, open_time, ingest_ts) and payload.

    NULLs match each other. Different rows without a key are told apart by their payloads, so none
    of them is lost; the same row received again is stored once.
    """
    return new_rejects(rejects, reject_rows(cleaned, as_of))


def new_rejects(rejects: DataFrame, rows: DataFrame) -> DataFrame:
    """``store_rejects`` of ready rows. Payloads are compared by their digests: the stored ones are never shuffled."""
    keys = ["symbol", "open_time", "ingest_ts", "_digest"]
    digest = F.sha2("payload", 256)
    once = dedup_latest(rows.withColumn("_digest", digest), keys, ["reason"])
    return new_rows(rejects.withColumn("_digest", digest), once, keys).drop("_digest")


def load_check(bronze: DataFrame) -> DataFrame:
    """Rows, first and last open time, and rows not closed (a NULL flag counts as open)."""
    return bronze.agg(
        F.count("*").alias("total"),
        F.min("open_time").alias("first_open"),
        F.max("open_time").alias("last_open"),
        F.sum(F.when(F.col("is_closed"), 0).otherwise(1)).alias("open_candles"),
    )


def check_of_periods(periods: DataFrame) -> DataFrame:
    """``load_check`` from the summaries of the stored periods."""
    return periods.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"), F.min("first_open").alias("first_open"),
        F.max("last_open").alias("last_open"), F.sum("open_rows").alias("open_candles"))


def series_completeness(silver: DataFrame) -> DataFrame:
    """Loaded against expected days, and open candles, per symbol."""
    first, last = F.min("day"), F.max("day")
    return silver.groupBy("symbol").agg(
        first.alias("first_day"),
        last.alias("last_day"),
        F.count("*").alias("days_loaded"),
        (F.datediff(last, first) + 1).alias("days_expected"),
        F.count_if(~F.col("is_closed")).alias("open_candles"),
    )


def date_spine(df: DataFrame, start: str, end: str, name: str = "day") -> DataFrame:
    """Every day from ``start`` to ``end`` (inclusive) of every row, in ``name``.

    Expanded month by month: no row ever holds more than one month list and 31 days.
    """
    keep = [c for c in df.columns if c not in (start, end)]
    months = df.select("*", F.explode(F.sequence(
        F.trunc(start, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))).alias("_month"))
    days = F.sequence(
        F.greatest(start, "_month"), F.least(end, F.last_day("_month")), F.expr("INTERVAL 1 DAY"))
    return months.select(*keep, F.explode(days).alias(name))


def _bit(day: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)


def day_masks(silver: DataFrame, by: str | Sequence[str] = "symbol", *period: str) -> DataFrame:
    """(by..., month_start, mask, first_day, last_day, days_loaded, open_candles) of each series' month; ``mask``
    has a bit for each day with a row. ``period`` columns are kept."""
    return silver.where(F.col("day").isNotNull()).groupBy(
        *period, *names(by), F.trunc("day", "month").alias("month_start")).agg(
        F.bit_or(_bit(F.col("day"))).alias("mask"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.count("*").alias("days_loaded"), F.count_if(~F.col("is_closed")).alias("open_candles")
        if "is_closed" in silver.columns else F.lit(0).cast("bigint").alias("open_candles"))


def completeness_of_masks(masks: DataFrame) -> DataFrame:
    """``series_completeness`` from the months' masks."""
    first, last = F.min("first_day"), F.max("last_day")
    return masks.groupBy("symbol").agg(
        first.alias("first_day"), last.alias("last_day"), F.sum("days_loaded").alias("days_loaded"),
        (F.datediff(last, first) + 1).alias("days_expected"), F.sum("open_candles").alias("open_candles"))


def missing_of_masks(masks: DataFrame, by: str | Sequence[str] = "symbol") -> DataFrame:
    """(by..., day): days between a series' first and last that have no bit. Months without a row have no mask:
    they follow the month before them."""
    by = names(by)
    months = Window.partitionBy(*by).orderBy("month_start")
    later = F.lead("month_start").over(months)
    rows = masks.withColumns({
        "_until": F.coalesce(F.date_sub(later, 1), F.col("last_day")),
        "_from": F.when(F.lag("month_start").over(months).isNull(), F.col("first_day")).otherwise(F.col("month_start"))})
    rows = rows.select(*by, "month_start", "mask", "_from", "_until", F.explode(F.sequence(
        "month_start", F.trunc("_until", "month"), F.expr("INTERVAL 1 MONTH"))).alias("_month"))
    days = F.sequence(F.greatest("_from", "_month"), F.least("_until", F.last_day("_month")), F.expr("INTERVAL 1 DAY"))
    own = F.when(F.col("_month") == F.col("month_start"), F.col("mask")).otherwise(0)
    free = F.filter(days, lambda d: F.col("_mask").bitwiseAND(_bit(d)) == 0)
    return rows.withColumn("_mask", own).select(*by, F.explode(free).alias("day"))


def missing_days(silver: DataFrame, by: str | Sequence[str] = "symbol") -> DataFrame:
    """Days without a row between the first and the last day of each series.

    One aggregate: a bit mask per series and month, compared with the days of the calendar.
    """
    return missing_of_masks(day_masks(silver, by), by)
