"""Deduplication, upserts and guarded appends, as plain DataFrame plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.operators.keys import all_of, join_null_safe, names
from wickline.operators.series import ordered_positions
from wickline.session import fits, staged

# Names of the counts in a load's metrics.
INSERTED, UPDATED, DELETED = "numTargetRowsInserted", "numTargetRowsUpdated", "numTargetRowsDeleted"
OUTPUT_ROWS, DURATION_MS = "numOutputRows", "executionTimeMs"

# A source of at most this many rows and bytes may be broadcast into a merge.
SMALL_SOURCE_ROWS = 200_000
SMALL_SOURCE_BYTES = 64 << 20


def dedup_latest(df: DataFrame, keys: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, NULL lowest, then by the other columns.

    An aggregate: every map task sends one row per key, so any number of versions of one key costs
    one row per task in the shuffle (the struct of columns is aggregated by sorting, on both sides).
    The remaining columns end the ordering, which makes full ties deterministic.
    """
    keys = names(keys)
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order, *[c for c in rest if c not in order]]
    ranked = [c for c in ranked if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def split_null_keys(df: DataFrame, keys: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose keys are all set, rows with a NULL key). Only the first may enter a merge."""
    complete = all_of([F.col(k).isNotNull() for k in names(keys)])
    return df.where(complete), df.where(~complete)


def merge_upsert_when(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    update_when: Column | None,
    small_source: bool | None = None,
) -> DataFrame:
    """New state of ``target`` after an upsert, with ``_change`` per row.

    ``update_when`` speaks of both rows as ``t.<column>`` and ``s.<column>``; unknown counts as
    false. ``source`` holds one row per key and no NULL keys (``dedup_latest``,
    ``split_null_keys``). ``_change`` is inserted, updated or unchanged.

    A source whose size was checked is broadcast and the target is never shuffled; any other
    source is merged by one full outer join on the keys.
    """
    keys = names(keys)
    if small_source is None:
        small_source = fits(source, SMALL_SOURCE_ROWS, SMALL_SOURCE_BYTES)
    columns = target.columns
    source = source.select(*columns)
    update = F.lit(True) if update_when is None else F.coalesce(update_when, F.lit(False))
    on = all_of([F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    marked = source.withColumn("_from_source", F.lit(True)).alias("s")
    from_source = F.col("s._from_source").isNotNull()

    def chosen(take: Column, change: Column) -> list[Column]:
        picked = [F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in columns]
        return [*picked, change.alias("_change")]

    if small_source:
        kept = target.alias("t").join(F.broadcast(marked), on, "left").select(*chosen(
            from_source & update,
            F.when(from_source & update, "updated").otherwise("unchanged")))
        # target LEFT SEMI source, then source LEFT ANTI that: both broadcast a part of the source.
        # Distinct, so that a target that repeats keys cannot outgrow the source's bound.
        present = target.select(*keys).join(F.broadcast(source.select(*keys)), keys, "left_semi").distinct()
        new = source.join(F.broadcast(present), keys, "left_anti")
        return kept.unionByName(new.select(*columns, F.lit("inserted").alias("_change")))

    held = target.withColumn("_from_target", F.lit(True)).alias("t")
    from_target = F.col("t._from_target").isNotNull()
    return held.join(marked, on, "full_outer").select(*chosen(
        from_source & (~from_target | update),
        F.when(~from_target, "inserted").when(from_source & update, "updated").otherwise("unchanged")))


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: str | Sequence[str], small_source: bool | None = None
) -> DataFrame:
    """Upsert in which a matching source row always replaces the target row."""
    return merge_upsert_when(target, source, keys, None, small_source)


def merge_counts(merged: DataFrame) -> DataFrame:
    """One row with the counts of a merge."""
    change = F.col("_change")
    return merged.agg(
        F.count_if(change == "inserted").alias(INSERTED),
        F.count_if(change == "updated").alias(UPDATED),
        F.lit(0).cast("bigint").alias(DELETED),
        F.count("*").alias(OUTPUT_ROWS),
    )


def later_version(order: Sequence[str], columns: Sequence[str]) -> Column:
    """Update rule that gives the winner of ``dedup_latest`` whatever the order of the loads."""
    ranked = [*order, *[c for c in columns if c not in order]]
    return F.struct(*[F.col(f"s.{c}") for c in ranked]) >= F.struct(*[F.col(f"t.{c}") for c in ranked])


def newer_or_closing() -> Column:
    """Update rule of the cleaned candles: a later ingest, or a closed row over an open one."""
    return (F.col("s.ingest_ts") > F.col("t.ingest_ts")) | (
        F.col("s.is_closed") & ~F.col("t.is_closed"))


def newer_or_closing_protected() -> Column:
    """Same rule, except that an open row never replaces a closed one."""
    return newer_or_closing() & ~(F.col("t.is_closed") & ~F.col("s.is_closed"))


def new_rows(target: DataFrame, source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Source rows whose key, NULLs included, is absent from the target (a hash anti join)."""
    keys = names(keys)
    return join_null_safe(source, target.select(*keys), keys, "left_anti")


def append_new_only(target: DataFrame, source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return target.unionByName(new_rows(target, source, keys).select(*target.columns))


def append_with_next_sequence(
    target: DataFrame, rows: DataFrame, id_col: str, order_by: str | Sequence[str]
) -> DataFrame:
    """Append ``rows`` numbered from MAX(id) + 1 in ``order_by`` (from 1 on an empty target).

    The numbers come from a range layout, not from one global window. The remaining columns end
    the ordering, so equal ``order_by`` values still spread over partitions.
    """
    order = names(order_by)
    order += [c for c in rows.columns if c not in order]
    top = staged(target.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint").alias("_top")), "top")
    numbered = ordered_positions(rows, [], order, "_n")
    numbered = numbered.withColumn(id_col, F.col("_n") + top.scalar())
    return target.unionByName(numbered.select(*target.columns))
