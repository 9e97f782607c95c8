"""Ordered computations over time series, including series too long for one task.

A window ``PARTITION BY symbol`` puts a whole series into one task. ``on_series`` first counts
the rows per series. Series of at most ``max_rows`` rows use the plain window: one shuffle, one
sort. Only the longer ones are cut into pieces of ``max_rows`` rows; each piece also receives the
last ``halo`` rows of the piece before it, so bounded frames see all the rows they need, and the
maximum over all earlier pieces travels as one column. Both plans give the same values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wickline.operators.keys import attach, join_null_safe, names
from wickline.session import staged

# Daily series stay below this for half a century; the halo of 199 rows adds 1 % above it.
MAX_ROWS = 20_000
# Upper bound of the copies of a long series' entry: 20 million rows a task at 20 billion a series.
MOST_SALTS = 1024


@dataclass
class Series:
    """What an ordered computation may ask of its series, however it is cut."""

    order: WindowSpec
    position: Column
    earlier_max: dict[str, Column] = field(default_factory=dict)

    def last(self, n: int) -> WindowSpec:
        return self.order.rowsBetween(-(n - 1), Window.currentRow)

    def previous(self, col: str) -> Column:
        return F.lag(col).over(self.order)

    def mean(self, col: str, n: int) -> Column:
        return F.avg(col).over(self.last(n))

    def stddev(self, col: str, n: int) -> Column:
        return F.stddev_samp(col).over(self.last(n))

    def running_max(self, col: str) -> Column:
        here = F.max(col).over(self.order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return F.greatest(here, self.earlier_max[col]) if col in self.earlier_max else here


def ordered_positions(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each ``by`` group from 1 in ``order``, without a task per group.

    Rows are range-partitioned on (by, order), so a group of any size spreads over many
    partitions. The position inside a partition comes from the partition's own row counter;
    the rows of earlier partitions are added from one count per (group, partition). The laid-out
    rows are staged: counts and positions must come from the very same layout.
    """
    columns = [F.col(c).asc_nulls_first() for c in [*by, *order]]
    laid = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    laid = staged(laid.withColumn("_row", F.monotonically_increasing_id()), "ordered")
    laid = laid.withColumn("_part", F.shiftright("_row", 33))
    # At most one row per partition plus one per group. Staged, so that Spark knows its size when
    # it chooses between a broadcast and a shuffle of the rows.
    parts = laid.groupBy(*by, "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(
        parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "parts")
    placed = join_null_safe(laid, starts, [*by, "_part"], "inner")
    position = F.col("_before") + F.col("_row") - F.col("_first") + 1
    return placed.withColumn(name, position).drop("_row", "_part", "_first", "_before")


def split_by_size(
    df: DataFrame, by: Sequence[str], rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of groups with at most ``rows`` rows, rows of larger groups or None if there are none).

    Runs one pre-aggregated count when the plan is built; ``df`` should be stored. The list of large
    groups has at most 1/``rows`` as many rows as ``df``; it is staged, so its join is planned by its
    true size. Where that is no broadcast, a group's rows are spread by a salt that grows with the
    largest group, so none of them meets its whole group in one task.
    """
    large = staged(df.groupBy(*by).count().where(F.col("count") > rows), "large")
    most = large.agg(F.max("count")).first()[0]
    if most is None:
        return df, None
    salts = min(MOST_SALTS, -(-most // rows))
    marked = attach(df, large.withColumn("_large", F.lit(True)).drop("count"), by,
                    F.xxhash64(*df.columns), "left", salts)
    short = marked.where(F.col("_large").isNull()).drop("_large")
    return short, marked.where(F.col("_large").isNotNull()).drop("_large")


def _cut(df: DataFrame, by: list[str], on: Sequence[str], halo: int, carry: Sequence[str], max_rows: int):
    placed = ordered_positions(df, by, on, "_position")
    offset = F.col("_position") - 1
    placed = placed.withColumn("_own", F.floor(offset / max_rows))
    copied = offset % max_rows >= max_rows - halo
    targets = F.when(copied, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))
    frame = placed.withColumn("_piece", F.explode(targets))
    earlier_max = {}
    if carry:
        tops = placed.groupBy(*by, "_own").agg(*[F.max(c).alias(f"_max_{c}") for c in carry])
        before = Window.partitionBy(*by).orderBy("_own").rowsBetween(Window.unboundedPreceding, -1)
        tops = tops.select(
            *by, F.col("_own").alias("_piece"),
            *[F.max(f"_max_{c}").over(before).alias(f"_max_{c}") for c in carry])
        frame = join_null_safe(frame, staged(tops, "tops"), [*by, "_piece"], "left")
        earlier_max = {c: F.col(f"_max_{c}") for c in carry}
    order = Window.partitionBy(*by, "_piece").orderBy("_position")
    return frame, Series(order, F.col("_position"), earlier_max)


def on_series(
    df: DataFrame,
    build: Callable[[DataFrame, Series], DataFrame],
    *,
    halo: int,
    by: str | Sequence[str] = "symbol",
    on: str = "day",
    carry: Sequence[str] = (),
    max_rows: int = MAX_ROWS,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Apply ``build(frame, series)`` to series ordered by ``on``, then ``ties``.

    Rows equal in (``by``, ``on``, ``ties``) have no order of their own; name columns in ``ties`` that
    tell rows of one time apart, and both plans number them alike. ``df`` should be stored: it is
    counted when the plan is built.

    ``halo``: how many earlier rows the widest frame of ``build`` reaches back.
    ``carry``: columns for which ``build`` uses ``series.running_max``.
    """
    by = names(by)
    if max_rows <= halo:
        raise ValueError("pieces must be longer than the halo")
    short, long = split_by_size(df, by, max_rows)
    order = Window.partitionBy(*by).orderBy(*[F.col(c).asc_nulls_first() for c in (on, *ties)])
    whole = build(short, Series(order, F.row_number().over(order).cast("bigint")))
    if long is None:
        return whole
    frame, series = _cut(long, by, [on, *ties], halo, carry, max_rows)
    pieces = build(frame, series).where(F.col("_piece") == F.col("_own"))
    return whole.unionByName(pieces.select(*whole.columns))


def lag_previous(df: DataFrame, col: str = "close", name: str = "prev_close", **series) -> DataFrame:
    """Value of the previous row of the series, whatever its date."""
    return on_series(df, lambda f, s: f.withColumn(name, s.previous(col)), halo=1, **series)


def row_index(df: DataFrame, name: str = "row_index", **series) -> DataFrame:
    return on_series(df, lambda f, s: f.withColumn(name, s.position), halo=0, **series)


def moving_average(df: DataFrame, col: str, n: int, name: str | None = None, **series) -> DataFrame:
    """Mean of the last ``n`` rows (rows, not days)."""
    name = name or f"{col}_ma{n}"
    return on_series(df, lambda f, s: f.withColumn(name, s.mean(col, n)), halo=n - 1, **series)


def rolling_stddev(df: DataFrame, col: str, n: int, name: str | None = None, **series) -> DataFrame:
    """Sample standard deviation of the last ``n`` rows."""
    name = name or f"{col}_sd{n}"
    return on_series(df, lambda f, s: f.withColumn(name, s.stddev(col, n)), halo=n - 1, **series)


def running_max(df: DataFrame, col: str, name: str | None = None, **series) -> DataFrame:
    """Largest value since the start of the series."""
    name = name or f"{col}_max"
    return on_series(
        df, lambda f, s: f.withColumn(name, s.running_max(col)), halo=0, carry=[col], **series)
