"""Exact median of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickline.operators.keys import attach, names
from wickline.operators.series import ordered_positions, split_by_size
from wickline.session import staged

# Up to this many rows a group's distinct values may sit in one aggregation buffer.
BUFFER_ROWS = 500_000
# Exact selection: cells counted per pass, values that are collected in the end, and passes at most.
CELLS = 1024
KEEP_ROWS = 10_000
PASSES = 12


def ranked_median(
    values: DataFrame, by: Sequence[str], col: str, name: str, spread: Sequence[str] = ()
) -> DataFrame:
    """Median of large groups: the values are ranked by a range layout, the middle ones kept.

    ``spread``: further columns that tell rows with equal values apart, so that one frequent
    value does not fill a single partition.
    """
    values = values.where(F.col(col).isNotNull()).select(*by, col, *spread)
    sizes = staged(values.groupBy(*by).agg(F.count("*").alias("_n")), "sizes")
    ranked = attach(ordered_positions(values, by, [col, *spread], "_rank"), sizes, by, F.col("_rank"))
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    middle = ranked.where((F.col("_rank") == low) | (F.col("_rank") == high))
    # Same interpolation as percentile at 0.5: half of the lower value plus half of the upper.
    return middle.groupBy(*by).agg((F.min(col) * 0.5 + F.max(col) * 0.5).alias(name))


def selected_median(
    values: DataFrame, by: Sequence[str], col: str, name: str, spread: Sequence[str] = (),
    keep: int = KEEP_ROWS, cells: int = CELLS, passes: int = PASSES,
) -> DataFrame:
    """Median of large groups by exact selection: (by..., name). ``values`` should be stored.

    A pass counts the values of each group in ``cells`` cells between the bounds of the part that holds
    the median, pre-aggregated per task, and narrows the bounds to the median's cell. When at most ``keep``
    values are left of a group, those alone are collected; no value is moved before. Groups whose values
    spread over so many magnitudes that ``passes`` do not do are ranked (``ranked_median``).
    """
    by = list(by)
    values = values.where(F.col(col).isNotNull()).select(*by, col, *spread)
    # Per group: bounds of what is left, values in it, and the ranks of the middle values among them.
    # Signs of zero are told apart by no comparison; adding zero makes them one.
    x = F.col(col) + F.lit(0).cast(values.schema[col].dataType)
    values = values.withColumn(col, x)
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    left = values.groupBy(*by).agg(F.count("*").alias("_n"), F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    left = staged(left.withColumns({"_a": low, "_b": high}), "bounds")
    done: DataFrame | None = None
    for _ in range(passes):
        over = (F.col("_lo") < F.col("_hi")) & (F.col("_n") > keep)
        flat = left.where(F.col("_lo") == F.col("_hi")).select(*by, F.col("_lo").alias("_x"), F.col("_hi").alias("_y"))
        done = flat if done is None else done.unionByName(flat)
        rest, left = left.where(over), left.where((F.col("_lo") < F.col("_hi")) & ~over)
        if rest.isEmpty():
            break
        held = attach(values, rest, by, F.xxhash64(*values.columns)).where(F.col(col).between(F.col("_lo"), F.col("_hi")))
        # Halved before the difference, which could overflow otherwise.
        share = (F.col(col) / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        cell = F.least(F.floor(share * cells), F.lit(cells - 1)).cast("int")
        counts = held.groupBy(*by, "_a", "_b", cell.alias("_cell")).agg(
            F.count("*").alias("_n"), F.min(col).alias("_lo"), F.max(col).alias("_hi"))
        upto = Window.partitionBy(*by).orderBy("_cell")
        counts = counts.withColumn("_upto", F.sum("_n").over(upto))
        counts = staged(counts.withColumn("_before", F.col("_upto") - F.col("_n")), "cells")
        has_a = (F.col("_before") < F.col("_a")) & (F.col("_a") <= F.col("_upto"))
        has_b = (F.col("_before") < F.col("_b")) & (F.col("_b") <= F.col("_upto"))
        # The middle values in two cells: the greatest of one and the least of the next that is not empty.
        ends = counts.where(has_a != has_b).groupBy(*by).agg(F.min("_hi").alias("_x"), F.max("_lo").alias("_y"))
        done = done.unionByName(ends)
        one = counts.where(has_a & has_b).select(
            *by, "_n", "_lo", "_hi", (F.col("_a") - F.col("_before")).alias("_a"), (F.col("_b") - F.col("_before")).alias("_b"))
        left = staged(left.select(*one.columns).unionByName(one), "bounds")
    few = left.where(F.col("_n") <= keep)
    held = attach(values, few, by, F.xxhash64(*values.columns)).where(F.col(col).between(F.col("_lo"), F.col("_hi")))
    lists = held.groupBy(*by, "_a", "_b").agg(F.sort_array(F.collect_list(col)).alias("_values"))
    picked = lists.select(*by, F.get("_values", (F.col("_a") - 1).cast("int")).alias("_x"),
                          F.get("_values", (F.col("_b") - 1).cast("int")).alias("_y"))
    found = done.unionByName(picked).select(*by, (F.col("_x") * 0.5 + F.col("_y") * 0.5).alias(name))
    many = staged(left.where(F.col("_n") > keep).select(*by), "wide")
    if many.isEmpty():
        return found
    rest = attach(values, many.withColumn("_wide", F.lit(True)), by, F.xxhash64(*values.columns)).drop("_wide")
    return found.unionByName(ranked_median(rest, by, col, name, spread))


def exact_median(
    df: DataFrame, by: str | Sequence[str], col: str, name: str, spread: Sequence[str] = (),
    buffer_rows: int = BUFFER_ROWS,
) -> DataFrame:
    """Interpolated median of ``col`` per group, NULLs ignored: (by..., name).

    Groups of at most ``buffer_rows`` values use the built-in ``percentile``, larger ones
    ``selected_median``.
    """
    by = names(by)
    values = df.where(F.col(col).isNotNull()).select(*by, col, *spread)
    small, large = split_by_size(values, by, buffer_rows)
    medians = small.groupBy(*by).agg(F.percentile(col, 0.5).alias(name))
    if large is None:
        return medians
    return medians.unionByName(selected_median(staged(large, "large-groups"), by, col, name, spread))
