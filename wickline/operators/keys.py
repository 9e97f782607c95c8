"""Small helpers for key columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL matches NULL, keeping the left side's key columns."""
    if not keys:
        raise ValueError("a join needs at least one key")
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = all_of([F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


# Copies of a per-key row in joins with the many rows of that key, where their number is not known.
SALTS = 16


def attach(
    df: DataFrame, per_key: DataFrame, keys: str | Sequence[str], spread: Column, how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join the one row that ``per_key`` has per key to all the rows of that key in ``df``.

    No broadcast is forced: Spark chooses one when the size of ``per_key`` allows. Otherwise both
    sides are shuffled by (keys, salt), the salt being taken from ``spread``, so that the rows of
    one very frequent key go to ``salts`` tasks. NULL keys match each other.
    """
    copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = df.withColumn("_salt", F.coalesce(F.pmod(F.hash(spread), F.lit(salts)), F.lit(0)))
    return join_null_safe(salted, copies, [*names(keys), "_salt"], how).drop("_salt")
