"""Sharding by jump consistent hashing.

A stable key alone decides a row's shard for a given number of shards: no ring table, no state.
Appending a shard moves a row only into the new shard, and only the share of rows that it needs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm.common import mix, prepared, table, text_bytes
from wickline.operators.series import ordered_positions

SHARDS = 16
# The multiplier of the jump generator and the odd step of SplitMix64.
JUMP_STEP = 2862933555777941757
KEY_STEP = 0x9E3779B97F4A7C15


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key among ``shards`` (the whole column advances together)."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    with np.errstate(over="ignore"):
        state = mix(keys.astype(np.int64).view(np.uint64) + np.uint64(KEY_STEP))
    out = np.zeros(len(state), np.int64)
    landing = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        out[live] = landing[live]
        with np.errstate(over="ignore"):
            state[live] = state[live] * np.uint64(JUMP_STEP) + np.uint64(1)
        drawn = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        landing[live] = ((out[live] + 1) * (float(1 << 31) / drawn)).astype(np.int64)
        live = live[landing[live] < shards]
    return out


def jump_shard(key: Column, shards: int) -> Column:
    """Column form of ``jump``. A NULL key goes where key 0 goes, so it too has one stable place. A key is an
    integer or text of one; under ANSI casts other text raises an error."""

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards), dtype="int32")

    return place(F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint")))


def sharded(df: DataFrame, key: str, text: str, shards: int = SHARDS) -> DataFrame:
    """Place every row: (key, size, text_crc32, law, shard, slot, grown_shard).

    ``size`` is the UTF-8 length plus 1; a NULL text has size 1 and the checksum of the empty text.
    ``slot`` numbers a shard's rows from 0 in the order (key, checksum, size), NULL keys first;
    repeated rows get different slots. ``grown_shard`` is the place with one more shard. Slots come
    from a range layout, so a shard of any size is numbered by many tasks; rows of a repeated key
    differ by a spread column there, which only tells equal rows apart. Other columns are dropped,
    whatever their names. An empty table gives no rows.
    """
    prepared(df.sparkSession)
    rows = df.select(
        F.col(key).alias("_key"),
        (text_bytes(F.col(text)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        jump_shard(F.col(key), shards).alias("shard"),
        jump_shard(F.col(key), shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_spread"),
    )
    placed = ordered_positions(rows, ["shard"], ["_key", "text_crc32", "size", "_spread"], "_position")
    return placed.select(
        F.col("_key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_position") - 1).alias("slot"), "grown_shard")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return sharded(table(spark, folder, "documents"), "doc_id", "text")


# The generator in 128-bit arithmetic, one step per level of the recursion. CRC-32 is left to a
# list fold over the bytes: eight shift steps each, the reflected polynomial 0xEDB88320.
CHECK = f"""
WITH RECURSIVE
keys AS (
  SELECT DISTINCT doc_id,
    (coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616 AS k FROM documents),
m0 AS (SELECT doc_id, ((k + {KEY_STEP}) % 18446744073709551616)::UBIGINT AS k FROM keys),
m1 AS (SELECT doc_id, (xor(k, k >> 30)::UHUGEINT * 13787848793156543929 % 18446744073709551616)::UBIGINT AS k FROM m0),
m2 AS (SELECT doc_id, (xor(k, k >> 27)::UHUGEINT * 10723151780598845931 % 18446744073709551616)::UBIGINT AS k FROM m1),
walk AS (
  SELECT doc_id, xor(k, k >> 31) AS k, -1::BIGINT AS b, 0::BIGINT AS j FROM m2
  UNION ALL
  SELECT doc_id, k2, j, floor((j + 1) * (2147483648.0::DOUBLE / ((k2 >> 33)::DOUBLE + 1)))::BIGINT
  FROM (SELECT doc_id, j, ((k::UHUGEINT * {JUMP_STEP} + 1) % 18446744073709551616)::UBIGINT AS k2
        FROM walk WHERE j < {SHARDS + 1})),
places AS (
  SELECT doc_id, max(j) FILTER (j < {SHARDS}) AS shard, max(j) FILTER (j < {SHARDS + 1}) AS grown
  FROM walk GROUP BY doc_id),
crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
      lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
sized AS (
  SELECT d.doc_id, coalesce(strlen(text), 0)::BIGINT + 1 AS size,
    xor(4294967295::UBIGINT, list_reduce(
      list_prepend(4294967295::UBIGINT,
        list_transform(range(1, 2 * coalesce(strlen(text), 0) + 1, 2),
          lambda p: ('0x' || substr(hex(encode(text)), p::INT, 2))::UBIGINT)),
      lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])))::BIGINT AS text_crc32,
    p.shard, p.grown
  FROM documents d JOIN places p ON d.doc_id IS NOT DISTINCT FROM p.doc_id, crc_table)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
  grown::INT AS grown_shard
FROM sized
"""
