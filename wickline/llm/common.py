"""What the operators share: tables, Arrow text batches, vectorised words and hashes."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.operators.keys import join_null_safe
from wickline.session import configure, staged

# Rows and bytes of an Arrow batch. Batches are the unit of memory of the Python workers.
BATCH_ROWS = 256
BATCH_BYTES = 4 << 20
# Bytes hashed at once; bounds the 8-byte arrays that hashing builds.
HASH_BYTES = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


# Workers live on between stages: let them give freed arrays back to the system at once.
RETURN_MEMORY = {
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(8 << 20), "MALLOC_ARENA_MAX": "2",
    "ARROW_DEFAULT_MEMORY_POOL": "system"}
# A task has one core: its libraries start no threads of their own.
ONE_THREAD = {"OMP_NUM_THREADS": "1", "RAYON_NUM_THREADS": "1", "TOKENIZERS_PARALLELISM": "false"}
# The folder that holds the package, for the workers of a session that was started elsewhere.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: those of the library, and small Arrow batches.

    Workers import the package by its name: they find it where it is installed, or at the driver's path.
    """
    own = spark.sparkContext.environment
    own.update(RETURN_MEMORY | ONE_THREAD)
    if ROOT not in own.get("PYTHONPATH", "").split(os.pathsep):
        own["PYTHONPATH"] = os.pathsep.join(p for p in (own.get("PYTHONPATH"), ROOT) if p)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return configure(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Each of ``names``, with underscores before it if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def text_bytes(column: Column) -> Column:
    """UTF-8 length of a text; 0 for NULL."""
    return F.coalesce(F.octet_length(column), F.lit(0))


def text_key(column: Column) -> Column:
    """Tells texts apart when a doc_id is repeated; NULL and empty texts differ in nothing that counts."""
    return F.xxhash64(F.coalesce(column, F.lit("")))


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    prepared(df.sparkSession)
    return df.mapInArrow(function, schema)


def sliced(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Consecutive batches put together up to about ``size`` bytes."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.nbytes
        if total >= size:
            yield pa.Table.from_batches(held).combine_chunks()
            held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column, without a Python object per row. NULLs have no bytes."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes in ``member`` within each row: (starts, ends, index of each row's first run).

    The last array has one entry more than there are rows.
    """
    inside = member[data]
    edges = np.empty(len(data) + 1, bool)
    edges[0] = True
    np.not_equal(inside[1:], inside[:-1], out=edges[1:-1])
    edges[-1] = True
    edges[offsets] = True
    at = np.flatnonzero(edges)
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kept = inside[at[:-1]]
    starts, ends = at[:-1][kept], at[1:][kept]
    return starts, ends, np.searchsorted(starts, offsets)


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, 2 * len(_powers))
        with np.errstate(over="ignore"):
            _powers = np.full(n, _MULTIPLIER, np.uint64)
            _inverses = np.full(n, _INVERSE, np.uint64)
            _powers[0] = _inverses[0] = 1
            np.multiply.accumulate(_powers, out=_powers)
            np.multiply.accumulate(_inverses, out=_inverses)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (constants of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span, from differences of one running polynomial per block of bytes.

    The spans are in order of their starts; they may overlap.
    """
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(starts, base + HASH_BYTES)))
        s, e = starts[first:last] - base, ends[first:last] - base
        size = int(e.max()) + 1
        _grow(size)
        with np.errstate(over="ignore"):
            running = np.zeros(size, np.uint64)
            np.cumsum((data[base : base + size - 1].astype(np.uint64) + np.uint64(1)) * _powers[: size - 1],
                      out=running[1:])
            out[first:last] = mix((running[e] - running[s]) * _inverses[s] + (e - s).astype(np.uint64))
        first = last
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span, for words that are told apart by it: no two are known to share one.

    A span is cut into blocks of eight bytes from its start; a block is mixed with its place, and the mixed
    blocks are added up. Unlike the polynomial of ``span_hashes``, which words of long repetitive patterns
    defeat, sums of mixed blocks have no algebra that texts run into. Spans may overlap; none is empty.
    """
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + HASH_BYTES)))
        s, e = starts[first:last], ends[first:last]
        base, top = int(s[0]), int(e.max())
        held = np.zeros(top - base + 8, np.uint8)
        held[:-8] = data[base:top]
        blocks = (e - s + 7) >> 3
        edges = np.cumsum(blocks) - blocks
        place = np.arange(int(blocks.sum())) - np.repeat(edges, blocks)
        at = np.repeat(s - base, blocks) + 8 * place
        words = np.ndarray((len(held) - 7,), "<u8", held, 0, (1,))[at]
        left = np.minimum(np.repeat(e - base, blocks) - at, 8).astype(np.uint64)
        with np.errstate(over="ignore"):
            words = words & (_FULL >> (np.uint64(64) - (left << np.uint64(3))))
            mixed = mix(words + mix(place.astype(np.uint64) * _MULTIPLIER + _MULTIPLIER))
            out[first:last] = mix(np.add.reduceat(mixed, edges) ^ ((e - s).astype(np.uint64) * _MULTIPLIER))
        first = last
    return out


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on; the last ``k`` - 1 positions are left out."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for i in range(k):
            total = total * _MULTIPLIER + words[i : i + n]
    return mix(total + np.uint64(k))


def grams_at(words: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """``gram_hashes`` at the given positions only."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(starts), np.uint64)
        for i in range(k):
            total = total * _MULTIPLIER + words[starts + i]
    return mix(total + np.uint64(k))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as the BIGINT that Spark stores."""
    return x.view(np.int64)


# Bits of the filters of keys, whatever the number of keys: 4 MB each.
KEY_BITS = 25


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """The 64-bit keys of ``column`` as a bit set; at most 2^KEY_BITS / 64 words reach the driver."""
    bit = F.shiftrightunsigned(column, 64 - KEY_BITS)
    words = keys.select(F.shiftright(bit, 6).alias("place"), F.expr(
        f"shiftleft(1L, CAST(shiftrightunsigned(`{column}`, {64 - KEY_BITS}) & 63 AS INT))").alias("mask"))
    out = np.zeros((1 << KEY_BITS) // 64, np.int64)
    for place, mask in words.groupBy("place").agg(F.bit_or("mask")).collect():
        out[place] = mask
    return out.view(np.uint64)


def without(docs: DataFrame, bad: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows listed in ``bad`` (``doc``, ``text_key``), which is staged.

    A filter of fixed size passes the rows that are certainly not listed; only the others, nearly as
    few as the listed ones, meet the list in a join. A list that fills the filter joins more rows.
    """
    spark = prepared(docs.sparkSession)
    bad = staged(bad.select(doc, "text_key", F.xxhash64(doc, "text_key").alias("_key")), "listed")
    shared = spark.sparkContext.broadcast(key_filter(bad, "_key"))

    @F.pandas_udf("boolean")
    def listed(keys: pd.Series) -> pd.Series:
        bits = keys.to_numpy(np.int64).view(np.uint64) >> np.uint64(64 - KEY_BITS)
        return pd.Series((shared.value[(bits >> np.uint64(6)).astype(np.int64)] >> (bits & np.uint64(63))
                          & np.uint64(1)).astype(bool))

    key, mark = unused(docs, "text_key", "_listed")
    keyed = docs.withColumn(key, text_key(F.col(text)))
    keyed = keyed.withColumn(mark, listed(F.xxhash64(doc, key)))
    listed_rows = bad.select(doc, F.col("text_key").alias(key))
    rest = join_null_safe(keyed.where(F.col(mark)), listed_rows, [doc, key], "left_anti")
    return keyed.where(~F.col(mark)).select(*docs.columns).unionByName(rest.select(*docs.columns))
