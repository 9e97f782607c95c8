"""Benchmark decontamination by winnowing.

Of every ``WINDOW`` consecutive words the smallest hash of ``GRAM`` words is a fingerprint. A span of
``WINDOW`` words that a document shares with an item has the same smallest hash in both, so every
shared span has a common fingerprint. Document fingerprints are met with those of the benchmark in a
filter of fixed size; around each hit the ``WINDOW``-word spans are extended and joined exactly with
the item's spans, by a 128-bit digest of their words. Items shorter than a window are looked up whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm.common import (
    LOWER, gram_hashes, grams_at, map_arrow, mix, prepared, span_hashes, spans, table, text_key, utf8, without,
)
from wickline.operators.keys import join_null_safe
from wickline.session import staged

WINDOW = 13
GRAM = 7
# A document is contaminated from one hit word in this many.
SHARE = 20
# Bits of the fingerprint filter, whatever the size of the benchmark: 2 MB. A benchmark of many
# millions of windows fills it; then more windows are joined, with the same result.
FILTER_BITS = 24

# Words: digits, letters a to z, and every byte beyond ASCII.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True

_HIT = pa.list_(pa.struct([("digest", pa.binary()), ("size", pa.int32()), ("starts", pa.list_(pa.int32()))]))


def _bits(hashes: np.ndarray) -> np.ndarray:
    """The two filter bits of each hash."""
    shift = np.uint64(64 - FILTER_BITS)
    return np.stack([hashes >> shift, mix(hashes) >> shift], axis=-1).astype(np.int64)


def _held(filter_words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = np.ones(len(hashes), bool)
    for bits in _bits(hashes).T:
        out[out] = (filter_words[bits[out] >> 6] >> (bits[out] & 63).astype(np.uint64)) & np.uint64(1) > 0
    return out


def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours."""
    pick = np.minimum if least else np.maximum
    out = values[: len(values) - width + 1].copy()
    for i in range(1, width):
        pick(out, values[i : len(values) - width + 1 + i], out=out)
    return out


def fingerprints(grams: np.ndarray) -> np.ndarray:
    """Which of the gram hashes are the least of some window (all of them, where several are equal)."""
    width = WINDOW - GRAM + 1
    if len(grams) < width:
        return np.zeros(len(grams), bool)
    least = _sliding(grams, width, True)
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return _sliding(around, width, False) == grams


def _words(column: pa.Array):
    data, offsets = utf8(column)
    data = LOWER[data]
    starts, ends, first = spans(data, offsets, WORD_BYTES)
    return data, starts, ends, first


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, size, digest, bits): every window of every item, with the filter bits of its prints."""
    for batch in batches:
        data, starts, ends, first = _words(batch.column(1))
        raw = data.tobytes()
        hashes = span_hashes(data, starts, ends)
        out: list[tuple] = []
        for item, a, b in zip(batch.column(0).to_pylist(), first[:-1].tolist(), first[1:].tolist()):
            words = [raw[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]
            size = min(WINDOW, len(words))
            if not size:
                continue
            whole = gram_hashes(hashes[a:b], size)
            prints = [whole]
            if size == WINDOW:
                prints.append(_sliding(gram_hashes(hashes[a:b], GRAM), WINDOW - GRAM + 1, True))
            bits = _bits(np.stack(prints, axis=-1)).reshape(len(whole), -1)
            out += [(item, size, _digest(words[i : i + size]), bits[i].tolist()) for i in range(len(whole))]
        columns = list(zip(*out)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([
            pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary()),
            pa.array(columns[3], pa.list_(pa.int64()))], names=["item", "size", "digest", "bits"])


def item_windows(items: DataFrame, item: str, text: str) -> DataFrame:
    """The windows of the benchmark, staged. An item whose id is NULL is the item ''."""
    rows = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return staged(map_arrow(rows, _item_windows, "item string, size int, digest binary, bits array<bigint>"),
                  "windows")


def _filter(windows: DataFrame) -> np.ndarray:
    """The fingerprints of the benchmark as a bit set: at most 2^FILTER_BITS / 64 words reach the driver."""
    bit = windows.select(F.explode("bits").alias("bit")).select(
        F.shiftright("bit", 6).alias("place"), F.expr("shiftleft(1L, CAST(bit & 63 AS INT))").alias("mask"))
    words = np.zeros((1 << FILTER_BITS) // 64, np.int64)
    for place, mask in bit.groupBy("place").agg(F.bit_or("mask")).collect():
        words[place] = mask
    return words.view(np.uint64)


def _candidates(hashes: np.ndarray, first: np.ndarray, sizes: list[int], words: np.ndarray):
    """(position, size) of the windows of a batch whose hashes the filter holds."""
    found = []
    limit = np.repeat(first[1:], np.diff(first))  # end of the text of each word
    at = np.arange(len(hashes))
    for size in sizes:
        if size < WINDOW:
            grams = gram_hashes(hashes, size)
            start = at[: len(grams)]
        else:
            # Windows that reach into the next text only add prints; their spans are left out below.
            grams = gram_hashes(hashes, GRAM)
            hits = np.flatnonzero(fingerprints(grams))
            hits = hits[_held(words, grams[hits])]
            if not len(hits):
                continue
            start = np.unique((hits[:, None] - np.arange(WINDOW - GRAM + 1)).ravel())
            start = start[(start >= 0) & (start + WINDOW <= len(hashes))]
            grams = grams_at(hashes, start, WINDOW)
        inside = start + size <= limit[start]
        start, grams = start[inside], grams[inside]
        start = start[_held(words, grams)]
        found.append((start, np.full(len(start), size)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _document_windows(sizes: list[int], shared) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.frombuffer(shared.value, np.uint64)
        for batch in batches:
            data, starts, ends, first = _words(batch.column(2))
            position, size = _candidates(span_hashes(data, starts, ends), first, sizes, words)
            hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            if len(position):
                row = np.searchsorted(first, position, side="right") - 1
                same: dict[tuple[int, bytes], dict] = {}
                for r, p, n in zip(row.tolist(), position.tolist(), size.tolist()):
                    digest = _digest([data[s:e].tobytes() for s, e in zip(starts[p : p + n], ends[p : p + n])])
                    one = same.get((r, digest))
                    if one is None:
                        one = same[r, digest] = {"digest": digest, "size": n, "starts": []}
                        hits[r].append(one)
                    one["starts"].append(p - int(first[r]))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(np.diff(first), pa.int64()), pa.array(hits, _HIT)],
                names=["_doc", "_key", "n_words", "hits"])

    return run


def contamination(docs: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str) -> DataFrame:
    """Per document: (doc, n_words, n_hit, n_items, items_sha256, contaminated).

    A word is hit when it lies in a run of ``WINDOW`` words that an item has too, or in a whole item of
    fewer words. NULL and empty texts have no words and are clean; an empty benchmark hits nothing; an
    empty table gives no rows. Repeated rows each get the result of their text, a repeated item id is
    one item, NULL ids are kept (the item ''). Extra columns play no part. What is collected: the
    filter and the window sizes (at most ``WINDOW``). A passage that many documents share meets the
    benchmark's distinct windows only; a window that many items share is joined once per set of items.
    """
    spark = docs.sparkSession
    windows = item_windows(items, item, item_text)
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())
    shared = spark.sparkContext.broadcast(_filter(windows).tobytes())
    rows = docs.select(F.col(doc).alias("_doc"), text_key(F.col(text)).alias("_key"), F.col(text).alias("_text"))
    kind = rows.schema["_doc"].dataType.simpleString()
    found = staged(map_arrow(
        rows, _document_windows(sizes, shared),
        f"_doc {kind}, _key bigint, n_words bigint, hits array<struct<digest:binary,size:int,starts:array<int>>>"),
        "document-windows")
    keys = ["_doc", "_key"]
    touched = F.size("hits") > 0

    pairs = windows.select("digest", "item").distinct()
    sets = pairs.groupBy("digest").agg(
        F.count("*").alias("_n"), F.bit_xor(F.xxhash64("item")).alias("_x"),
        F.bit_xor(F.xxhash64("item", F.lit(1))).alias("_y"))
    named = sets.join(sets.groupBy("_n", "_x", "_y").agg(F.min("digest").alias("_set")), ["_n", "_x", "_y"])
    named = staged(named.select("digest", "_set"), "window-sets")

    met = found.where(touched).select(*keys, F.explode("hits").alias("h")).select(
        *keys, F.col("h.digest").alias("digest"), F.transform(
            "h.starts", lambda s: F.struct(s.alias("a"), (s + F.col("h.size")).alias("b"))).alias("at"))
    met = met.groupBy(*keys, "digest").agg(F.first("at").alias("at"))
    met = staged(met.join(named, "digest"), "hits")
    covered = met.groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("at"))).alias("at")).select(
        *keys, F.aggregate("at", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["end"], x["a"]))).alias("n"),
            F.greatest(s["end"], x["b"]).alias("end")), lambda s: s["n"].cast("bigint")).alias("n_hit"))
    members = pairs.join(named.select("_set").distinct().withColumnRenamed("_set", "digest"), "digest")
    listed = met.select(*keys, F.col("_set").alias("digest")).distinct().join(members, "digest").groupBy(*keys).agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    per_text = join_null_safe(covered, listed, keys, "inner")
    some = join_null_safe(found.where(touched).drop("hits"), per_text, keys, "left")
    none = found.where(~touched).drop("hits").withColumns({
        "n_hit": F.lit(None).cast("bigint"), "items": F.lit(None).cast("array<string>")})
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return none.unionByName(some).select(
        F.col("_doc").alias(doc), "n_words", n_hit.alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"), F.col("_key").alias("text_key"))


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """``docs`` without the contaminated ones."""
    prepared(spark)
    judged = contamination(docs, "doc_id", "text", table(spark, folder, "benchmark"), "item_id", "text")
    return without(docs, judged.where("contaminated").select("doc_id", "text_key").distinct())


def query(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), "doc_id", "text",
                         table(spark, folder, "benchmark"), "item_id", "text").drop("text_key")


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
CHECK = f"""
WITH items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS size,
    array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS win
  FROM items, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) u(i) WHERE len(w) > 0),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
dw AS (
  SELECT rid, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM docs, (SELECT DISTINCT size FROM iw) s, unnest(range(1, len(w) - size + 2)) u(i) WHERE len(w) >= size),
hits AS (SELECT rid, i, dw.size AS size, item FROM dw JOIN iw USING (win)),
cover AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT rid, i, size FROM hits), unnest(range(i, i + size)) u(p) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN cover USING (rid) LEFT JOIN named USING (rid)
"""
