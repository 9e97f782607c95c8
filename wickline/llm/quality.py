"""Quality classifier: hashed word and character n-gram vectors, averaged per document, softmax output.

The vectors and the output layer are trained by stochastic gradient descent on a bounded sample. To
score, the two softmax logits of an average are the average of each feature's logit difference, so the
model is folded into one number per bucket; texts of any length are scored whole, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm.common import HASH_BYTES, map_arrow, mix, span_hashes, spans, table, utf8
from wickline.llm.learning import Example, examples, remainder, sample

BITS = 18
DIMENSIONS = 8
GRAMS = (3, 4, 5)
EPOCHS = 6
RATE = 0.3
PER_CLASS = 1500
HELD_OUT = (3, 1)
# Logit differences are summed as whole multiples of 2^-20: the sum does not depend on the order.
UNIT = 1 << 20

# Words are runs of bytes other than white space; character n-grams are taken of the bytes of a word.
INK = np.ones(256, bool)
INK[[9, 10, 11, 12, 13, 32]] = False
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Buckets of two features that are not hashed: the end that every text has, and a word said again.
END, AGAIN = 0, 1


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _word_buckets(data: np.ndarray, offsets: np.ndarray):
    """(buckets of words, which words repeat the word before, first word of each text)."""
    starts, ends, first = spans(data, offsets, INK)
    hashes = span_hashes(data, starts, ends)
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[first[:-1][first[:-1] < len(hashes)]] = False
    return _bucket(hashes), again, first


def _gram_buckets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of n-grams: (first byte, buckets by starting byte, which of them lie within a word)."""
    for low in range(0, len(data), HASH_BYTES):
        high = min(len(data), low + HASH_BYTES)
        block = data[low : min(len(data), high + max(GRAMS) - 1)]
        inside = INK[block]
        borders = offsets[1:-1]
        borders = borders[(borders > low) & (borders < low + len(block))] - low
        total = np.zeros(len(block), np.uint64)
        valid = np.ones(len(block), bool)
        for n in range(1, max(GRAMS) + 1):
            keep = len(block) - n + 1
            if keep <= 0:
                break
            total, valid = total[:keep], valid[:keep]
            with np.errstate(over="ignore"):
                total = total * _STEP + block[n - 1 :]
            valid = valid & inside[n - 1 :]
            if n > 1:
                crossing = borders - (n - 1)
                valid[crossing[(crossing >= 0) & (crossing < keep)]] = False
            if n in GRAMS:
                own = min(keep, high - low)
                yield low, _bucket(mix(total[:own] + np.uint64(n))), valid[:own]


def features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, shares) of one text; the shares add up to 1."""
    offsets = np.array([0, len(data)])
    words, again, _ = _word_buckets(data, offsets)
    parts = [np.array([END]), words, np.full(int(again.sum()), AGAIN)]
    parts += [buckets[valid] for _, buckets, valid in _gram_buckets(data, offsets)]
    index, count = np.unique(np.concatenate(parts), return_counts=True)
    return index, count / count.sum()


@dataclass
class Model:
    """Feature vectors and output layer; ``fold`` is the logit difference of each bucket."""

    vectors: np.ndarray
    output: np.ndarray
    fold: np.ndarray


def train(found: list[Example], epochs: int = EPOCHS, rate: float = RATE, seed: int = 1) -> Model:
    """Stochastic gradient descent, one document a step, the rarer class weighted up."""
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((1 << BITS, DIMENSIONS)) - 0.5) / DIMENSIONS).astype(np.float32)
    output = np.zeros((DIMENSIONS, 2), np.float32)
    sizes = np.bincount([e.label for e in found], minlength=2)
    weight = np.sqrt(len(found) / (2 * np.maximum(sizes, 1)))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for k in rng.permutation(len(found)):
            one = found[k]
            hidden = one.weight @ vectors[one.index]
            logits = hidden @ output
            share = np.exp(logits - logits.max())
            share /= share.sum()
            share[one.label] -= 1
            share *= weight[one.label]
            back = output @ share
            output -= step * np.outer(hidden, share)
            vectors[one.index] -= step * back
    fold = np.rint((vectors @ (output[:, 1] - output[:, 0])).astype(np.float64) * UNIT).astype(np.int64)
    return Model(vectors, output, fold)


def logits(fold: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Logit difference of every text of a batch."""
    def by_text(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(values))[edges])

    words, again, first = _word_buckets(data, offsets)
    total = fold[END] + by_text(fold[words] + np.where(again, fold[AGAIN], 0), first)
    count = 1 + np.diff(first) + by_text(again.astype(np.int64), first)
    for low, buckets, valid in _gram_buckets(data, offsets):
        edges = np.clip(offsets - low, 0, len(buckets))
        total = total + by_text(np.where(valid, fold[buckets], 0), edges)
        count = count + by_text(valid.astype(np.int64), edges)
    return total / count / UNIT


def scored(df: DataFrame, doc: str, text: str, fold: np.ndarray) -> DataFrame:
    """``df`` with ``score``, the chance that its text is of class 1, and ``predicted``."""
    shared = df.sparkSession.sparkContext.broadcast(fold)
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(place))
            score = 1 / (1 + np.exp(-np.clip(logits(shared.value, data, offsets), -500, 500)))
            kept = [batch.column(i) for i in range(batch.num_columns) if i != place]
            names = [n for i, n in enumerate(batch.schema.names) if i != place]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score, pa.float64()),
                                              pa.array((score >= 0.5).astype(np.int32))],
                                             names=[*names, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text)
    return map_arrow(df, run, f"{schema}, score double, predicted int")


def quality(
    docs: DataFrame, doc: str, text: str, labels: DataFrame, label_doc: str, label: str,
    held_out: tuple[int, int] = HELD_OUT, per_class: int = PER_CLASS,
) -> DataFrame:
    """Score every text whole: (doc, held_out, score, predicted).

    Learns from at most ``per_class`` labelled documents of each class whose id is not held out. NULL
    and empty texts have the one feature that every text has. Without usable labels every score is
    0.5. A NULL id is not held out. Repeated rows each get their text's score; extra columns play no
    part; an empty table gives no rows.
    """
    parts, part = held_out
    rows = sample(docs, doc, text, labels, label_doc, label,
                  lambda d: remainder(d, parts) != part, per_class)
    model = train(examples(rows, features))
    kept = docs.select(F.col(doc).alias("doc"), (remainder(F.col(doc), parts) == part).alias("held_out"),
                       F.col(text).alias("text"))
    return scored(kept, "doc", "text", model.fold).withColumnRenamed("doc", doc)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"), "doc_id", "text",
                   table(spark, folder, "labels"), "doc_id", "quality")
