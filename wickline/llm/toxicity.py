"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(b + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j), with x_i = 1 / sqrt(number of
terms) for the distinct terms of a text: words, and the beginnings of longer words. The pair sum takes
time linear in the terms. Terms too rare in the sample to learn from have no weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm.common import LOWER, map_arrow, mix, prepared, span_hashes, spans, table, text_key, utf8, without
from wickline.llm.learning import Example, PER_CLASS, examples, remainder, sample

BITS = 18
FACTORS = 4
BEGINNINGS = (4, 5, 6, 7, 8)
LEAST_DOCUMENTS = 3
EPOCHS = 15
RATE = 2.0
DECAY = 1e-5
HELD_OUT = (5, 0)

WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, row of each) of all terms of a batch, in no order and with repeats."""
    data = LOWER[data]
    starts, ends, first = spans(data, offsets, WORD_BYTES)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    hashes, rows = [span_hashes(data, starts, ends)], [row]
    for n in BEGINNINGS:
        longer = ends - starts > n
        hashes.append(mix(span_hashes(data, starts[longer], starts[longer] + n) + np.uint64(n)))
        rows.append(row[longer])
    return (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(rows)


def features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    index = np.unique(_terms(data, np.array([0, len(data)]))[0])
    return index, np.ones(len(index), np.float32)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    known: np.ndarray


def train(found: list[Example], epochs: int = EPOCHS, rate: float = RATE, decay: float = DECAY, seed: int = 0) -> Machine:
    """Stochastic gradient descent on the logistic loss, one document a step."""
    rng = np.random.default_rng(seed)
    seen = np.zeros(1 << BITS, np.int32)
    for one in found:
        seen[one.index] += 1
    known = seen >= LEAST_DOCUMENTS
    linear = np.zeros(1 << BITS, np.float32)
    factors = (rng.standard_normal((1 << BITS, FACTORS)) * 0.01).astype(np.float32)
    sizes = np.bincount([e.label for e in found], minlength=2)
    bias = -1.0 if sizes.sum() else 0.0
    lift = np.sqrt(max(1.0, sizes[0] / max(1, sizes[1])))
    rows = [(one.index[known[one.index]], one.label) for one in found]
    for epoch in range(epochs):
        step = rate / (1 + epoch / 2)
        for k in rng.permutation(len(rows)):
            index, label = rows[k]
            scale = max(1, len(index)) ** -0.5
            v = factors[index]
            total = v.sum(0) * scale
            logit = bias + linear[index].sum() * scale + ((total**2).sum() - (v**2).sum() * scale**2) / 2
            wrong = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label
            if label:
                wrong *= lift
            if abs(wrong) < 1e-2:
                continue
            bias -= step * wrong
            linear[index] -= step * (wrong * scale + decay * linear[index])
            factors[index] -= step * (wrong * (total * scale - v * scale**2) + decay * v)
    return Machine(float(bias), linear, factors, known)


def logits(machine: Machine, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    index, row = _terms(data, offsets)
    keep = machine.known[index]
    pairs = np.unique((row[keep] << BITS) | index[keep])
    row, index = pairs >> BITS, pairs & ((1 << BITS) - 1)
    n = len(offsets) - 1
    scale = np.maximum(1, np.bincount(row, minlength=n)) ** -0.5

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=values, minlength=n)

    v = machine.factors[index].astype(np.float64)
    out = machine.bias + total(machine.linear[index]) * scale
    for f in range(v.shape[1]):
        out += ((total(v[:, f]) * scale) ** 2 - total(v[:, f] ** 2) * scale**2) / 2
    return out


def scored(df: DataFrame, text: str, machine: Machine) -> DataFrame:
    """``df`` without ``text``, with ``score`` and ``predicted``."""
    shared = df.sparkSession.sparkContext.broadcast(machine)
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = 1 / (1 + np.exp(-np.clip(logits(shared.value, *utf8(batch.column(place))), -500, 500)))
            kept = [batch.column(i) for i in range(batch.num_columns) if i != place]
            names = [n for i, n in enumerate(batch.schema.names) if i != place]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score, pa.float64()),
                                              pa.array((score >= 0.5).astype(np.int32))],
                                             names=[*names, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text)
    return map_arrow(df, run, f"{schema}, score double, predicted int")


def toxicity(
    docs: DataFrame, doc: str, text: str, labels: DataFrame, label_doc: str, label: str,
    held_out: tuple[int, int] = HELD_OUT, per_class: int = PER_CLASS,
) -> DataFrame:
    """Score every text whole: (doc, held_out, score, predicted, text_key).

    Learns from at most ``per_class`` labelled documents of each class whose id is not held out. NULL
    and empty texts, and texts without known terms, get the score of the bias alone; without usable
    labels that is 0.5. A NULL id is not held out. Repeated rows each get their text's score; extra
    columns play no part; an empty table gives no rows.
    """
    parts, part = held_out
    rows = sample(docs, doc, text, labels, label_doc, label,
                  lambda d: remainder(d, parts) != part, per_class)
    machine = train(examples(rows, features))
    kept = docs.select(F.col(doc).alias("doc"), (remainder(F.col(doc), parts) == part).alias("held_out"),
                       text_key(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    return scored(kept, "text", machine).withColumnRenamed("doc", doc)


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """``docs`` without the documents predicted toxic."""
    prepared(spark)
    judged = toxicity(docs, "doc_id", "text", table(spark, folder, "labels"), "doc_id", "toxic")
    return without(docs, judged.where("predicted = 1").select("doc_id", "text_key").distinct())


def query(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), "doc_id", "text",
                    table(spark, folder, "labels"), "doc_id", "toxic").drop("text_key")
