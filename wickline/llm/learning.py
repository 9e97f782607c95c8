"""What the trained operators share: who may be learned from, the bounded sample, its way to the driver."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import map_arrow
from wickline.session import staged

# The sample: at most so many labelled documents of each class, and so many distinct features in all
# (8 bytes each). The rest of the labels is not looked at.
PER_CLASS = 3000
FEATURES = 6_000_000


@dataclass
class Example:
    label: int
    index: np.ndarray
    weight: np.ndarray


def remainder(doc: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; -1 for a NULL id, which is never held out or learned from."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % parts, F.lit(-1))


def sample(
    docs: DataFrame, doc: str, text: str, labels: DataFrame, label_doc: str, label: str,
    usable: Callable[[Column], Column], per_class: int = PER_CLASS,
) -> DataFrame:
    """(_order, _label, _text): labelled documents in a hash order of their ids, at most ``per_class`` a class.

    Labels other than 0 and 1 are ignored; of several labels of one document the greatest counts, of
    several texts of one id the least. The id lists have at most 2 * ``per_class`` rows, so they are
    broadcast; texts of a repeated id shrink to one before the shuffle.
    """
    known = labels.select(F.col(label_doc).alias("_id"), F.col(label).cast("int").alias("_label"))
    known = known.where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & usable(F.col("_id")))
    known = known.groupBy("_id").agg(F.max("_label").alias("_label")).withColumn("_order", F.xxhash64("_id"))
    present = docs.select(F.col(doc).alias("_id")).where(F.col("_id").isNotNull())
    known = staged(known.join(present, "_id", "left_semi"), "labelled")
    chosen = [known.where(F.col("_label") == c).orderBy("_order", "_id").limit(per_class) for c in (0, 1)]
    chosen = staged(chosen[0].unionByName(chosen[1]), "chosen")
    texts = docs.select(F.col(doc).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_order", "_label").agg(
        F.min("_text").alias("_text")).select("_order", "_label", "_text")


def examples(
    rows: DataFrame, features: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], limit: int = FEATURES
) -> list[Example]:
    """The sample's sparse features, in the sample's order, up to ``limit`` features in all.

    A text with more than its share, a quarter of ``limit``, is no example: the sample only fits the model.
    ``features`` maps the bytes of one text to (indices as int32, weights as float32).
    """
    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(2).to_pylist():
                index, weight = features(np.frombuffer(text.encode(), np.uint8))
                out.append((len(index), index.astype(np.int32).tobytes(), weight.astype(np.float32).tobytes()))
            n, index, weight = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(index, pa.binary()),
                pa.array(weight, pa.binary())], names=["_order", "_label", "n", "index", "weight"])

    sparse = staged(map_arrow(rows, run, "_order bigint, _label int, n int, index binary, weight binary"), "sample")
    sparse = sparse.where(F.col("n") <= limit // 4)
    sizes = sorted((r[0], r[1], r[2]) for r in sparse.select("_order", "_label", "n").collect())
    fits = np.cumsum([n for _, _, n in sizes]) <= limit
    if not len(sizes):
        return []
    last = sizes[int(fits.sum()) - 1][0]
    found = sparse.where(F.col("_order") <= F.lit(last)).orderBy("_order", "_label").collect()
    return [Example(r["_label"], np.frombuffer(r["index"], np.int32), np.frombuffer(r["weight"], np.float32))
            for r in found]
