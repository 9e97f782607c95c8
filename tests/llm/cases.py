"""Small tables with the awkward rows that every operator meets."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside; they must not clash.
CLASHING = ["_doc", "_key", "text_key", "shard", "score", "spans", "node", "group", "hits", "_slim", "size"]


def documents(spark, rows, extra=()):
    """``rows``: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", None) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for name in extra:
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("own"))
    return df


def prose(seed: int, words: int, vocabulary: int = 5000) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(words))
