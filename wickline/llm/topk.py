"""Exact top-k inner product search by MaxScore over shards.

A term is a dimension; its posting list holds the weight of every vector of a shard. A query bounds
each term by the largest product that the shard allows. Given a threshold from a few exactly scored
vectors, the terms of the smallest bounds that cannot reach it even together are non-essential: the
essential postings are traversed for all vectors, the others are probed, largest bound first, only for
vectors that can still compete. Queries and vectors meet as blocks; the shards' best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickline.llm.common import map_arrow, prepared, table
from wickline.session import staged

BEST = 5
SCALE = 256
QUERY_STEP = 50
# Weights in a shard and in a block of queries; 8 bytes each, so both are a few megabytes.
SHARD_CELLS = 1 << 18
BLOCK_CELLS = 1 << 16
SEEDS = 32
SEED_TERMS = 8
PROBES = 4
# Sums of products below this are exact as doubles, their bounds too.
EXACT = 1 << 51


def codes(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, row, codes): floor(scale * component) of the usable vectors, staged. ``row`` tells rows of one id apart.

    Vectors that are NULL or hold a NULL or non-finite component take no part, nor do rows without an id.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite)
    floors = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return staged(rows.select(F.col(key).cast("bigint").alias("id"), floors.alias("codes")).withColumn(
        "row", F.monotonically_increasing_id()), "codes")


def _blocks(rows: DataFrame, count: int, name: str, width: int) -> DataFrame:
    """(name, ids, rows, weights): ``count`` blocks of about equal size, chosen by a hash of the row."""
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("id", "ascending"), ("row", "ascending")])
        lists = group.column("codes").to_pylist()
        weights = np.zeros((len(lists), width), np.int64)
        for i, one in enumerate(lists):
            weights[i, : len(one)] = one
        ids, numbers = (group.column(c).to_numpy().astype(np.int64) for c in ("id", "row"))
        return pa.table({name: pa.array([group.column(name)[0].as_py()], pa.int32()),
                         f"{name}_ids": [ids.tobytes()], f"{name}_rows": [numbers.tobytes()],
                         f"{name}_weights": [weights.T.tobytes()]})

    keyed = rows.withColumn(name, F.pmod(F.xxhash64("row"), F.lit(count)).cast("int"))
    return keyed.groupBy(name).applyInArrow(
        pack, f"{name} int, {name}_ids binary, {name}_rows binary, {name}_weights binary")


class Shard:
    """Posting lists of a block of vectors: ``postings[term]`` has the weight of each vector."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, postings: np.ndarray):
        self.ids, self.rows, self.postings = ids, rows, postings
        self.most = postings.max(axis=1) if len(ids) else np.zeros(len(postings))
        self.least = postings.min(axis=1) if len(ids) else np.zeros(len(postings))

    def search(self, own: int, query: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the ``best`` vectors by score, ties to the smaller id, row ``own`` left out."""
        others = np.flatnonzero(self.rows != own)
        high = np.maximum(query * self.most, query * self.least)
        low = np.minimum(query * self.most, query * self.least)
        order = np.argsort(high - low, kind="stable")[::-1]
        threshold = None
        if len(others) > max(best, SEEDS):
            first = order[:SEED_TERMS]
            partial = query[first] @ self.postings[first]
            seeds = np.argpartition(partial, len(partial) - SEEDS - 1)[-SEEDS - 1:]
            seeds = seeds[self.rows[seeds] != own]
            if len(seeds) >= best:
                threshold = np.sort(query @ self.postings[:, seeds])[-best]
        if threshold is None:
            found, total = others, query @ self.postings[:, others]
        else:
            # rest[i]: what the terms from place i on can add at most, over what they add at least.
            spread = (high - low)[order]
            rest = np.append(np.cumsum(spread[::-1])[::-1], 0)
            base = low.sum()
            essential = int(np.argmax(rest + base < threshold)) if (rest + base < threshold).any() else len(order)
            terms = order[:essential]
            total = query[terms] @ self.postings[terms]
            reach = np.append(np.cumsum(high[order][::-1])[::-1], 0)
            found = others[total[others] + reach[essential] >= threshold]
            total = total[found]
            place = essential
            while place < len(order):
                terms = order[place : place + PROBES]
                total = total + query[terms] @ self.postings[np.ix_(terms, found)]
                place += len(terms)
                live = total + reach[min(place, len(order))] >= threshold
                found, total = found[live], total[live]
        top = np.lexsort((self.ids[found], -total))[:best]
        return self.ids[found][top], total[top]


def _matrix(blob: bytes, width: int) -> np.ndarray:
    return np.frombuffer(blob, np.int64).reshape(width, -1)


def _exact(queries: np.ndarray, postings: np.ndarray) -> bool:
    """Whether doubles hold every partial sum."""
    def largest(x: np.ndarray) -> np.ndarray:
        return np.abs(x.astype(np.float64)).max(axis=1, initial=0)

    return float(largest(queries) @ largest(postings)) < EXACT


def top_k(
    df: DataFrame, key: str, vector: str, best: int = BEST, step: int = QUERY_STEP, scale: int = SCALE
) -> DataFrame:
    """Of each vector whose id is divisible by ``step``, the ``best`` other vectors:
    (query_id, rank, vec_id, score).

    Scores are integer inner products, ties go to the smaller id; shorter vectors count as filled up
    with zeros. With fewer vectors all are returned; an empty table gives no rows. See ``codes`` for NULLs.
    Rows of one id are rows of their own: each of them is a query, and a candidate of the others. Extra
    columns play no part. A score beyond 64 bits raises an error.
    """
    prepared(df.sparkSession)
    rows = codes(df, key, vector, scale)
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("codes")), F.lit(0))).first()
    asked = rows.where(F.pmod("id", F.lit(step)) == 0)
    width = max(1, width)
    shards = max(1, -(-n * width // SHARD_CELLS))
    blocks = max(1, -(-asked.count() * width // BLOCK_CELLS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_ids, q_rows, q_weights, v_ids, v_rows, v_weights in zip(*(c.to_pylist() for c in batch.columns)):
                queries, postings = _matrix(q_weights, width), _matrix(v_weights, width)
                kind = np.float64 if _exact(queries, postings) else object
                shard = Shard(*(np.frombuffer(x, np.int64) for x in (v_ids, v_rows)), postings.astype(kind))
                out: list[tuple[int, int, int, int]] = []
                asking = zip(*(np.frombuffer(x, np.int64).tolist() for x in (q_ids, q_rows)), queries.T.astype(kind))
                for one, own, query in asking:
                    ids, scores = shard.search(own, query, best)
                    out += [(one, own, i, int(s)) for i, s in zip(ids.tolist(), scores.tolist())]
                columns = list(zip(*out)) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["query_id", "query_row", "vec_id", "score"])

    spread = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    left = _blocks(asked, blocks, "block", width).withColumn("shard", spread)
    right = _blocks(rows, shards, "shard", width)
    met = left.repartition(shards, "shard").join(right.repartition(shards, "shard"), "shard")
    found = map_arrow(met.select("block_ids", "block_rows", "block_weights", "shard_ids", "shard_rows", "shard_weights"), run,
                      "query_id bigint, query_row bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    merged = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return merged.select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), "vec_id", "embedding")


CHECK = f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.rid, q.vec_id AS query_id, v.vec_id AS vec_id, list_inner_product(q.c, v.c)::BIGINT AS score
  FROM v q JOIN v ON q.rid <> v.rid WHERE q.vec_id % {QUERY_STEP} = 0)
SELECT query_id, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= {BEST}
"""
