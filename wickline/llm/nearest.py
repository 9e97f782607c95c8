"""Approximate nearest neighbours by cosine: one hierarchical navigable small-world graph per shard.

Equal vectors are one node. The nodes of a shard are ordered by their level, so that each layer holds the
first nodes and its links are one flat array: row i has the neighbours of node i. Graphs are built and
searched in batches, vectorised over the vectors of a batch; they are staged, and every block of queries
searches every shard. The shards' best are scored in double precision and merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickline.llm.common import map_arrow, mix, prepared, table
from wickline.session import staged

BEST = 5
QUERY_STEP = 50
# Components in a shard and in a block of queries: 2 MB and a quarter of one, as floats.
SHARD_CELLS = 1 << 19
BLOCK_CELLS = 1 << 16
# Links of a node in the upper layers (twice as many in the lowest), and nodes kept while searching.
LINKS = 16
BUILD_WIDTH = 100
SEARCH_WIDTH = 128
UPPER_WIDTH = 8
# Vectors inserted or searched together, and nodes of one search expanded together.
BATCH = 256
EXPANDED = 4
_SALT = np.uint64(0xD6E8FEB86659FD93)


def _beam(
    vectors: np.ndarray, queries: np.ndarray, links: np.ndarray, entry: np.ndarray, nodes: int, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Search one layer for every query: (nodes, similarities), best first; -1 where fewer were met.

    ``entry`` has the nodes to begin with (-1 for none) of each query; the layer holds ``nodes`` nodes.
    """
    n = len(queries)
    seen = np.zeros((n, nodes + 1), bool)
    seen[:, -1] = True
    ids = np.full((n, width), -1)
    sims = np.full((n, width), -np.inf, np.float32)
    open_ = np.zeros((n, width), bool)
    live, fresh = np.arange(n), np.sort(entry, axis=1)
    while len(live):
        # What is new among the neighbours of the expanded nodes.
        new = ~seen[live[:, None], fresh]
        new[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
        row, col = np.nonzero(new)
        met = fresh[row, col]
        seen[live[row], met] = True
        found = np.full(fresh.shape, -np.inf, np.float32)
        found[row, col] = np.einsum("nd,nd->n", vectors[met], queries[live[row]])
        both = np.concatenate([sims[live], found], axis=1)
        best = np.argpartition(-both, width - 1, axis=1)[:, :width]
        sims[live] = np.take_along_axis(both, best, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], np.where(new, fresh, -1)], axis=1), best, 1)
        open_[live] = np.take_along_axis(np.concatenate([open_[live], new], axis=1), best, 1)
        # The best nodes not expanded yet; a search is over when there are none.
        left = np.where(open_[live], sims[live], -np.inf)
        count = min(EXPANDED, width)
        pick = np.argpartition(-left, count - 1, axis=1)[:, :count]
        taken = np.take_along_axis(left, pick, 1) > -np.inf
        going = taken.any(axis=1)
        live, pick, taken = live[going], pick[going], taken[going]
        open_[live[:, None], pick] = False
        around = links[np.where(taken, ids[live[:, None], pick], 0)]
        around[~taken] = -1
        fresh = np.sort(around.reshape(len(live), count * links.shape[1]), axis=1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _chosen(vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` neighbours of each row of candidates (best first, -1 for none), -1 filled.

    First those nearer to the node than to any neighbour chosen before, then the nearest of the others.
    """
    out = np.full((len(ids), most), -1)
    for a in range(0, len(ids), BATCH):
        own, near = ids[a : a + BATCH], sims[a : a + BATCH]
        held = vectors[own]
        among = held @ held.transpose(0, 2, 1)
        closest = np.full(own.shape, -np.inf, np.float32)
        kept = np.zeros(own.shape, bool)
        for c in range(own.shape[1]):
            good = (own[:, c] >= 0) & (closest[:, c] < near[:, c])
            kept[:, c] = good
            closest[good] = np.maximum(closest[good], among[good, c])
        rank = np.argsort(np.where(own < 0, 2, np.where(kept, 0, 1)), axis=1, kind="stable")[:, :most]
        best = np.take_along_axis(own, rank, 1)
        out[a : a + BATCH, : best.shape[1]] = best
    return out


@dataclass
class Graph:
    """``links[l]`` are the neighbours of the first nodes, those of layer ``l``; node 0 is in all layers."""

    vectors: np.ndarray
    links: list[np.ndarray]

    @classmethod
    def build(cls, vectors: np.ndarray, keys: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH):
        """(graph, order of the nodes). Levels are drawn by the hash of ``keys``."""
        draw = (mix(keys.astype(np.int64).view(np.uint64) ^ _SALT).astype(np.float64) + 1) / 2.0**64
        levels = np.floor(-np.log(np.minimum(draw, 1)) / np.log(links)).astype(np.int64)
        order = np.lexsort((keys, -levels))
        vectors, levels = np.ascontiguousarray(vectors[order], np.float32), levels[order]
        layers = int(levels[0]) + 1 if len(levels) else 1
        sizes = [int((levels >= layer).sum()) for layer in range(layers)]
        graph = cls(vectors, [np.full((size, links * (1 if layer else 2)), -1) for layer, size in enumerate(sizes)])
        start, stop = 0, min(len(vectors), BATCH // 4)
        while start < len(vectors):
            graph._insert(start, stop, links, width)
            start, stop = stop, min(len(vectors), stop + min(stop, BATCH))
        return graph, order

    def _insert(self, start: int, stop: int, most: int, width: int) -> None:
        own = self.vectors[start:stop]
        mates = own @ own.T
        np.fill_diagonal(mates, -np.inf)
        entry = np.full((len(own), 1), 0 if start else -1)
        for layer in range(len(self.links) - 1, -1, -1):
            here = min(start, len(self.links[layer]))
            new = len(self.links[layer]) - start
            met, sims = (_beam(self.vectors, own, self.links[layer], entry, here, width if new > 0 else UPPER_WIDTH)
                         if here else (np.full((len(own), 1), -1), np.full((len(own), 1), -np.inf, np.float32)))
            entry = met[:, :UPPER_WIDTH]
            if new <= 0:
                continue
            new = min(new, len(own))
            # Candidates: the nodes met, and the others that are inserted at the same time.
            ids = np.concatenate([met[:new], np.tile(np.arange(start, start + new), (new, 1))], axis=1)
            near = np.concatenate([sims[:new], mates[:new, :new]], axis=1)
            ids = np.where(near > -np.inf, ids, -1)
            best = np.argsort(-near, axis=1, kind="stable")[:, :width]
            ids, near = np.take_along_axis(ids, best, 1), np.take_along_axis(near, best, 1)
            picked = _chosen(self.vectors, ids, near, most)
            self.links[layer][start : start + new, :most] = picked
            self._answer(layer, start, picked)

    def _answer(self, layer: int, start: int, picked: np.ndarray) -> None:
        """Link back from the chosen neighbours; a node with too many links chooses among them."""
        links = self.links[layer]
        row, col = np.nonzero(picked >= 0)
        target, source = picked[row, col], row + start
        sim = np.einsum("nd,nd->n", self.vectors[target], self.vectors[source])
        order = np.lexsort((-sim, target))
        target, source, sim = target[order], source[order], sim[order]
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        most = links.shape[1]
        place = np.arange(len(target)) - np.repeat(first, counts)
        kept = place < most
        ids = np.full((len(nodes), 2 * most), -1)
        ids[:, :most] = links[nodes]
        ids[np.repeat(np.arange(len(nodes)), counts)[kept], most + place[kept]] = source[kept]
        # A new node that chose a target may be among the target's own choices.
        ids.sort(axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        for a in range(0, len(nodes), BATCH):
            part = ids[a : a + BATCH]
            near = np.einsum("jcd,jd->jc", self.vectors[part], self.vectors[nodes[a : a + BATCH]])
            near[part < 0] = -np.inf
            best = np.argsort(-near, axis=1, kind="stable")
            part, near = np.take_along_axis(part, best, 1), np.take_along_axis(near, best, 1)
            full = (part[:, most:] >= 0).any(axis=1)
            out = part[:, :most].copy()
            if full.any():
                out[full] = _chosen(self.vectors, part[full], near[full], most)
            links[nodes[a : a + BATCH]] = out

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """The nodes met nearest to each query, best first; -1 filled."""
        out = []
        for a in range(0, len(queries), BATCH):
            own = queries[a : a + BATCH]
            entry = np.zeros((len(own), 1), np.int64)
            for layer in range(len(self.links) - 1, -1, -1):
                met, _ = _beam(self.vectors, own, self.links[layer], entry, len(self.links[layer]),
                               UPPER_WIDTH if layer else width)
                entry = met[:, :UPPER_WIDTH]
            out.append(met)
        return np.concatenate(out)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, in single precision, for the graph."""
    return (vectors / np.sqrt(np.einsum("nd,nd->n", vectors, vectors))[:, None]).astype(np.float32)


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as doubles, filled up with zeros and scaled by a power of two each, so that no product overflows."""
    lists = lists.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    out[np.arange(width)[None] < sizes[:, None]] = lists.flatten().to_numpy()
    _, power = np.frexp(np.abs(out).max(axis=1, initial=0))
    return np.ldexp(out, -power[:, None])


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(row, id, vector) of the rows that take part, as doubles; staged. ``row`` tells repeated ids apart."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite & some)
    rows = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """(vector, members): the ``most`` smallest (id, row) of each vector.

    The limit is applied before the shuffle too, so a vector that most rows share sends few of them.
    """
    order = Window.partitionBy("vector").orderBy("id", "row")
    few = rows.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= most)
    return few.groupBy("vector").agg(F.array_sort(F.collect_list(F.struct("id", "row"))).alias("members"))


_GRAPH = "shard int, ids array<array<bigint>>, rows array<array<bigint>>, vectors binary, sizes array<int>, links array<binary>"


def graphs(nodes: DataFrame, shards: int, width: int, links: int = LINKS, build_width: int = BUILD_WIDTH) -> DataFrame:
    """One row per shard (``_GRAPH``), staged. A hash of the vector deals out the nodes."""
    def build(group: pa.Table) -> pa.Table:
        vectors = _matrix(group.column("vector"), width)
        members = group.column("members").combine_chunks()
        keys = members.flatten().field("id").to_numpy()[members.offsets.to_numpy()[:-1]]
        graph, order = Graph.build(_unit(vectors), keys, links, build_width)
        lists = members.take(pa.array(order)).to_pylist()
        return pa.table({
            "shard": pa.array([group.column("shard")[0].as_py()], pa.int32()),
            "ids": pa.array([[[m["id"] for m in one] for one in lists]], pa.list_(pa.list_(pa.int64()))),
            "rows": pa.array([[[m["row"] for m in one] for one in lists]], pa.list_(pa.list_(pa.int64()))),
            "vectors": [np.ascontiguousarray(vectors[order]).tobytes()],
            "sizes": pa.array([[x for layer in graph.links for x in layer.shape]], pa.list_(pa.int32())),
            "links": [[layer.astype(np.int32).tobytes() for layer in graph.links]]})

    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))
    # Building costs far more than its bytes tell: every shard is a task of its own, however small it is.
    return staged(dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(build, _GRAPH), "graphs")


def nearest(
    df: DataFrame, key: str, vector: str, best: int = BEST, step: int = QUERY_STEP, width: int = SEARCH_WIDTH,
    links: int = LINKS, build_width: int = BUILD_WIDTH,
) -> DataFrame:
    """Of each vector whose id is divisible by ``step``, the ``best`` nearest other rows found:
    (query_id, rank, vec_id, score).

    ``score`` is the cosine of the original vectors in double precision; ties go to the smaller id. Shorter
    vectors count as filled up with zeros. Vectors that are NULL, zero or hold a NULL or non-finite component
    take no part, nor do rows without an id. Rows of one id are rows of their own: each of them is a query and
    a candidate of the others. With fewer candidates all are returned; an empty table gives no rows.
    Extra columns, whatever their names, play no part.
    """
    prepared(df.sparkSession)
    rows = usable(df, key, vector)
    size = rows.agg(F.coalesce(F.max(F.size("vector")), F.lit(1))).first()[0]
    nodes = staged(distinct_vectors(rows, best + 1), "nodes")
    asked = rows.where(F.pmod("id", F.lit(step)) == 0)
    shards = max(1, -(-nodes.count() * size // SHARD_CELLS))
    blocks = max(1, -(-asked.count() * size // BLOCK_CELLS))
    index = graphs(nodes, shards, size, links, build_width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.to_pylist():
                vectors = np.frombuffer(one["vectors"]).reshape(-1, size)
                shapes = np.array(one["sizes"]).reshape(-1, 2)
                graph = Graph(_unit(vectors), [np.frombuffer(b, np.int32).reshape(s).astype(np.int64)
                                               for b, s in zip(one["links"], shapes)])
                queries = np.frombuffer(one["q_vectors"]).reshape(-1, size)
                met = graph.search(_unit(queries), max(width, best + 1))
                lengths = [np.sqrt(np.einsum("nd,nd->n", x, x)) for x in (vectors, queries)]
                out: list[tuple] = []
                for i, (q, own) in enumerate(zip(one["q_ids"], one["q_rows"])):
                    some = met[i][met[i] >= 0]
                    scores = vectors[some] @ queries[i] / (lengths[0][some] * lengths[1][i])
                    held = [(-s, v, r) for s, k in zip(scores.tolist(), some.tolist())
                            for v, r in zip(one["ids"][k], one["rows"][k]) if r != own]
                    out += [(q, own, v, r, -s) for s, v, r in sorted(held)[:best]]
                columns = list(zip(*out)) if out else [[]] * 5
                kinds = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 names=["query_id", "query_row", "vec_id", "row", "score"])

    def pack(group: pa.Table) -> pa.Table:
        return pa.table({"block": pa.array([group.column("block")[0].as_py()], pa.int32()),
                         "q_ids": pa.array([group.column("id").to_pylist()], pa.list_(pa.int64())),
                         "q_rows": pa.array([group.column("row").to_pylist()], pa.list_(pa.int64())),
                         "q_vectors": [_matrix(group.column("vector"), size).tobytes()]})

    dealt = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    left = dealt.groupBy("block").applyInArrow(
        pack, "block int, q_ids array<bigint>, q_rows array<bigint>, q_vectors binary").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    met = left.drop("block").repartition(shards, "shard").join(index.repartition(shards, "shard"), "shard").drop("shard")
    found = map_arrow(met, run, "query_id bigint, query_row bigint, vec_id bigint, row bigint, score double")
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id", "row")
    merged = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return merged.select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), "vec_id", "embedding")
