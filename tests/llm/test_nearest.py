import math
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from wickline.llm import nearest
from wickline.llm.common import table

SCHEMA = "vec_id bigint, embedding array<float>"


def single(vector):
    return None if vector is None else [None if x is None else float(np.float32(x)) for x in vector]


def brute(rows, best=5, step=50):
    """(query_id, rank, vec_id, score) of every query row, from all pairs."""
    good = [(k, v) for k, v in ((k, single(v)) for k, v in rows) if k is not None and v and any(v)
            and all(x is not None and math.isfinite(x) for x in v)]
    size = max((len(v) for _, v in good), default=1)
    matrix = np.array([v + [0.0] * (size - len(v)) for _, v in good]).reshape(-1, size)
    unit = matrix / np.abs(matrix).max(axis=1, initial=1e-300)[:, None]
    unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
    out = []
    for i, (q, _) in enumerate(good):
        if q % step == 0:
            scores = unit @ unit[i]
            ranked = sorted((-s, good[j][0]) for j, s in enumerate(scores.tolist()) if j != i)[:best]
            out += [(q, r, v, -s) for r, (s, v) in enumerate(ranked, 1)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "row", "vector", "members", "shard", "rank", "score"):
        df = df.withColumn(name, F.lit("own"))
    return sorted(map(tuple, nearest.nearest(df, "vec_id", "embedding", **options).collect()))


def recall(found, expected):
    got, want = defaultdict(set), defaultdict(set)
    for rows, into in ((found, got), (expected, want)):
        for q, _, v, _ in rows:
            into[q].add(v)
    return sum(len(got[q] & want[q]) for q in want) / sum(map(len, want.values()))


def same(found, expected):
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in found], [r[3] for r in expected], rtol=0, atol=1e-12)


def test_recall_on_the_given_vectors(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        rows = [tuple(r) for r in table(spark, folder, "embeddings").select("vec_id", "embedding").collect()]
        found = sorted(map(tuple, nearest.query(spark, folder).collect()))
        expected = brute(rows)
        assert len(found) == len(expected) and recall(found, expected) >= 0.97
        exact = {(q, v): s for q, _, v, s in expected}
        assert all(abs(exact[q, v] - s) < 1e-12 for q, _, v, s in found if (q, v) in exact)


def test_recall_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SHARD_CELLS", 32 * 300)
    monkeypatch.setattr(nearest, "BLOCK_CELLS", 32 * 7)
    pick = np.random.default_rng(5)
    rows = [(i, [float(x) for x in pick.normal(size=32)]) for i in range(1500)]
    assert recall(run(spark, rows), brute(rows)) >= 0.95


def test_one_common_vector(spark):
    """The rows of one vector shrink to those that can be answers; ties go to the smaller id."""
    rows = [(i, [1.0, 2.0, -1.0]) for i in range(400)] + [(i, [1.0, 2.0, i / 100]) for i in range(400, 450)]
    same(run(spark, rows), brute(rows))


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0])]
    same(run(spark, rows, best=9), brute(rows, best=9))


def test_awkward_rows(spark):
    rows = [(0, [1.0, 2.0]), (50, [1.0]), (100, []), (150, None), (200, [float("nan"), 1.0]), (250, [float("inf"), 1.0]),
            (300, [None, 1.0]), (None, [1.0, 1.0]), (3, [-3.0, 4.0, 5.0]), (-50, [0.1, 0.2]), (350, [0.0, 0.0]),
            (7, [1e38, -1e38]), (400, [1e-44, 1e-44])]
    same(run(spark, rows), brute(rows))


def test_few(spark):
    assert run(spark, [(0, [1.0])]) == []
    same(run(spark, [(0, [1.0]), (1, [2.0])]), [(0, 1, 1, 1.0)])
    assert nearest.nearest(spark.createDataFrame([], SCHEMA), "vec_id", "embedding").count() == 0


def test_graph_is_flat_and_connected():
    pick = random.Random(6)
    vectors = np.array([[pick.gauss(0, 1) for _ in range(8)] for _ in range(700)], np.float32)
    vectors /= np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    graph, order = nearest.Graph.build(vectors, np.arange(700))
    assert sorted(order.tolist()) == list(range(700))
    for layer in graph.links:
        assert layer.max() < len(layer)
        for i, own in enumerate(layer):
            own = own[own >= 0]
            assert i not in own and len(set(own.tolist())) == len(own)
    seen, todo = {0}, [0]
    while todo:
        for j in graph.links[0][todo.pop()].tolist():
            if j >= 0 and j not in seen:
                seen.add(j)
                todo.append(j)
    assert len(seen) >= 690
