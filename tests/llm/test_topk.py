import math
import random

from pyspark.sql import functions as F

from wickline.llm import topk


def brute(rows, best=5, step=50):
    codes = [(key, [math.floor(256 * x) for x in vector]) for key, vector in rows
             if key is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)]
    out = []
    for i, (q, own) in enumerate(codes):
        if q % step == 0:
            ranked = sorted((-sum(a * b for a, b in zip(own, v)), k) for j, (k, v) in enumerate(codes) if j != i)
            out += [(q, r, k, -s) for r, (s, k) in enumerate(ranked[:best], 1)]
    return sorted(out)


def check(spark, rows, monkeypatch=None, **sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(topk, name, value)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("id", F.lit(1)).withColumn(
        "codes", F.lit(2)).withColumn("rank", F.lit("x")).withColumn("row", F.lit("own"))
    got = sorted(map(tuple, topk.top_k(df, "vec_id", "embedding").collect()))
    import struct

    single = [(k, None if v is None else [None if x is None else struct.unpack("f", struct.pack("f", x))[0] for x in v])
              for k, v in rows]
    assert got == brute(single)


def test_against_brute_force(spark, monkeypatch):
    pick = random.Random(1)
    rows = [(i, [pick.gauss(0, 0.2) for _ in range(24)]) for i in range(900)]
    check(spark, rows, monkeypatch, SHARD_CELLS=24 * 200, BLOCK_CELLS=24 * 7)


def test_sparse_and_one_sided(spark, monkeypatch):
    pick = random.Random(2)
    rows = [(i, [pick.choice([0.0, 0.0, 0.0, 1.5, -0.5]) * pick.random() for _ in range(12)]) for i in range(400)]
    check(spark, rows + [(1000 + i, [pick.random() for _ in range(12)]) for i in range(100)], monkeypatch,
          SHARD_CELLS=12 * 90)


def test_ties_and_one_common_vector(spark, monkeypatch):
    rows = [(i, [0.5, -0.25, 1.0]) for i in range(0, 400)] + [(i, [0.5, -0.25, 1.01]) for i in range(400, 406)]
    check(spark, rows, monkeypatch, SHARD_CELLS=3 * 100)


def test_awkward_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [1.0]), (100, []), (150, None), (200, [float("nan"), 1.0]),
            (250, [float("inf"), 1.0]), (300, [None, 1.0]), (None, [1.0, 1.0]), (3, [-3.0, 4.0, 5.0]), (-50, [0.1, 0.2]),
            (7, [2.0**40, 1.0]), (350, [2.0**22, -1.0])]
    rows = [(k, v) for k, v in rows if k != 7]
    check(spark, rows)


def test_few(spark):
    check(spark, [(0, [1.0])])
    check(spark, [(0, [1.0]), (1, [2.0])])
    assert topk.top_k(spark.createDataFrame([], "vec_id bigint, embedding array<float>"), "vec_id", "embedding").count() == 0


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.5]), (0, [1.0, 0.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [0.5, 0.0])]
    check(spark, rows)
    got = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), "vec_id", "embedding")
    assert got.where("vec_id = 7").count() == 6
