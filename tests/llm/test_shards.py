import zlib
from collections import defaultdict

import numpy as np
import pytest

from cases import CLASHING, documents
from wickline.llm.shards import jump, sharded


def test_more_shards_take_rows_only_into_the_new_one():
    keys = np.arange(-5000, 20000)
    for n in (1, 2, 7, 16, 100):
        before, after = jump(keys, n), jump(keys, n + 1)
        moved = before != after
        assert set(after[moved]) <= {n}
        assert abs(moved.mean() - 1 / (n + 1)) < 0.02
        assert before.min() >= 0 and before.max() < n
    counts = np.bincount(jump(keys, 16))
    assert counts.min() > 0.9 * counts.mean()


def test_no_shards():
    with pytest.raises(ValueError):
        jump(np.array([1]), 0)


def test_rows(spark):
    rows = [(None, "a"), (None, None), (1, ""), (1, "é"), (1, "é"), (2, "x" * 200_000)]
    df = documents(spark, rows, [c for c in CLASHING if c not in ("size", "shard")]).withColumnRenamed("lang", "size")
    got = sharded(df, "doc_id", "text", 4).collect()
    assert len(got) == len(rows)
    texts = sorted((r.size, r.text_crc32) for r in got)
    assert texts == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    places, slots = defaultdict(set), defaultdict(list)
    for r in got:
        places[r.doc_id].add((r.shard, r.grown_shard))
        slots[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 4)
    assert all(len(p) == 1 for p in places.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_key_may_hold_all_rows(spark):
    got = sharded(documents(spark, [(7, "same")] * 500), "doc_id", "text").collect()
    assert sorted(r.slot for r in got) == list(range(500)) and len({r.shard for r in got}) == 1


def test_empty(spark):
    assert sharded(documents(spark, []), "doc_id", "text").count() == 0
