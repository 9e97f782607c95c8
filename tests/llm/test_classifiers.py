import random
import zlib

import numpy as np
import pytest

from cases import documents, prose
from wickline.llm import learning, quality, toxicity

SF = "/root/testdata/sf0.1"


def labels(spark, rows, name):
    return spark.createDataFrame(rows, f"doc_id bigint, {name} int, score int")


def corpus(spark, n=400):
    """Clean prose, and shouted prose with a repeated insult as class 0 of quality and 1 of toxicity."""
    pick = random.Random(1)
    rows, marks = [], []
    for i in range(n):
        text, bad = prose(i, pick.randrange(20, 60)), i % 3 == 0
        if bad:
            text += " zorgs blimp !!! " + " ".join(["SHOUT!!"] * 20)
        rows.append((i, text))
        marks.append((i, bad))
    return rows, marks


@pytest.mark.parametrize("op", ["quality", "toxicity"])
def test_learns_and_holds_out(spark, op):
    rows, marks = corpus(spark)
    rows += [(None, None), (None, "x"), (7000, ""), (7001, "word " * 100_000), (1, rows[1][1])]
    name = "quality" if op == "quality" else "toxic"
    known = [(i, int(bad) if name == "toxic" else int(not bad), 1) for i, bad in marks] + [
        (3, 7, 1), (4, None, 1), (None, 1, 1), (99999, 0, 1), (1, None, 1)]
    run, parts, part = (quality.quality, 3, 1) if op == "quality" else (toxicity.toxicity, 5, 0)
    got = run(documents(spark, rows), "doc_id", "text", labels(spark, known, name), "doc_id", name).collect()
    assert len(got) == len(rows)
    truth = {i: (bad if name == "toxic" else not bad) for i, bad in marks}
    right = [r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth and r.held_out]
    assert len(right) > 50 and np.mean(right) > 0.95
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % parts == part)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    twice = [r.score for r in got if r.doc_id == 1]
    assert len(twice) == 2 and twice[0] == twice[1]


@pytest.mark.parametrize("run,name", [(quality.quality, "quality"), (toxicity.toxicity, "toxic")])
def test_held_out_labels_are_not_used(spark, run, name):
    rows, marks = corpus(spark, 120)
    parts, part = (3, 1) if name == "quality" else (5, 0)
    held = {i for i, _ in marks if zlib.crc32(str(i).encode()) % parts == part}
    known = [(i, int(bad), 1) for i, bad in marks]
    other = [(i, 1 - y if i in held else y, s) for i, y, s in known]
    scores = [sorted(map(tuple, run(documents(spark, rows), "doc_id", "text", labels(spark, k, name), "doc_id",
                                    name).select("doc_id", "score").collect())) for k in (known, other)]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("run,name", [(quality.quality, "quality"), (toxicity.toxicity, "toxic")])
def test_nothing_to_learn_from(spark, run, name):
    docs = documents(spark, [(1, "a b"), (2, None)])
    got = run(docs, "doc_id", "text", labels(spark, [], name), "doc_id", name).collect()
    assert [r.score for r in got] == [0.5, 0.5]
    assert run(documents(spark, []), "doc_id", "text", labels(spark, [], name), "doc_id", name).count() == 0


def test_sample_is_bounded(spark):
    rows, marks = corpus(spark, 200)
    rows += [(0, "again")] * 300
    got = learning.sample(documents(spark, rows), "doc_id", "text", labels(spark, [(i, int(b), 1) for i, b in marks], "y"),
                          "doc_id", "y", lambda d: d >= 0, 20).collect()
    assert len(got) == 40 and len({r._order for r in got}) == 40
    assert {r._label for r in got} == {0, 1}


def test_folded_model_is_the_model():
    """The score is the softmax of the averaged vectors, block by block and batch by batch."""
    pick = random.Random(3)
    texts = ["", "a", "Ha Ha Ha", "é" * 30 + " x", prose(1, 300), " ".join("".join(
        pick.choice("abc XY!\n") for _ in range(9)) for _ in range(50))]
    raw = [t.encode() for t in texts]
    found = [learning.Example(i % 2, *quality.features(np.frombuffer(r, np.uint8))) for i, r in enumerate(raw)]
    model = quality.train(found)
    whole = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.append(0, np.cumsum([len(r) for r in raw]))
    got = quality.logits(model.fold, whole, offsets)
    for value, one in zip(got, found):
        hidden = one.weight @ model.vectors[one.index]
        assert abs((hidden @ model.output) @ [-1, 1] - value) < 1e-4
    size, quality.HASH_BYTES = quality.HASH_BYTES, 37
    try:
        assert np.array_equal(got, quality.logits(model.fold, whole, offsets))
    finally:
        quality.HASH_BYTES = size


def test_machine_learns_a_pair():
    """Two terms that are harmless alone and toxic together: no additive weights tell them apart."""
    pick = random.Random(5)
    found = []
    for _ in range(600):
        a, b = pick.random() < 0.5, pick.random() < 0.5
        text = " ".join(["filler"] + ["insult"] * a + ["group"] * b)
        index, weight = toxicity.features(np.frombuffer(text.encode(), np.uint8))
        found.append(learning.Example(int(a and b), index, weight))
    machine = toxicity.train(found, epochs=30)
    texts = [b"filler", b"filler insult", b"filler group", b"filler insult group"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))
    got = toxicity.logits(machine, data, offsets)
    assert list(got > 0) == [False, False, False, True]
    # the linear-time pair sum is the sum over pairs
    index, _ = toxicity.features(np.frombuffer(texts[3], np.uint8))
    index = index[machine.known[index]]
    x = len(index) ** -0.5
    pairs = sum(machine.factors[i] @ machine.factors[j] for n, i in enumerate(index) for j in index[:n]) * x * x
    assert abs(machine.bias + machine.linear[index].sum() * x + pairs - got[3]) < 1e-4


@pytest.mark.parametrize("run,name,least", [(quality.quality, "quality", 0.97), (toxicity.toxicity, "toxic", 0.92)])
def test_held_out_accuracy(spark, run, name, least):
    docs, known = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = run(docs, "doc_id", "text", known, "doc_id", name).where("held_out").join(known, "doc_id")
    assert scored.selectExpr(f"avg(CAST(predicted = {name} AS INT))").first()[0] >= least


def test_toxic_documents_are_dropped(spark, tmp_path):
    rows, marks = corpus(spark)
    labels(spark, [(i, int(b), 0) for i, b in marks], "toxic").write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(spark, rows + [(None, None), (1, rows[1][1])])
    kept = toxicity.stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    clean = {i for i, b in marks if not b}
    assert len(set(ids) & clean) >= 0.98 * len(clean) and len(set(ids) - clean - {None}) <= 4
    assert None in ids and ids.count(1) == 2
