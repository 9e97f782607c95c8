import random

import pytest

from cases import CLASHING, documents, prose
from compare import connect, differences
from wickline.llm import contamination


@pytest.fixture()
def judge(spark):
    def run(docs, items):
        table = spark.createDataFrame(items, "item_id bigint, text string")
        return contamination.contamination(documents(spark, docs, CLASHING), "doc_id", "text", table, "item_id", "text")

    return run


def against_sql(spark, judge, tmp_path, docs, items):
    documents(spark, docs).write.parquet(f"{tmp_path}/d")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/b")
    con = connect(str(tmp_path))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{tmp_path}/b/*.parquet')")
    assert differences(judge(docs, items).drop("text_key"), con, contamination.CHECK) == []


def test_every_shared_span_is_found(spark, judge, tmp_path):
    pick = random.Random(5)
    items = [(i, prose(1000 + i, pick.choice([13, 14, 20, 40]), 40)) for i in range(30)]
    items += [(100 + n, prose(2000 + n, n)) for n in range(1, 13)] + [(5, prose(7, 30)), (None, prose(8, 15)), (200, None), (201, "")]
    docs = []
    for d in range(150):
        words = prose(d, pick.randrange(0, 60), 40).split()
        item = (pick.choice(items)[1] or "").upper().split()
        a = pick.randrange(0, len(item) + 1)
        cut = item[a : a + pick.randrange(0, 20)]
        at = pick.randrange(0, len(words) + 1)
        docs.append((d, ", ".join(words[:at] + cut + words[at:])))
    against_sql(spark, judge, tmp_path, docs, items)


def test_awkward_rows(spark, judge, tmp_path):
    item = prose(1, 20)
    docs = [(None, item), (None, None), (1, ""), (2, item), (2, item), (2, item + " more"), (3, "?!"),
            (4, prose(9, 3000) + " " + item), (5, " ".join([item] * 300)), (6, prose(4, 100_000, 90))]
    against_sql(spark, judge, tmp_path, docs, [(1, item), (1, item), (2, item), (3, prose(1, 20).title())])


def test_share(judge):
    item = prose(1, 13)
    docs = [(1, item + " " + prose(2, 13 * 19)), (2, item + " " + prose(2, 13 * 19 + 1))]
    got = {r.doc_id: (r.n_hit, r.contaminated) for r in judge(docs, [(1, item)]).collect()}
    assert got == {1: (13, True), 2: (13, False)}


def test_passage_in_all_items_and_documents(spark, judge, tmp_path):
    passage = prose(3, 30)
    docs = [(d, f"{prose(d, 20)} {passage}") for d in range(200)]
    against_sql(spark, judge, tmp_path, docs, [(i, f"{prose(500 + i, 5)} {passage}") for i in range(60)])


def test_nothing_to_find(judge):
    assert [r.n_hit for r in judge([(1, "a b")], []).collect()] == [0]
    assert judge([], [(1, "a")]).count() == 0
