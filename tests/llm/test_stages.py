"""Stages of the pipeline on documents with awkward rows and columns of their own."""

import pytest
from pyspark.sql import functions as F

from cases import CLASHING, documents, prose
from wickline.llm import contamination, lines, neardup
from wickline.llm.common import table

FOLDER = "/root/testdata/sf0.001"
INSIDE = [*CLASHING, "_h1", "_h2", "_gone", "_hits", "_parts", "_text_key", "_listed", "group", "component_id", "n"]


@pytest.mark.parametrize("stage", [lines.stage, neardup.stage, contamination.stage], ids=["lines", "neardup", "benchmark"])
def test_own_columns_of_any_name_stay(spark, stage):
    """Columns named like the operators' own come back as they were, in order; no other row is lost."""
    item = table(spark, FOLDER, "benchmark").where("text IS NOT NULL").first().text
    rows = [(1, prose(1, 80)), (2, prose(2, 80)), (3, None), (4, ""), (None, prose(5, 30)), (6, item), (7, prose(1, 80))]
    docs = documents(spark, rows, dict.fromkeys(INSIDE))
    got = stage(spark, docs, FOLDER)
    assert got.columns == docs.columns
    kept = got.collect()
    assert all(r[name] == "own" for r in kept for name in dict.fromkeys(INSIDE))
    want = {1, 2, 3, 4, None, 6, 7}
    want -= {7} if stage is neardup.stage else {6} if stage is contamination.stage else set()
    assert sorted(map(str, (r.doc_id for r in kept))) == sorted(map(str, want))
    texts = {r.doc_id: r.text for r in docs.select("doc_id", F.col("text")).collect()}
    assert all(r.text == texts[r.doc_id] for r in kept)
