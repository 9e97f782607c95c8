"""A corpus pipeline over ``documents``: each stage works on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wickline.llm import bpe, contamination, lines, neardup, toxicity
from wickline.llm.common import table
from wickline.session import staged

STAGES = [
    ("toxicity", toxicity.stage),
    ("line_dedup", lines.stage),
    ("jaccard_join", neardup.stage),
    ("decontamination", contamination.stage),
    ("bpe", bpe.stage),
]

# Two stages are trained and one counts tokens, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every result is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = staged(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
