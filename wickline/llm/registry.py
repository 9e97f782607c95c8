"""Queries of the operators and the SQL that checks them."""

from __future__ import annotations

from wickline.llm import (
    alignment, archives, bpe, contamination, lines, nearest, neardup, quality, secrets, shards, spelling, topk, toxicity,
)

QUERIES = {
    "op1_quality": quality.query,
    "op2_decontamination": contamination.query,
    "op3_top_k": topk.query,
    "op4_sharding": shards.query,
    "op5_toxicity": toxicity.query,
    "op6_secrets": secrets.query,
    "op7_line_dedup": lines.query,
    "op8_warc": archives.query,
    "op9_jaccard_join": neardup.query,
    "op10_bpe": bpe.query,
    "op11_spelling": spelling.query,
    "op12_alignment": alignment.query,
    "op13_nearest": nearest.query,
}

CHECKS = {
    "op2_decontamination": contamination.CHECK,
    "op3_top_k": topk.CHECK,
    "op4_sharding": shards.CHECK,
    "op6_secrets": secrets.CHECK,
    "op7_line_dedup": lines.CHECK,
    "op8_warc": archives.CHECK,
    "op9_jaccard_join": neardup.CHECK,
    "op11_spelling": spelling.CHECK,
}
