"""The queries of this package, with SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from lakemill.llm import conversations, exact_dedup, line_dedup, mixing, neighbours, packing, passage_dedup, phrases, quality, simhash, substring_dedup, token_counts, token_store

QUERIES = {
    "op1_substring_dedup": substring_dedup.query,
    "op2_token_store": token_store.query,
    "op3_line_dedup": line_dedup.query,
    "op4_mixing": mixing.query,
    "op5_simhash": simhash.query,
    "op6_passage_dedup": passage_dedup.query,
    "op7_exact_dedup": exact_dedup.query,
    "op8_packing": packing.query,
    "op9_neighbours": neighbours.query,
    "op10_quality": quality.query,
    "op11_conversations": conversations.query,
    "op12_phrases": phrases.query,
    "op13_token_counts": token_counts.query,
    "pipeline": corpus_pipeline.run,
}
ORACLE = {
    "op4_mixing": mixing.ORACLE,
    "op7_exact_dedup": exact_dedup.ORACLE,
    "op12_phrases": phrases.ORACLE,
}
