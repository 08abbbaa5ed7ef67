"""The corpus queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import queries, sql

QUERIES = {
    "op1_repeats": queries.op1_repeats,
    "op2_tokens": queries.op2_tokens,
    "op3_neighbours": queries.op3_neighbours,
    "op4_quality": queries.op4_quality,
    "op5_pieces": queries.op5_pieces,
    "op6_topk": queries.op6_topk,
    "op7_licenses": queries.op7_licenses,
    "op8_neardup": queries.op8_neardup,
    "op9_mixing": queries.op9_mixing,
    "op10_lm": queries.op10_lm,
    "op11_phrases": queries.op11_phrases,
    "op12_alignment": queries.op12_alignment,
    "op13_warc": queries.op13_warc,
}
ORACLE_SQL = {
    "op6_topk": sql.TOP_PRODUCTS,
    "op9_mixing": sql.MIXING,
    "op11_phrases": sql.PHRASES,
    "op13_warc": sql.WARC,
}
