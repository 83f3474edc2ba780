"""Queries of this subpackage over the test tables, and their SQL."""

from __future__ import annotations

from menumix.llm import bpe, conversations, exact_dedup, language_model, line_dedup, mixing, near_dedup, nearest, quality, source_audit, substring_dedup, toxicity, warc

QUERIES = {
    "op1_near_dedup": near_dedup.op1_near_dedup,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_arc_to_warc": warc.op3_arc_to_warc,
    "op4_quality": quality.op4_quality,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_language_model": language_model.op6_language_model,
    "op7_substring_dedup": substring_dedup.op7_substring_dedup,
    "op8_bpe": bpe.op8_bpe,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_nearest": nearest.op10_nearest,
    "op11_source_audit": source_audit.op11_source_audit,
    "op12_conversation_repair": conversations.op12_conversation_repair,
    "op13_toxicity": toxicity.op13_toxicity,
}
SQL = {"op3_arc_to_warc": warc.SQL, "op9_exact_dedup": exact_dedup.SQL, "op11_source_audit": source_audit.SQL, "op12_conversation_repair": conversations.SQL}
