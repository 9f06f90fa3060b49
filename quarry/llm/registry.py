"""Queries of the subpackage by name, and DuckDB SQL where it can express them."""

from __future__ import annotations

from quarry.llm import (bpe, conversation_repair, decontaminate, fill_middle, html_wrappers, language_id, line_dedup, link_trust, near_dedup,
                        quality_model, quality_rules, suffix_dedup, toxicity)

QUERIES = {
    "op1_near_dedup": near_dedup.op1_near_dedup,
    "op2_byte_bpe": bpe.op2_byte_bpe,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_language_id": language_id.op6_language_id,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_html_wrappers": html_wrappers.op8_html_wrappers,
    "op9_quality_model": quality_model.op9_quality_model,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_url_trust": link_trust.op11_url_trust,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_fill_middle": fill_middle.op13_fill_middle,
}
ORACLE: dict[str, str] = {
    "op5_decontaminate": decontaminate.ORACLE,
    "op11_url_trust": link_trust.ORACLE,
    "op13_fill_middle": fill_middle.ORACLE,
}
