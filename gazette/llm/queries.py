"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from gazette.llm import (decontaminate, filter_audit, html_blocks, jaccard_join, langid, license_scan, merkle, packing, quality_mil,
                         quality_rules, substring_dedup, token_binary, url_filter)

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_language_id": langid.op3_language_id,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_quality_mil": quality_mil.op6_quality_mil,
    "op7_html_text": html_blocks.op7_html_text,
    "op8_token_binary": token_binary.op8_token_binary,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_license_scan": license_scan.op11_license_scan,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}
#: The others need a tokenizer, zstandard, a trained model, an HTML reader or crc32.
ORACLE = {
    "op2_substring_dedup": substring_dedup.OP2_SQL,
    "op5_jaccard_join": jaccard_join.OP5_SQL,
    "op10_decontamination": decontaminate.OP10_SQL,
    "op11_license_scan": license_scan.OP11_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
