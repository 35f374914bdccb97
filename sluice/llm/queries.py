"""The operators' queries and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from . import decontam, language_id, license_scan, line_dedup, mixing, near_dedup, secret_scan, sharding, substring_dedup, suffix_dedup, token_alignment, topk, vector_codes

QUERIES = {
    "op1_top_k": topk.op1_top_k,
    "op2_decontaminate": decontam.op2_decontaminate,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_sharding": sharding.op4_sharding,
    "op5_license_scan": license_scan.op5_license_scan,
    "op6_language_id": language_id.op6_language_id,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_mixing": mixing.op8_mixing,
    "op9_secret_scan": secret_scan.op9_secret_scan,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_line_dedup": line_dedup.op12_line_dedup,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}

# the others are tested against brute force in tests/llm
ORACLES = {
    "op1_top_k": topk.SQL,
    "op2_decontaminate": decontam.SQL,
    "op3_substring_dedup": substring_dedup.SQL,
    "op8_mixing": mixing.SQL,
    "op10_near_dedup": near_dedup.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op12_line_dedup": line_dedup.SQL,
}
