"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from airloom.llm import (
    chat, decontaminate, near_dedup, packing, periodic_runs, pieces, pii, quality, repair,
    secret_scan, substring_dedup, suffix_dedup, token_counts,
)
from airloom.llm.common import Query

QUERIES: dict[str, Query] = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_benchmark_decontamination": decontaminate.op2_benchmark_decontamination,
    "op3_chat_perspectives": chat.op3_chat_perspectives,
    "op4_substring_dedup": substring_dedup.op4_substring_dedup,
    "op5_minhash_near_dedup": near_dedup.op5_minhash_near_dedup,
    "op6_pii_bootstrap": pii.op6_pii_bootstrap,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_secret_scan": secret_scan.op10_secret_scan,
    "op11_vector_packing": packing.op11_vector_packing,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_structure_repair": repair.op13_structure_repair,
}

#: The others are tested against brute force.
SQL: dict[str, str] = {
    "op2_benchmark_decontamination": decontaminate.SQL,
    "op3_chat_perspectives": chat.SQL,
    "op4_substring_dedup": substring_dedup.SQL,
    "op5_minhash_near_dedup": near_dedup.SQL,
    "op9_quality_rules": quality.SQL,
    "op12_periodic_runs": periodic_runs.SQL,
    "op13_structure_repair": repair.SQL,
}
