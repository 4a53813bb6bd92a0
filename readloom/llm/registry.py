"""The package's registered queries."""

from __future__ import annotations

import importlib

_MODULES = {
    "op1_pfor_tokens": "token_output",
    "op2_cross_polytope_ann": "cross_polytope",
    "op3_licence_digests": "licence_scan",
    "op4_lsh_forest_near_dedup": "near_dedup",
    "op5_maxent_lm": "maxent_lm",
    "op6_gsaca_suffix_dedup": "suffix_dedup",
    "op7_countmin_substring_dedup": "substring_dedup",
    "op9_bm25_decontaminate": "decontaminate",
    "op10_random_indexing_quality": "quality",
    "op8_length_buckets": "packing",
    "op11_merkle_manifest": "merkle",
    "op12_source_divergence": "divergence",
    "op13_secret_worklist": "secrets",
}


def queries() -> dict:
    return {name: importlib.import_module(f"{__package__}.{m}").query for name, m in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, m in _MODULES.items():
        sql = getattr(importlib.import_module(f"{__package__}.{m}"), "ORACLE_SQL", None)
        if sql:
            out[name] = sql
    return out
