"""Operators of a training-data pipeline; nothing outside this subpackage imports it but the entry module."""

from __future__ import annotations

import importlib

from loomspark.ship import shipped

#: Module -> its query; a module's SQL, where there is any, is its oracle.
OPERATORS = {
    "jaccard_join": "op1_jaccard_join",
    "toxicity": "op2_toxicity",
    "token_files": "op3_token_files",
    "media": "op4_media",
    "quality": "op5_quality",
    "decontaminate": "op6_decontaminate",
    "html_text": "op7_html_text",
    "mixing": "op8_mix_sources",
    "line_dedup": "op9_line_dedup",
    "licenses": "op10_license_scan",
    "spelling": "op11_spelling_variants",
    "hard_negatives": "op12_hard_negatives",
    "lm_scoring": "op13_lm_scores",
}


def queries() -> dict:
    return {name: shipped(getattr(importlib.import_module(f"{__name__}.{module}"), name)) for module, name in OPERATORS.items()}


def oracle_sql() -> dict:
    found = {name: getattr(importlib.import_module(f"{__name__}.{module}"), "SQL", None) for module, name in OPERATORS.items()}
    return {name: sql for name, sql in found.items() if sql}
