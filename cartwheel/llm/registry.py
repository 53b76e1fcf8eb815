"""Queries and oracle SQL of the text operators."""

from __future__ import annotations

import importlib

MODULES = [
    "suffix_dedup", "lang_id", "packing", "token_files", "decontaminate", "line_dedup", "toxicity", "exact_dedup", "simhash", "pii",
    "quality", "resampling", "merkle",
]


def _modules():
    return [importlib.import_module(f"cartwheel.llm.{m}") for m in MODULES]


def queries() -> dict:
    return {name: fn for m in _modules() for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in getattr(m, "ORACLE", {}).items()}
