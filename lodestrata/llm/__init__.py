"""Corpus operators for training data. Each module registers its query in QUERIES and its SQL, if any, in ORACLES."""

from __future__ import annotations

from importlib import import_module

MODULES = ("suffix_dedup", "simhash", "packing", "sharding", "exact_dedup", "sentencepiece_bpe", "quality_rules", "pii", "neighbours", "line_templates")


def queries() -> dict:
    return {k: f for m in MODULES for k, f in import_module(f"{__name__}.{m}").QUERIES.items()}


def oracle_sql() -> dict:
    return {k: q for m in MODULES for k, q in import_module(f"{__name__}.{m}").ORACLES.items()}
