"""Operators for preparing training corpora. Nothing else in the library imports this subpackage."""

from __future__ import annotations

import importlib

_MODULES = ("query_tokens", "query_layout", "query_text", "query_pairs", "query_vectors", "query_manifest", "query_runs")


def _collect(attribute: str) -> dict:
    found: dict = {}
    for name in _MODULES:
        found |= getattr(importlib.import_module(f"tidemark.llm.{name}"), attribute)
    return found


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("ORACLES")
