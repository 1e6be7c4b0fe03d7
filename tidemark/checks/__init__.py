"""Queries over the driver tables, each with the SQL it must agree with."""

from __future__ import annotations

import importlib

from tidemark.checks.base import ORACLES, QUERIES

_MODULES = ("series_queries", "table_queries", "quality_queries", "flow_queries", "job_queries")


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"tidemark.checks.{name}")


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict:
    _load()
    return dict(ORACLES)
