"""Registered queries over the test tables, each with its DuckDB counterpart where SQL can say it."""

from __future__ import annotations

import importlib

MODULES = ("traces", "ingest", "logs", "metrics", "documents", "scalars", "processors", "streams", "typed")


def _load():
    for module in MODULES:
        importlib.import_module(f"checks.{module}")
    return importlib.import_module("checks.registry")


def all_queries() -> dict:
    return dict(_load().QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(_load().ORACLES)
