"""All queries of the core."""

from __future__ import annotations

import importlib

from .registry import Query

MODULES = ("references", "ledger", "lint", "merge", "wiki", "calls", "stream")


def gather(package: str, modules: tuple[str, ...]) -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the modules' registries."""
    queries: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for m in modules:
        r = importlib.import_module(f"{package}.{m}").REGISTRY
        queries |= r.queries
        sql |= r.sql
    return queries, sql


def core() -> tuple[dict[str, Query], dict[str, str]]:
    return gather("notewright.plans", MODULES)
