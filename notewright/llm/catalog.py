"""All queries of this subpackage."""

from __future__ import annotations

from ..plans.catalog import gather
from ..plans.registry import Query

MODULES = ("language_queries", "names_queries", "quality_queries", "splitting_queries", "token_queries", "truncation_queries")


def llm() -> tuple[dict[str, Query], dict[str, str]]:
    return gather("notewright.llm", MODULES)
