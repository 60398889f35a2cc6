"""All queries of the core, by name, with their SQL."""

from __future__ import annotations

from palimpsest.queries import intake_queries, join_queries, revision_queries, text_queries

_MODULES = [revision_queries, join_queries, text_queries, intake_queries]


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.SQL.items()}
