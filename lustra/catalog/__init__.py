"""Registered queries: every operator over the given tables, with oracle SQL."""

from __future__ import annotations

from lustra.catalog import access, cleansing, histories, storage
from lustra.catalog.base import Query


def all_queries() -> dict[str, Query]:
    """Every registered query by name."""
    found: dict[str, Query] = {}
    for family in (storage, cleansing, access, histories):
        for name, query in family.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = query
    return found
