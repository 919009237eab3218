"""Queries over the given tables, each beside the SQL text it must agree with."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query (spark, sf_dir) -> DataFrame and, where there is one, its SQL."""
    def add(build):
        assert name not in QUERIES, name
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return add
