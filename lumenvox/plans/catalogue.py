"""Registered queries over the given tables and their DuckDB counterparts."""

from __future__ import annotations

from lumenvox.plans import capture, motion

MODULES = (capture, motion)


def queries() -> dict:
    return {name: query for m in MODULES for name, (query, _) in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
