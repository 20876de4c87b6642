"""Registration of queries with their SQL twins."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return add
