"""The registered queries of the chain engine: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register a callable (spark, sf_dir) -> DataFrame under a name, with its oracle SQL where there is one."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
