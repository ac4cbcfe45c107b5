"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every query reads the given tables (or data Spark derives from them) in
full; the oracle computes the same result independently in DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import queries_core, queries_dedup, queries_eval, queries_geo, queries_accept, queries_io, queries_keyword, queries_quota, queries_release, queries_runs, queries_more, queries_scene, queries_sim, queries_walk  # noqa: F401
