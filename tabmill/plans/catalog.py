"""Registry of named queries: ``name -> (spark builder, DuckDB oracle text or None)``.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
derived tables.  Computed columns carry the same alias as in the oracle text.
Builders are registered by the ``queries_*`` modules imported at the bottom.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def queries() -> dict[str, Builder]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)


_LOADED = False


def _load() -> None:
    global _LOADED
    if _LOADED:
        return
    _LOADED = True
    from . import queries_explain, queries_house, queries_risk  # noqa: F401
