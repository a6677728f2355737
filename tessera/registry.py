"""One registry holds each named query and, where SQL can express it, its DuckDB oracle.

A query is a callable ``(spark, sf_dir) -> DataFrame``. The oracle is an
independent SQL text over the same parquet tables (views named after the tables).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class RegisteredQuery:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    rows: tuple[str, ...]   # SURVEY §2 rows served, e.g. ("A1",)


_QUERIES: dict[str, RegisteredQuery] = {}


def query(name: str, oracle: str | None = None, rows: tuple[str, ...] = ()):
    def deco(fn):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = RegisteredQuery(name, fn, oracle, rows)
        return fn
    return deco


def all_queries() -> dict[str, RegisteredQuery]:
    # importing the plans package registers everything
    from tessera import plans  # noqa: F401
    return dict(_QUERIES)
