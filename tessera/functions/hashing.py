"""Deterministic, reproducible pseudo-random numbers from row keys.

The value of a key is the first 32 bits of md5("<key>:<salt>") read as an
unsigned integer. DuckDB computes the same number with
``('0x' || substr(md5(cast(key AS varchar) || ':<salt>'), 1, 8))::BIGINT``,
so every split and sample is checkable by an independent engine and is stable
across retries and executor loss (no dependence on partitioning or task order).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hash32(key, salt: str | int) -> Column:
    """Unsigned 32-bit hash of ``key`` (cast to string) salted by ``salt``."""
    s = F.concat(_c(key).cast("string"), F.lit(f":{salt}"))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def bucket(key, salt: str | int, modulo: int = 1000) -> Column:
    return hash32(key, salt) % F.lit(modulo)


def uniform(key, salt: str | int) -> Column:
    """Uniform in (0, 1): (h + 0.5) / 2^32."""
    return (hash32(key, salt).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)


def sql_hash32(key_sql: str, salt: str | int) -> str:
    """DuckDB spelling of :func:`hash32` for oracle SQL."""
    return f"('0x' || substr(md5(cast({key_sql} AS varchar) || ':{salt}'), 1, 8))::BIGINT"


def sql_uniform(key_sql: str, salt: str | int) -> str:
    return f"(({sql_hash32(key_sql, salt)})::DOUBLE + 0.5) / 4294967296.0"
