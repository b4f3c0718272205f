from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(key: str, sql: str | None = None):
    """Register a query builder under ``key`` with its SQL twin."""
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key!r}")
        REGISTRY[key] = (fn, sql.strip() if sql else None)
        return fn
    return deco
