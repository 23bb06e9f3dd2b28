"""Registry of driver queries: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    build: Builder
    sql: str | None
    ops: str


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, ops: str = ""):
    """Register a builder under ``name`` with its oracle SQL (None = rows-only check)."""
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, ops)
        return fn
    return deco
