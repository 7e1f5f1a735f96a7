"""Queries bound to the driver tables, each beside its DuckDB oracle SQL.

``REGISTRY[key] = (fn, oracle_sql_or_None)`` where ``fn(spark, sf_dir)``
returns a DataFrame. Modules register themselves on import.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = (fn, oracle)
        return fn
    return deco


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    import importlib
    for mod in ("cumulation", "scd", "loads", "graph", "facts", "activity",
                "patterns", "layout", "experiments", "streams"):
        try:
            importlib.import_module(f"dimforge.plans.{mod}")
        except ModuleNotFoundError as e:  # module not written yet
            if e.name != f"dimforge.plans.{mod}":
                raise
    return REGISTRY
