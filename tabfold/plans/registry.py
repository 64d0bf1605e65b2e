"""Query catalogue: every registered query is (spark, sf_dir) -> DataFrame,
optionally paired with DuckDB SQL over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` (with its oracle SQL when SQL can say it)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


MODULES = ("q_flagship", "q_columns", "q_profile", "q_text_time", "q_folds", "q_metrics",
           "q_impute", "q_ensemble", "q_learn")


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    import importlib.util
    for m in MODULES:
        name = f"tabfold.plans.{m}"
        if importlib.util.find_spec(name) is not None:
            importlib.import_module(name)
