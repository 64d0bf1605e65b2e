"""SQL fragments shared by the DuckDB oracle strings."""

from __future__ import annotations


def r6(expr: str, digits: int = 6) -> str:
    """Same rounding as :func:`tabfold.functions.columns.round6`."""
    s = 10 ** digits
    return f"CAST(floor(({expr}) * {s}.0 + 0.5) / {s}.0 AS DOUBLE)"


def fold_sql(key: str, k: int, seed: int = 0) -> str:
    """Hash fold of a key: first 32 md5 bits of 'seed:key' mod k."""
    return (f"CAST(CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) % {k}"
            f" AS INTEGER)")


def unit_sql(key: str, seed: int = 0) -> str:
    return f"(CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0)"
