"""Registered queries: each an operator over whole tables, with its DuckDB twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..plans.derive import Given

_QUERIES: dict[str, Callable[[Given], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of the given tables under a name."""

    def keep(f: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: lambda spark, sf_dir, f=f: f(Given(spark, sf_dir)) for name, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


from . import clinical, graphs, picks, retrieval, sets, staged, vocabulary  # noqa: E402, F401
