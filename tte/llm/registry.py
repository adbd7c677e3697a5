"""Registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame`` and, where SQL can state
the result, the DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tte.llm.common import ready

QueryFn = Callable[..., DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        def run(spark, sf_dir):
            ready(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    from tte.llm import catalogue  # noqa: F401  importing it runs the decorators

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from tte.llm import catalogue  # noqa: F401

    return dict(_SQL)
