"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` plus, where SQL can
state it, the equivalent DuckDB SQL over the raw test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QueryFn = Callable[..., DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query under ``name`` (an inventory ID prefix, e.g. ``K2_km_survival``)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark, sf_dir):
            from tte.session import ensure_checkpoint_dir, ship_package

            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)


def _load_all() -> None:
    # importing the modules runs their @register decorators
    from tte.plans import (  # noqa: F401
        q_curves, q_metrics, q_quality, q_drift, q_monitor, q_score, q_models, q_sources,
        q_stream,
    )


def r6(c: Column | str, digits: int = 6) -> Column:
    """Round for the oracle comparison: round-half-away of x * 10^d on the binary value, then
    divide, which is how the SQL side's ``round(x, d)`` treats a DOUBLE. (Spark's own
    ``round(x, d)`` rounds the shortest decimal text instead, which differs at exact-looking
    halves such as -0.9046514999999999.)"""
    col = F.col(c) if isinstance(c, str) else c
    m = float(10 ** digits)
    return F.round(col.cast("double") * m, 0) / m
