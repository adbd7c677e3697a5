"""Scalar Column expressions (E1-E6). All JVM-side except the normal CDF, which Spark lacks."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tte.operators.calibration import bin_edges, bin_equal  # noqa: F401  (E2 lives with the curves)


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound a column; nulls stay null (``least``/``greatest`` alone would skip them)."""
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(out)


def sigmoid(c: Column) -> Column:
    """1 / (1 + exp(-r))."""
    return 1.0 / (1.0 + F.exp(-c))


def logistic_cdf(z: Column) -> Column:
    """E5 (logistic): 1 / (1 + exp(-z))."""
    return sigmoid(z)


from pyspark.sql import types as T  # noqa: E402


@F.pandas_udf(T.DoubleType())
def _normal_cdf_udf(z: pd.Series) -> pd.Series:
    erf = np.vectorize(math.erf, otypes=[float])
    v = z.to_numpy(dtype=float)
    out = 0.5 * (1.0 + erf(v / math.sqrt(2.0)))
    return pd.Series(out)


def normal_cdf(z: Column) -> Column:
    """E5 (normal): Phi(z) via ``math.erf`` in an Arrow-batched pandas UDF (Spark has no erf)."""
    return _normal_cdf_udf(z)


@F.pandas_udf(T.DoubleType())
def _normal_hazard_udf(z: pd.Series) -> pd.Series:
    def one(v):
        tail = 0.5 * math.erfc(v / math.sqrt(2.0)) if v < 35 else 0.0
        return math.exp(-0.5 * v * v) / math.sqrt(2 * math.pi) / tail if tail > 0 else v + 1.0 / v

    return pd.Series([one(v) for v in z.to_numpy(dtype=float)])


@F.pandas_udf(T.DoubleType())
def _normal_log_survival_udf(z: pd.Series) -> pd.Series:
    def one(v):
        tail = 0.5 * math.erfc(v / math.sqrt(2.0)) if v < 35 else 0.0
        return math.log(tail) if tail > 0 else -0.5 * v * v - math.log(v * math.sqrt(2 * math.pi))

    return pd.Series([one(v) for v in z.to_numpy(dtype=float)])


def normal_hazard(z: Column) -> Column:
    """phi(z) / (1 - Phi(z)), by its asymptote far out."""
    return _normal_hazard_udf(z)


def normal_log_survival(z: Column) -> Column:
    """log(1 - Phi(z)), by its asymptote far out."""
    return _normal_log_survival_udf(z)


def aft_cdf(z: Column, dist: str = "normal") -> Column:
    """E5: CDF of the AFT error distribution: ``normal``, ``logistic`` or ``extreme`` (Weibull)."""
    if dist == "normal":
        return normal_cdf(z)
    if dist == "logistic":
        return logistic_cdf(z)
    if dist in ("extreme", "weibull"):
        return 1.0 - F.exp(-F.exp(z))
    raise ValueError(f"unknown distribution {dist!r}")


def monotone_survival(surv: Column) -> Column:
    """E6 on an ``ARRAY<DOUBLE>`` ordered by horizon: each value is raised to the max of itself
    and all later values (running max from the right), so the array is non-increasing."""
    rev = F.reverse(surv)
    running = F.aggregate(
        rev, F.array().cast("array<double>"),
        lambda acc, x: F.concat(acc, F.array(F.greatest(x, F.coalesce(F.try_element_at(acc, F.lit(-1)), x)))),
    )
    return F.reverse(running)
