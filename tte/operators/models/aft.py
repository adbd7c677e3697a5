"""Accelerated failure time models (L2, K10): log T = mu(x) + sigma W.

Normal and logistic W are fitted by Newton steps (``LocationScaleAFT``). Weibull (extreme-value W) fits with MLlib's ``AFTSurvivalRegression``; its ``censorCol`` is 1 for
an observed event, so right censoring is [t, inf) (T7). Survival at a horizon is
1 - F((ln t - mu) / sigma) made non-increasing over the horizons (E6).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import AFTSurvivalRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tte.functions.expr import aft_cdf, monotone_survival, normal_hazard, normal_log_survival


def aft_survival(df: DataFrame, horizons: Sequence[float], mu: str = "mu", sigma: float = 1.0,
                 dist: str = "extreme") -> DataFrame:
    """``surv`` ARRAY over horizons (each at least 1e-8), clipped to [0, 1] and monotone."""
    vals = []
    for h in horizons:
        z = (F.lit(float(max(h, 1e-8))).cast("double").alias("h"))
        zz = (F.log(z) - F.col(mu)) / F.lit(float(sigma))
        s = 1.0 - aft_cdf(zz, dist)
        vals.append(F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0)))
    return df.withColumn("surv", monotone_survival(F.array(*vals)))


class WeibullAFT:
    """L2: Weibull AFT via MLlib. ``risk`` = -mu (a shorter expected log-time is a higher risk)."""

    def __init__(self, features: Sequence[str], time: str = "time", event: str = "event", max_iter: int = 100):
        self.features = list(features)
        self.time = time
        self.event = event
        self.max_iter = max_iter
        self.model_ = None

    def _vec(self, df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=self.features, outputCol="_features", handleInvalid="keep").transform(df)

    def fit(self, df: DataFrame) -> "WeibullAFT":
        # a log-time model has no place for times that are not positive: their number is reported
        self.n_excluded_ = df.where(~F.coalesce(F.col(self.time) > 0, F.lit(False))).count()
        d = self._vec(df.where(F.col(self.time) > 0)).withColumn("_label", F.col(self.time).cast("double")) \
            .withColumn("_censor", F.col(self.event).cast("double"))
        aft = AFTSurvivalRegression(featuresCol="_features", labelCol="_label", censorCol="_censor",
                                    predictionCol="_pred", maxIter=self.max_iter)
        self.model_ = aft.fit(d)
        self.coef_ = list(self.model_.coefficients)
        self.intercept_ = float(self.model_.intercept)
        self.sigma_ = float(self.model_.scale)
        return self

    def risk(self, df: DataFrame) -> DataFrame:
        mu = F.lit(self.intercept_)
        for b, f in zip(self.coef_, self.features):
            mu = mu + F.lit(float(b)) * F.col(f)
        return df.withColumn("mu", mu).withColumn("risk", -F.col("mu"))

    def survival(self, df: DataFrame, horizons: Sequence[float]) -> DataFrame:
        scored = df if "mu" in df.columns else self.risk(df)
        return aft_survival(scored, horizons, "mu", self.sigma_, "extreme")


class LocationScaleAFT:
    """L2: log T = mu(x) + sigma W with a ``normal`` or ``logistic`` W, right-censored, by Newton steps.

    Each step is one aggregate over the rows: the log-likelihood, its gradient and its Hessian in the
    coefficients and log sigma, (p + 2)(p + 3) / 2 sums for p features. ``risk`` = -mu. Rows whose time
    is not positive, or that lack a feature, cannot enter; ``n_excluded_`` counts them."""

    def __init__(self, features: Sequence[str], dist: str = "logistic", time: str = "time", event: str = "event",
                 max_iter: int = 50, tol: float = 1e-8):
        if dist not in ("normal", "logistic"):
            raise ValueError("dist must be normal or logistic; WeibullAFT fits the extreme-value form")
        self.features, self.dist, self.time, self.event = list(features), dist, time, event
        self.max_iter, self.tol, self.converged_, self.n_excluded_ = max_iter, tol, False, 0

    def _terms(self, z, e):
        """log-likelihood without log sigma, its first and second derivative in z."""
        if self.dist == "logistic":
            c = 1.0 / (1.0 + F.exp(-z))
            log_s = -F.log1p(F.exp(-F.abs(z))) - F.greatest(z, F.lit(0.0))
            return (F.when(e == 1, z + 2 * log_s).otherwise(log_s), F.when(e == 1, 1 - 2 * c).otherwise(-c),
                    F.when(e == 1, -2 * c * (1 - c)).otherwise(-c * (1 - c)))
        h = normal_hazard(z)
        return (F.when(e == 1, -0.5 * z * z - 0.5 * math.log(2 * math.pi)).otherwise(normal_log_survival(z)),
                F.when(e == 1, -z).otherwise(-h), F.when(e == 1, F.lit(-1.0)).otherwise(-h * (h - z)))

    def fit(self, df: DataFrame) -> LocationScaleAFT:
        ok = (F.col(self.time) > 0) & F.col(self.event).isNotNull()
        for f in self.features:
            ok = ok & F.col(f).isNotNull()
        p = len(self.features) + 1
        cols = ["_one", *[f"_x{i}" for i in range(p - 1)]]
        data = df.where(ok).select(F.lit(1.0).alias("_one"), *[F.col(f).cast("double").alias(c) for f, c in zip(self.features, cols[1:], strict=True)],
                                   F.log(F.col(self.time).cast("double")).alias("_y"), F.col(self.event).cast("double").alias("_e")).persist()
        try:
            start = data.agg(F.avg("_y").alias("m"), F.stddev_pop("_y").alias("s"), F.count(F.lit(1)).alias("n")).first()
            self.n_excluded_ = df.count() - start["n"]
            theta = np.array([start["m"] or 0.0, *[0.0] * (p - 1), np.log(max(start["s"] or 1.0, 1e-3))])
            value, grad, hess = self._derivatives(data, theta, cols)
            for _ in range(self.max_iter):
                step = np.linalg.solve(-hess + 1e-9 * np.eye(p + 1), grad)
                while True:
                    new = self._derivatives(data, theta + step, cols)
                    if new[0] >= value - 1e-12 or np.max(np.abs(step)) < 1e-10:
                        break
                    step = step / 2
                theta, gain = theta + step, new[0] - value
                value, grad, hess = new
                if abs(gain) < self.tol * max(1.0, abs(value)) and np.max(np.abs(step)) < 1e-5:
                    self.converged_ = True
                    break
        finally:
            data.unpersist()
        self.intercept_, self.coef_, self.sigma_, self.loglik_ = float(theta[0]), theta[1:-1], float(np.exp(theta[-1])), float(value)
        return self

    def _derivatives(self, data: DataFrame, theta: np.ndarray, cols: list[str]):
        sigma = float(np.exp(theta[-1]))
        mu = F.lit(0.0)
        for b, c in zip(theta[:-1], cols, strict=True):
            mu = mu + F.lit(float(b)) * F.col(c)
        rows = data.withColumn("_z", (F.col("_y") - mu) / sigma)
        value, first, second = self._terms(F.col("_z"), F.col("_e"))
        rows = rows.withColumns({"_l": value, "_a": first, "_b": second})
        p, a, b, z = len(cols), F.col("_a"), F.col("_b"), F.col("_z")
        sums = [F.sum(F.col("_l") - F.col("_e") * float(theta[-1])).alias("l"), F.sum(-z * a - F.col("_e")).alias("gs"), F.sum(z * a + z * z * b).alias("hs")]
        sums += [F.sum(-a * F.col(c) / sigma).alias(f"g{i}") for i, c in enumerate(cols)]
        sums += [F.sum(F.col(c) * (a + z * b) / sigma).alias(f"m{i}") for i, c in enumerate(cols)]
        sums += [F.sum(b * F.col(cols[i]) * F.col(cols[j]) / sigma ** 2).alias(f"h{i}_{j}") for i in range(p) for j in range(i, p)]
        r = rows.agg(*sums).first()
        grad = np.array([*[r[f"g{i}"] for i in range(p)], r["gs"]], dtype=float)
        hess = np.zeros((p + 1, p + 1))
        for i in range(p):
            hess[i, p] = hess[p, i] = r[f"m{i}"]
            for j in range(i, p):
                hess[i, j] = hess[j, i] = r[f"h{i}_{j}"]
        hess[p, p] = r["hs"]
        return float(r["l"]), grad, hess

    def risk(self, df: DataFrame) -> DataFrame:
        mu = F.lit(self.intercept_)
        for b, f in zip(self.coef_, self.features, strict=True):
            mu = mu + F.lit(float(b)) * F.col(f)
        return df.withColumn("mu", mu).withColumn("risk", -F.col("mu"))

    def survival(self, df: DataFrame, horizons: Sequence[float]) -> DataFrame:
        return aft_survival(self.risk(df), horizons, "mu", self.sigma_, self.dist)
