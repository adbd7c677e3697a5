"""A fixed-coefficient linear risk model with a Breslow baseline (used for scoring a known model
and by the stand-in risk of the test cohorts)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tte.operators.models.cox import breslow_baseline, survival_from_baseline


class LinearRisk:
    """risk = sum coef_j x_j; survival S0(h) ^ exp(risk) with S0 the Breslow baseline of ``train``."""

    def __init__(self, coef: dict[str, float], time: str = "time", event: str = "event"):
        self.coef = dict(coef)
        self.time = time
        self.event = event
        self.baseline_ = None

    def risk_expr(self):
        expr = F.lit(0.0)
        for f, b in self.coef.items():
            expr = expr + F.lit(float(b)) * F.col(f)
        return expr

    def fit(self, train: DataFrame) -> "LinearRisk":
        self.baseline_ = breslow_baseline(self.risk(train), F.exp(F.col("risk")), self.time, self.event)
        return self

    def risk(self, df: DataFrame) -> DataFrame:
        return df.withColumn("risk", self.risk_expr())

    def survival(self, df: DataFrame, horizons: Sequence[float]) -> DataFrame:
        scored = df if "risk" in df.columns else self.risk(df)
        return survival_from_baseline(scored, self.baseline_, horizons, F.exp(F.col("risk")))
