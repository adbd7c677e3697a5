"""Calibration and decision curves.

Input: long predictions ``(time, event, horizon, surv)``; weights from ``ipcw_weights`` (the
reference's convention: censoring KM with ``ties="all"``, linear read clipped to [1e-8, 1]).
Bins and thresholds are literal lists, so every curve is one grouped aggregate, no cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tte.operators.curves import ipcw_weights


def bin_edges(bins: int) -> list[float]:
    """Equal-width edges on [0, 1] exactly as ``numpy.linspace`` gives them."""
    return [float(x) for x in np.linspace(0.0, 1.0, bins + 1)]


def bin_equal(c: Column, bins: int) -> Column:
    """Left-closed equal-width bin index; values >= 1.0 get index ``bins`` (callers drop it),
    values < 0 get -1. Compared with the literal edges, not ``floor(c * bins)``."""
    edges = bin_edges(bins)
    out = F.lit(-1)
    for i, e in enumerate(edges):
        out = F.when(c >= F.lit(e), F.lit(i)).otherwise(out)
    return out


def _clip01(c: Column) -> Column:
    return F.when(c.isNull(), c).otherwise(F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)))


def reliability_ipcw(long_preds: DataFrame, horizons: Sequence[float], bins: int = 10, time: str = "time",
                     event: str = "event") -> DataFrame:
    """M7: IPCW reliability curve: per horizon and bin, expected = mean clipped S, observed =
    sum(w * I(T > h)) / sum(w), interval +-1.96 sqrt(max(o(1-o), 1e-8) / sum w) kept in [0, 1];
    bins with sum w <= 0 left out; a prediction of exactly 1.0 falls outside every bin."""
    subjects = long_preds.where(F.col("horizon") == float(horizons[0]))
    j = ipcw_weights(long_preds, horizons, time, event, ties="all", lookup="linear", train=subjects,
                     exploded=True, times_in_curve=True)
    p = _clip01(F.col("surv"))
    j = j.withColumn("_p", p).withColumn("bin", bin_equal(p, bins)).where((F.col("bin") >= 0) & (F.col("bin") < bins))
    agg = j.groupBy(F.col("horizon").alias("time"), "bin").agg(
        F.sum("weight").alias("_sw"),
        F.sum(F.when(F.col(time) > F.col("horizon"), F.col("weight")).otherwise(F.lit(0.0))).alias("_sy"),
        F.avg("_p").alias("expected"),
        F.count(F.lit(1)).alias("count"),
    ).where(F.col("_sw") > 0)
    o = F.col("_sy") / F.col("_sw")
    se = F.sqrt(F.greatest(o * (1 - o), F.lit(1e-8)) / F.col("_sw"))
    return agg.select(
        "time", "bin", "expected", o.alias("observed"),
        F.greatest(o - 1.96 * se, F.lit(0.0)).alias("ci_lower"),
        F.least(o + 1.96 * se, F.lit(1.0)).alias("ci_upper"),
        "count",
    )


def reliability_naive(long_preds: DataFrame, bins: int = 10, time: str = "time", event: str = "event") -> DataFrame:
    """M8: the older unweighted curve: observed = share with T > h or censored (no clipping)."""
    b = bin_equal(F.col("surv"), bins)
    j = long_preds.withColumn("bin", b).where((F.col("bin") >= 0) & (F.col("bin") < bins))
    obs = ((F.col(time) > F.col("horizon")) | (F.col(event) == 0)).cast("double")
    return j.groupBy(F.col("horizon").alias("time"), "bin").agg(
        F.avg("surv").alias("expected"), F.avg(obs).alias("observed"), F.count(F.lit(1)).alias("count"))


def calibration_mae(curve: DataFrame) -> DataFrame:
    """M9: mean absolute gap between expected and observed per horizon."""
    return curve.groupBy("time").agg(F.avg(F.abs(F.col("expected") - F.col("observed"))).alias("mae"))


def decision_curve_ipcw(long_preds: DataFrame, horizons: Sequence[float], thresholds: Sequence[float],
                        time: str = "time", event: str = "event") -> DataFrame:
    """IPCW net benefit per horizon and threshold.

    risk = 1 - clip(S); TP and FP are weight sums among risk >= threshold divided by n;
    NB = TP - FP p/(1-p); treat-all = prevalence - (1 - prevalence) p/(1-p); treat-none = 0.
    One pass per horizon with one conditional sum per threshold.
    """
    subjects = long_preds.where(F.col("horizon") == float(horizons[0]))
    j = ipcw_weights(long_preds, horizons, time, event, ties="all", lookup="linear", train=subjects,
                     exploded=True, times_in_curve=True)
    t, e, h = F.col(time), F.col(event), F.col("horizon")
    ew = F.when((t <= h) & (e == 1), F.col("weight")).otherwise(F.lit(0.0))
    nw = F.when(t > h, F.col("weight")).otherwise(F.lit(0.0))
    risk = 1.0 - _clip01(F.col("surv"))
    aggs = [F.count(F.lit(1)).alias("_n"), F.sum(ew).alias("_ew")]
    for i, thr in enumerate(thresholds):
        aggs += [F.sum(F.when(risk >= float(thr), ew).otherwise(F.lit(0.0))).alias(f"_tp{i}"),
                 F.sum(F.when(risk >= float(thr), nw).otherwise(F.lit(0.0))).alias(f"_fp{i}")]
    wide = j.groupBy("horizon").agg(*aggs)
    n = F.greatest(F.col("_n"), F.lit(1))
    rows = []
    for i, thr in enumerate(thresholds):
        odds = float(thr) / max(1.0 - float(thr), 1e-8)
        prev = F.col("_ew") / n
        rows.append(F.struct(
            F.lit(float(thr)).alias("threshold"),
            (F.col(f"_tp{i}") / n - F.col(f"_fp{i}") / n * odds).alias("net_benefit"),
            (prev - (1 - prev) * odds).alias("treat_all"),
            F.lit(0.0).alias("treat_none"),
        ))
    return wide.select(F.col("horizon").alias("time"), F.explode(F.array(*rows)).alias("_r")).select("time", "_r.*")


def decision_curve_naive(long_preds: DataFrame, thresholds: Sequence[float], time: str = "time",
                         event: str = "event") -> DataFrame:
    """The older unweighted curve: events among the treated / n - share treated x p."""
    t, e, h = F.col(time), F.col(event), F.col("horizon")
    ev = ((t <= h) & (e == 1)).cast("double")
    risk = 1.0 - F.col("surv")
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, thr in enumerate(thresholds):
        treat = risk >= float(thr)
        aggs += [F.sum(F.when(treat, ev).otherwise(F.lit(0.0))).alias(f"_te{i}"),
                 F.sum(treat.cast("double")).alias(f"_tr{i}")]
    wide = long_preds.groupBy("horizon").agg(*aggs)
    rows = [F.struct(F.lit(float(thr)).alias("threshold"),
                     (F.col(f"_te{i}") / F.col("_n") - F.col(f"_tr{i}") / F.col("_n") * float(thr)).alias("net_benefit"))
            for i, thr in enumerate(thresholds)]
    return wide.select(F.col("horizon").alias("time"), F.explode(F.array(*rows)).alias("_r")).select("time", "_r.*")
