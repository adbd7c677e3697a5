"""Cross-validation of Cox models with all folds and penalties fitted together (V5-V7).

``split.cross_validate`` and its kin take any model and fit one after the other. For Cox models the
Newton steps of all folds and grid points share their passes (``cox_together``), and all held-out
scores come from one grouped concordance.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tte.operators.models.cox import CoxPH, cox_folds, cox_tables, cox_together
from tte.operators.pairs import concordance
from tte.operators.split import kfold
from tte.session import ensure_checkpoint_dir


def linear_risk(model: CoxPH) -> Column:
    return sum((F.lit(float(b)) * F.col(c) for b, c in zip(model.coef_, model.features, strict=True)), F.lit(0.0))


class CoxFit:
    """Fits a Cox model to one table, or to many ``together`` in the same passes."""

    def __init__(self, features: Sequence[str], time: str = "time", event: str = "event"):
        self.features, self.time, self.event = list(features), time, event

    def __call__(self, rows: DataFrame) -> CoxPH:
        return CoxPH(self.features, time=self.time, event=self.event).fit(rows)

    def together(self, tables: Sequence[DataFrame]) -> list[CoxPH]:
        return cox_tables(tables, self.features, time=self.time, event=self.event)


class CIndex:
    """The C-index of a model on one table (0 without a comparable pair), or of many models on theirs ``together``, by one
    grouped count."""

    def __init__(self, time: str = "time", event: str = "event"):
        self.time, self.event = time, event

    def __call__(self, model: CoxPH, rows: DataFrame) -> float:
        return concordance(model.risk(rows), "risk", self.time, self.event).first()["c_index"] or 0.0

    def together(self, models: Sequence[CoxPH], tables: Sequence[DataFrame]) -> list[float]:
        scored = [m.risk(t).select(F.lit(i).alias("_case"), self.time, self.event, "risk") for i, (m, t) in enumerate(zip(models, tables, strict=True))]
        found = concordance(reduce(DataFrame.unionAll, scored), "risk", self.time, self.event, by=["_case"]).select("_case", "c_index").collect()
        c = {r["_case"]: r["c_index"] for r in found}
        return [c.get(i) or 0.0 for i in range(len(models))]


def cox_oof(df: DataFrame, features: Sequence[str], alpha: float = 0.0, k: int = 5, id_col: str = "subject_id", seed: int = 42,
            stratify: str | None = "event", time: str = "time", event: str = "event") -> tuple[DataFrame, dict[int, CoxPH]]:
    """V5: every row with its ``fold`` and the ``risk`` that the model of the other folds gives it; and the models."""
    ensure_checkpoint_dir(df.sparkSession)
    folded = kfold(df, id_col, k, seed, stratify).checkpoint()  # ranked by a sort, and read by the fits and by every score
    models = {f: m for (f, _), m in cox_folds(folded, features, [alpha], k, time=time, event=event).items()}
    risk = F.lit(None).cast("double")
    for f, m in models.items():
        risk = F.when(F.col("fold") == f, linear_risk(m)).otherwise(risk)
    return folded.withColumn("risk", risk), models


def _scored(rows: DataFrame, cases: Sequence[tuple[Column, Column]], time: str, event: str) -> dict[int, float]:
    """C-index per case (its place in ``cases``; None without a comparable pair) over the rows of its condition, scored by its risk;
    all cases in one grouped count."""
    each = F.array(*[F.when(cond, F.struct(F.lit(i).alias("_case"), risk.alias("_risk"))) for i, (cond, risk) in enumerate(cases)])
    long = rows.select(time, event, F.explode(each).alias("_x")).where("_x is not null").select(time, event, "_x._case", "_x._risk")
    return {r["_case"]: r["c_index"] for r in concordance(long, "_risk", time, event, by=["_case"]).select("_case", "c_index").collect()}


def cox_search(df: DataFrame, features: Sequence[str], alphas: Sequence[float], k: int = 3, id_col: str = "subject_id", seed: int = 42,
               time: str = "time", event: str = "event") -> DataFrame:
    """V7: ``alpha, mean_c``, the mean held-out C-index over the folds, for every penalty tried."""
    folded = kfold(df, id_col, k, seed, event, keep=list(dict.fromkeys([time, event, *features]))).persist()
    try:
        models = cox_folds(folded, features, alphas, k, time=time, event=event)
        # k x alphas numbers
        c = _scored(folded, [(F.col("fold") == f, linear_risk(m)) for (f, _), m in models.items()], time, event)
    finally:
        folded.unpersist()
    scores = [(float(a), c[i]) for i, (_, a) in enumerate(models) if i in c]
    return df.sparkSession.createDataFrame(scores, "alpha double, c_index double").groupBy("alpha").agg(F.avg("c_index").alias("mean_c"))


def random_alphas(lo: float, hi: float, trials: int, seed: int = 42) -> list[float]:
    """Log-uniform draws."""
    return np.exp(np.random.default_rng(seed).uniform(np.log(lo), np.log(hi), trials)).tolist()


def cox_nested_cv(df: DataFrame, features: Sequence[str], alphas: Sequence[float], outer: int = 3, inner: int = 3, id_col: str = "subject_id",
                  seed: int = 42, time: str = "time", event: str = "event") -> DataFrame:
    """V6: per outer fold the penalty with the best mean inner C-index on the outer training rows (ties: the
    first of ``alphas``), that mean, and the C-index on the outer fold of the model refitted with it: ``outer_fold, alpha,
    inner_c, outer_c``. Inner folds are drawn once over all rows, so an outer fold's training rows are split by the
    same draw; inner and outer models of all penalties are fitted together."""
    rows = kfold(kfold(df, id_col, outer, seed, event).withColumnRenamed("fold", "outer"), id_col, inner, seed + 1, event,
                 keep=list(dict.fromkeys([time, event, *features, "outer"]))).withColumnRenamed("fold", "inner")
    rows = rows.persist()
    try:
        # subset f * (inner + 1) + g leaves out outer fold f and inner fold g (g = inner: none)
        problems = dict(enumerate((f * (inner + 1) + g, a) for f in range(outer) for g in range(inner + 1) for a in alphas))
        models = cox_together(rows, features, problems, lambda band, which: (band["outer"] != which // (inner + 1)) & (band["inner"] != which % (inner + 1)),
                              ["outer", "inner"], time, event)
        cases = []
        for number, (which, a) in problems.items():
            f, g = divmod(which, inner + 1)
            held = (F.col("outer") == f) if g == inner else (F.col("outer") != f) & (F.col("inner") == g)
            cases.append((held, linear_risk(models[number])))
        # outer x inner x alphas numbers
        scores = _scored(rows, cases, time, event)
    finally:
        rows.unpersist()
    c = {(*divmod(which, inner + 1), float(a)): scores.get(number) or 0.0 for number, (which, a) in problems.items()}
    out = []
    for f in range(outer):
        means = [float(np.mean([c.get((f, g, float(a)), 0.0) for g in range(inner)])) for a in alphas]
        best = int(np.argmax(means))
        out.append((f, float(alphas[best]), means[best], c.get((f, inner, float(alphas[best])), 0.0)))
    return df.sparkSession.createDataFrame(out, "outer_fold int, alpha double, inner_c double, outer_c double")
