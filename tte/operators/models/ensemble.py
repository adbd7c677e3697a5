"""Ensembles, horizon classifiers, per-group fits and model updates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tte.operators.curves import ipcw_weights
from tte.operators.models.cox import CoxPH, cox_derivatives, cox_newton_local, newton_together, survival_exponential
from tte.operators.pairs import concordance
from tte.operators.vector_scan import Band, band_of_batches, band_sums, ranged


def combine(df: DataFrame, risks: Sequence[str], weights: Sequence[float] | None = None, out: str = "risk") -> DataFrame:
    """(weighted) mean of risk columns."""
    w = list(weights) if weights is not None else [1.0] * len(risks)
    tot = sum(w)
    expr = F.lit(0.0)
    for c, wi in zip(risks, w):
        expr = expr + F.lit(float(wi) / tot) * F.col(c)
    return df.withColumn(out, expr)


class Bagging:
    """``n`` Cox members, each on a hashed Poisson bootstrap (weights via row repetition of
    the weight value) and a hashed feature subset; risks averaged. Each member keeps its own
    feature subset."""

    def __init__(self, features: Sequence[str], n: int = 5, feat_frac: float = 1.0, seed: int = 42, alpha: float = 0.1):
        self.features, self.n, self.feat_frac, self.seed, self.alpha = list(features), n, feat_frac, seed, alpha
        self.members_: list[CoxPH] = []

    def fit(self, df: DataFrame, id_col: str) -> "Bagging":
        from tte.operators.replicates import bootstrap_weights

        rng = np.random.default_rng(self.seed)
        k = max(1, int(round(self.feat_frac * len(self.features))))
        for m in range(self.n):
            feats = sorted(rng.choice(self.features, size=k, replace=False).tolist())
            bw = bootstrap_weights(df, id_col, 1, self.seed + m)
            # no copy of a row of weight 0; a filter on the weight would be computed from the id once more
            rep = bw.select("*", F.explode(F.array_repeat(F.lit(1), F.col("bw").cast("int"))).alias("_copy"))
            self.members_.append(CoxPH(feats, alpha=self.alpha).fit(rep))
        return self

    def risk(self, df: DataFrame) -> DataFrame:
        expr = F.lit(0.0)
        for m in self.members_:
            lp = F.lit(0.0)
            for b, f in zip(m.coef_, m.features):
                lp = lp + F.lit(float(b)) * F.col(f)
            expr = expr + lp / float(len(self.members_))
        return df.withColumn("risk", expr)

    def survival(self, df: DataFrame, horizons: Sequence[float]) -> DataFrame:
        """``risk`` and ``surv``, the mean of the members' survival arrays."""
        out, names = self.risk(df).withColumnRenamed("risk", "_bagged"), []
        for i, m in enumerate(self.members_):
            out = m.survival(out, horizons).withColumnRenamed("surv", f"_surv_{i}").drop("risk")
            names.append(f"_surv_{i}")
        return average_arrays(out.withColumnRenamed("_bagged", "risk"), names)


def average_arrays(df: DataFrame, arrays: Sequence[str], out: str = "surv") -> DataFrame:
    """Element-wise mean of equally long array columns, which are dropped."""
    total = F.col(arrays[0])
    for a in arrays[1:]:
        total = F.zip_with(total, F.col(a), lambda x, y: x + y)
    return df.withColumn(out, F.transform(total, lambda x: x / float(len(arrays)))).drop(*arrays)


def stacking(oof: DataFrame, base_risks: Sequence[str], event: str = "event") -> tuple[list[float], float]:
    """Linear meta model on out-of-fold base risks (one column per base model, T13) against
    the event flag (MLlib ``LinearRegression``). Returns (weights, intercept)."""
    v = VectorAssembler(inputCols=list(base_risks), outputCol="_f").transform(oof)
    m = LinearRegression(featuresCol="_f", labelCol=event).fit(v.withColumn(event, F.col(event).cast("double")))
    return [float(c) for c in m.coefficients], float(m.intercept)


def stacked_scores(df: DataFrame, base_risks: Sequence[str], weights: Sequence[float], intercept: float,
                   horizons: Sequence[float], scale: float = 1000.0) -> DataFrame:
    """The meta model's ``risk`` and the survival of a constant hazard ``max(risk, 0) / scale`` (K9)."""
    risk = F.lit(float(intercept))
    for w, r in zip(weights, base_risks, strict=True):
        risk = risk + F.lit(float(w)) * F.col(r)
    return _with_exponential(df.withColumn("risk", risk), horizons, scale)


def dynamic_scores(df: DataFrame, kept: Sequence[str], horizons: Sequence[float], scale: float = 1000.0) -> DataFrame:
    """Mean ``risk`` of the models kept and the survival of a constant hazard (K9)."""
    return _with_exponential(combine(df, kept), horizons, scale)


def _with_exponential(df: DataFrame, horizons: Sequence[float], scale: float) -> DataFrame:
    hazard = df.withColumn("_hazard", F.greatest(F.col("risk"), F.lit(0.0)) / scale)
    return survival_exponential(hazard, horizons, "_hazard").drop("_hazard")


def long_risks(df: DataFrame, risks: dict[str, str], name: str, time: str = "time", event: str = "event") -> DataFrame:
    """``time, event``, ``name`` and ``risk``: every row once per name, with the risk of the column that ``risks`` maps it to."""
    each = F.array(*[F.struct(F.lit(n).alias(name), F.col(r).cast("double").alias("risk")) for n, r in risks.items()])
    return df.select(time, event, F.explode(each).alias("_m")).select(time, event, "_m.*")


def dynamic_selection(oof: DataFrame, base_risks: Sequence[str], method: str = "top_half") -> list[str]:
    """Keep the better half of the base models by out-of-fold C-index (``top_half``), the
    first half (``first_half``) or all (``all``)."""
    if method == "all":
        return list(base_risks)
    half = max(1, len(base_risks) // 2)
    if method == "first_half":
        return list(base_risks)[:half]
    found = {r["model"]: r["c_index"] for r in concordance(long_risks(oof, {r: r for r in base_risks}, "model"), by=["model"]).collect()}
    scores = [(-(found.get(r) or 0.0), r) for r in base_risks]
    return [r for _, r in sorted(scores)[:half]]


CLASSIFIERS = {
    "logistic": lambda **p: LogisticRegression(**p),
    "svc": lambda **p: LinearSVC(**p),
    "tree": lambda **p: DecisionTreeClassifier(**p),
    "forest": lambda **p: RandomForestClassifier(**p),
    "gbt": lambda **p: GBTClassifier(**p),
    "naive_bayes": lambda **p: NaiveBayes(modelType="gaussian", **p),
}


def horizon_classifier(df: DataFrame, features: Sequence[str], tau: float, time: str = "time", event: str = "event",
                       kind: str = "logistic", **params):
    """P(event by tau) from an MLlib classifier (a key of ``CLASSIFIERS``) weighted by IPCW weights
    (censored before tau get weight 0). Returns a function that adds ``risk`` = P(event by tau); the
    support vector classifier has no probability, its risk is the sigmoid of the margin. Rows without a
    feature value are not learned from and get a null risk."""
    return horizon_classifiers(df, features, tau, {kind: params}, time, event)[kind]


def horizon_classifiers(df: DataFrame, features: Sequence[str], tau: float, kinds: dict[str, dict], time: str = "time",
                        event: str = "event") -> dict[str, Callable[[DataFrame], DataFrame]]:
    """L10 for several kinds, each with its parameters: the censoring curve is planned once for all."""
    whole = _whole(features)
    w = ipcw_weights(df.where(whole), [tau], time, event).withColumn("_y", ((F.col(time) <= tau) & (F.col(event) == 1)).cast("double"))
    v = VectorAssembler(inputCols=list(features), outputCol="_f").transform(w.where(F.col("weight") > 0))
    # not persisted: kept rows lie in other partitions, and the trees' fits depend on those
    models = {kind: CLASSIFIERS[kind](featuresCol="_f", labelCol="_y", weightCol="weight", **params).fit(v) for kind, params in kinds.items()}
    return {kind: _scorer(model, features) for kind, model in models.items()}


def _whole(features: Sequence[str]) -> Column:
    whole = F.lit(True)
    for f in features:
        whole = whole & F.col(f).isNotNull()
    return whole


def _scorer(model, features: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    whole = _whole(features)

    def score(x: DataFrame) -> DataFrame:
        vv = VectorAssembler(inputCols=list(features), outputCol="_f", handleInvalid="keep").transform(x)
        scored = model.transform(vv)
        p = vector_to_array("probability")[1] if "probability" in scored.columns else 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))
        return scored.withColumn("risk", F.when(whole, p)).drop("_f", "rawPrediction", "probability", "prediction")

    return score


def fit_per_group(df: DataFrame, key: str, features: Sequence[str], time: str = "time", event: str = "event",
                  alpha: float = 0.0, n_iter: int = 50, tol: float = 1e-9) -> DataFrame:
    """One Cox model per group, ``key, n, coef_...``, whatever the number of groups and their sizes; a null key is a group
    like any other (the reference keeps the first group only).

    The rows are ranged by group and descending time into bands. A group that lies within one band takes all its Newton
    steps there, in the task that holds the band. The groups that reach over a band's end, fewer than there are bands,
    take theirs together: each step is one set of passes over the bands for all of them (``cox_derivatives``).
    The likelihood, the steps and the stop test are the same. Rows without a time, event or feature are left out
    and not counted in ``n``; a group without an event or with a single row has null coefficients."""
    feats = list(features)
    ok = " and ".join(f"({c} is not null and not isnan({c}))" for c in (f"cast(`{c}` as double)" for c in [time, event, *feats]))
    rows = df.select(F.col(key).alias("key"), F.to_json(F.struct(F.col(key).alias("k"))).alias("g"), F.col(time).cast("double").alias("t"),
                     F.col(event).cast("double").alias("e"), F.array(*[F.col(c).cast("double") for c in feats]).alias("z"),
                     F.expr(ok).alias("ok"))
    data = ranged(rows, "t", rows.count(), descending=True, group="g")
    out = T.StructType([T.StructField("g", T.StringType()), T.StructField("n", T.LongType()), T.StructField("coef", T.ArrayType(T.DoubleType()))])

    def ends(batches):
        keys = [b.column("g") for b in batches if b.num_rows]
        if keys:
            yield pa.RecordBatch.from_pydict({"band": pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              "first": pa.array([keys[0][0].as_py()]), "last": pa.array([keys[-1][-1].as_py()])})

    bands = data.select("g").mapInArrow(ends, "band int, first string, last string").orderBy("band").collect()
    long = sorted({a["last"] for a, b in zip(bands, bands[1:]) if a["last"] == b["first"]})  # fewer than bands
    number = {g: i for i, g in enumerate(long)}

    def within(batches):
        _, band = band_of_batches(batches)
        found = []
        for g, at in pd.Series(band.get("g", [])).groupby(band.get("g", []), sort=False).indices.items():
            if g not in number:
                at = at[band["ok"][at].astype(bool)]
                fit = len(at) >= 2 and band["e"][at].sum() > 0
                coef = cox_newton_local(band["z"][at], band["t"][at], band["e"][at], alpha, n_iter, tol).tolist() if fit else [None] * len(feats)
                found.append((g, len(at), coef))
        if found:
            yield pa.RecordBatch.from_pydict(dict(zip(("g", "n", "coef"), zip(*found), strict=True)),
                                             schema=pa.schema([("g", pa.string()), ("n", pa.int64()), ("coef", pa.list_(pa.float64()))]))

    # the result of the small groups is written, so the kept bands can go
    small = data.select("g", "t", "e", "z", "ok").mapInArrow(within, out).checkpoint()
    try:
        fitted = _fit_long(data, number, len(feats), alpha, n_iter, tol) if number else []
    finally:
        data.unpersist()
    found = small.unionByName(df.sparkSession.createDataFrame(fitted, out))
    keys = rows.groupBy("g").agg(F.first("key", ignorenulls=False).alias("key"))
    return keys.join(found, "g").select(F.col("key").alias(key), "n", *[F.col("coef")[i].alias(f"coef_{f}") for i, f in enumerate(feats)])


def _fit_long(data: DataFrame, number: dict[str, int], p: int, alpha: float, n_iter: int, tol: float) -> list[tuple]:
    """The groups that several bands share: (group, rows, coefficients)."""

    def raw(band: Band):
        for g, at in pd.Series(band["g"]).groupby(band["g"], sort=False).indices.items():
            if g in number:
                at = at[band["ok"][at].astype(bool)]
                yield number[g], {"t": band["t"][at], "e": band["e"][at], "z": band["z"][at]}

    sums = band_sums(data, lambda _, __, x: np.concatenate(([len(x["t"]), x["e"].sum()], x["z"].sum(axis=0), (x["z"] ** 2).sum(axis=0))), raw)
    scale, problems = {}, {}
    for i, x in sums.items():
        n, mu = x[0], x[2: p + 2] / x[0]
        sd = np.sqrt(np.maximum(x[p + 2:] / n - mu ** 2, 0.0))
        sd[sd < 1e-12 * np.maximum(1.0, np.abs(mu))] = 1.0
        scale[i] = mu, sd
        if n >= 2 and x[1] > 0:
            problems[i] = np.zeros(p), alpha / sd ** 2

    def parts(band: Band):
        for i, x in raw(band):
            if i in problems:
                yield i, x | {"z": (x["z"] - scale[i][0]) / scale[i][1]}

    fits = newton_together(lambda betas: cox_derivatives(data, betas, parts), problems, n_iter, tol) if problems else {}
    return [(g, int(sums[i][0]) if i in sums else 0, (fits[i][0] / scale[i][1]).tolist() if i in fits else [None] * p) for g, i in number.items()]


def update_model(model: CoxPH, history: DataFrame, new: DataFrame, strategy: str = "sliding", ts: str = "ts",
                 window_days: int = 30, min_samples: int = 50, n_updates: int = 0, max_updates: int = 10):
    """Refit warm-started from the old coefficients: ``online`` on the new rows, ``batch`` on
    history + new, ``sliding`` on the rows of the last ``window_days`` (by ``ts``). Gate: at least
    ``min_samples`` new rows and fewer than ``max_updates`` updates so far. Returns (model, updated)."""
    n_new = new.count()
    if n_new < min_samples or n_updates >= max_updates:
        return model, False
    if strategy == "online":
        data = new
    elif strategy == "batch":
        data = history.unionByName(new, allowMissingColumns=True)
    elif strategy == "sliding":
        allr = history.unionByName(new, allowMissingColumns=True)
        end = allr.agg(F.max(ts).alias("_end"))
        data = allr.crossJoin(F.broadcast(end)).where(
            F.col(ts) > F.col("_end") - F.expr(f"INTERVAL {int(window_days)} DAYS")).drop("_end")
    else:
        raise ValueError("strategy must be online, batch or sliding")
    fresh = CoxPH(model.features, alpha=model.alpha, time=model.time, event=model.event).fit(data, init=model.coef_)
    return fresh, True
