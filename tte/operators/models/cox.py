"""Cox proportional hazards on Spark (L1) with the Breslow baseline (K7-K9) and a local NumPy
form for per-group fits (L11).

Newton-Raphson on the Breslow partial likelihood. The rows are ranged by descending time once and kept as bytes; each step
is a vector scan of w = exp(x b) and w x over the bands (``vector_scan``), a scalar scan of the hazard, and
one pass that adds up the gradient and the Hessian as matrix products; for a few features (``FEW``) the last two are one
pass. The plans have the same size for 2 and for 100 features. Besides p + p x p sums only p + 1 numbers a band
(2 p x p more for a few features) reach the driver, where the p x p system is solved. Features are centred and scaled inside; the ridge penalty
0.5 alpha |b|^2 applies to the coefficients on the original scale.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tte.operators.curves import curve_at
from tte.operators.scan import prefix_sum
from tte.operators.vector_scan import Band, band_of_batches, band_offsets, band_sums, ranged, rows_where, running, whole
from tte.session import ensure_checkpoint_dir


def breslow_baseline(df: DataFrame, rel_risk: Column | str, time: str = "time", event: str = "event",
                     by: Sequence[str] = ()) -> DataFrame:
    """K7: baseline cumulative hazard at event times: H0(t) = sum over event times s <= t of
    d_s / max(sum of relative risks with T >= s, 1e-8); ``surv0`` = exp(-H0).
    Output ``by..., time, hazard0, surv0`` (one row per distinct event time)."""
    by = list(by)
    r = F.col(rel_risk) if isinstance(rel_risk, str) else rel_risk
    agg = df.groupBy(*by, F.col(time).cast("double").alias("time")).agg(
        F.sum(r.cast("double")).alias("_r"), F.sum(F.col(event).cast("double")).alias("_d"))
    # S0(t) = sum over T >= t: running sum in descending time = running sum over -time
    rev = prefix_sum(agg.withColumn("_nt", -F.col("time")), "_nt", ["_r"], by=by)
    ev = rev.where(F.col("_d") > 0).withColumn("_inc", F.col("_d") / F.greatest(F.col("cum__r"), F.lit(1e-8)))
    h = prefix_sum(ev.select(*by, "time", "_inc"), "time", ["_inc"], by=by)
    return h.select(*by, "time", F.col("cum__inc").alias("hazard0"), F.exp(-F.col("cum__inc")).alias("surv0"))


def survival_from_baseline(df: DataFrame, baseline: DataFrame, horizons: Sequence[float], rel_risk: Column | str,
                           lookup: str = "step") -> DataFrame:
    """K8: S(h | x) = S0(h) ^ r for each row; S0 read at the (few) horizons and broadcast.
    Adds ``surv`` as ``ARRAY<DOUBLE>`` in horizon order."""
    s0 = curve_at(baseline, horizons, "surv0", lookup)
    wide = s0.groupBy().pivot("horizon", [float(h) for h in horizons]).agg(F.first("surv0"))
    names = [f"_s0_{i}" for i in range(len(horizons))]
    wide = wide.select(*[F.col(f"`{float(h)}`").alias(n) for h, n in zip(horizons, names)])
    r = F.col(rel_risk) if isinstance(rel_risk, str) else rel_risk
    out = df.crossJoin(F.broadcast(wide))
    return out.withColumn("surv", F.array(*[F.pow(F.col(n), r) for n in names])).drop(*names)


def survival_exponential(df: DataFrame, horizons: Sequence[float], risk: str = "risk") -> DataFrame:
    """K9: exp(-risk t) clipped to [0, 1] per horizon, as ``ARRAY<DOUBLE>``."""
    vals = [F.least(F.greatest(F.exp(-F.col(risk) * float(h)), F.lit(0.0)), F.lit(1.0)) for h in horizons]
    return df.withColumn("surv", F.array(*vals))


class CoxPH:
    """L1: ridge Cox model, Breslow ties; ``risk`` = x b (higher = earlier event)."""

    def __init__(self, features: Sequence[str], alpha: float = 0.0, n_iter: int = 50, tol: float = 1e-9,
                 time: str = "time", event: str = "event"):
        self.features = list(features)
        self.alpha = alpha
        self.n_iter = n_iter
        self.tol = tol
        self.time = time
        self.event = event
        self.coef_: np.ndarray | None = None
        self._baseline: DataFrame | None = None
        self._baseline_rows: DataFrame | None = None
        self.loglik_: float | None = None
        self.n_iter_: int = 0
        self.converged_ = False
        self.n_excluded_ = 0

    def _lp(self, coef: np.ndarray, cols: Sequence[str]) -> Column:
        expr = F.lit(0.0)
        for b, c in zip(coef, cols):
            expr = expr + F.lit(float(b)) * F.col(c)
        return expr

    def fit(self, df: DataFrame, init: np.ndarray | None = None) -> "CoxPH":
        p = len(self.features)
        stats = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(self.features)],
                       *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(self.features)]).collect()[0]
        mu, sd = _scales(stats, p)
        data = ranged(cox_rows(df, self.features, mu, sd, self.time, self.event), "t", stats["n"], descending=True, pack=True)
        try:
            # rows without a time, event or feature cannot enter a risk set: their number is reported
            self.n_excluded_ = stats["n"] - (data.agg(F.sum("_rows")).first()[0] or 0)
            beta = (np.asarray(init, float) * sd) if init is not None else np.zeros(p)
            pen = self.alpha / sd ** 2  # ridge on the original-scale coefficients
            beta, self.loglik_, self.n_iter_, self.converged_ = newton(
                lambda b: cox_derivatives(data, {0: b})[0], beta, pen, self.n_iter, self.tol)
        finally:
            data.unpersist()
        if not self.converged_:
            warnings.warn(f"Cox fit stopped after {self.n_iter} steps without converging", stacklevel=2)
        self.coef_ = beta / sd
        self.intercept_shift_ = float(np.dot(self.coef_, mu))
        return self.with_baseline(df)

    def with_baseline(self, df: DataFrame) -> "CoxPH":
        """Take the Breslow baseline of the rows ``df``."""
        self._baseline, self._baseline_rows = None, df
        return self

    @property
    def baseline_(self) -> DataFrame | None:
        """The Breslow baseline, planned when it is first read: its scans run actions of their own."""
        if self._baseline is None and self._baseline_rows is not None:
            self._baseline = breslow_baseline(self.risk(self._baseline_rows), F.exp(F.col("risk")), self.time, self.event)
        return self._baseline

    @baseline_.setter
    def baseline_(self, baseline: DataFrame | None) -> None:
        self._baseline = baseline

    def risk(self, df: DataFrame) -> DataFrame:
        """I1 (linear): ``risk`` = x b on the original scale."""
        return df.withColumn("risk", self._lp(self.coef_, self.features))

    def survival(self, df: DataFrame, horizons: Sequence[float]) -> DataFrame:
        """S(h | x) = S0(h) ^ exp(x b), S0 the Breslow baseline of the training rows."""
        scored = df if "risk" in df.columns else self.risk(df)
        return survival_from_baseline(scored, self.baseline_, horizons, F.exp(F.col("risk")))


def cox_rows(df: DataFrame, features: Sequence[str], mu: np.ndarray, sd: np.ndarray, time: str, event: str, keep: Sequence[Column] = ()) -> DataFrame:
    """Rows ``t, e, z`` (and ``keep``) with a time, an event and all features, the features centred and scaled in one array."""
    z = F.array(*[(F.col(c).cast("double") - float(m)) / float(s) for c, m, s in zip(features, mu, sd, strict=True)])
    complete = " and ".join(["t is not null", "e is not null", *[f"z[{i}] is not null and not isnan(z[{i}])" for i in range(len(features))]])
    return df.select(F.col(time).cast("double").alias("t"), F.col(event).cast("double").alias("e"), z.alias("z"), *keep).where(complete)


Derivatives = tuple[float, np.ndarray, np.ndarray]
#: Up to so many features the p x p sums of single bands go to the driver, which saves a pass.
FEW = 8


def cox_derivatives(data: DataFrame, betas: dict[int, np.ndarray], parts: Callable[[Band], Iterable[tuple[int, Band]]] = whole) -> dict[int, Derivatives]:
    """Log-likelihood, gradient and Hessian of the Breslow partial likelihood of every problem at its coefficients, in
    the same passes over the bands of ``data`` (``cox_rows`` in descending order of time, ``parts`` as in
    ``band_offsets``).

    With S0(t), S1(t) the sums of w and w z over the risk set (a vector scan of length p + 1) and A(t) the sum of
    d / S0 over event times up to t, the sum over event times of d S2 / S0 is the sum over subjects of
    w A(t) z z', so the scan never carries p x p numbers; those are summed once, as matrix products of a band."""
    shift = dict.fromkeys(betas, 0.0)

    def mine(band: Band):
        return ((p, rows) for p, rows in parts(band) if p in betas)

    def weights(problem: int, rows: Band) -> tuple[np.ndarray, np.ndarray]:
        lp = rows["z"] @ betas[problem]
        return lp, np.exp(np.minimum(lp - shift[problem], 700.0))

    def scanned(problem: int, rows: Band) -> np.ndarray:
        _, w = weights(problem, rows)
        return np.column_stack((w, w[:, None] * rows["z"]))

    offsets = band_offsets(data, "t", scanned, parts=mine)
    if any(not np.isfinite(o.before).all() or o.before[0] > 1e250 for o in offsets.values()):
        # weights only enter as ratios within a risk set: far out, the largest is shifted to 1
        shift |= _largest(data, betas, mine)
        offsets = band_offsets(data, "t", scanned, parts=mine)

    def risk_sets(number: int, problem: int, rows: Band) -> tuple[np.ndarray, np.ndarray]:
        sums = running(rows["t"], scanned(problem, rows), offsets[number, problem])
        return sums, np.maximum(sums[:, 0], 1e-300)  # a risk set far below the largest risk underflows

    # events before a time lie behind it in this order, so what a band does not hold of A comes from the bands after it
    few = all(len(beta) <= FEW for beta in betas.values())
    share = {} if few else _hazards_outside(data, risk_sets, mine)

    def part(number: int, problem: int, rows: Band, own: bool = False) -> np.ndarray:
        t, e, z = rows["t"], rows["e"], rows["z"]
        sums, s0 = risk_sets(number, problem, rows)
        later, above = (0.0, 0.0) if own else share[number, problem]
        # A(t): events at times up to t; this band's rows from t's first row on, the bands after, and the rows
        # of t in the bands before
        a = np.cumsum((e / s0)[::-1])[::-1][np.searchsorted(-t, -t, side="left")] + later
        a[t == t[0]] += above
        lp, w = weights(problem, rows)
        dead = e > 0
        s1 = sums[dead, 1:] / s0[dead, None]
        ll = float((e * (lp - shift[problem])).sum() - (e[dead] * np.log(s0[dead])).sum())
        grad = (e[:, None] * z).sum(axis=0) - (e[dead, None] * s1).sum(axis=0)
        hess = (s1 * e[dead, None]).T @ s1 - (z * (w * a)[:, None]).T @ z
        out = np.concatenate(([ll], grad, hess.ravel()))
        if not own:
            return out
        # with the sums of w z z' of the band and of its first time, its Hessian is completed where the other bands' hazards are known
        first, mine_h = t == t[0], e / s0
        zw = z * w[:, None]
        return np.concatenate(([t[0], t[-1], mine_h.sum(), mine_h[t == t[-1]].sum()], out, (zw.T @ z).ravel(), (zw[first].T @ z[first]).ravel()))

    found = _completed(data, lambda *a: part(*a, own=True), mine, betas) if few else band_sums(data, part, mine)
    out = {}
    for problem, beta in betas.items():
        p = len(beta)
        x = found.get(problem, np.zeros(1 + p + p * p))
        out[problem] = float(x[0]), x[1: p + 1], x[p + 1:].reshape(p, p)
    return out


def _largest(data: DataFrame, betas: dict[int, np.ndarray], parts) -> dict[int, float]:
    def run(batches):
        _, band = band_of_batches(batches)
        for problem, rows in parts(band) if band else ():
            if len(rows["t"]):
                yield pa.RecordBatch.from_arrays([pa.array([problem], pa.int32()), pa.array([float((rows["z"] @ betas[problem]).max())])], names=["problem", "x"])

    return {r["problem"]: float(r["x"]) for r in data.mapInArrow(run, "problem int, x double").groupBy("problem").agg(F.max("x").alias("x")).collect()}


def _hazards_outside(data: DataFrame, risk_sets, parts) -> dict[tuple[int, int], tuple[float, float]]:
    """Per (band, problem): the hazard of the events in the bands after it, and of those at its first time in the
    bands before."""

    def run(batches):
        number, band = band_of_batches(batches)
        for problem, rows in parts(band) if band else ():
            t = rows["t"]
            if len(t):
                mine = rows["e"] / risk_sets(number, problem, rows)[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([problem], pa.int32()), *(pa.array([float(x)]) for x in (
                        t[0], t[-1], mine.sum(), mine[t == t[-1]].sum()))], names=["band", "problem", "first", "last", "total", "tail"])

    return _outside(data.mapInArrow(run, "band int, problem int, first double, last double, total double, tail double").toPandas())


def _outside(rows: pd.DataFrame) -> dict[tuple[int, int], tuple[float, float]]:
    out = {}
    for problem, own in rows.sort_values(["problem", "band"]).groupby("problem"):
        first, last, total, tail = (own[c].to_numpy() for c in ("first", "last", "total", "tail"))
        later = np.cumsum(total[::-1])[::-1] - total
        above = np.zeros(len(own))
        for i in range(1, len(own)):
            if last[i - 1] == first[i]:
                above[i] = tail[i - 1] + (above[i - 1] if first[i - 1] == last[i - 1] else 0.0)
        out |= {(int(b), int(problem)): (float(x), float(y)) for b, x, y in zip(own["band"], later, above, strict=True)}
    return out


def _completed(data: DataFrame, part, parts, betas: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """``band_sums`` of the derivatives in one pass without the hazards outside the bands, for few features: a band's Hessian
    lacks these times its sums of w z z', which are added here."""

    def run(batches):
        number, band = band_of_batches(batches)
        for problem, rows in parts(band) if band else ():
            if len(rows["t"]):
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([problem], pa.int32()),
                                                  pa.array([part(number, problem, rows).tolist()], pa.list_(pa.float64()))], names=["band", "problem", "x"])

    rows = data.mapInArrow(run, "band int, problem int, x array<double>").toPandas()
    x = {(int(b), int(p)): np.asarray(v, dtype=np.float64) for b, p, v in zip(rows["band"], rows["problem"], rows["x"], strict=True)}
    share = _outside(pd.DataFrame([(*key, *v[:4]) for key, v in x.items()], columns=["band", "problem", "first", "last", "total", "tail"]))
    out = {}
    for (number, problem), v in sorted(x.items()):
        p = len(betas[problem])
        own, all_rows, first = v[4: 5 + p + p * p].copy(), *np.split(v[5 + p + p * p:], 2)
        later, above = share[number, problem]
        own[1 + p:] -= later * all_rows + above * first
        out[problem] = out[problem] + own if problem in out else own
    return out


def cox_together(df: DataFrame, features: Sequence[str], problems: dict[int, tuple[int, float]], subset: Callable[[Band, int], np.ndarray],
                 keep: Sequence[str], time: str = "time", event: str = "event", n_iter: int = 50, tol: float = 1e-9) -> dict[int, CoxPH]:
    """Cox models, without baselines, of many subsets of the rows: ``problems`` maps a number to (subset, alpha) and
    ``subset(band, number)`` marks the band's rows of a subset by the whole-number columns ``keep``.

    The rows are ranged once and all problems take their Newton steps in the same passes, so the number of passes
    does not depend on how many there are, and the models equal those of separate fits."""
    feats = list(features)
    stats = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(feats)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(feats)]).first()
    mu, sd = _scales(stats, len(feats))
    data = ranged(cox_rows(df, feats, mu, sd, time, event, [F.col(c).cast("int").alias(c) for c in keep]), "t", stats["n"], descending=True, pack=True)
    by_subset: dict[int, list[int]] = {}
    for number, (which, _) in problems.items():
        by_subset.setdefault(which, []).append(number)

    def parts(band: Band):
        for which, numbers in by_subset.items():
            rows = rows_where(band, subset(band, which))
            for number in numbers:
                yield number, rows

    try:
        fits = newton_together(lambda betas: cox_derivatives(data, betas, parts),
                               {p: (np.zeros(len(feats)), a / sd ** 2) for p, (_, a) in problems.items()}, n_iter, tol)
    finally:
        data.unpersist()
    out = {}
    for number, (_, alpha) in problems.items():
        m = out[number] = CoxPH(feats, alpha, n_iter, tol, time, event)
        beta, m.loglik_, m.n_iter_, m.converged_ = fits[number]
        m.coef_ = beta / sd
    return out


def cox_tables(tables: Sequence[DataFrame], features: Sequence[str], alpha: float = 0.0, time: str = "time", event: str = "event",
               n_iter: int = 50, tol: float = 1e-9) -> list[CoxPH]:
    """The models, without baselines, that ``CoxPH.fit`` gives for each of the tables. Their rows are scaled by their own table,
    ranged once as one table, and all models take their Newton steps in the same passes."""
    feats, cases = list(features), range(len(tables))
    own = [t.select(F.lit(i).alias("_case"), F.col(time).cast("double").alias(time), F.col(event).cast("double").alias(event),
                    *[F.col(c).cast("double").alias(c) for c in feats]) for i, t in enumerate(tables)]
    ensure_checkpoint_dir(tables[0].sparkSession)
    rows = reduce(DataFrame.unionAll, own).checkpoint()  # what prepared a table runs and is planned once, for the scales and the passes
    known = " and ".join([f"`{time}` is not null", f"`{event}` is not null", *[f"`{c}` is not null" for c in feats]])
    stats = {r["_case"]: r for r in rows.groupBy("_case").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.expr(known)).alias("known"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(feats)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(feats)]).collect()}
    scales = [_scales(stats[i], len(feats)) if i in stats else (np.zeros(len(feats)), np.ones(len(feats))) for i in cases]
    of_case = lambda values: F.get(F.array(*[F.lit(float(v)) for v in values]), F.col("_case"))
    scaled = rows.select("_case", time, event, *[((F.col(c) - of_case(m[i] for m, _ in scales)) / of_case(s[i] for _, s in scales)).alias(c)
                                                 for i, c in enumerate(feats)])
    data = ranged(cox_rows(scaled, feats, np.zeros(len(feats)), np.ones(len(feats)), time, event, [F.col("_case")]), "t",
                  sum(r["n"] for r in stats.values()), descending=True, group="_case", pack=True)

    def parts(band: Band):
        for case in np.unique(band["_case"]):
            yield int(case), rows_where(band, band["_case"] == case)

    try:
        fits = newton_together(lambda betas: cox_derivatives(data, betas, parts),
                               {i: (np.zeros(len(feats)), alpha / scales[i][1] ** 2) for i in cases}, n_iter, tol)
    finally:
        data.unpersist()
    out = []
    for i in cases:
        m = CoxPH(feats, alpha, n_iter, tol, time, event)
        beta, m.loglik_, m.n_iter_, m.converged_ = fits[i]
        if not m.converged_:
            warnings.warn(f"Cox fit stopped after {n_iter} steps without converging", stacklevel=2)
        if i in stats:  # a feature that is not a number anywhere leaves no row
            m.n_excluded_ = stats[i]["n"] - (stats[i]["known"] if np.isfinite(scales[i]).all() else 0)
        m.coef_ = beta / scales[i][1]
        m.intercept_shift_ = float(np.dot(m.coef_, scales[i][0]))
        out.append(m)
    return out


def cox_folds(folded: DataFrame, features: Sequence[str], alphas: Sequence[float], k: int, fold: str = "fold", time: str = "time",
              event: str = "event") -> dict[tuple[int, float], CoxPH]:
    """Cox models of every fold's complement at every penalty, ``(fold, alpha)`` to a model, fitted together."""
    pairs = dict(enumerate((f, a) for f in range(k) for a in alphas))
    fits = cox_together(folded, features, pairs, lambda band, f: band[fold] != f, [fold], time, event)
    return {pair: fits[number] for number, pair in pairs.items()}


def _scales(stats, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and standard deviations (1 for a constant feature)."""
    mu = np.array([stats[f"m{i}"] or 0.0 for i in range(p)], dtype=float)
    sd = np.array([stats[f"s{i}"] or 1.0 for i in range(p)], dtype=float)
    sd[sd == 0] = 1.0
    return mu, sd


def cox_newton_local(x: np.ndarray, t: np.ndarray, e: np.ndarray, alpha: float = 0.0, n_iter: int = 50,
                     tol: float = 1e-9) -> np.ndarray:
    """NumPy Breslow Cox for one bounded group (L11): same likelihood as ``CoxPH``."""
    n, p = x.shape
    mu, sd = x.mean(0), x.std(0)
    sd[sd == 0] = 1.0
    zz = (x - mu) / sd
    order = np.argsort(-t, kind="stable")
    zz, t, e = zz[order], t[order], e[order]
    # last index of each tie group in descending time: the risk set of time t is rows[: last]
    _, first_idx = np.unique(-t, return_index=True)
    last = np.r_[first_idx[1:], n] - 1

    def derivatives(beta):
        lp = zz @ beta
        w = np.exp(lp - lp.max())
        s0 = np.maximum(np.cumsum(w)[last], 1e-300)
        s1 = np.cumsum(w[:, None] * zz, 0)[last]
        s2 = np.cumsum(w[:, None, None] * zz[:, :, None] * zz[:, None, :], 0)[last]
        d = np.add.reduceat(e, first_idx)
        ez = np.add.reduceat(e[:, None] * zz, first_idx, axis=0)
        m = d > 0
        ll = float(np.sum((e * lp)) - np.sum(d[m] * (np.log(s0[m]) + lp.max())))
        g = (ez[m] - d[m, None] * s1[m] / s0[m, None]).sum(0)
        h = -(d[m, None, None] * (s2[m] / s0[m, None, None] - s1[m][:, :, None] * s1[m][:, None, :] / (s0[m] ** 2)[:, None, None])).sum(0)
        return ll, g, h

    return newton(derivatives, np.zeros(p), alpha / sd ** 2, n_iter, tol)[0] / sd


def newton(derivatives, beta: np.ndarray, pen: np.ndarray, n_iter: int, tol: float):
    """Newton steps with halving on the penalised log-likelihood, the same for the distributed and the
    local fit. ``derivatives(beta)`` gives value, gradient and Hessian without the penalty
    ``0.5 * sum(pen * beta ** 2)``. Returns (beta, log-likelihood, steps, converged)."""
    return newton_together(lambda betas: {0: derivatives(betas[0])}, {0: (beta, pen)}, n_iter, tol)[0]


def newton_together(derivatives, problems: dict[int, tuple[np.ndarray, np.ndarray]], n_iter: int, tol: float) -> dict[int, tuple]:
    """``newton`` for many problems, ``(beta, pen)`` each: those that have not converged take each step in one call of
    ``derivatives``, which maps their coefficients to their derivatives."""
    steps = {p: _newton_steps(beta, pen, n_iter, tol) for p, (beta, pen) in problems.items()}
    asked, done = {p: next(s) for p, s in steps.items()}, {}
    while asked:
        found, now = derivatives(asked), {}
        for p in asked:
            try:
                now[p] = steps[p].send(found[p])
            except StopIteration as end:
                done[p] = end.value
        asked = now
    return done


def _newton_steps(beta: np.ndarray, pen: np.ndarray, n_iter: int, tol: float):
    """Yields coefficients, is sent their derivatives, and returns what ``newton`` does."""
    before = before_beta = None
    steps, p = 0, len(beta)
    for _ in range(n_iter):
        ll, grad, hess = yield beta
        ll -= 0.5 * float(np.sum(pen * beta ** 2))
        if before is not None and ll < before - 1e-12:
            beta = (beta + before_beta) / 2.0  # back towards the previous point
            continue
        step = np.linalg.solve(-(hess - np.diag(pen)) + 1e-12 * np.eye(p), grad - pen * beta)
        before_beta, beta, steps = beta.copy(), beta + step, steps + 1
        if before is not None and abs(ll - before) < tol * max(1.0, abs(ll)) and np.max(np.abs(step)) < 1e-6:
            return beta, ll, steps, True
        before = ll
    return beta, before, steps, False
