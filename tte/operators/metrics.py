"""Censoring-aware accuracy metrics: Brier, integrated Brier, time-dependent AUC, bootstrap
intervals, leaderboard, out-of-fold assembly and regression checks (M3-M6, M12-M14).

Predictions come in long form ``(id..., time, event, horizon, surv)`` or with a ``risk`` column.
The censoring curve G is fitted on ``train`` (scikit-survival convention: events before censoring
at tied times, ``ties="events_first"``, read as a step function).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tte.operators.curves import curve_at, km_curves
from tte.operators.pairs import concordance, dominance, plan_points
from tte.operators.replicates import coefficients, id_hash, interval, replicate_sums, weight_matrix
from tte.operators.scan import prefix_sum
from tte.operators.vector_scan import Band, Offsets, band_offsets, band_sums, ranged, running
from tte.session import ensure_checkpoint_dir


def _g_at_times(train: DataFrame, test: DataFrame, time: str, event: str, same_times: bool = False,
                cens: DataFrame | None = None) -> DataFrame:
    """Censoring survival G(T) (events_first, step; ``cens`` if it is known) for each test row.

    With ``same_times`` (every test time is a train time, e.g. the same subjects) this is an
    equi-join on the curve's time; otherwise a banded range lookup (``lookup_curve``)."""
    from tte.operators.curves import lookup_curve

    if cens is None:
        cens = km_curves(train, time, event, ties="events_first").select("time", "cens")
    if same_times:
        g = cens.select(F.col("time").alias("_gt"), F.col("cens").alias("g_t"))
        return test.join(g, F.col(time).cast("double") == F.col("_gt"), "left").drop("_gt")
    return lookup_curve(test, cens, time, "cens", "step").withColumnRenamed("cens", "g_t")


def brier_parts(train: DataFrame, test_long: DataFrame, horizons: Sequence[float], time: str = "time", event: str = "event",
                same_times: bool = False) -> DataFrame:
    """Each test row with its ``contribution`` to the Brier score of its horizon."""
    cens = km_curves(train, time, event, ties="events_first").select("time", "cens")
    g_h = curve_at(cens, horizons, "cens", "step").withColumnRenamed("cens", "g_h")
    with_g = _g_at_times(train, test_long, time, event, same_times, cens)
    j = with_g.join(F.broadcast(g_h), "horizon")
    t, e, h, s = F.col(time), F.col(event), F.col("horizon"), F.col("surv")
    return j.withColumn("contribution", (
        F.when((t <= h) & (e == 1), F.when(F.col("g_t") > 0, s * s / F.col("g_t")).otherwise(F.lit(0.0)))
        .when(t > h, F.when(F.col("g_h") > 0, (1 - s) * (1 - s) / F.col("g_h")).otherwise(F.lit(0.0)))
        .otherwise(F.lit(0.0))
    ))


def brier_score(train: DataFrame, test_long: DataFrame, horizons: Sequence[float], time: str = "time",
                event: str = "event", by: Sequence[str] = (), same_times: bool = False) -> DataFrame:
    """M3: Brier score per horizon.

    mean over test rows of I(T <= h, event) S^2 / G(T) + I(T > h) (1 - S)^2 / G(h); censored
    before h contribute 0. A zero G gives weight 0 (never 0/0). ``test_long`` has ``horizon`` and
    ``surv`` columns; output ``by..., horizon, brier, n``.
    """
    parts = brier_parts(train, test_long, horizons, time, event, same_times)
    return parts.groupBy(*by, "horizon").agg(F.avg("contribution").alias("brier"), F.count(F.lit(1)).alias("n"))


def integrated_brier(brier: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M4: trapezoid of the Brier curve over its horizons divided by (max - min); needs >= 2
    horizons (null otherwise). Works on the small per-horizon table."""
    by = list(by)
    w = Window.partitionBy(*by).orderBy("horizon")
    seg = brier.select(
        *by, "horizon", "brier",
        F.lag("horizon").over(w).alias("_h0"), F.lag("brier").over(w).alias("_b0"),
    )
    area = (F.col("horizon") - F.col("_h0")) * (F.col("brier") + F.col("_b0")) / 2.0
    agg = seg.groupBy(*by).agg(
        F.sum(area).alias("_area"), F.min("horizon").alias("_lo"), F.max("horizon").alias("_hi"),
        F.count(F.lit(1)).alias("_k"),
    )
    return agg.select(
        *by,
        F.when((F.col("_k") >= 2) & (F.col("_hi") > F.col("_lo")), F.col("_area") / (F.col("_hi") - F.col("_lo")))
        .alias("ibs"),
    )


def dynamic_auc(train: DataFrame, test: DataFrame, horizons: Sequence[float], risk: str = "risk",
                time: str = "time", event: str = "event", same_times: bool = False) -> tuple[DataFrame, DataFrame]:
    """M5: cumulative/dynamic AUC per horizon and its mean.

    Cases: T <= h with the event, weight 1/G(T) (G from ``train``, events_first, step); controls:
    T > h, weight 1. AUC(h) = P(risk_case > risk_control), ties 0.5, weighted. Horizons at or
    past the largest test time are dropped. The mean weights each AUC by the drop of the test KM
    survival between consecutive horizons, divided by 1 - S(last).
    Rank-sum form: per horizon, weighted case and control counts per distinct risk, then a banded
    running count of controls over risk; no pair join.
    Returns ``(per_horizon[horizon, auc], mean[mean_auc])``.
    """
    max_t = test.agg(F.max(time).alias("_max_t"))
    hs = [float(h) for h in horizons]
    with_g = _g_at_times(train, test, time, event, same_times)
    t, e = F.col(time), F.col(event)
    # one row per distinct risk with a (case weight, control count) pair per horizon: no cross
    # join with the horizons, one running count over risk for all of them
    aggs = []
    for i, h in enumerate(hs):
        aggs.append(F.sum(F.when((t <= h) & (e == 1) & (F.col("g_t") > 0), 1.0 / F.col("g_t")).otherwise(F.lit(0.0))).alias(f"cw{i}"))
        aggs.append(F.sum(F.when(t > h, F.lit(1.0)).otherwise(F.lit(0.0))).alias(f"kw{i}"))
    per_risk = with_g.groupBy(F.col(risk).cast("double").alias("risk")).agg(*aggs)
    ensure_checkpoint_dir(test.sparkSession)
    per_risk = per_risk.checkpoint()  # read for the bands, their totals and the scan; the join above runs once
    scanned = prefix_sum(per_risk, "risk", [f"kw{i}" for i in range(len(hs))], exclusive=True)
    tot = []
    for i in range(len(hs)):
        tot += [F.sum(F.col(f"cw{i}") * (F.col(f"cum_kw{i}") + 0.5 * F.col(f"kw{i}"))).alias(f"_num{i}"),
                F.sum(f"cw{i}").alias(f"_cw{i}"), F.sum(f"kw{i}").alias(f"_kw{i}")]
    wide = scanned.agg(*tot)
    rows = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"_num{i}").alias("_num"), F.col(f"_cw{i}").alias("_cw"),
                              F.col(f"_kw{i}").alias("_kw")) for i, h in enumerate(hs)])
    long = wide.select(F.explode(rows).alias("_r")).select("_r.*").crossJoin(F.broadcast(max_t)) \
        .where(F.col("horizon") < F.col("_max_t"))
    auc = long.select("horizon", F.when((F.col("_cw") > 0) & (F.col("_kw") > 0), F.col("_num") / (F.col("_cw") * F.col("_kw")))
                      .alias("auc"))
    km = km_curves(test, time, event).select("time", "surv")
    s_at = curve_at(km, list(horizons), "surv", "step")
    j = auc.join(F.broadcast(s_at), "horizon")
    w = Window.orderBy("horizon")  # over at most len(horizons) rows
    j = j.withColumn("_drop", F.coalesce(F.lag("surv").over(w), F.lit(1.0)) - F.col("surv"))
    mean = j.agg(
        (F.sum(F.col("auc") * F.col("_drop")) / (1.0 - F.max_by("surv", "horizon"))).alias("mean_auc")
    )
    return auc, mean


def bootstrap_brier(train: DataFrame, test_long: DataFrame, horizons: Sequence[float], id_col: str, reps: int = 200,
                    seed: int = 42, level: float = 0.95, time: str = "time", event: str = "event",
                    same_times: bool = False) -> tuple[DataFrame, DataFrame]:
    """M6: percentile bootstrap intervals of the Brier score per horizon and of the integrated Brier
    score. Test subjects are resampled, the censoring curve of ``train`` stays. A row's part in the
    score does not depend on the replicate, so it is computed once; the replicates are weighted sums,
    one matrix product a batch of rows.
    Returns ``(horizon, estimate, ci_lower, ci_upper, reps, std)`` and the same without horizon."""
    parts = brier_parts(train, test_long, horizons, time, event, same_times).select(id_col, "horizon", "contribution")
    sums = replicate_sums(parts, id_col, ["contribution"], reps, seed, ["horizon"])
    per_rep = sums.select("horizon", F.posexplode(F.arrays_zip("w", "contribution")).alias("rep", "x")).select(
        "horizon", "rep", F.when(F.col("x.w") > 0, F.col("x.contribution") / F.col("x.w")).alias("brier"))
    point = parts.groupBy("horizon").agg(F.avg("contribution").alias("brier"))
    brier = point.withColumnRenamed("brier", "estimate").join(interval(per_rep, "brier", ["horizon"], level), "horizon")
    ibs = integrated_brier(point).select(F.col("ibs").alias("estimate")).crossJoin(
        interval(integrated_brier(per_rep, by=["rep"]), "ibs", [], level))  # one row each
    return brier, ibs


def bootstrap_auc(train: DataFrame, test: DataFrame, horizons: Sequence[float], id_col: str, reps: int = 200, seed: int = 42,
                  level: float = 0.95, risk: str = "risk", time: str = "time", event: str = "event",
                  same_times: bool = False) -> DataFrame:
    """M6: percentile bootstrap interval of the dynamic AUC (M5) per horizon.

    The rows are ranged by risk once; a vector scan carries the control weights of all replicates and
    horizons, so one pass over the bands gives every replicate's rank sum. Rows without a risk are left out."""
    hs, polynomials = [float(h) for h in horizons], coefficients(seed, reps)
    g = _g_at_times(train, test, time, event, same_times).select(
        F.col(risk).cast("double").alias("risk"), F.col(time).cast("double").alias("t"), (F.col(event) == 1).cast("double").alias("e"),
        F.coalesce(F.col("g_t"), F.lit(0.0)).alias("g"), id_hash(id_col).alias("x")).where("risk is not null and t is not null and e is not null")
    bands = ranged(g, "risk", test.count())
    slices = [polynomials[lo: lo + 32] for lo in range(0, reps, 32)]

    def controls(band: Band) -> np.ndarray:
        return (band["t"][:, None] > np.array(hs)).astype(np.float64)

    def sums(_: int, band: Band):
        out = [[], [], []]
        held, key = controls(band), band["risk"]
        for some in slices:
            w = weight_matrix(band["x"], some)
            for i, rows in enumerate((slice(None), key == key[0], key == key[-1])):
                out[i].append((held[rows].T @ w[rows]).ravel())
        return tuple(np.concatenate(x) for x in out)

    def part(number: int, problem: int, band: Band) -> np.ndarray:
        held, key, off, out, at = controls(band), band["risk"], offsets[number, problem], [], 0
        ends = (band["t"][:, None] <= np.array(hs)) & (band["e"] == 1)[:, None] & (band["g"] > 0)[:, None]
        case = np.where(ends, 1.0 / np.where(band["g"] > 0, band["g"], 1.0)[:, None], 0.0)
        for some in slices:
            w = weight_matrix(band["x"], some)
            for i in range(len(hs)):
                mine = Offsets(*(x[at: at + len(some)] for x in off))
                at += len(some)
                k = held[:, i, None] * w
                below, upto = running(key, k, mine, exclusive=True), running(key, k, mine)
                c = case[:, i, None] * w
                out.append(np.concatenate(((c * (below + upto) / 2).sum(axis=0), c.sum(axis=0), k.sum(axis=0))))
        return np.concatenate(out)

    try:
        offsets = band_offsets(bands, "risk", sums=sums)
        total, at, rows = band_sums(bands, part).get(0, ()), 0, []
        for some in slices if len(total) else []:
            for h in hs:
                num, cases, held = total[at: at + 3 * len(some)].reshape(3, -1)
                at += 3 * len(some)
                rows += [(h, float(a / (b * c))) for a, b, c in zip(num, cases, held, strict=True) if b > 0 and c > 0]
    finally:
        bands.unpersist()
    per_rep = test.sparkSession.createDataFrame(rows, "horizon double, auc double")
    point, _ = dynamic_auc(train, test, hs, risk, time, event, same_times)
    return point.withColumnRenamed("auc", "estimate").join(interval(per_rep, "auc", ["horizon"], level), "horizon")


def bootstrap_concordance(df: DataFrame, id_col: str, reps: int = 200, seed: int = 42, level: float = 0.95,
                          risk: str = "risk", time: str = "time", event: str = "event") -> DataFrame:
    """M6: percentile bootstrap interval of Harrell's C, std = (hi - lo) / 3.92. One count (B3) whose kernels
    carry the weights of all replicates. Rows with a null time, event or risk are left out."""
    polynomials = coefficients(seed, reps)
    pts = df.where(F.col(time).isNotNull() & F.col(event).isNotNull() & F.col(risk).isNotNull()).select(
        F.col(time).cast("double").alias("xv"), F.when(F.col(event).cast("int") == 1, 0).otherwise(1).alias("tie"),
        F.col(risk).cast("double").alias("y"), id_hash(id_col).alias("w"))
    total = dominance(pts, weights=lambda w: weight_matrix(w.to_numpy(), polynomials), plan=plan_points(pts, rows=True))
    x = total.select(F.explode(F.arrays_zip("less", "eq", "greater")).alias("x")).select("x.*")
    pairs = F.col("less") + F.col("eq") + F.col("greater")
    per_rep = x.select(F.when(pairs > 0, (F.col("less") + 0.5 * F.col("eq")) / pairs).alias("c_index"))
    point = concordance(df, risk, time, event).select(F.col("c_index").alias("estimate"))
    return point.crossJoin(interval(per_rep, "c_index", [], level))  # one row each


def leaderboard(metrics: DataFrame, model: str = "model", metric: str = "metric", value: str = "value",
                names: Sequence[str] = ("concordance", "ibs", "brier")) -> DataFrame:
    """One row per model (pivot with a fixed value list), ordered by concordance desc, then
    IBS asc, then model."""
    wide = metrics.groupBy(model).pivot(metric, list(names)).agg(F.first(value))
    order = []
    if "concordance" in names:
        order.append(F.col("concordance").desc_nulls_last())
    if "ibs" in names:
        order.append(F.col("ibs").asc_nulls_last())
    return wide.orderBy(*order, F.col(model))


def assemble_oof(fold_preds: DataFrame, id_col: str, horizons: Sequence[float]) -> DataFrame:
    """Out-of-fold table ``id, time, event, risk, surv@h...`` from long fold outputs
    ``(id, fold, time, event, risk, horizon, surv)``; pivot with the fixed horizon list."""
    hs = [float(h) for h in horizons]
    wide = fold_preds.groupBy(id_col, "fold", "time", "event", "risk").pivot("horizon", hs).agg(F.first("surv"))
    return wide.select(id_col, "fold", "time", "event", "risk",
                       *[F.col(f"`{h}`").alias(f"surv@{int(h) if h.is_integer() else h}") for h in hs])


def check_regression(new: DataFrame, baseline: DataFrame, tolerance: float = 0.02, metric: str = "metric",
                     value: str = "value", higher_is_better: str = "higher_is_better",
                     relative: bool = False) -> DataFrame:
    """Per metric, fail when the new value is worse than the baseline by more than the
    tolerance (absolute, or relative: new < base * (1 - tol))."""
    j = new.select(metric, F.col(value).alias("new")).join(baseline.select(metric, F.col(value).alias("base"), higher_is_better), metric)
    sign = F.when(F.col(higher_is_better), F.lit(1.0)).otherwise(F.lit(-1.0))
    delta = (F.col("new") - F.col("base")) * sign
    if relative:
        fail = F.when(F.col(higher_is_better), F.col("new") < F.col("base") * (1 - tolerance)).otherwise(
            F.col("new") > F.col("base") * (1 + tolerance))
    else:
        fail = delta < -tolerance
    return j.select(metric, "new", "base", delta.alias("change"), fail.alias("regressed"))
