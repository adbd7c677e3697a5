"""Monitoring tables: batch metrics, alerts, summaries, trends, rules, alert states, experiment
comparisons, A/B tests and model ranking (N1-N19).

History tables are append-only DataFrames ``(ts, model, n_samples, concordance, brier, drift)``.
Time windows are ``rangeBetween`` frames over epoch seconds partitioned by model, so each model's
history is windowed on its own partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tte.operators.curves import curve_at, km_curves
from tte.operators.drift import drift_scores, feature_stats
from tte.operators.pairs import concordance
from tte.session import ensure_checkpoint_dir

DAY = 86400
# fixed alert thresholds of the performance monitor
ALERT_THRESHOLDS = {"concordance_drop": 0.05, "brier_increase": 0.02, "feature_drift": 0.1}


def batch_metrics(df: DataFrame, models: dict[str, tuple[Column, Column]], batch: str, horizon: float,
                  feature: str, time: str = "time", event: str = "event") -> DataFrame:
    """Per (model, batch): n, Harrell's C (banded B3, grouped), Brier at ``horizon`` with the
    batch's own censoring curve (events_first, step) and the D2 drift of ``feature`` against the
    first batch. ``models`` maps a model name to (risk column, survival-at-horizon column)."""
    arr = F.array(*[F.struct(F.lit(m).alias("model"), r.cast("double").alias("risk"), s.cast("double").alias("surv"))
                    for m, (r, s) in models.items()])
    long = df.select(batch, time, event, feature, F.explode(arr).alias("_m")).select(batch, time, event, feature, "_m.*")
    conc = concordance(long, by=["model", batch]).select("model", batch, "c_index")
    cens = km_curves(df, time, event, by=[batch], ties="events_first").select(batch, "time", "cens")
    g_h = curve_at(cens, [horizon], "cens", "step", by=[batch]).select(batch, F.col("cens").alias("g_h"))
    g_t = cens.select(batch, F.col("time").alias("_t"), F.col("cens").alias("g_t"))
    j = long.join(g_t, [long[batch] == g_t[batch], F.col(time) == F.col("_t")]).drop(g_t[batch]).join(g_h, batch)
    t, e, s = F.col(time), F.col(event), F.col("surv")
    contrib = (F.when((t <= horizon) & (e == 1), F.when(F.col("g_t") > 0, s * s / F.col("g_t")).otherwise(F.lit(0.0)))
               .when(t > horizon, F.when(F.col("g_h") > 0, (1 - s) * (1 - s) / F.col("g_h")).otherwise(F.lit(0.0)))
               .otherwise(F.lit(0.0)))
    br = j.groupBy("model", batch).agg(F.avg(contrib).alias("brier"), F.count(F.lit(1)).alias("n_samples"))
    fs = df.groupBy(batch).agg(F.avg(feature).alias("_mu"), F.stddev_samp(feature).alias("_sd"))
    first = fs.orderBy(batch).limit(1).select(F.col("_mu").alias("_mu0"), F.col("_sd").alias("_sd0"))
    drift = fs.crossJoin(F.broadcast(first)).select(
        batch, F.when(F.col("_sd0") > 0, F.greatest(F.abs(F.col("_mu") - F.col("_mu0")) / F.col("_sd0"),
                                                   F.abs(F.col("_sd") - F.col("_sd0")) / F.col("_sd0"))).otherwise(F.lit(0.0)).alias("drift"))
    out = br.join(conc, ["model", batch], "left").join(drift, batch)
    return out.select(F.col(batch).cast("timestamp_ntz").alias("ts"), "model", "n_samples",
                      F.col("c_index").alias("concordance"), "brier", "drift")


class BatchReport(NamedTuple):
    """``metrics``: a row per batch and model, a history for ``alerts`` and what follows it. ``features``: the D1 statistics and
    the drift of every column in every batch."""

    metrics: DataFrame
    features: DataFrame


def batch_report(df: DataFrame, models: dict[str, tuple[Column, Sequence[Column]]], batch: str, horizons: Sequence[float], numeric: Sequence[str],
                 categorical: Sequence[str] = (), time: str = "time", event: str = "event") -> BatchReport:
    """N1 in full: Harrell's C and the integrated Brier score of several models per batch, and all features' statistics
    and drift (D2, D3) against the first batch.

    ``models`` maps a name to its risk and to its survival at each of the two or more ``horizons``. Each batch has its own
    censoring curve (events first, step), read once per row and not once per model and horizon. ``metrics``:
    ``ts, model, n_samples`` (all rows of the batch), ``concordance, brier`` (integrated over the horizons), ``drift`` (the largest
    of the columns) and ``drift_column`` (that column, the first by name of equal ones). ``features``: ``ts`` and the columns of
    ``feature_stats``, with ``drift``. Rows without a time, event or prediction enter no score, rows without a batch nothing."""
    df = df.where(F.col(batch).isNotNull())
    ensure_checkpoint_dir(df.sparkSession)
    hs = sorted(float(h) for h in horizons)
    if len(hs) < 2:
        raise ValueError("an integrated Brier score needs two horizons")
    order = sorted(range(len(hs)), key=lambda i: float(horizons[i]))
    t, e = F.col("_t"), F.col("_e")
    preds = [(r.cast("double"), [survs[i].cast("double") for i in order]) for r, survs in models.values()]
    rows = df.select(F.col(batch).alias("_batch"), F.col(time).cast("double").alias("_t"), F.col(event).alias("_e"),
                     *[x for i, (r, ss) in enumerate(preds) for x in (r.alias(f"_r{i}"), F.array(*ss).alias(f"_s{i}"))])
    cens = km_curves(rows.where(t.isNotNull() & e.isNotNull()), "_t", "_e", by=["_batch"], ties="events_first").select("_batch", "time", "cens")
    cens = cens.checkpoint()  # a row per batch and distinct time, read twice
    g_h = curve_at(cens, hs, "cens", "step", by=["_batch"]).groupBy("_batch").agg(F.array_sort(F.collect_list(F.struct("horizon", "cens"))).alias("_gh"))
    g_t = cens.select("_batch", F.col("time").cast("double").alias("_t"), F.col("cens").alias("_gt"))
    read = rows.join(g_t, ["_batch", "_t"], "left").join(g_h, "_batch", "left")
    scores = []
    for i in range(len(preds)):
        for j, h in enumerate(hs):
            s, g = F.col(f"_s{i}")[j], F.col("_gh")[j]["cens"]
            part = (F.when((t <= h) & (e == 1), F.when(F.col("_gt") > 0, s * s / F.col("_gt")).otherwise(0.0))
                    .when(t > h, F.when(g > 0, (1 - s) * (1 - s) / g).otherwise(0.0)).otherwise(0.0))
            scores.append(F.avg(F.when(t.isNotNull() & e.isNotNull() & s.isNotNull(), part)).alias(f"_x{i}_{j}"))
    wide = read.groupBy("_batch").agg(F.count(F.lit(1)).alias("n_samples"), *scores)
    brier = F.array(*[F.struct(F.lit(m).alias("model"), sum(
        ((hs[j + 1] - hs[j]) / 2 * (F.col(f"_x{i}_{j}") + F.col(f"_x{i}_{j + 1}")) for j in range(len(hs) - 1)), F.lit(0.0)) / (hs[-1] - hs[0]))
        for i, m in enumerate(models)])
    brier = wide.select("_batch", "n_samples", F.explode(brier).alias("_m")).select("_batch", "n_samples", "_m.model", F.col("_m.col2").alias("brier"))
    risks = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"_r{i}").alias("risk")) for i, m in enumerate(models)])
    long = rows.where(t.isNotNull() & e.isNotNull()).select("_batch", "_t", "_e", F.explode(risks).alias("_m")).select("_batch", "_t", "_e", "_m.*")
    conc = concordance(long.where("risk is not null"), time="_t", event="_e", by=["model", "_batch"]).select("model", "_batch", "c_index")

    stats = feature_stats(df, numeric, categorical, by=[batch]).withColumnRenamed(batch, "_batch").checkpoint()  # a row per batch and column
    first = stats.agg(F.min("_batch").alias("_first"))
    base = stats.join(F.broadcast(first), F.col("_batch") == F.col("_first")).drop("_batch", "_first")
    features = stats.join(drift_scores(base, stats, by=["_batch"]), ["_batch", "column", "kind"])
    worst = features.groupBy("_batch").agg(F.max("drift").alias("drift"), F.min_by("column", F.struct(-F.col("drift"), "column")).alias("drift_column"))
    metrics = brier.join(conc, ["model", "_batch"], "left").join(worst, "_batch", "left")
    ts = F.col("_batch").cast("timestamp_ntz").alias("ts")
    return BatchReport(metrics.select(ts, "model", "n_samples", F.col("c_index").alias("concordance"), "brier", "drift", "drift_column"),
                       features.select(ts, *[c for c in features.columns if c != "_batch"]))


def _epoch(ts: str = "ts") -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def alerts(history: DataFrame, days: int = 7, thresholds: dict | None = None, min_points: int = 3) -> DataFrame:
    """Alerts per history point. The window is the model's points with ts in
    (ts - days, ts], the current point included. C drop: window mean - current > .05; Brier rise:
    current - window mean > .02 (only when Brier > 0); both need >= 3 points in the window.
    Drift > .1: ``data_drift``, severity low below .2 else medium."""
    th = dict(ALERT_THRESHOLDS, **(thresholds or {}))
    w = Window.partitionBy("model").orderBy(_epoch()).rangeBetween(-(days * DAY - 1), 0)
    h = history.select("*", F.avg("concordance").over(w).alias("_c_mean"), F.count(F.lit(1)).over(w).alias("_pts"),
                       F.avg("brier").over(w).alias("_b_mean"))
    c_drop = F.col("_c_mean") - F.col("concordance")
    b_rise = F.col("brier") - F.col("_b_mean")
    cands = F.array(
        F.when((F.col("_pts") >= min_points) & (c_drop > th["concordance_drop"]),
               F.struct(F.lit("performance_degradation").alias("type"), F.lit("medium").alias("severity"),
                        F.lit("concordance").alias("metric"), F.col("concordance").alias("value"),
                        F.lit(th["concordance_drop"]).alias("threshold"))),
        F.when((F.col("brier") > 0) & (F.col("_pts") >= min_points) & (b_rise > th["brier_increase"]),
               F.struct(F.lit("performance_degradation").alias("type"), F.lit("medium").alias("severity"),
                        F.lit("brier").alias("metric"), F.col("brier").alias("value"),
                        F.lit(th["brier_increase"]).alias("threshold"))),
        F.when(F.col("drift") > th["feature_drift"],
               F.struct(F.lit("data_drift").alias("type"), F.when(F.col("drift") < 0.2, "low").otherwise("medium").alias("severity"),
                        F.lit("drift").alias("metric"), F.col("drift").alias("value"),
                        F.lit(th["feature_drift"]).alias("threshold"))),
    )
    return h.select("ts", "model", F.explode(F.filter(cands, lambda x: x.isNotNull())).alias("_a")).select("ts", "model", "_a.*")


def trend_label(x: Column, y: Column, n: Column, higher_is_better: bool = True) -> Column:
    """N4 as an aggregate expression: < 3 points insufficient_data; |r| < .3 stable; else by the
    slope's sign, read with ``higher_is_better`` (the reference reads it the same way for Brier)."""
    r = F.corr(x, y)
    slope = F.regr_slope(y, x)
    good = slope > 0 if higher_is_better else slope < 0
    return (F.when(n < 3, "insufficient_data").when(F.coalesce(F.abs(r), F.lit(0.0)) < 0.3, "stable")
            .when(good, "improving").otherwise("degrading"))


def performance_summary(history: DataFrame, days: int = 30) -> DataFrame:
    """Per model over its last ``days`` (before its newest point, inclusive window): count,
    total samples, mean / population std / min / max / trend of C, and of Brier where > 0."""
    w = Window.partitionBy("model")
    h = history.withColumn("_end", F.max(_epoch()).over(w)).where(_epoch() > F.col("_end") - days * DAY)
    wi = Window.partitionBy("model").orderBy("ts")
    h = h.withColumn("_i", F.row_number().over(wi).cast("double"))
    hb = F.when(F.col("brier") > 0, F.col("brier"))
    ib = F.when(F.col("brier") > 0, F.col("_i"))
    return h.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_observations"), F.sum("n_samples").alias("total_samples"),
        F.avg("concordance").alias("c_mean"), F.stddev_pop("concordance").alias("c_std"),
        F.min("concordance").alias("c_min"), F.max("concordance").alias("c_max"),
        trend_label(F.col("_i"), F.col("concordance"), F.count("concordance")).alias("c_trend"),
        F.avg(hb).alias("brier_mean"), F.stddev_pop(hb).alias("brier_std"),
        trend_label(ib, hb, F.count(hb), higher_is_better=False).alias("brier_trend"),
    )


def recent(alert_table: DataFrame, days: int = 7, severity: str | None = None, limit: int = 10) -> DataFrame:
    """Newest alerts of the last ``days`` (relative to the newest alert), optionally of one
    severity, newest first, at most ``limit`` (the limit is the feature: a top-k report)."""
    end = alert_table.agg(F.max(_epoch()).alias("_end"))
    a = alert_table.crossJoin(F.broadcast(end)).where(_epoch() > F.col("_end") - days * DAY).drop("_end")
    if severity:
        a = a.where(F.col("severity") == severity)
    return a.orderBy(F.col("ts").desc(), F.col("model"), F.col("metric")).limit(limit)


def retain_last(history: DataFrame, n: int = 1000) -> DataFrame:
    """The newest ``n`` points per model."""
    w = Window.partitionBy("model").orderBy(F.col("ts").desc())
    return history.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def rule_is_met(v: Column) -> Column:
    """Whether a value meets the rule's ``condition`` and ``threshold`` columns."""
    c, t = F.col("condition"), F.col("threshold")
    return (F.when(c == ">", v > t).when(c == "<", v < t).when(c == ">=", v >= t).when(c == "<=", v <= t)
            .when(c == "==", F.abs(v - t) < 1e-6).when(c == "!=", F.abs(v - t) >= 1e-6).otherwise(F.lit(False)))


def evaluate_rules(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules ``(rule_id, metric, condition, threshold, severity, enabled)`` against long
    metrics ``(metric, value)``. ``==`` / ``!=`` compare within 1e-6; a metric that is missing gives
    no alert, except ``outlier_count_*`` which defaults to 0."""
    r = rules.where(F.col("enabled"))
    j = r.join(metrics, "metric", "left")
    v = F.when(F.col("value").isNull() & F.col("metric").startswith("outlier_count_"), F.lit(0.0)).otherwise(F.col("value"))
    return j.where(v.isNotNull() & rule_is_met(v)).select("rule_id", "metric", v.alias("value"), "threshold", "severity",
                                               F.lit("active").alias("status"))


def alert_state(log: DataFrame) -> DataFrame:
    """Fold an append-only action log ``(alert_id, ts, action)`` into the current status:
    create -> active; acknowledge only from active; resolve from active or acknowledged.
    Per alert the (small) action list is sorted by time and folded with ``aggregate``."""
    g = log.groupBy("alert_id").agg(F.array_sort(F.collect_list(F.struct("ts", "action"))).alias("_acts"))
    folded = F.aggregate(
        "_acts", F.lit(None).cast("string"),
        lambda st, a: (F.when(a["action"] == "create", F.lit("active"))
                       .when((a["action"] == "acknowledge") & (st == "active"), F.lit("acknowledged"))
                       .when((a["action"] == "resolve") & st.isin("active", "acknowledged"), F.lit("resolved"))
                       .otherwise(st)),
    )
    return g.select("alert_id", folded.alias("status"), F.size("_acts").alias("n_actions"))


def metric_trend(history: DataFrame, metric: str, hours: int = 24 * 7) -> DataFrame:
    """Points of one metric in the last ``hours`` before the newest point, by time."""
    end = history.agg(F.max(_epoch()).alias("_end"))
    h = history.crossJoin(F.broadcast(end)).where(_epoch() > F.col("_end") - hours * 3600)
    return h.select("ts", "model", F.col(metric).alias("value")).orderBy("ts", "model")


def experiment_results(runs: DataFrame, metric: str = "concordance") -> DataFrame:
    """Per model mean, population std, n, min, max of a metric and a flag on the best mean."""
    g = runs.groupBy("model").agg(F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"),
                                  F.count(metric).alias("n"), F.min(metric).alias("min"), F.max(metric).alias("max"))
    best = g.agg(F.max_by("model", F.struct("mean", "model")).alias("_best"))
    return g.crossJoin(F.broadcast(best)).select("*", (F.col("model") == F.col("_best")).alias("is_best")).drop("_best")


def compare_runs(runs: DataFrame, metrics: Sequence[str], run_id: str = "run_id") -> DataFrame:
    """Per metric mean, sample std, min, max, count, quartiles (exact) and the best run (max for
    concordance, min otherwise)."""
    arr = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    long = runs.select(run_id, F.explode(arr).alias("_m")).select(run_id, "_m.*").where(F.col("value").isNotNull())
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"), F.count(F.lit(1)).alias("count"),
        F.percentile("value", 0.25).alias("q25"), F.percentile("value", 0.5).alias("median"),
        F.percentile("value", 0.75).alias("q75"),
        F.when(F.col("metric") == "concordance", F.max_by(run_id, F.struct("value", run_id)))
        .otherwise(F.min_by(run_id, F.struct("value", run_id))).alias("best_run"),
    )


def experiment_means(runs: DataFrame, metrics: Sequence[str], experiment: str = "experiment") -> DataFrame:
    """Per experiment the number of runs and the mean of each metric (``mean_<metric>``)."""
    return runs.groupBy(experiment).agg(F.count(F.lit(1)).alias("n_runs"), *[F.avg(m).alias(f"mean_{m}") for m in metrics])


def param_importance(runs: DataFrame, params: Sequence[str], metric: str, k: int = 5) -> DataFrame:
    """|Pearson correlation| of each numeric parameter with the metric, top ``k``."""
    wide = runs.agg(*[F.abs(F.corr(F.col(p).cast("double"), F.col(metric).cast("double"))).alias(p) for p in params])
    arr = F.array(*[F.struct(F.lit(p).alias("param"), F.col(p).alias("importance")) for p in params])
    return wide.select(F.explode(arr).alias("_r")).select("_r.*").where(F.col("importance").isNotNull()) \
        .orderBy(F.col("importance").desc(), "param").limit(k)


def update_triggers(history: DataFrame, days: int = 7, c_drop: float = 0.02, drift: float = 0.1) -> DataFrame:
    """Per point: first C of the window (ts - days, ts] minus current > ``c_drop``; drift of the
    window's max > ``drift``."""
    w = Window.partitionBy("model").orderBy(_epoch()).rangeBetween(-(days * DAY - 1), 0)
    h = history.select("ts", "model", "concordance", "drift",
                       F.first("concordance").over(w).alias("_c0"), F.max("drift").over(w).alias("_dmax"))
    return h.select("ts", "model", ((F.col("_c0") - F.col("concordance")) > c_drop).alias("performance_trigger"),
                    (F.col("_dmax") > drift).alias("drift_trigger"))


def ab_assign(df: DataFrame, id_col: str, test_name: str, split: dict[str, float]) -> DataFrame:
    """Variant per subject from the first 32 bits of ``md5(id|test)`` modulo 10000 against the cumulative
    shares (which must sum to 1 +- .01); deterministic under retry."""
    total = sum(split.values())
    if abs(total - 1.0) > 0.01:
        raise ValueError(f"variant shares sum to {total}, not 1")
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(test_name)).cast("binary"))
    u = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(10000))
    expr, acc = None, 0.0
    items = list(split.items())
    for i, (name, share) in enumerate(items):
        acc += share
        cond = u < int(round(acc * 10000)) if i < len(items) - 1 else F.lit(True)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn("variant", expr)


def ab_results(df: DataFrame, metric: str, control: str, min_n: int = 1000) -> DataFrame:
    """Per variant n, mean, sample std; Welch z against the control and a two-sided normal
    p-value; ``significant`` needs p < .05 and both sides >= ``min_n``."""
    from tte.functions.expr import normal_cdf

    g = df.groupBy("variant").agg(F.count(F.lit(1)).alias("n"), F.avg(metric).alias("mean"),
                                  F.stddev_samp(metric).alias("std"))
    c = g.where(F.col("variant") == control).select(F.col("n").alias("_n0"), F.col("mean").alias("_m0"), F.col("std").alias("_s0"))
    j = g.crossJoin(F.broadcast(c))
    se = F.sqrt(F.col("std") ** 2 / F.col("n") + F.col("_s0") ** 2 / F.col("_n0"))
    z = F.when(se > 0, (F.col("mean") - F.col("_m0")) / se)
    j = j.withColumn("z", z).withColumn("p_value", 2 * (1 - normal_cdf(F.abs(F.col("z")))))
    return j.select("variant", "n", "mean", "std", (F.col("mean") - F.col("_m0")).alias("lift"), "z", "p_value",
                    ((F.col("p_value") < 0.05) & (F.col("n") >= min_n) & (F.col("_n0") >= min_n)).alias("significant"))


def rank_models(scores: DataFrame, metric: str, higher_is_better: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Per segment (``by``) and model: mean metric over its folds/batches, rank by the
    direction, population std, stability 1 / (1 + std) (1.0 with one value)."""
    by = list(by)
    g = scores.groupBy(*by, "model").agg(F.avg(metric).alias("score"), F.stddev_pop(metric).alias("std"),
                                         F.count(metric).alias("n"))
    # means of equal values in another order may differ in the last place: they tie
    order = F.round("score", 9).desc() if higher_is_better else F.round("score", 9).asc()
    w = Window.partitionBy(*by).orderBy(order, F.col("model"))
    return g.select(*by, "model", "score", "std", F.rank().over(w).alias("rank"),
                    F.when(F.col("n") > 1, 1.0 / (1.0 + F.col("std"))).otherwise(F.lit(1.0)).alias("stability"))


def select_model(ranked: DataFrame, criterion: str = "best", by: Sequence[str] = ()) -> DataFrame:
    """Per segment the chosen model: ``best`` (rank 1), ``stable`` (highest stability) or
    ``balanced`` (.7 rank / n + .3 (1 - stability), lowest wins); ties by model name."""
    by = list(by)
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    r = ranked.withColumn("_n", n)
    if criterion == "best":
        key = F.col("rank").cast("double")
    elif criterion == "stable":
        key = -F.col("stability")
    elif criterion == "balanced":
        key = 0.7 * F.col("rank") / F.col("_n") + 0.3 * (1 - F.col("stability"))
    else:
        raise ValueError("criterion must be best, stable or balanced")
    w = Window.partitionBy(*by).orderBy(key, F.col("model"))
    return r.withColumn("_pick", F.row_number().over(w)).where(F.col("_pick") == 1).select(*by, "model", "score", "rank", "stability")


def select_ensemble(ranked: DataFrame, k: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """N19, ensemble criterion: per segment the ``k`` best models by rank (ties by name) with equal
    weights 1 / (number chosen)."""
    by = list(by)
    order = Window.partitionBy(*by).orderBy("rank", "model")
    chosen = ranked.withColumn("_pick", F.row_number().over(order)).where(F.col("_pick") <= k)
    return chosen.select(*by, "model", "score", "rank", (1.0 / F.count(F.lit(1)).over(Window.partitionBy(*by))).alias("weight"))


def best_average(rankings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """N19, best average over metrics: ``rankings`` holds N18 rows of several metrics (column
    ``metric``); the model with the smallest mean rank wins, ties by name. Returns ``by..., model,
    mean_rank, n_metrics``."""
    by = list(by)
    g = rankings.groupBy(*by, "model").agg(F.avg("rank").alias("mean_rank"), F.count(F.lit(1)).alias("n_metrics"))
    order = Window.partitionBy(*by).orderBy(F.round("mean_rank", 9), "model")
    return g.withColumn("_pick", F.row_number().over(order)).where(F.col("_pick") == 1).drop("_pick")


def quality_report_trend(reports: DataFrame, days: int = 7, ts: str = "ts") -> DataFrame:
    """Over the last ``days`` of quality reports ``(ts, score, n_issues)``: first and last
    score and issue count, the score slope per report, and advice when the slope is < -1
    (declining) or > .5 (improving); needs >= 2 reports (>= 3 for the slope)."""
    end = reports.agg(F.max(_epoch(ts)).alias("_end"))
    r = reports.crossJoin(F.broadcast(end)).where(_epoch(ts) > F.col("_end") - days * DAY)
    r = r.withColumn("_i", F.row_number().over(Window.orderBy(ts)).cast("double"))  # a week of reports: small
    g = r.agg(F.count(F.lit(1)).alias("n_reports"), F.min_by("score", ts).alias("first_score"),
              F.max_by("score", ts).alias("last_score"), F.min_by("n_issues", ts).alias("first_issues"),
              F.max_by("n_issues", ts).alias("last_issues"), F.regr_slope("score", "_i").alias("slope"))
    slope = F.when(F.col("n_reports") >= 3, F.col("slope"))
    advice = (F.when(F.col("n_reports") < 2, "insufficient_data").when(slope < -1, "quality declining: investigate sources")
              .when(slope > 0.5, "quality improving").otherwise("stable"))
    return g.select("n_reports", "first_score", "last_score", "first_issues", "last_issues", slope.alias("slope"),
                    advice.alias("advice"))


def retrain_triggers(history: DataFrame, interval_s: int = 3600, c_drop: float = 0.02, drift: float = 0.1,
                     min_new_rows: int = 100) -> DataFrame:
    """Per history point, with the model (re)trained at its first point: scheduled (time
    since the last training > ``interval_s``), performance (first C minus current > ``c_drop``),
    drift (> ``drift``) and data volume (rows since the last training >= ``min_new_rows``).
    Trainings are not simulated: the last training is the model's first point."""
    w = Window.partitionBy("model").orderBy(_epoch()).rowsBetween(Window.unboundedPreceding, 0)
    h = history.select("ts", "model", "concordance", "drift", "n_samples",
                       F.first(_epoch()).over(w).alias("_t0"), F.first("concordance").over(w).alias("_c0"),
                       F.sum("n_samples").over(w).alias("_rows"))
    return h.select("ts", "model", ((_epoch() - F.col("_t0")) > interval_s).alias("scheduled"),
                    F.coalesce((F.col("_c0") - F.col("concordance")) > c_drop, F.lit(False)).alias("performance"),
                    (F.col("drift") > drift).alias("drift_trigger"), (F.col("_rows") >= min_new_rows).alias("data_volume"))
