"""Registered queries: preprocessing (P*), splits (V*), models (L*), OOF assembly, leaderboard and
regression checks (M12-M14)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tte.operators.metrics import assemble_oof, check_regression, leaderboard
from tte.operators.models.aft import LocationScaleAFT, WeibullAFT
from tte.operators.models.cox import CoxPH, cox_derivatives, cox_rows
from tte.operators.models.cox_cv import CIndex, CoxFit, cox_nested_cv, cox_oof, cox_search, random_alphas
from tte.operators.models.ensemble import (
    CLASSIFIERS, Bagging, combine, dynamic_scores, dynamic_selection, fit_per_group, horizon_classifiers, long_risks, stacked_scores, stacking,
    update_model,
)
from tte.operators.models.hazard import DiscreteHazard, person_period
from tte.operators.pairs import concordance
from tte.operators.prep import OneHot, SimpleImputer, StandardScaler, build_pipeline, fit_transform_split
from tte.operators.split import contiguous_folds, kfold, stratified_split
from tte.operators.vector_scan import ranged
from tte.plans.registry import r6, register
from tte.plans.sqltext import COHORT_EPISODES, COHORT_LINES, COHORT_ORDERS, RISK, draws_cte
from tte.sources.testdata import HORIZONS, cohort_episodes, cohort_lines, cohort_orders, standin_long, with_standin

SEGMENTS = ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')
DQ = '"'
ONEHOT_SUMS = ", ".join(f"CAST(sum(CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END) AS DOUBLE) AS {DQ}c_mktsegment_{s}{DQ}" for s in SEGMENTS)
ONEHOT_COLS = ", ".join(f"CAST(seg = '{s}' AS DOUBLE) AS {DQ}c_mktsegment_{s}{DQ}" for s in SEGMENTS)

PREP_SQL = f"""{COHORT_ORDERS},
pf AS (SELECT subject_id, time, event, x_price, CASE WHEN subject_id % 5 = 0 THEN NULL ELSE x_bal END AS x_bal,
              CASE WHEN subject_id % 11 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM cohort)"""


def prep_frame(spark, sf_dir):
    """Orders cohort with gaps by a stated rule: x_bal null when subject_id % 5 = 0, segment null
    when subject_id % 11 = 0 (every row kept)."""
    c = cohort_orders(spark, sf_dir)
    return c.select("subject_id", "time", "event", "x_price",
                    F.when(F.col("subject_id") % 5 == 0, F.lit(None)).otherwise(F.col("x_bal")).alias("x_bal"),
                    F.when(F.col("subject_id") % 11 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))


@register("P1_imputer", f"""WITH {PREP_SQL},
c AS (SELECT avg(x_bal) AS m, quantile_cont(x_bal, 0.5) AS med,
             (SELECT c_mktsegment FROM pf WHERE c_mktsegment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode FROM pf)
SELECT subject_id, round(coalesce(x_bal, c.m), 6) AS bal_mean, round(coalesce(x_bal, c.med), 6) AS bal_median,
       coalesce(c_mktsegment, c.mode) AS segment_mode FROM pf CROSS JOIN c""")
def p1_imputer(spark, sf_dir):
    pf = prep_frame(spark, sf_dir)
    a = SimpleImputer(["x_bal"], "mean").fit(pf).exprs(pf)["x_bal"]
    b = SimpleImputer(["x_bal"], "median").fit(pf).exprs(pf)["x_bal"]
    c = SimpleImputer(["c_mktsegment"], "most_frequent").fit(pf).exprs(pf)["c_mktsegment"]
    return pf.select("subject_id", r6(a).alias("bal_mean"), r6(b).alias("bal_median"), c.alias("segment_mode"))


@register("P3_standard_scaler", f"""WITH {PREP_SQL}, c AS (SELECT avg(x_price) AS m, stddev_pop(x_price) AS s FROM pf)
SELECT subject_id, round((x_price - m) / CASE WHEN s = 0 OR s IS NULL THEN 1.0 ELSE s END, 6) AS x_price FROM pf CROSS JOIN c""")
def p3_scaler(spark, sf_dir):
    pf = prep_frame(spark, sf_dir)
    e = StandardScaler(["x_price"]).fit(pf).exprs(pf)["x_price"]
    return pf.select("subject_id", r6(e).alias("x_price"))


@register("P4_one_hot", f"""WITH {PREP_SQL}
SELECT {ONEHOT_SUMS},
       CAST(sum(CASE WHEN c_mktsegment IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS all_zero FROM pf""")
def p4_one_hot(spark, sf_dir):
    """Column sums of the encoding (unknown / null rows are all zeros)."""
    pf = prep_frame(spark, sf_dir)
    ex = OneHot(["c_mktsegment"]).fit(pf).exprs(pf)
    enc = pf.select(*[e.alias(n) for n, e in ex.items()])
    zero = sum((F.col(f"`{n}`") for n in ex), F.lit(0.0)) == 0
    return enc.agg(*[F.sum(f"`{n}`").alias(n) for n in ex], F.sum(zero.cast("long")).alias("all_zero"))


SPEC = [("imputer", {"strategy": "median"}), ("imputer_cat", {}), ("scaler", {}), ("encoder", {})]


@register("P5_pipeline", f"""WITH {PREP_SQL},
c1 AS (SELECT quantile_cont(x_price, 0.5) AS mp, quantile_cont(x_bal, 0.5) AS mb,
              (SELECT c_mktsegment FROM pf WHERE c_mktsegment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode FROM pf),
f1 AS (SELECT subject_id, coalesce(x_price, mp) AS x_price, coalesce(x_bal, mb) AS x_bal, coalesce(c_mktsegment, mode) AS seg FROM pf CROSS JOIN c1),
c2 AS (SELECT avg(x_price) AS ap, stddev_pop(x_price) AS sp, avg(x_bal) AS ab, stddev_pop(x_bal) AS sb FROM f1)
SELECT subject_id, round((x_price - ap) / sp, 6) AS x_price, round((x_bal - ab) / sb, 6) AS x_bal,
  {ONEHOT_COLS}
FROM f1 CROSS JOIN c2""")
def p5_pipeline(spark, sf_dir):
    pf = prep_frame(spark, sf_dir).select("subject_id", "x_price", "x_bal", "c_mktsegment")
    pipe = build_pipeline(SPEC, ["x_price", "x_bal"], ["c_mktsegment"]).fit(pf)
    out = pipe.transform(pf)
    return out.select("subject_id", r6("x_price").alias("x_price"), r6("x_bal").alias("x_bal"),
                      *[c for c in out.columns if c.startswith("c_mktsegment_")])


@register("P6_fit_transform_split", f"""WITH {PREP_SQL},
c AS (SELECT avg(x_price) AS ap, stddev_pop(x_price) AS sp FROM pf),
{COHORT_LINES.strip().replace('cohort AS (', 'ln AS (', 1)}
SELECT c_mktsegment, round(avg((x_price - ap) / sp), 6) AS mean_scaled_price, count(*) AS n
FROM ln CROSS JOIN c GROUP BY c_mktsegment""")
def p6_split(spark, sf_dir):
    """Scaler constants from the orders cohort applied to the shipped-lines cohort."""
    pf = prep_frame(spark, sf_dir).select("x_price")
    lines = cohort_lines(spark, sf_dir)
    pipe = build_pipeline([("scaler", {})], ["x_price"], [])
    _, test = fit_transform_split(pipe, pf, lines.select("x_price", "c_mktsegment"))
    return test.groupBy("c_mktsegment").agg(r6(F.avg("x_price")).alias("mean_scaled_price"), F.count(F.lit(1)).alias("n"))


@register("V1_stratified_split", f"""WITH {COHORT_ORDERS},
c AS (SELECT count(*) AS n, sum(event) AS pos FROM cohort),
k AS (SELECT CAST(floor(n * 0.2) AS BIGINT) AS n_test, CAST(floor(pos * 0.2) AS BIGINT) AS n_pos, n, pos FROM c)
SELECT 'test' AS split, 1 AS event, CAST(n_pos AS BIGINT) AS n FROM k UNION ALL SELECT 'test', 0, CAST(n_test - n_pos AS BIGINT) FROM k
UNION ALL SELECT 'train', 1, CAST(pos - n_pos AS BIGINT) FROM k UNION ALL SELECT 'train', 0, CAST(n - pos - (n_test - n_pos) AS BIGINT) FROM k""")
def v1_split(spark, sf_dir):
    s = stratified_split(cohort_orders(spark, sf_dir), "subject_id", "event", 0.2, 42)
    return s.groupBy("split", "event").agg(F.count(F.lit(1)).alias("n"))


@register("V2_kfold", f"""WITH {COHORT_ORDERS},
r AS (SELECT event, CAST((row_number() OVER (PARTITION BY event ORDER BY subject_id) - 1) % 5 AS INT) AS fold FROM cohort)
SELECT fold, event, count(*) AS n FROM r GROUP BY fold, event""")
def v2_kfold(spark, sf_dir):
    """Fold sizes per stratum (the hashed order itself is checked for determinism in the tests)."""
    f = kfold(cohort_orders(spark, sf_dir), "subject_id", 5, 42, stratify="event")
    return f.groupBy("fold", "event").agg(F.count(F.lit(1)).alias("n"))


@register("V3_contiguous_folds", f"""WITH {COHORT_ORDERS},
r AS (SELECT CAST(least(floor((rank() OVER (ORDER BY time) - 1) * 5 / (SELECT count(*) FROM cohort)), 4) AS INT) AS fold, time FROM cohort)
SELECT fold, count(*) AS n, min(time) AS t_min, max(time) AS t_max FROM r GROUP BY fold""")
def v3_contiguous(spark, sf_dir):
    f = contiguous_folds(cohort_orders(spark, sf_dir), "time", 5)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("t_min"), F.max("time").alias("t_max"))


@register("L1_coxph_fit")
def l1_cox(spark, sf_dir):
    """Rows-only: Newton fit of a ridge Cox model on the orders cohort; C-index of its risk."""
    co = cohort_orders(spark, sf_dir)
    m = CoxPH(["x_price", "x_bal"], alpha=0.01).fit(co)
    c = concordance(m.risk(co)).select("c_index")
    return c.select(F.lit(float(m.coef_[0])).alias("coef_x_price"), F.lit(float(m.coef_[1])).alias("coef_x_bal"),
                    F.lit(m.n_iter_).alias("iterations"), "c_index")


@register("L2_weibull_aft")
def l2_aft(spark, sf_dir):
    """Rows-only: MLlib Weibull AFT; survival at the horizons is non-increasing per row."""
    co = cohort_orders(spark, sf_dir)
    m = WeibullAFT(["x_price", "x_bal"]).fit(co)
    s = m.survival(co, HORIZONS)
    return s.agg(F.count(F.lit(1)).alias("n"), F.avg(F.element_at("surv", 1)).alias("mean_s90"),
                 F.sum((F.element_at("surv", 1) < F.element_at("surv", 3)).cast("int")).alias("n_increasing"))


EDGES = (30.0, 90.0, 180.0, 365.0, 730.0, 1095.0, 1825.0, 2600.0)


@register("L3_person_period", f"""WITH {COHORT_ORDERS},
iv AS (SELECT * FROM (VALUES {', '.join(f'({i + 1}, CAST({s} AS DOUBLE), CAST({e} AS DOUBLE))' for i, (s, e) in enumerate(zip((0.0,) + EDGES[:-1], EDGES)))}) t(interval, s, e))
SELECT interval, count(*) AS n, CAST(sum(CASE WHEN event = 1 AND time <= e THEN 1 ELSE 0 END) AS DOUBLE) AS events
FROM cohort JOIN iv ON time > s GROUP BY interval""")
def l3_person_period(spark, sf_dir):
    pp = person_period(cohort_orders(spark, sf_dir), EDGES)
    return pp.groupBy("interval").agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("events"))


@register("L4_hazard_forest")
def l4_forest(spark, sf_dir):
    """Rows-only: discrete-time hazard forest; C-index of the summed hazard."""
    co = cohort_orders(spark, sf_dir)
    m = DiscreteHazard(["x_price", "x_bal"], EDGES, "forest", n_trees=20, depth=4).fit(co)
    return concordance(m.survival(co, "subject_id")).select("c_index", "comparable")


@register("L5_hazard_gbt")
def l5_gbt(spark, sf_dir):
    co = cohort_orders(spark, sf_dir)
    m = DiscreteHazard(["x_price", "x_bal"], EDGES, "gbt", depth=3, rounds=10).fit(co)
    return concordance(m.survival(co, "subject_id")).select("c_index", "comparable")


@register("L6_combine", f"""WITH {COHORT_ORDERS}
SELECT subject_id, round(0.5 * ({RISK}) + 0.3 * x_price + 0.2 * (-x_bal), 6) AS risk FROM cohort""")
def l6_combine(spark, sf_dir):
    co = with_standin(cohort_orders(spark, sf_dir)).withColumnRenamed("risk", "r1").withColumn("r3", -F.col("x_bal"))
    return combine(co, ["r1", "x_price", "r3"], [0.5, 0.3, 0.2]).select("subject_id", r6("risk").alias("risk"))


@register("L7_bagging")
def l7_bagging(spark, sf_dir):
    co = cohort_orders(spark, sf_dir)
    b = Bagging(["x_price", "x_bal"], n=3, feat_frac=0.5, seed=7).fit(co, "subject_id")
    scored = b.survival(co, HORIZONS)
    return concordance(scored).select("c_index").crossJoin(scored.agg(F.avg(F.element_at("surv", 1)).alias("mean_s90")))


def _oof(spark, sf_dir, k=3):
    oof, models = cox_oof(cohort_orders(spark, sf_dir), ["x_price", "x_bal"], alpha=0.01, k=k)
    return oof.select("subject_id", "fold", "time", "event", "risk", "x_price", "x_bal"), models


@register("V5_cross_validate")
def v5_cv(spark, sf_dir):
    """3-fold out-of-fold C-index of a Cox model; all folds are fitted together (tested against separate fits)."""
    oof, _ = _oof(spark, sf_dir)
    return concordance(oof).select("c_index", "comparable")


@register("M13_assemble_oof", f"""WITH {COHORT_ORDERS}, s AS (SELECT *, {RISK} AS risk, CAST(subject_id % 3 AS INT) AS fold FROM cohort)
SELECT subject_id, fold, time, event, round(risk, 6) AS risk,
       {', '.join(f"round(exp(-exp(risk - 1.5) * {h} / 1000.0), 6) AS surv_{int(h)}" for h in HORIZONS)} FROM s""")
def m13_oof(spark, sf_dir):
    """Out-of-fold table of the stand-in model, folds by id modulo 3."""
    long = standin_long(cohort_orders(spark, sf_dir)).withColumn("fold", (F.col("subject_id") % 3).cast("int"))
    wide = assemble_oof(long.select("subject_id", "fold", "time", "event", "risk", "horizon", "surv"), "subject_id", HORIZONS)
    return wide.select("subject_id", "fold", "time", "event", r6("risk").alias("risk"),
                       *[r6(F.col(f"`surv@{int(h)}`")).alias(f"surv_{int(h)}") for h in HORIZONS])


def _bases(spark, sf_dir):
    oof, _ = _oof(spark, sf_dir)
    return oof.withColumn("r_price", F.col("x_price")).withColumn("r_bal", -F.col("x_bal")), ["risk", "r_price", "r_bal"]


@register("L8_stacking")
def l8_stacking(spark, sf_dir):
    """Rows-only: a linear meta model on three out-of-fold risks; its weights, C-index and mean survival."""
    o2, bases = _bases(spark, sf_dir)
    o2 = o2.withColumnRenamed("risk", "r_cox")
    bases[0] = "r_cox"
    w, b = stacking(o2, bases)
    scored = stacked_scores(o2, bases, w, b, HORIZONS)
    c = concordance(scored).select("c_index").crossJoin(scored.agg(F.avg(F.element_at("surv", 1)).alias("mean_s90")))
    return c.select(*[F.lit(x).alias(n) for x, n in zip([*w, b], ["w_cox", "w_price", "w_bal", "intercept"], strict=True)], "c_index", "mean_s90")


@register("L9_dynamic_selection")
def l9_dynamic(spark, sf_dir):
    """Rows-only: the better half of three out-of-fold risks, combined; C-index and mean survival."""
    o2, bases = _bases(spark, sf_dir)
    keep = dynamic_selection(o2, bases)
    scored = dynamic_scores(o2, keep, HORIZONS)
    c = concordance(scored).select("c_index").crossJoin(scored.agg(F.avg(F.element_at("surv", 1)).alias("mean_s90")))
    return c.select(F.lit(",".join(keep)).alias("models"), "c_index", "mean_s90")


@register("L10_horizon_classifier")
def l10_horizon(spark, sf_dir):
    """Rows-only: C-index of P(event within a year) by each classifier kind."""
    scored = co = cohort_orders(spark, sf_dir)
    params = {"forest": {"numTrees": 10, "seed": 1}, "gbt": {"maxIter": 5, "seed": 1}, "svc": {"maxIter": 20}}
    scores = horizon_classifiers(co, ["x_price", "x_bal"], 365.0, {kind: params.get(kind, {}) for kind in CLASSIFIERS})
    for kind, score in scores.items():
        scored = score(scored).withColumnRenamed("risk", f"_{kind}")
    c = concordance(long_risks(scored, {kind: f"_{kind}" for kind in scores}, "model"), by=["model"]).select(F.col("model").alias("kind"), "c_index")
    kinds = spark.createDataFrame([(kind,) for kind in scores], "kind string")
    return kinds.join(c, "kind", "left")


@register("L2_normal_aft")
def l2_normal(spark, sf_dir):
    return _location_scale(spark, sf_dir, "normal")


@register("L2_logistic_aft")
def l2_logistic(spark, sf_dir):
    return _location_scale(spark, sf_dir, "logistic")


def _location_scale(spark, sf_dir, dist):
    """Rows-only: Newton fit of a log-time model; its scale, convergence and C-index."""
    co = cohort_orders(spark, sf_dir)
    m = LocationScaleAFT(["x_price", "x_bal"], dist).fit(co)
    return concordance(m.risk(co)).select(F.lit(m.intercept_).alias("intercept"), F.lit(float(m.coef_[0])).alias("coef_x_price"),
                                          F.lit(float(m.coef_[1])).alias("coef_x_bal"), F.lit(m.sigma_).alias("sigma"),
                                          F.lit(m.converged_).alias("converged"), "c_index")


@register("L11_fit_per_group")
def l11_groups(spark, sf_dir):
    """Rows-only: one Cox model per market segment (local Newton per group)."""
    return fit_per_group(cohort_orders(spark, sf_dir), "c_mktsegment", ["x_price", "x_bal"])


@register("L12_update_model")
def l12_update(spark, sf_dir):
    """Rows-only: sliding-window warm-started refit on the episode cohort (history = first two
    weeks of signups, new = the rest)."""
    ep = cohort_episodes(spark, sf_dir).withColumnRenamed("start_ts", "ts")
    cut = F.lit("2024-01-15").cast("timestamp")
    hist, new = ep.where(F.col("ts") < cut), ep.where(F.col("ts") >= cut)
    m0 = CoxPH(["x1"]).fit(hist)
    m1, updated = update_model(m0, hist, new, "sliding", window_days=14)
    return spark.createDataFrame([(float(m0.coef_[0]), float(m1.coef_[0]), updated)], "coef_before double, coef_after double, updated boolean")


@register("M12_leaderboard", f"""WITH {COHORT_ORDERS},
m AS (SELECT c.*, mm.model, CASE mm.model WHEN 'standin' THEN {RISK} WHEN 'price' THEN x_price ELSE -x_bal END AS risk
      FROM cohort c CROSS JOIN (VALUES ('standin'), ('price'), ('neg_bal')) mm(model)),
cc AS (SELECT a.model, sum(CASE WHEN b.risk < a.risk THEN 1.0 WHEN b.risk = a.risk THEN 0.5 ELSE 0.0 END) / count(*) AS concordance
       FROM m a JOIN m b ON a.model = b.model AND a.event = 1 AND (b.time > a.time OR (b.time = a.time AND b.event = 0)) GROUP BY a.model)
SELECT model, round(concordance, 6) AS concordance, CAST(rank() OVER (ORDER BY concordance DESC, model) AS INT) AS position FROM cc""")
def m12_leaderboard(spark, sf_dir):
    co = with_standin(cohort_orders(spark, sf_dir))
    arr = F.array(F.struct(F.lit("standin").alias("model"), F.col("risk").alias("r")),
                  F.struct(F.lit("price").alias("model"), F.col("x_price").alias("r")),
                  F.struct(F.lit("neg_bal").alias("model"), (-F.col("x_bal")).alias("r")))
    long = co.select("time", "event", F.explode(arr).alias("_m")).select("time", "event", "_m.model", F.col("_m.r").alias("risk"))
    c = concordance(long, by=["model"]).select("model", F.lit("concordance").alias("metric"), F.col("c_index").alias("value"))
    lb = leaderboard(c, names=("concordance",))
    from pyspark.sql import Window
    return lb.select("model", r6("concordance").alias("concordance"),
                     F.rank().over(Window.orderBy(F.col("concordance").desc(), "model")).cast("int").alias("position"))


@register("M14_check_regression", f"""WITH {COHORT_ORDERS},
s AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'base' ELSE 'new' END AS side, avg(event) AS event_rate, avg(time) AS mean_time FROM cohort GROUP BY 1),
l AS (SELECT side, 'event_rate' AS metric, event_rate AS value, false AS hib FROM s UNION ALL SELECT side, 'mean_time', mean_time, true FROM s)
SELECT n.metric, round(n.value, 6) AS new, round(b.value, 6) AS base,
       round((n.value - b.value) * CASE WHEN b.hib THEN 1 ELSE -1 END, 6) AS change,
       (n.value - b.value) * CASE WHEN b.hib THEN 1 ELSE -1 END < -0.02 AS regressed
FROM l n JOIN l b ON n.metric = b.metric AND n.side = 'new' AND b.side = 'base'""")
def m14_regression(spark, sf_dir):
    """Other segments (new) against BUILDING (baseline) on event rate (lower is better) and mean
    follow-up time (higher is better), absolute tolerance .02."""
    co = cohort_orders(spark, sf_dir).withColumn("side", F.when(F.col("c_mktsegment") == "BUILDING", "base").otherwise("new"))
    s = co.groupBy("side").agg(F.avg("event").alias("event_rate"), F.avg("time").alias("mean_time"))
    arr = F.array(F.struct(F.lit("event_rate").alias("metric"), F.col("event_rate").alias("value"), F.lit(False).alias("higher_is_better")),
                  F.struct(F.lit("mean_time").alias("metric"), F.col("mean_time").alias("value"), F.lit(True).alias("higher_is_better")))
    long = s.select("side", F.explode(arr).alias("_m")).select("side", "_m.*")
    r = check_regression(long.where(F.col("side") == "new"), long.where(F.col("side") == "base"), 0.02)
    return r.select("metric", r6("new").alias("new"), r6("base").alias("base"), r6("change").alias("change"), "regressed")


@register("V6_nested_cv")
def v6_nested(spark, sf_dir):
    """2 x 2 nested CV over the ridge penalty of the Cox model, all fits together (tested against separate fits)."""
    return cox_nested_cv(cohort_orders(spark, sf_dir), ["x_price", "x_bal"], [0.0, 1.0], outer=2, inner=2)


@register("V7_random_search")
def v7_random(spark, sf_dir):
    """Three log-uniform ridge penalties by 2-fold C-index, all fits together."""
    return cox_search(cohort_orders(spark, sf_dir), ["x_price", "x_bal"], random_alphas(1e-3, 10.0, 3), k=2)


# fixed coefficients at which the derivatives are stated in SQL (the stand-in risk)
COX_AT = (0.4, -0.1)


@register("L1_cox_derivatives", f"""WITH {COHORT_ORDERS},
s AS (SELECT time, event, x_price, x_bal, {RISK} AS lp, exp({RISK}) AS w FROM cohort WHERE time IS NOT NULL AND event IS NOT NULL AND x_price IS NOT NULL AND x_bal IS NOT NULL),
t AS (SELECT time, sum(event) AS d, sum(w) AS s0, sum(w * x_price) AS s1, sum(w * x_bal) AS s2, sum(w * x_price * x_price) AS s11,
             sum(w * x_price * x_bal) AS s12, sum(w * x_bal * x_bal) AS s22 FROM s GROUP BY time),
r AS (SELECT time, d, {', '.join(f"sum({c}) OVER (ORDER BY time DESC) AS {c}" for c in ('s0', 's1', 's2', 's11', 's12', 's22'))} FROM t),
e AS (SELECT sum(event * lp) AS lp, sum(event * x_price) AS e1, sum(event * x_bal) AS e2 FROM s)
SELECT round(max(lp) - sum(d * ln(s0)), 6) AS loglik, round(max(e1) - sum(d * s1 / s0), 6) AS grad_price, round(max(e2) - sum(d * s2 / s0), 6) AS grad_bal,
       round(-sum(d * (s11 / s0 - s1 * s1 / (s0 * s0))), 6) AS hess_price, round(-sum(d * (s12 / s0 - s1 * s2 / (s0 * s0))), 6) AS hess_both,
       round(-sum(d * (s22 / s0 - s2 * s2 / (s0 * s0))), 6) AS hess_bal
FROM r CROSS JOIN e""")
def l1_derivatives(spark, sf_dir):
    """Log-likelihood, gradient and Hessian of the partial likelihood at fixed coefficients, by the array scan."""
    co = cohort_orders(spark, sf_dir)
    rows = cox_rows(co, ["x_price", "x_bal"], np.zeros(2), np.ones(2), "time", "event")
    data = ranged(rows, "t", co.count(), descending=True)
    try:
        ll, grad, hess = cox_derivatives(data, {0: np.array(COX_AT)})[0]
    finally:
        data.unpersist()
    values = [ll, *grad, hess[0, 0], hess[0, 1], hess[1, 1]]
    names = ["loglik", "grad_price", "grad_bal", "hess_price", "hess_both", "hess_bal"]
    return spark.createDataFrame([tuple(map(float, values))], ", ".join(f"{n} double" for n in names)).select(*[r6(n).alias(n) for n in names])


@register("L1_cox_gradient_at_solution", "SELECT 0.0::DOUBLE AS gradient, true AS converged")
def l1_solution(spark, sf_dir):
    """The largest entry of the gradient at the fitted coefficients, per subject and rounded, is 0."""
    co = cohort_orders(spark, sf_dir)
    m = CoxPH(["x_price", "x_bal"]).fit(co)
    n = co.count()
    data = ranged(cox_rows(co, m.features, np.zeros(2), np.ones(2), "time", "event"), "t", n, descending=True)
    try:
        _, grad, _ = cox_derivatives(data, {0: m.coef_})[0]
    finally:
        data.unpersist()
    return spark.createDataFrame([(float(np.abs(grad).max()) / n, m.converged_)], "gradient double, converged boolean").select(
        F.abs(r6("gradient")).alias("gradient"), "converged")


@register("V10_leakage_probe")
def v10_leak(spark, sf_dir):
    """A Cox model on both features is fitted and scored by its C-index after two preparations: centring the features (which must
    pass), and replacing the price by the mean follow-up of the customer's orders of that priority, groups that span the
    folds (which sees held-out outcomes and gains when it is fitted before splitting)."""
    from tte.operators.split import leakage_probe

    def centred(train, rows):
        m = train.agg(F.avg("x_price").alias("_a"), F.avg("x_bal").alias("_b"))  # one row
        both = rows.crossJoin(F.broadcast(m))
        return both.withColumn("x_price", F.col("x_price") - F.col("_a")).withColumn("x_bal", F.col("x_bal") - F.col("_b")).drop("_a", "_b")

    def target_mean(train, rows):
        means = train.groupBy(F.col("x_bal").alias("_b"), F.col("o_orderpriority").alias("_p")).agg(F.avg("time").alias("_m"))
        same = rows["x_bal"].eqNullSafe(F.col("_b")) & rows["o_orderpriority"].eqNullSafe(F.col("_p"))
        average = train.agg(F.avg("time").alias("_all"))
        known = rows.join(means, same, "left").crossJoin(F.broadcast(average))  # one row
        return known.withColumn("x_price", F.coalesce("_m", "_all")).drop("_b", "_p", "_m", "_all")

    found = leakage_probe(cohort_orders(spark, sf_dir), {"centred": centred, "target_mean": target_mean}, CoxFit, CIndex(), ["x_price", "x_bal"], k=2)
    rows = [(name, *result) for name, result in found.items()]
    return spark.createDataFrame(rows, "preparation string, honest double, early double, leak_detected boolean")


@register("X1_permutation_importance")
def x1_perm(spark, sf_dir):
    from tte.operators.explain import permutation_importance

    m = CoxPH(["x_price", "x_bal"]).fit(cohort_orders(spark, sf_dir))
    return permutation_importance(cohort_orders(spark, sf_dir), "subject_id", m.risk, ["x_price", "x_bal"], repeats=2)


def _fixed():
    from tte.operators.models.linear import LinearRisk

    return LinearRisk({"x_price": 0.4, "x_bal": -0.1})


@register("X2_permutation_shift", """SELECT feature, 0.0::DOUBLE AS shift FROM (VALUES ('x_price'), ('x_bal')) t(feature)""")
def x2_shift(spark, sf_dir):
    """0 for a linear model by construction: a permutation keeps every value, hence the mean."""
    from tte.operators.explain import permutation_shift

    s = permutation_shift(cohort_orders(spark, sf_dir), "subject_id", _fixed().risk, ["x_price", "x_bal"], repeats=2)
    return s.select("feature", F.abs(r6("shift")).alias("shift"))


def _permuted_sql(at: str, feature: str, rep: int) -> str:
    """The row number that the permutation sends ``at`` to: one turn of the network (a and b are its digits)."""
    from tte.operators.permute import permutation_keys
    from tte.operators.replicates import PRIME

    left, right = f"({at} // b)", f"({at} % b)"
    mix = lambda x, k: f"((((({x} + {k}) % {PRIME}) * (({x} + {k}) % {PRIME})) + 40503 * (({x} + {k}) % {PRIME}) + {k}) % {PRIME})"
    steps, keys = [], permutation_keys(42, f"{feature}:{rep}")
    for i, k in enumerate(keys):
        l, r = (f"l{i}", f"r{i}")
        steps.append((l, r, mix(r if i % 2 == 0 else l, k), i % 2 == 0))
    out = f"SELECT *, {left} AS l0, {right} AS r0 FROM @src"
    for l, r, m, on_left in steps:
        i = int(l[1:]) + 1
        out = f"SELECT * EXCLUDE ({l}, {r}), {f'({l} + {m}) % a' if on_left else l} AS l{i}, {r if on_left else f'({r} + {m}) % b'} AS r{i} FROM ({out})"
    return f"SELECT * EXCLUDE (l4, r4), l4 * b + r4 AS moved FROM ({out})"


def _copies_sql() -> str:
    parts = []
    for f in ("x_price", "x_bal"):
        for r in range(2):
            turn = _permuted_sql("pos", f, r)
            walk = f"""SELECT row, n, a, b, row AS pos, 0 AS turn FROM numbered CROSS JOIN size
  UNION ALL SELECT row, n, a, b, moved, turn + 1 FROM ({turn.replace('@src', '(SELECT * FROM w_%s_%d WHERE turn = 0 OR pos >= n)' % (f, r))})"""
            parts.append((f"w_{f}_{r}", walk, f, r))
    ctes = ",\n".join(f"{name} AS ({walk})" for name, walk, _, _ in parts)
    reads = " UNION ALL ".join(
        f"SELECT '{f}' AS permuted, {r} AS rep, o.row, v.{f} AS value FROM {name} w JOIN numbered o ON o.row = w.row JOIN numbered v ON v.row = w.pos WHERE w.turn > 0 AND w.pos < w.n"
        for name, _, f, r in parts)
    return f"""WITH RECURSIVE {COHORT_ORDERS}, numbered AS (SELECT *, row_number() OVER (ORDER BY subject_id) - 1 AS row FROM cohort),
size AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT count(*) AS n, CAST(floor(sqrt(count(*) - 1)) AS BIGINT) + 1 AS a FROM cohort)),
{ctes}, copies AS ({reads})
SELECT permuted, rep, count(*) AS n, round(sum(value), 6) AS total, round(avg(value * (row % 97)), 6) AS placed FROM copies GROUP BY permuted, rep"""


@register("X2_permuted_copies", _copies_sql())
def x2_copies(spark, sf_dir):
    """Which value each row gets: per feature and repeat the count, the total (that of the table) and a sum that
    depends on the place of every value."""
    from tte.operators.explain import permuted_copies
    from tte.operators.permute import row_numbers

    co = cohort_orders(spark, sf_dir).select("subject_id", "x_price", "x_bal")
    own, _ = row_numbers(co, "subject_id", "row")
    c = permuted_copies(own, "subject_id", ["x_price", "x_bal"], 2, 42)
    value = F.when(F.col("permuted") == "x_price", F.col("x_price")).otherwise(F.col("x_bal"))
    return c.groupBy("permuted", "rep").agg(F.count(F.lit(1)).alias("n"), r6(F.sum(value)).alias("total"),
                                            r6(F.avg(value * (F.col("row") % 97))).alias("placed"))


SHAP_DRAWS = 8


@register("X5_sampled_shapley", f"""WITH {COHORT_ORDERS}, numbered AS (SELECT *, row_number() OVER (ORDER BY subject_id) - 1 AS row, count(*) OVER () AS n FROM cohort),
{draws_cte(42, SHAP_DRAWS, index=True)},
bg AS (SELECT d.subject_id, avg(b.x_price) AS b_price, avg(b.x_bal) AS b_bal FROM draws d CROSS JOIN (SELECT count(*) AS n FROM cohort) c
       JOIN numbered b ON b.row = d.u::HUGEINT * c.n // 2147483647 GROUP BY d.subject_id),
s AS (SELECT 0.4 * (x_price - b_price) AS p, -0.1 * (x_bal - b_bal) AS q FROM numbered JOIN bg USING (subject_id))
SELECT 'x_price' AS feature, round(avg(p), 6) AS mean_shapley, round(avg(abs(p)), 6) AS mean_abs FROM s
UNION ALL SELECT 'x_bal', round(avg(q), 6), round(avg(abs(q)), 6) FROM s""")
def x5_shapley(spark, sf_dir):
    """Monte Carlo Shapley values of the fixed linear risk per order, summarised per feature. In a linear model a feature's
    value is its coefficient times the distance to the drawn background rows, whatever the order of the walk."""
    from tte.operators.explain import sampled_shapley

    co = cohort_orders(spark, sf_dir)
    sh = sampled_shapley(co, "subject_id", _fixed().risk, ["x_price", "x_bal"], co, draws=SHAP_DRAWS)
    return sh.groupBy("feature").agg(r6(F.avg("shapley")).alias("mean_shapley"), r6(F.avg(F.abs("shapley"))).alias("mean_abs"))


@register("X10_X11_counterfactuals")
def x10_cf(spark, sf_dir):
    """Rows-only: random-search counterfactuals towards risk 0 for orders above the median risk,
    summarised (X11)."""
    from tte.operators.explain import counterfactual_search, counterfactual_summary
    from tte.operators.models.linear import LinearRisk

    m = LinearRisk({"x_price": 0.4, "x_bal": -0.1})
    cf = counterfactual_search(cohort_orders(spark, sf_dir).select("subject_id", "x_price", "x_bal"), "subject_id", m.risk,
                               {"x_price": (0.0, 5.0), "x_bal": (-1.0, 9.0)}, target=0.0, n_draws=20, max_dist=0.3)
    return counterfactual_summary(cf, ["x_price", "x_bal"])


@register("P2_iterative_imputer")
def p2_iterative(spark, sf_dir):
    """Rows-only: x_bal gaps (rule: subject_id % 5 = 0) filled from x_price and time by rounds of
    ridge fits; the mean and count of the filled column."""
    from tte.operators.prep import IterativeImputer

    pf = prep_frame(spark, sf_dir).select("subject_id", "x_price", "x_bal", "time")
    imp = IterativeImputer(["x_price", "x_bal", "time"], max_iter=5).fit(pf)
    out = pf.select("subject_id", imp.exprs(pf)["x_bal"].alias("x_bal"))
    return out.agg(F.count("x_bal").alias("n_filled"), F.avg("x_bal").alias("mean_x_bal"))
