"""Registered queries: scoring, stratification and explanation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tte.operators.explain import (
    counterfactual_summary, explain_rows, linear_contributions, partial_dependence, population_insights, risk_distribution,
    top_features, treatment_effect, treatment_effect_interval,
)
from tte.operators.models.cox import breslow_baseline, survival_exponential
from tte.operators.models.linear import LinearRisk
from tte.operators.score import (
    cohort_flags, cohort_summary, compare_scores, median_survival, recommendations, risk_band, risk_category,
    risk_percentile, score_batch, stratify, survival_wide, urgency,
)
from tte.plans.registry import r6, register
from tte.plans.sqltext import COHORT_LINES, COHORT_ORDERS, RISK
from tte.sources.testdata import HORIZONS, cohort_lines, cohort_orders, standin_surv, with_standin

COEF = {"x_price": 0.4, "x_bal": -0.1}
HZ_SQL = ", ".join(f"(CAST({h} AS DOUBLE))" for h in HORIZONS)

BASELINE_CTE = f"""{COHORT_ORDERS},
sc AS (SELECT *, {RISK} AS risk FROM cohort),
pt AS (SELECT time, sum(exp(risk)) AS r, sum(event) AS d FROM sc GROUP BY time),
rs AS (SELECT time, d, sum(r) OVER (ORDER BY time DESC) AS s0 FROM pt),
bl AS (SELECT time, sum(d / greatest(s0, 1e-8)) OVER (ORDER BY time) AS hazard0 FROM rs WHERE d > 0)"""


@register("K7_breslow_baseline", f"""WITH {BASELINE_CTE}
SELECT time, round(hazard0, 6) AS hazard0, round(exp(-hazard0), 6) AS surv0 FROM bl""")
def k7_baseline(spark, sf_dir):
    co = with_standin(cohort_orders(spark, sf_dir))
    b = breslow_baseline(co, F.exp(F.col("risk")))
    return b.select("time", r6("hazard0").alias("hazard0"), r6("surv0").alias("surv0"))


@register("I1_score_batch", f"""WITH {BASELINE_CTE},
s0h AS (SELECT hz.horizon, coalesce((SELECT exp(-hazard0) FROM bl WHERE bl.time <= hz.horizon ORDER BY bl.time DESC LIMIT 1), 1.0) AS s0
        FROM (VALUES {HZ_SQL}) hz(horizon))
SELECT subject_id, round(risk, 6) AS risk,
  round(pow((SELECT s0 FROM s0h WHERE horizon = 90.0), exp(risk)), 6) AS surv_prob_90d,
  round(pow((SELECT s0 FROM s0h WHERE horizon = 180.0), exp(risk)), 6) AS surv_prob_180d,
  round(pow((SELECT s0 FROM s0h WHERE horizon = 365.0), exp(risk)), 6) AS surv_prob_365d
FROM sc""")
def i1_score(spark, sf_dir):
    """I1 + K8 + I4: a fixed linear model with its Breslow baseline scores every order."""
    co = cohort_orders(spark, sf_dir)
    m = LinearRisk(COEF).fit(co)
    s = survival_wide(score_batch(co, m, HORIZONS), HORIZONS)
    return s.select("subject_id", r6("risk").alias("risk"),
                    *[r6(f"surv_prob_{int(h)}d").alias(f"surv_prob_{int(h)}d") for h in HORIZONS])


@register("K9_survival_exponential", f"""WITH {COHORT_ORDERS}
SELECT subject_id, {', '.join(f"round(least(greatest(exp(-(exp({RISK} - 1.5) / 1000.0) * {h}), 0.0), 1.0), 6) AS s{int(h)}" for h in HORIZONS)}
FROM cohort""")
def k9_exponential(spark, sf_dir):
    co = cohort_orders(spark, sf_dir).withColumn("rate", F.exp(0.4 * F.col("x_price") + -0.1 * F.col("x_bal") - 1.5) / 1000.0)
    s = survival_exponential(co, HORIZONS, "rate")
    return s.select("subject_id", *[r6(F.element_at("surv", i + 1)).alias(f"s{int(h)}") for i, h in enumerate(HORIZONS)])


@register("I2_risk_percentile", f"""WITH {COHORT_LINES}, ref AS (SELECT {RISK} AS r FROM cohort),
o AS ({COHORT_ORDERS.strip().replace('cohort AS (', '', 1)[:-1]}),
u AS (SELECT subject_id, {RISK} AS r, 0 AS isref FROM o UNION ALL SELECT NULL, r, 1 FROM ref),
c AS (SELECT subject_id, isref, sum(isref) OVER (ORDER BY r RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM u)
SELECT subject_id, round(k * 100.0 / (SELECT count(*) FROM ref), 6) AS risk_percentile FROM c WHERE isref = 0""")
def i2_percentile(spark, sf_dir):
    """Orders scored against the risk distribution of the shipped lines."""
    o = with_standin(cohort_orders(spark, sf_dir)).select("subject_id", "risk")
    ref = with_standin(cohort_lines(spark, sf_dir)).select("risk")
    p = risk_percentile(o, ref)
    return p.select("subject_id", r6("risk_percentile").alias("risk_percentile"))


def _cat_sql(v):
    return f"CASE WHEN {v} <= 0.25 THEN 'low' WHEN {v} <= 0.5 THEN 'moderate' WHEN {v} <= 0.75 THEN 'high' WHEN {v} <= 1.0 THEN 'very_high' ELSE 'very_high' END"


@register("I3_risk_category", f"""WITH {COHORT_ORDERS}, s AS (SELECT *, {RISK} AS risk FROM cohort),
e AS (SELECT *, (count(*) OVER (ORDER BY risk RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) * 1.0 / count(*) OVER () AS ecdf FROM s)
SELECT 'sigmoid' AS method, {_cat_sql('1.0 / (1.0 + exp(-risk))')} AS risk_category, count(*) AS n FROM e GROUP BY 2
UNION ALL
SELECT 'ecdf', {_cat_sql('ecdf')}, count(*) FROM e GROUP BY 2""")
def i3_category(spark, sf_dir):
    """Categories from sigmoid(risk) and from the ECDF of the cohort itself as reference."""
    s = with_standin(cohort_orders(spark, sf_dir)).select("subject_id", "risk")
    a = risk_category(s).groupBy("risk_category").agg(F.count(F.lit(1)).alias("n")).withColumn("method", F.lit("sigmoid"))
    e = risk_percentile(s, s.select("risk"))
    b = risk_category(e, ecdf="ecdf").groupBy("risk_category").agg(F.count(F.lit(1)).alias("n")).withColumn("method", F.lit("ecdf"))
    return a.unionByName(b).select("method", "risk_category", "n")


MED_HZ = (90.0, 180.0, 365.0, 730.0, 1095.0, 1825.0, 2555.0)


@register("I5_median_survival", f"""WITH {COHORT_ORDERS},
l AS (SELECT subject_id, hz.h, exp(-exp({RISK} - 1.5) * hz.h / 1000.0) AS s FROM cohort CROSS JOIN (VALUES {', '.join(f'(CAST({h} AS DOUBLE))' for h in MED_HZ)}) hz(h)),
m AS (SELECT subject_id, min(CASE WHEN s <= 0.5 THEN h END) AS median_survival FROM l GROUP BY subject_id)
SELECT median_survival, count(*) AS n FROM m GROUP BY median_survival""")
def i5_median(spark, sf_dir):
    co = cohort_orders(spark, sf_dir).withColumn("surv", F.array(*[standin_surv(h) for h in MED_HZ]))
    return median_survival(co, MED_HZ).groupBy("median_survival").agg(F.count(F.lit(1)).alias("n"))


P365 = f"(1.0 - exp(-exp({RISK} - 1.5) * 365.0 / 1000.0))"


@register("I6_risk_band", f"""WITH {COHORT_ORDERS}
SELECT CASE WHEN {P365} >= 0.7 THEN 'high_risk' WHEN {P365} >= 0.3 THEN 'medium_risk' ELSE 'low_risk' END AS risk_band, count(*) AS n
FROM cohort GROUP BY 1""")
def i6_band(spark, sf_dir):
    co = cohort_orders(spark, sf_dir).withColumn("p365", 1.0 - standin_surv(365.0))
    return risk_band(co, "p365").groupBy("risk_band").agg(F.count(F.lit(1)).alias("n"))


def _stratified(spark, sf_dir):
    co = cohort_orders(spark, sf_dir).withColumn("p365", 1.0 - standin_surv(365.0))
    c = linear_contributions(co, COEF)
    return recommendations(urgency(stratify(c, "p365", "contrib")))


STRAT_CTE = f"""{COHORT_ORDERS},
mu AS (SELECT avg(x_price) AS mp, avg(x_bal) AS mb FROM cohort),
s AS (SELECT c.*, {P365} AS p365, 0.4 * (x_price - mp) AS c_price, -0.1 * (x_bal - mb) AS c_bal FROM cohort c CROSS JOIN mu),
t AS (SELECT *, CASE WHEN p365 <= 0.2 THEN 'low' WHEN p365 <= 0.4 THEN 'moderate' WHEN p365 <= 0.7 THEN 'high'
                     WHEN p365 <= 1.0 THEN 'very_high' ELSE 'unknown' END AS risk_category FROM s),
u AS (SELECT *, CASE WHEN risk_category = 'very_high' THEN 'critical' ELSE 'routine' END AS urgency FROM t)"""


@register("I7_stratify", f"""WITH {STRAT_CTE}
SELECT risk_category, urgency, CAST(sum(CASE WHEN c_price > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS n_price_factor,
       CAST(sum(CASE WHEN c_bal < -0.05 THEN 1 ELSE 0 END) AS BIGINT) AS n_bal_protective,
       round(avg(greatest(p365 - 0.1, 0.0)), 6) AS mean_ci_lower, count(*) AS n
FROM u GROUP BY risk_category, urgency""")
def i7_stratify(spark, sf_dir):
    """I7 + I8 with X4 contributions of the fixed linear model."""
    s = _stratified(spark, sf_dir)
    return s.groupBy("risk_category", "urgency").agg(
        F.sum(F.array_contains("risk_factors", "x_price").cast("long")).alias("n_price_factor"),
        F.sum(F.array_contains("protective_factors", "x_bal").cast("long")).alias("n_bal_protective"),
        r6(F.avg("ci_lower")).alias("mean_ci_lower"), F.count(F.lit(1)).alias("n"))


@register("I9_recommendations", f"""WITH {STRAT_CTE}
SELECT risk_category, CASE risk_category WHEN 'very_high' THEN 4 WHEN 'high' THEN 4 WHEN 'moderate' THEN 3 ELSE 2 END AS n_advice, count(*) AS n
FROM u GROUP BY risk_category""")
def i9_recommendations(spark, sf_dir):
    s = _stratified(spark, sf_dir)
    return s.groupBy("risk_category", F.size("recommendations").alias("n_advice")).agg(F.count(F.lit(1)).alias("n"))


@register("I10_cohort_summary", f"""WITH {STRAT_CTE}
SELECT count(*) AS total, round(avg(p365), 6) AS average_risk,
  {', '.join(f"CAST(sum(CASE WHEN risk_category = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS risk_category_{c}" for c in ('low', 'moderate', 'high', 'very_high'))},
  {', '.join(f"CAST(sum(CASE WHEN urgency = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS urgency_{c}" for c in ('routine', 'urgent', 'critical'))},
  CAST(sum(CASE WHEN risk_category IN ('high', 'very_high') THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_patients
FROM u""")
def i10_summary(spark, sf_dir):
    s = cohort_summary(_stratified(spark, sf_dir), "p365")
    return s.withColumn("average_risk", r6("average_risk"))


@register("I11_cohort_flags", f"""WITH {STRAT_CTE},
f AS (SELECT 'x_price' AS factor FROM u WHERE c_price > 0.05 UNION ALL SELECT 'x_bal' FROM u WHERE c_bal > 0.05),
top AS (SELECT factor, count(*) AS k FROM f GROUP BY factor ORDER BY k DESC, factor LIMIT 3),
b AS (SELECT count(*) AS n, sum(CASE WHEN risk_category = 'very_high' THEN 1 ELSE 0 END) AS vh,
             sum(CASE WHEN risk_category = 'high' THEN 1 ELSE 0 END) AS h, sum(CASE WHEN risk_category = 'moderate' THEN 1 ELSE 0 END) AS m FROM u)
SELECT vh > 0 AS has_very_high, h > 0.5 * m AS high_exceeds_half_moderate,
       coalesce(list_sort((SELECT list(factor) FROM top WHERE k > 0.2 * (SELECT n FROM b))), []) AS common_factors FROM b""")
def i11_flags(spark, sf_dir):
    """Rows-only: cohort-level flags (array of common factors)."""
    return cohort_flags(_stratified(spark, sf_dir))


@register("I12_compare_scores", f"""WITH {COHORT_ORDERS}, s AS (SELECT {RISK} AS standin, x_price AS price, -x_bal AS neg_bal FROM cohort)
SELECT 'standin' AS model, round(avg(standin), 6) AS mean, round(stddev_pop(standin), 6) AS std, round(min(standin), 6) AS min, round(max(standin), 6) AS max FROM s
UNION ALL SELECT 'price', round(avg(price), 6), round(stddev_pop(price), 6), round(min(price), 6), round(max(price), 6) FROM s
UNION ALL SELECT 'neg_bal', round(avg(neg_bal), 6), round(stddev_pop(neg_bal), 6), round(min(neg_bal), 6), round(max(neg_bal), 6) FROM s""")
def i12_compare(spark, sf_dir):
    co = with_standin(cohort_orders(spark, sf_dir)).select(F.col("risk").alias("standin"), F.col("x_price").alias("price"),
                                                           (-F.col("x_bal")).alias("neg_bal"))
    per_model, _ = compare_scores(co, ["standin", "price", "neg_bal"])
    return per_model.select("model", *[r6(c).alias(c) for c in ("mean", "std", "min", "max")])


@register("I12_score_correlation", f"""WITH {COHORT_ORDERS}, s AS (SELECT {RISK} AS standin, x_price AS price, -x_bal AS neg_bal FROM cohort)
SELECT 'standin' AS model_a, 'price' AS model_b, round(corr(standin, price), 6) AS corr FROM s
UNION ALL SELECT 'standin', 'neg_bal', round(corr(standin, neg_bal), 6) FROM s
UNION ALL SELECT 'price', 'neg_bal', round(corr(price, neg_bal), 6) FROM s""")
def i12_corr(spark, sf_dir):
    co = with_standin(cohort_orders(spark, sf_dir)).select(F.col("risk").alias("standin"), F.col("x_price").alias("price"),
                                                           (-F.col("x_bal")).alias("neg_bal"))
    _, corr = compare_scores(co, ["standin", "price", "neg_bal"])
    return corr.select("model_a", "model_b", r6("corr").alias("corr"))


@register("X4_X6_top_features", f"""WITH {STRAT_CTE}
SELECT name, round(mean_abs, 6) AS mean_abs FROM (
  SELECT 'x_price' AS name, avg(abs(c_price)) AS mean_abs FROM s UNION ALL SELECT 'x_bal', avg(abs(c_bal)) FROM s)
ORDER BY mean_abs DESC, name LIMIT 10""")
def x6_top(spark, sf_dir):
    c = linear_contributions(cohort_orders(spark, sf_dir), COEF)
    return top_features(c, 10).select("name", r6("mean_abs").alias("mean_abs"))


@register("X7_explain_rows", f"""WITH {STRAT_CTE}
SELECT CAST(CASE WHEN abs(c_price) + abs(c_bal) > 0.5 THEN 0.9 WHEN abs(c_price) + abs(c_bal) > 0.2 THEN 0.7 ELSE 0.5 END AS DOUBLE) AS confidence,
       CAST((CASE WHEN abs(c_price) > 0.05 THEN 1 ELSE 0 END) + (CASE WHEN abs(c_bal) > 0.05 THEN 1 ELSE 0 END) AS INT) AS n_findings,
       count(*) AS n
FROM s GROUP BY 1, 2""")
def x7_explain(spark, sf_dir):
    e = explain_rows(linear_contributions(cohort_orders(spark, sf_dir), COEF))
    return e.groupBy("confidence", F.size("findings").alias("n_findings")).agg(F.count(F.lit(1)).alias("n"))


@register("X8_population_insights", f"""WITH {STRAT_CTE},
l AS (SELECT 'x_price' AS name, c_price AS v FROM s UNION ALL SELECT 'x_bal', c_bal FROM s),
g AS (SELECT name, avg(v) AS mc, avg(abs(v)) AS ma, avg(CASE WHEN abs(v) > 0.05 THEN 1.0 ELSE 0.0 END) AS sr FROM l GROUP BY name)
SELECT name, round(mc, 6) AS mean_contribution, round(ma, 6) AS mean_abs, round(sr, 6) AS share_relevant,
       CAST(row_number() OVER (ORDER BY ma DESC, name) AS INT) AS rank, row_number() OVER (ORDER BY ma DESC, name) <= 1 AS is_top FROM g""")
def x8_insights(spark, sf_dir):
    """All features, the first marked as top."""
    p = population_insights(linear_contributions(cohort_orders(spark, sf_dir), COEF), top=1)
    return p.select("name", *[r6(c).alias(c) for c in ("mean_contribution", "mean_abs", "share_relevant")], "rank", "is_top")


@register("X8_risk_distribution", f"""WITH {COHORT_ORDERS}, s AS (SELECT {RISK} AS risk FROM cohort)
SELECT count(*) AS n, round(avg(risk), 6) AS mean, round(stddev_samp(risk), 6) AS std, round(min(risk), 6) AS min, round(max(risk), 6) AS max,
       round(quantile_cont(risk, 0.25), 6) AS q25, round(quantile_cont(risk, 0.5), 6) AS q50, round(quantile_cont(risk, 0.75), 6) AS q75,
       round(quantile_cont(risk, 0.9), 6) AS q90 FROM s""")
def x8_distribution(spark, sf_dir):
    d = risk_distribution(with_standin(cohort_orders(spark, sf_dir)))
    return d.select("n", *[r6(c).alias(c) for c in ("mean", "std", "min", "max", "q25", "q50", "q75", "q90")])


@register("X11_counterfactual_summary", f"""WITH {COHORT_ORDERS},
m AS (SELECT x_price AS o_price, x_bal AS o_bal, least(greatest(x_price - 0.5, 0), 5) AS n_price, least(greatest(x_bal + 1.0, -1), 9) AS n_bal FROM cohort),
d AS (SELECT *, sqrt(((n_price - o_price) / 5.0) ** 2 + ((n_bal - o_bal) / 10.0) ** 2) AS distance FROM m)
SELECT count(*) AS n, round(avg(distance), 6) AS mean_distance, round(min(distance), 6) AS min_distance, round(max(distance), 6) AS max_distance,
       round(avg(n_price - o_price), 6) AS mean_change_x_price, round(avg(n_bal - o_bal), 6) AS mean_change_x_bal FROM d""")
def x11_summary(spark, sf_dir):
    """Summary of a fixed change of every order (price down by .5, balance up by 1, within bounds)."""
    co = cohort_orders(spark, sf_dir).select(F.col("x_price").alias("_orig_x_price"), F.col("x_bal").alias("_orig_x_bal"))
    clip = lambda c, lo, hi: F.least(F.greatest(c, F.lit(lo)), F.lit(hi))
    cf = co.withColumn("x_price", clip(F.col("_orig_x_price") - 0.5, 0.0, 5.0)).withColumn("x_bal", clip(F.col("_orig_x_bal") + 1.0, -1.0, 9.0))
    a, b = (F.col("x_price") - F.col("_orig_x_price")) / 5.0, (F.col("x_bal") - F.col("_orig_x_bal")) / 10.0
    s = counterfactual_summary(cf.withColumn("distance", F.sqrt(a * a + b * b)), ["x_price", "x_bal"])
    return s.select("n", *[r6(c).alias(c) for c in ("mean_distance", "min_distance", "max_distance", "mean_change_x_price", "mean_change_x_bal")])


@register("X9_treatment_interval")
def x9_interval(spark, sf_dir):
    """Effect of the balance with a bootstrap interval over 200 replicates. The model is linear, so every replicate's effect
    is the coefficient times the change, and the interval is one point."""
    m = LinearRisk(COEF)
    return treatment_effect_interval(cohort_orders(spark, sf_dir), "subject_id", m.risk, "x_bal", [0.0, 5.0])


PD_GRID = (0.5, 1.0, 2.0, 3.0, 4.0)


@register("X3_partial_dependence", f"""WITH {COHORT_ORDERS}
SELECT g.v AS grid_value, round(avg(0.4 * g.v - 0.1 * x_bal), 6) AS mean_risk
FROM cohort CROSS JOIN (VALUES {', '.join(f'(CAST({v} AS DOUBLE))' for v in PD_GRID)}) g(v) GROUP BY g.v""")
def x3_pd(spark, sf_dir):
    m = LinearRisk(COEF)
    pdp = partial_dependence(cohort_orders(spark, sf_dir), m.risk, "x_price", PD_GRID)
    return pdp.select("grid_value", r6("mean_risk").alias("mean_risk"))


@register("X9_treatment_effect", f"""WITH {COHORT_ORDERS},
g AS (SELECT v.v AS value, avg(0.4 * x_price - 0.1 * v.v) AS mean_risk, stddev_samp(0.4 * x_price - 0.1 * v.v) AS std_risk
      FROM cohort CROSS JOIN (VALUES (CAST(0.0 AS DOUBLE)), (CAST(5.0 AS DOUBLE))) v(v) GROUP BY v.v)
SELECT value, round(mean_risk, 6) AS mean_risk, round(std_risk, 6) AS std_risk,
       round(mean_risk - (SELECT mean_risk FROM g WHERE value = 0.0), 6) AS effect FROM g""")
def x9_effect(spark, sf_dir):
    m = LinearRisk(COEF)
    t = treatment_effect(cohort_orders(spark, sf_dir), m.risk, "x_bal", [0.0, 5.0])
    return t.select("value", *[r6(c).alias(c) for c in ("mean_risk", "std_risk", "effect")])


@register("I4_survival_wide", f"""WITH {COHORT_ORDERS}
SELECT subject_id, {', '.join(f"round(exp(-exp({RISK} - 1.5) * {h} / 1000.0), 6) AS surv_prob_{int(h)}d" for h in HORIZONS)} FROM cohort""")
def i4_wide(spark, sf_dir):
    """Survival array to ``surv_prob_{h}d`` columns (stand-in survival)."""
    co = with_standin(cohort_orders(spark, sf_dir)).select("subject_id", "surv")
    w = survival_wide(co, HORIZONS)
    return w.select("subject_id", *[r6(f"surv_prob_{int(h)}d").alias(f"surv_prob_{int(h)}d") for h in HORIZONS])


@register("I8_urgency", f"""WITH {STRAT_CTE}
SELECT urgency, count(*) AS n FROM u GROUP BY urgency""")
def i8_urgency(spark, sf_dir):
    return _stratified(spark, sf_dir).groupBy("urgency").agg(F.count(F.lit(1)).alias("n"))


@register("K8_survival_from_baseline", f"""WITH {BASELINE_CTE},
s0 AS (SELECT coalesce((SELECT exp(-hazard0) FROM bl WHERE bl.time <= 365.0 ORDER BY bl.time DESC LIMIT 1), 1.0) AS s0)
SELECT c_mktsegment, round(avg(pow(s0, exp(risk))), 6) AS mean_s365 FROM sc CROSS JOIN s0 GROUP BY c_mktsegment""")
def k8_from_baseline(spark, sf_dir):
    """S0(365) ^ exp(risk) averaged per segment (Breslow baseline of the fixed linear model)."""
    from tte.operators.models.cox import survival_from_baseline

    co = with_standin(cohort_orders(spark, sf_dir)).drop("surv")
    m = LinearRisk(COEF).fit(co)
    s = survival_from_baseline(co, m.baseline_, [365.0], F.exp(F.col("risk")))
    return s.groupBy("c_mktsegment").agg(r6(F.avg(F.element_at("surv", 1))).alias("mean_s365"))


@register("K10_aft_survival", f"""WITH {COHORT_ORDERS}, s AS (SELECT subject_id, 7.0 - ({RISK}) AS mu FROM cohort)
SELECT subject_id,
  {', '.join(f"round(least(greatest(1.0 - (1.0 - exp(-exp((ln({h}) - mu) / 1.2))), 0.0), 1.0), 6) AS w{int(h)}" for h in HORIZONS)},
  {', '.join(f"round(least(greatest(1.0 - 1.0 / (1.0 + exp(-((ln({h}) - mu) / 1.2))), 0.0), 1.0), 6) AS l{int(h)}" for h in HORIZONS)}
FROM s""")
def k10_aft(spark, sf_dir):
    """AFT survival at the horizons for mu = 7 - risk, sigma = 1.2: Weibull (extreme value) and
    log-logistic forms, clipped and made non-increasing."""
    from tte.operators.models.aft import aft_survival

    co = with_standin(cohort_orders(spark, sf_dir)).drop("surv").withColumn("mu", 7.0 - F.col("risk"))
    w = aft_survival(co, HORIZONS, "mu", 1.2, "extreme").withColumnRenamed("surv", "sw")
    lg = aft_survival(w, HORIZONS, "mu", 1.2, "logistic")
    return lg.select("subject_id", *[r6(F.element_at("sw", i + 1)).alias(f"w{int(h)}") for i, h in enumerate(HORIZONS)],
                     *[r6(F.element_at("surv", i + 1)).alias(f"l{int(h)}") for i, h in enumerate(HORIZONS)])
