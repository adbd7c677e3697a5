"""Registered queries: monitoring history and everything read from it.

The history is built from the episode cohort: one batch per signup day, two scoring models
(``value``: risk = x1; ``inverse``: risk = -x1), survival at 24 h = exp(-0.5 exp((risk - 25) / 25)).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tte.operators.monitor import (
    ab_assign, ab_results, alert_state, alerts, batch_metrics, batch_report, best_average, compare_runs, evaluate_rules, experiment_means,
    experiment_results, metric_trend, param_importance, performance_summary, rank_models, recent, retain_last, select_ensemble,
    select_model, update_triggers,
)
from tte.operators.quality import quality_metrics
from tte.plans.registry import r6, register
from tte.plans.sqltext import COHORT_EPISODES, COHORT_ORDERS, QUALITY_FRAME, km_ctes
from tte.sources.testdata import cohort_episodes, cohort_orders, quality_frame, with_standin

HORIZON = 24.0


def _surv(risk):
    return F.exp(-0.5 * F.exp((risk - 25.0) / 25.0))


def history(spark, sf_dir):
    ep = cohort_episodes(spark, sf_dir).withColumn("batch", F.to_date("start_ts"))
    models = {"value": (F.col("x1"), _surv(F.col("x1"))), "inverse": (-F.col("x1"), _surv(-F.col("x1")))}
    return batch_metrics(ep, models, "batch", HORIZON, "x1")


HIST_CTE = f"""{COHORT_EPISODES},
s AS (SELECT *, CAST(start_ts AS DATE) AS batch FROM cohort),
m AS (SELECT s.*, mm.model, CASE WHEN mm.model = 'value' THEN x1 ELSE -x1 END AS risk
      FROM s CROSS JOIN (VALUES ('value'), ('inverse')) mm(model)),
conc AS (SELECT a.model, a.batch,
           sum(CASE WHEN b.risk < a.risk THEN 1.0 WHEN b.risk = a.risk THEN 0.5 ELSE 0.0 END) / count(*) AS concordance
         FROM m a JOIN m b ON a.model = b.model AND a.batch = b.batch AND a.event = 1
           AND (b.time > a.time OR (b.time = a.time AND b.event = 0)) GROUP BY a.model, a.batch),
{km_ctes(src='s', by='batch')},
gh AS (SELECT bb.batch, coalesce((SELECT cens_ef FROM km k WHERE k.batch = bb.batch AND k.time <= {HORIZON} ORDER BY k.time DESC LIMIT 1), 1.0) AS g_h
       FROM (SELECT DISTINCT batch FROM s) bb),
br AS (SELECT mm.model, mm.batch, count(*) AS n_samples,
         avg(CASE WHEN mm.time <= {HORIZON} AND mm.event = 1 THEN CASE WHEN k.cens_ef > 0 THEN mm.sv * mm.sv / k.cens_ef ELSE 0 END
                  WHEN mm.time > {HORIZON} THEN CASE WHEN gh.g_h > 0 THEN (1 - mm.sv) * (1 - mm.sv) / gh.g_h ELSE 0 END ELSE 0 END) AS brier
       FROM (SELECT *, exp(-0.5 * exp((risk - 25.0) / 25.0)) AS sv FROM m) mm
       JOIN km k ON k.batch = mm.batch AND k.time = mm.time JOIN gh ON gh.batch = mm.batch GROUP BY mm.model, mm.batch),
fs AS (SELECT batch, avg(x1) AS mu, stddev_samp(x1) AS sd FROM s GROUP BY batch),
f0 AS (SELECT mu AS mu0, sd AS sd0 FROM fs ORDER BY batch LIMIT 1),
dr AS (SELECT batch, CASE WHEN sd0 > 0 THEN greatest(abs(mu - mu0) / sd0, abs(sd - sd0) / sd0) ELSE 0.0 END AS drift FROM fs, f0),
hist AS (SELECT CAST(br.batch AS TIMESTAMP) AS ts, br.model, br.n_samples, conc.concordance, br.brier, dr.drift
         FROM br LEFT JOIN conc ON conc.model = br.model AND conc.batch = br.batch JOIN dr ON dr.batch = br.batch)"""


@register("N1_batch_metrics", f"""WITH {HIST_CTE}
SELECT ts, model, n_samples, round(concordance, 6) AS concordance, round(brier, 6) AS brier, round(drift, 6) AS drift FROM hist""")
def n1_batch_metrics(spark, sf_dir):
    h = history(spark, sf_dir)
    return h.select("ts", "model", "n_samples", r6("concordance").alias("concordance"), r6("brier").alias("brier"),
                    r6("drift").alias("drift"))


REPORT_HORIZONS = (12.0, 24.0, 48.0)
REPORT_CTE = f"""{HIST_CTE},
hz AS (SELECT CAST(h AS DOUBLE) AS h FROM (VALUES (12), (24), (48)) t(h)),
ghs AS (SELECT bb.batch, h, coalesce((SELECT cens_ef FROM km k WHERE k.batch = bb.batch AND k.time <= h ORDER BY k.time DESC LIMIT 1), 1.0) AS g_h
        FROM (SELECT DISTINCT batch FROM s) bb, hz),
bh AS (SELECT mm.model, mm.batch, g.h,
         avg(CASE WHEN mm.time <= g.h AND mm.event = 1 THEN CASE WHEN k.cens_ef > 0 THEN pow(exp(-g.h / 48.0 * exp((risk - 25.0) / 25.0)), 2) / k.cens_ef ELSE 0 END
                  WHEN mm.time > g.h THEN CASE WHEN g.g_h > 0 THEN pow(1 - exp(-g.h / 48.0 * exp((risk - 25.0) / 25.0)), 2) / g.g_h ELSE 0 END ELSE 0 END) AS brier
       FROM m mm JOIN ghs g ON g.batch = mm.batch JOIN km k ON k.batch = mm.batch AND k.time = mm.time GROUP BY mm.model, mm.batch, g.h),
seg AS (SELECT model, batch, h, brier, lag(h) OVER o AS h0, lag(brier) OVER o AS b0 FROM bh WINDOW o AS (PARTITION BY model, batch ORDER BY h)),
ibs AS (SELECT model, batch, sum((h - h0) * (brier + b0) / 2) / 36.0 AS ibs FROM seg GROUP BY model, batch),
nx AS (SELECT batch, x1 AS x, 'x1' AS "column" FROM s UNION ALL SELECT batch, CAST(hour(start_ts) AS DOUBLE), 'hour' FROM s),
ns AS (SELECT batch, "column", avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min, max(x) AS max, 1 - count(x) / count(*) AS missing_rate FROM nx GROUP BY 1, 2),
cv AS (SELECT batch, CAST(CAST(floor(x1 / 20) AS BIGINT) AS VARCHAR) AS v, count(*) AS k FROM s WHERE x1 IS NOT NULL GROUP BY 1, 2),
cs AS (SELECT batch, count(*)::DOUBLE AS u, max(k) / sum(k) AS top FROM cv GROUP BY batch),
feat AS (SELECT n.batch, n."column", 'numeric' AS kind, n.mean, n.std, n.min, n.max, n.missing_rate, NULL::DOUBLE AS unique_count, NULL::DOUBLE AS top_category_rate,
           CASE WHEN b.std > 0 THEN greatest(abs(n.mean - b.mean) / b.std, abs(n.std - b.std) / b.std) ELSE 0.0 END AS drift
         FROM ns n JOIN ns b ON b."column" = n."column" AND b.batch = (SELECT min(batch) FROM s)
         UNION ALL
         SELECT c.batch, 'band', 'categorical', NULL, NULL, NULL, NULL, (SELECT 1 - count(x1) / count(*) FROM s WHERE s.batch = c.batch), c.u, c.top,
           greatest(abs(c.top - b.top), abs(c.u - b.u) / greatest(b.u, 1)) FROM cs c JOIN cs b ON b.batch = (SELECT min(batch) FROM s)),
worst AS (SELECT batch, max(drift) AS drift, first("column" ORDER BY drift DESC, "column") AS drift_column FROM feat GROUP BY batch)"""


def _report(spark, sf_dir):
    ep = cohort_episodes(spark, sf_dir).withColumns({
        "batch": F.to_date("start_ts"), "hour": F.hour("start_ts").cast("double"), "band": F.floor(F.col("x1") / 20).cast("string")})
    surv = lambda r: [F.exp(-h / 48.0 * F.exp((r - 25.0) / 25.0)) for h in REPORT_HORIZONS]
    x = F.col("x1")
    return batch_report(ep, {"value": (x, surv(x)), "inverse": (-x, surv(-x))}, "batch", REPORT_HORIZONS, ["x1", "hour"], ["band"])


@register("N1_batch_report", f"""WITH {REPORT_CTE}
SELECT hist.ts, hist.model, hist.n_samples, round(hist.concordance, 6) AS concordance, round(ibs.ibs, 6) AS brier, round(worst.drift, 6) AS drift, drift_column
FROM hist JOIN ibs ON ibs.model = hist.model AND CAST(ibs.batch AS TIMESTAMP) = hist.ts JOIN worst ON worst.batch = ibs.batch""")
def n1_batch_report(spark, sf_dir):
    """C, integrated Brier score over three horizons and the largest drift of three features, per signup day and model."""
    m = _report(spark, sf_dir).metrics
    return m.select("ts", "model", "n_samples", r6("concordance").alias("concordance"), r6("brier").alias("brier"), r6("drift").alias("drift"), "drift_column")


@register("N1_batch_features", f"""WITH {REPORT_CTE}
SELECT CAST(batch AS TIMESTAMP) AS ts, "column", kind, round(mean, 6) AS mean, round(std, 6) AS std, min, max, round(missing_rate, 6) AS missing_rate,
       unique_count, round(top_category_rate, 6) AS top_category_rate, round(drift, 6) AS drift FROM feat""")
def n1_batch_features(spark, sf_dir):
    f = _report(spark, sf_dir).features
    return f.select("ts", "column", "kind", r6("mean").alias("mean"), r6("std").alias("std"), "min", "max", r6("missing_rate").alias("missing_rate"),
                    "unique_count", r6("top_category_rate").alias("top_category_rate"), r6("drift").alias("drift"))


ALERT_SQL = f"""{HIST_CTE},
w AS (SELECT *, avg(concordance) OVER win AS c_mean, count(*) OVER win AS pts, avg(brier) OVER win AS b_mean FROM hist
      WINDOW win AS (PARTITION BY model ORDER BY epoch(ts) RANGE BETWEEN {7 * 86400 - 1} PRECEDING AND CURRENT ROW)),
al AS (
  SELECT ts, model, 'performance_degradation' AS type, 'medium' AS severity, 'concordance' AS metric, concordance AS value, 0.05 AS threshold
  FROM w WHERE pts >= 3 AND c_mean - concordance > 0.05
  UNION ALL
  SELECT ts, model, 'performance_degradation', 'medium', 'brier', brier, 0.02 FROM w WHERE brier > 0 AND pts >= 3 AND brier - b_mean > 0.02
  UNION ALL
  SELECT ts, model, 'data_drift', CASE WHEN drift < 0.2 THEN 'low' ELSE 'medium' END, 'drift', drift, 0.1 FROM w WHERE drift > 0.1)"""


@register("N2_alerts", f"""WITH {ALERT_SQL}
SELECT ts, model, type, severity, metric, round(value, 6) AS value, CAST(threshold AS DOUBLE) AS threshold FROM al""")
def n2_alerts(spark, sf_dir):
    a = alerts(history(spark, sf_dir))
    return a.select("ts", "model", "type", "severity", "metric", r6("value").alias("value"), "threshold")


@register("N3_performance_summary", f"""WITH {HIST_CTE},
h AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY ts) AS i FROM hist
      WHERE epoch(ts) > (SELECT max(epoch(ts)) FROM hist h2 WHERE h2.model = hist.model) - 30 * 86400)
SELECT model, count(*) AS n_observations, CAST(sum(n_samples) AS BIGINT) AS total_samples, round(avg(concordance), 6) AS c_mean,
  round(stddev_pop(concordance), 6) AS c_std, round(min(concordance), 6) AS c_min, round(max(concordance), 6) AS c_max,
  CASE WHEN count(concordance) < 3 THEN 'insufficient_data' WHEN coalesce(abs(corr(i, concordance)), 0) < 0.3 THEN 'stable'
       WHEN regr_slope(concordance, i) > 0 THEN 'improving' ELSE 'degrading' END AS c_trend,
  round(avg(CASE WHEN brier > 0 THEN brier END), 6) AS brier_mean, round(stddev_pop(CASE WHEN brier > 0 THEN brier END), 6) AS brier_std,
  CASE WHEN count(CASE WHEN brier > 0 THEN brier END) < 3 THEN 'insufficient_data'
       WHEN coalesce(abs(corr(CASE WHEN brier > 0 THEN i END, CASE WHEN brier > 0 THEN brier END)), 0) < 0.3 THEN 'stable'
       WHEN regr_slope(CASE WHEN brier > 0 THEN brier END, CASE WHEN brier > 0 THEN i END) < 0 THEN 'improving' ELSE 'degrading' END AS brier_trend
FROM h GROUP BY model""")
def n3_summary(spark, sf_dir):
    """N3 with N4 trends (C: higher is better; Brier: lower is better)."""
    s = performance_summary(history(spark, sf_dir), 30)
    return s.select("model", "n_observations", "total_samples",
                    *[r6(c).alias(c) for c in ("c_mean", "c_std", "c_min", "c_max")], "c_trend",
                    r6("brier_mean").alias("brier_mean"), r6("brier_std").alias("brier_std"), "brier_trend")


@register("N5_recent_alerts", f"""WITH {ALERT_SQL}
SELECT ts, model, type, severity, metric FROM al
WHERE epoch(ts) > (SELECT max(epoch(ts)) FROM al) - 7 * 86400
ORDER BY ts DESC, model, metric LIMIT 10""")
def n5_recent(spark, sf_dir):
    return recent(alerts(history(spark, sf_dir)), 7, None, 10).select("ts", "model", "type", "severity", "metric")


@register("N6_retain_last", f"""WITH {HIST_CTE}
SELECT ts, model, n_samples FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY ts DESC) AS rn FROM hist) WHERE rn <= 10""")
def n6_retain(spark, sf_dir):
    return retain_last(history(spark, sf_dir), 10).select("ts", "model", "n_samples")


# fixed rule table of the quality monitor queries: (rule_id, metric, condition, threshold, severity, enabled)
QUALITY_RULES = [
    ("missing_high", "missing_values_percentage", ">", 5.0, "high", True),
    ("duplicates_any", "duplicate_rows_percentage", ">", 0.0, "medium", True),
    ("discount_complete", "column_completeness_l_discount", "<", 95.0, "high", True),
    ("flag_complete", "column_completeness_l_returnflag", "<", 95.0, "medium", True),
    ("status_complete", "column_completeness_l_linestatus", "==", 100.0, "low", True),
    ("quantity_outliers", "outlier_count_l_quantity", ">", 0.0, "low", True),
    ("disabled_rule", "missing_values_percentage", ">", 0.0, "low", False),
]


def _rules_df(spark):
    return spark.createDataFrame(QUALITY_RULES, "rule_id string, metric string, condition string, threshold double, "
                                                "severity string, enabled boolean")


@register("N7_evaluate_rules", f"""WITH {QUALITY_FRAME},
mt AS (
  SELECT 'missing_values_percentage' AS metric,
         ({' + '.join(f'sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)' for c in ('l_orderkey', 'l_linenumber', 'l_quantity', 'l_returnflag', 'l_linestatus', 'l_discount'))}) * 100.0 / (count(*) * 6) AS value FROM qf
  UNION ALL SELECT 'duplicate_rows_percentage', (SELECT coalesce(sum(k - 1), 0) FROM (SELECT count(*) AS k FROM qf GROUP BY l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus, l_discount)) * 100.0 / count(*) FROM qf
  UNION ALL SELECT 'column_completeness_l_discount', (1 - sum(CASE WHEN l_discount IS NULL THEN 1 ELSE 0 END) / count(*)) * 100.0 FROM qf
  UNION ALL SELECT 'column_completeness_l_returnflag', (1 - sum(CASE WHEN l_returnflag IS NULL THEN 1 ELSE 0 END) / count(*)) * 100.0 FROM qf
  UNION ALL SELECT 'column_completeness_l_linestatus', (1 - sum(CASE WHEN l_linestatus IS NULL THEN 1 ELSE 0 END) / count(*)) * 100.0 FROM qf),
r AS (SELECT * FROM (VALUES {', '.join(f"('{a}', '{b}', '{c}', CAST({d} AS DOUBLE), '{e}', {str(f).lower()})" for a, b, c, d, e, f in QUALITY_RULES)})
      t(rule_id, metric, condition, threshold, severity, enabled)),
j AS (SELECT r.*, CASE WHEN mt.value IS NULL AND r.metric LIKE 'outlier_count_%' THEN 0.0 ELSE mt.value END AS v
      FROM r LEFT JOIN mt ON mt.metric = r.metric WHERE r.enabled)
SELECT rule_id, metric, round(v, 6) AS value, threshold, severity, 'active' AS status FROM j
WHERE v IS NOT NULL AND CASE condition WHEN '>' THEN v > threshold WHEN '<' THEN v < threshold WHEN '>=' THEN v >= threshold
  WHEN '<=' THEN v <= threshold WHEN '==' THEN abs(v - threshold) < 1e-6 WHEN '!=' THEN abs(v - threshold) >= 1e-6 ELSE false END""")
def n7_rules(spark, sf_dir):
    """Quality metrics of the quality frame (long form) against the rule table."""
    ds, cols = quality_metrics(quality_frame(spark, sf_dir))
    long = ds.select(F.explode(F.array(
        F.struct(F.lit("missing_values_percentage").alias("metric"), F.col("missing_pct").alias("value")),
        F.struct(F.lit("duplicate_rows_percentage").alias("metric"), F.col("duplicate_pct").alias("value")),
    )).alias("_m")).select("_m.*").unionByName(
        cols.select(F.concat(F.lit("column_completeness_"), F.col("column")).alias("metric"), F.col("completeness").alias("value")))
    out = evaluate_rules(long, _rules_df(spark))
    return out.select("rule_id", "metric", r6("value").alias("value"), "threshold", "severity", "status")


@register("N8_alert_state", f"""WITH {ALERT_SQL},
ids AS (SELECT model || '|' || metric || '|' || CAST(ts AS VARCHAR) AS alert_id, ts, value FROM al),
log AS (SELECT alert_id, ts, 'create' AS action, 0 AS k FROM ids
        UNION ALL SELECT alert_id, ts + INTERVAL 1 HOUR, 'acknowledge', 1 FROM ids WHERE value > 0.3
        UNION ALL SELECT alert_id, ts + INTERVAL 2 HOUR, 'resolve', 2 FROM ids WHERE value > 0.6
        UNION ALL SELECT alert_id, ts + INTERVAL 3 HOUR, 'acknowledge', 3 FROM ids WHERE value > 0.6)
SELECT alert_id, CASE WHEN max(CASE WHEN action = 'resolve' THEN 1 ELSE 0 END) = 1 THEN 'resolved'
                      WHEN max(CASE WHEN action = 'acknowledge' THEN 1 ELSE 0 END) = 1 THEN 'acknowledged' ELSE 'active' END AS status,
       CAST(count(*) AS INT) AS n_actions
FROM log GROUP BY alert_id""")
def n8_state(spark, sf_dir):
    """An action log derived from the alerts (acknowledge when value > .3; resolve, then a late
    acknowledge that must be ignored, when value > .6) folded into states."""
    a = alerts(history(spark, sf_dir)).withColumn(
        "alert_id", F.concat_ws("|", "model", "metric", F.col("ts").cast("string")))
    hour = F.expr("INTERVAL 1 HOUR")
    act = lambda ts, action: F.struct(ts.alias("ts"), F.lit(action).alias("action"))
    # an alert's actions from its one row: a union would make the history once per action
    acts = F.filter(F.array(act(F.col("ts"), "create"), F.when(F.col("value") > 0.3, act(F.col("ts") + hour, "acknowledge")),
                            F.when(F.col("value") > 0.6, act(F.col("ts") + hour * 2, "resolve")),
                            F.when(F.col("value") > 0.6, act(F.col("ts") + hour * 3, "acknowledge"))), lambda x: x.isNotNull())
    return alert_state(a.select("alert_id", F.explode(acts).alias("_act")).select("alert_id", "_act.*"))


@register("N9_metric_trend", f"""WITH {HIST_CTE}
SELECT ts, model, round(concordance, 6) AS value FROM hist WHERE epoch(ts) > (SELECT max(epoch(ts)) FROM hist) - 168 * 3600""")
def n9_trend(spark, sf_dir):
    t = metric_trend(history(spark, sf_dir), "concordance", 168)
    return t.select("ts", "model", r6("value").alias("value"))


@register("N11_experiment_results", f"""WITH {HIST_CTE},
g AS (SELECT model, avg(concordance) AS mean, stddev_pop(concordance) AS std, count(concordance) AS n,
             min(concordance) AS min, max(concordance) AS max FROM hist GROUP BY model)
SELECT model, round(mean, 6) AS mean, round(std, 6) AS std, n, round(min, 6) AS min, round(max, 6) AS max,
       model = (SELECT model FROM g ORDER BY mean DESC, model DESC LIMIT 1) AS is_best FROM g""")
def n11_experiments(spark, sf_dir):
    e = experiment_results(history(spark, sf_dir))
    return e.select("model", *[r6(c).alias(c) for c in ("mean", "std")], "n", r6("min").alias("min"), r6("max").alias("max"), "is_best")


@register("N12_compare_runs", f"""WITH {HIST_CTE},
runs AS (SELECT model || '@' || CAST(ts AS VARCHAR) AS run_id, concordance, brier FROM hist),
l AS (SELECT run_id, 'concordance' AS metric, concordance AS value FROM runs WHERE concordance IS NOT NULL
      UNION ALL SELECT run_id, 'brier', brier FROM runs WHERE brier IS NOT NULL)
SELECT metric, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max,
  count(*) AS count, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS median,
  round(quantile_cont(value, 0.75), 6) AS q75,
  CASE WHEN metric = 'concordance' THEN arg_max(run_id, (value, run_id)) ELSE arg_min(run_id, (value, run_id)) END AS best_run
FROM l GROUP BY metric""")
def n12_compare(spark, sf_dir):
    h = history(spark, sf_dir).withColumn("run_id", F.concat(F.col("model"), F.lit("@"), F.col("ts").cast("string")))
    c = compare_runs(h, ["concordance", "brier"])
    return c.select("metric", *[r6(x).alias(x) for x in ("mean", "std", "min", "max")], "count",
                    *[r6(x).alias(x) for x in ("q25", "median", "q75")], "best_run")


@register("N13_param_importance", f"""WITH {HIST_CTE},
c AS (SELECT 'n_samples' AS param, abs(corr(CAST(n_samples AS DOUBLE), concordance)) AS importance FROM hist
      UNION ALL SELECT 'drift', abs(corr(drift, concordance)) FROM hist
      UNION ALL SELECT 'brier', abs(corr(brier, concordance)) FROM hist)
SELECT param, round(importance, 6) AS importance FROM c WHERE importance IS NOT NULL ORDER BY importance DESC, param LIMIT 5""")
def n13_params(spark, sf_dir):
    p = param_importance(history(spark, sf_dir), ["n_samples", "drift", "brier"], "concordance")
    return p.select("param", r6("importance").alias("importance"))


@register("N14_update_triggers", f"""WITH {HIST_CTE}
SELECT ts, model,
  first_value(concordance) OVER win - concordance > 0.02 AS performance_trigger, max(drift) OVER win > 0.1 AS drift_trigger
FROM hist WINDOW win AS (PARTITION BY model ORDER BY epoch(ts) RANGE BETWEEN {7 * 86400 - 1} PRECEDING AND CURRENT ROW)""")
def n14_triggers(spark, sf_dir):
    return update_triggers(history(spark, sf_dir))


AB_CTE = f"""{COHORT_ORDERS},
h AS (SELECT *, CAST('0x' || substr(md5(CAST(subject_id AS VARCHAR) || '|price-model-v2'), 1, 8) AS BIGINT) % 10000 AS u FROM cohort),
ab AS (SELECT *, CASE WHEN u < 5000 THEN 'control' WHEN u < 8000 THEN 'a' ELSE 'b' END AS variant FROM h)"""


@register("N16_ab_assign", f"""WITH {AB_CTE}
SELECT subject_id, variant FROM ab""")
def n16_ab_assign(spark, sf_dir):
    """Variant of every order under a 50/30/20 split."""
    a = ab_assign(cohort_orders(spark, sf_dir), "subject_id", "price-model-v2", {"control": 0.5, "a": 0.3, "b": 0.2})
    return a.select("subject_id", "variant")


@register("N17_ab_results", f"""WITH {AB_CTE},
g AS (SELECT variant, count(*) AS n, avg(event) AS mean, stddev_samp(event) AS std FROM ab GROUP BY variant),
z AS (SELECT g.*, g.mean - c.mean AS lift, c.n AS n0, CASE WHEN sqrt(g.std ** 2 / g.n + c.std ** 2 / c.n) > 0
        THEN (g.mean - c.mean) / sqrt(g.std ** 2 / g.n + c.std ** 2 / c.n) END AS z
      FROM g, (SELECT * FROM g WHERE variant = 'control') c)
SELECT variant, n, round(mean, 6) AS mean, round(std, 6) AS std, round(lift, 6) AS lift, round(z, 6) AS z,
       abs(z) > 1.959963984540054 AND n >= 1000 AND n0 >= 1000 AS significant FROM z""")
def n17_ab_results(spark, sf_dir):
    """Event rate by variant vs control; p < .05 is |z| > 1.96 on the SQL side."""
    a = ab_assign(cohort_orders(spark, sf_dir), "subject_id", "price-model-v2", {"control": 0.5, "a": 0.3, "b": 0.2})
    r = ab_results(a.withColumn("y", F.col("event").cast("double")), "y", "control")
    return r.select("variant", "n", *[r6(c).alias(c) for c in ("mean", "std", "lift", "z")], "significant")


@register("N18_rank_models", f"""WITH {HIST_CTE},
g AS (SELECT model, avg(concordance) AS score, stddev_pop(concordance) AS std, count(concordance) AS n FROM hist GROUP BY model)
SELECT model, round(score, 6) AS score, round(std, 6) AS std, CAST(rank() OVER (ORDER BY score DESC, model) AS INT) AS rank,
       round(CASE WHEN n > 1 THEN 1.0 / (1.0 + std) ELSE 1.0 END, 6) AS stability FROM g""")
def n18_rank(spark, sf_dir):
    r = rank_models(history(spark, sf_dir), "concordance")
    return r.select("model", r6("score").alias("score"), r6("std").alias("std"), "rank", r6("stability").alias("stability"))


@register("N19_select_model", f"""WITH {HIST_CTE},
g AS (SELECT model, avg(concordance) AS score, stddev_pop(concordance) AS std, count(concordance) AS n FROM hist GROUP BY model),
r AS (SELECT model, score, rank() OVER (ORDER BY score DESC, model) AS rank, CASE WHEN n > 1 THEN 1.0 / (1.0 + std) ELSE 1.0 END AS stability,
             count(*) OVER () AS k FROM g)
SELECT model, round(score, 6) AS score, CAST(rank AS INT) AS rank, round(stability, 6) AS stability FROM r
ORDER BY 0.7 * rank / k + 0.3 * (1 - stability), model LIMIT 1""")
def n19_select(spark, sf_dir):
    s = select_model(rank_models(history(spark, sf_dir), "concordance"), "balanced")
    return s.select("model", r6("score").alias("score"), "rank", r6("stability").alias("stability"))


def _daily_reports(spark, sf_dir):
    """Daily quality reports of the events stream: duplicate share of (user, type) pairs, missing
    share, a score (Q10 form without outliers) and the number of issues."""
    from tte.sources.tables import table

    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    d = ev.groupBy("day", "user_id", "event_type").agg(F.count(F.lit(1)).alias("k")).groupBy("day").agg(
        (F.sum(F.col("k") - 1) * 100.0 / F.sum("k")).alias("dup_pct"))
    m = ev.groupBy("day").agg((F.sum(F.col("props").isNull().cast("long")) * 100.0 / F.count(F.lit(1))).alias("miss_pct"))
    r = d.join(m, "day")
    score = (100 - F.col("miss_pct")) * 0.4 + (100 - F.least(F.col("dup_pct") * 2, F.lit(40.0))) * 0.2 + 40.0
    issues = (F.col("dup_pct") > 1).cast("int") + (F.col("miss_pct") > 5).cast("int")
    return r.select(F.col("day").cast("timestamp").alias("ts"), score.alias("score"), issues.alias("n_issues"))


@register("N10_quality_report_trend", """
WITH ev AS (SELECT CAST(ts AS DATE) AS day, user_id, event_type, props FROM events),
d AS (SELECT day, sum(k - 1) * 100.0 / sum(k) AS dup_pct FROM (SELECT day, user_id, event_type, count(*) AS k FROM ev GROUP BY ALL) GROUP BY day),
m AS (SELECT day, sum(CASE WHEN props IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*) AS miss_pct FROM ev GROUP BY day),
r AS (SELECT CAST(d.day AS TIMESTAMP) AS ts, (100 - miss_pct) * 0.4 + (100 - least(dup_pct * 2, 40.0)) * 0.2 + 40.0 AS score,
             CAST(dup_pct > 1 AS INT) + CAST(miss_pct > 5 AS INT) AS n_issues FROM d JOIN m USING (day)),
w AS (SELECT *, row_number() OVER (ORDER BY ts) AS i FROM r WHERE epoch(ts) > (SELECT max(epoch(ts)) FROM r) - 7 * 86400)
SELECT count(*) AS n_reports, round(arg_min(score, ts), 6) AS first_score, round(arg_max(score, ts), 6) AS last_score,
       arg_min(n_issues, ts) AS first_issues, arg_max(n_issues, ts) AS last_issues, round(regr_slope(score, i), 6) AS slope,
       CASE WHEN count(*) < 2 THEN 'insufficient_data' WHEN regr_slope(score, i) < -1 THEN 'quality declining: investigate sources'
            WHEN regr_slope(score, i) > 0.5 THEN 'quality improving' ELSE 'stable' END AS advice FROM w""")
def n10_report_trend(spark, sf_dir):
    from tte.operators.monitor import quality_report_trend

    t = quality_report_trend(_daily_reports(spark, sf_dir))
    return t.select("n_reports", r6("first_score").alias("first_score"), r6("last_score").alias("last_score"),
                    "first_issues", "last_issues", r6("slope").alias("slope"), "advice")


@register("N15_retrain_triggers", f"""WITH {HIST_CTE}
SELECT ts, model, epoch(ts) - first_value(epoch(ts)) OVER w > 3600 AS scheduled,
       coalesce(first_value(concordance) OVER w - concordance > 0.02, false) AS performance,
       drift > 0.1 AS drift_trigger, sum(n_samples) OVER w >= 100 AS data_volume
FROM hist WINDOW w AS (PARTITION BY model ORDER BY epoch(ts) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def n15_retrain(spark, sf_dir):
    from tte.operators.monitor import retrain_triggers

    return retrain_triggers(history(spark, sf_dir))


@register("N4_trend", f"""WITH {HIST_CTE}, h AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY ts) AS i FROM hist)
SELECT model, CASE WHEN count(concordance) < 3 THEN 'insufficient_data' WHEN coalesce(abs(corr(i, concordance)), 0) < 0.3 THEN 'stable'
                   WHEN regr_slope(concordance, i) > 0 THEN 'improving' ELSE 'degrading' END AS c_trend,
       CASE WHEN count(drift) < 3 THEN 'insufficient_data' WHEN coalesce(abs(corr(i, drift)), 0) < 0.3 THEN 'stable'
            WHEN regr_slope(drift, i) < 0 THEN 'improving' ELSE 'degrading' END AS drift_trend
FROM h GROUP BY model""")
def n4_trend(spark, sf_dir):
    """Trend labels of C (higher is better) and drift (lower is better) over all batches."""
    from pyspark.sql import Window

    from tte.operators.monitor import trend_label

    h = history(spark, sf_dir).withColumn("_i", F.row_number().over(Window.partitionBy("model").orderBy("ts")).cast("double"))
    return h.groupBy("model").agg(trend_label(F.col("_i"), F.col("concordance"), F.count("concordance")).alias("c_trend"),
                                  trend_label(F.col("_i"), F.col("drift"), F.count("drift"), higher_is_better=False).alias("drift_trend"))


@register("N12_experiment_means", f"""WITH {HIST_CTE}
SELECT model AS experiment, count(*) AS n_runs, round(avg(concordance), 6) AS mean_concordance, round(avg(brier), 6) AS mean_brier
FROM hist GROUP BY model""")
def n12_means(spark, sf_dir):
    m = experiment_means(history(spark, sf_dir).withColumnRenamed("model", "experiment"), ["concordance", "brier"])
    return m.select("experiment", "n_runs", r6("mean_concordance").alias("mean_concordance"), r6("mean_brier").alias("mean_brier"))


RANKED_SQL = f"""{HIST_CTE},
g AS (SELECT model, avg(concordance) AS c, avg(brier) AS b, avg(drift) AS d FROM hist GROUP BY model),
rk AS (SELECT model, c, rank() OVER (ORDER BY round(c, 9) DESC, model) AS rc, rank() OVER (ORDER BY round(b, 9), model) AS rb,
       rank() OVER (ORDER BY round(d, 9), model) AS rd FROM g)"""


@register("N19_best_average", f"""WITH {RANKED_SQL}
SELECT model, round((rc + rb + rd) / 3.0, 6) AS mean_rank, CAST(3 AS BIGINT) AS n_metrics FROM rk ORDER BY (rc + rb + rd), model LIMIT 1""")
def n19_best_average(spark, sf_dir):
    """Best mean rank over concordance, Brier and drift (the models share the batches' drift, so that metric is a tie)."""
    h = history(spark, sf_dir)
    ranked = None
    for metric, up in (("concordance", True), ("brier", False), ("drift", False)):
        one = rank_models(h, metric, up).withColumn("metric", F.lit(metric))
        ranked = one if ranked is None else ranked.unionByName(one)
    return best_average(ranked).select("model", r6("mean_rank").alias("mean_rank"), "n_metrics")


@register("N19_ensemble", f"""WITH {RANKED_SQL}
SELECT model, round(c, 6) AS score, CAST(rc AS INT) AS rank, round(1.0 / (SELECT count(*) FROM rk WHERE rc <= 2), 6) AS weight FROM rk WHERE rc <= 2""")
def n19_ensemble(spark, sf_dir):
    e = select_ensemble(rank_models(history(spark, sf_dir), "concordance"), k=2)
    return e.select("model", r6("score").alias("score"), "rank", r6("weight").alias("weight"))
