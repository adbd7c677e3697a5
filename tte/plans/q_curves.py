"""Registered queries: cohorts (S9) and curves (K1-K6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tte.operators.curves import curve_at, ipcw_weights, km_curves, km_quantile, risk_table
from tte.plans.registry import r6, register
from tte.plans.sqltext import COHORT_EPISODES, COHORT_LINES, COHORT_ORDERS, km_ctes
from tte.sources.testdata import HORIZONS, cohort_episodes, cohort_lines, cohort_orders

FLAGSHIP_HORIZONS = (90.0, 365.0, 1825.0)


@register("S9_cohort_orders", f"""
WITH {COHORT_ORDERS}
SELECT subject_id, time, event, x_price, x_bal,
       c_mktsegment, o_orderpriority FROM cohort""")
def s9_cohort_orders(spark, sf_dir):
    c = cohort_orders(spark, sf_dir)
    return c.select("subject_id", "time", "event", "x_price", "x_bal",
                    "c_mktsegment", "o_orderpriority")


@register("S9_episodes", f"""
WITH {COHORT_EPISODES}
SELECT subject_id, user_id, round(time, 6) AS time, event, x1, start_ts FROM cohort""")
def s9_episodes(spark, sf_dir):
    c = cohort_episodes(spark, sf_dir)
    return c.select("subject_id", "user_id", r6("time").alias("time"), "event", "x1",
                    F.col("start_ts").cast("timestamp_ntz").alias("start_ts"))


@register("K1_risk_table", f"""
WITH {COHORT_ORDERS}, {km_ctes()}
SELECT time, n_at_risk, d, c FROM km""")
def k1_risk_table(spark, sf_dir):
    rt = risk_table(cohort_orders(spark, sf_dir))
    return rt.select("time", F.col("n_at_risk").cast("bigint").alias("n_at_risk"),
                     F.col("d").cast("bigint").alias("d"), F.col("c").cast("bigint").alias("c"))


@register("K2_km_survival", f"""
WITH {COHORT_ORDERS}, {km_ctes()}
SELECT time, round(surv, 6) AS surv FROM km""")
def k2_km_survival(spark, sf_dir):
    cur = km_curves(cohort_orders(spark, sf_dir))
    return cur.select("time", r6("surv").alias("surv"))


@register("K2_km_by_segment", f"""
WITH {COHORT_ORDERS}, {km_ctes(by='c_mktsegment')}, hz AS (SELECT CAST(horizon AS DOUBLE) AS horizon FROM (VALUES (90.0), (365.0), (1825.0)) t(horizon))
SELECT s.c_mktsegment, hz.horizon,
       round(coalesce((SELECT k.surv FROM km k WHERE k.c_mktsegment = s.c_mktsegment AND k.time <= hz.horizon
                       ORDER BY k.time DESC LIMIT 1), 1.0), 6) AS surv
FROM (SELECT DISTINCT c_mktsegment FROM km) s CROSS JOIN hz""")
def k2_km_by_segment(spark, sf_dir):
    """Flagship: share of orders with no returned shipment by day 90, 365, 1825, per segment."""
    cur = km_curves(cohort_orders(spark, sf_dir), by=["c_mktsegment"])
    at = curve_at(cur, FLAGSHIP_HORIZONS, "surv", "step", by=["c_mktsegment"])
    return at.select("c_mktsegment", "horizon", r6("surv").alias("surv"))


@register("K3_km_censoring", f"""
WITH {COHORT_ORDERS}, {km_ctes()}
SELECT time, round(cens, 6) AS cens_all, round(cens_ef, 6) AS cens_events_first FROM km""")
def k3_km_censoring(spark, sf_dir):
    co = cohort_orders(spark, sf_dir)
    a = km_curves(co, ties="all").select("time", r6("cens").alias("cens_all"))
    b = km_curves(co, ties="events_first").select("time", r6("cens").alias("cens_events_first"))
    return a.join(b, "time")


@register("K4_curve_at_step", f"""
WITH {COHORT_LINES}, {km_ctes()}, hz AS (SELECT CAST(horizon AS DOUBLE) AS horizon FROM (VALUES (30.0), (90.0), (365.0), (1000.0), (5000.0)) t(horizon))
SELECT horizon,
  round(coalesce((SELECT surv FROM km WHERE time <= horizon ORDER BY time DESC LIMIT 1), 1.0), 6) AS surv,
  round(coalesce((SELECT cens FROM km WHERE time <= horizon ORDER BY time DESC LIMIT 1), 1.0), 6) AS cens
FROM hz""")
def k4_curve_at_step(spark, sf_dir):
    cur = km_curves(cohort_lines(spark, sf_dir))
    hs = (30.0, 90.0, 365.0, 1000.0, 5000.0)
    s = curve_at(cur, hs, "surv", "step")
    c = curve_at(cur, hs, "cens", "step")
    return s.join(c, "horizon").select("horizon", r6("surv").alias("surv"), r6("cens").alias("cens"))


_LIN_HZ = (0.001, 0.5, 7.25, 24.0, 100.3, 250.0, 400.0)


def _lin_sql():
    vals = ", ".join(f"(CAST({h} AS DOUBLE))" for h in _LIN_HZ)
    lo_t = "(SELECT max(time) FROM km WHERE time <= horizon)"
    lo_v = "(SELECT cens FROM km WHERE time <= horizon ORDER BY time DESC LIMIT 1)"
    hi_t = "(SELECT min(time) FROM km WHERE time >= horizon)"
    hi_v = "(SELECT cens FROM km WHERE time >= horizon ORDER BY time LIMIT 1)"
    v = (f"CASE WHEN {lo_t} IS NULL THEN 1.0 WHEN {hi_t} IS NULL THEN {lo_v} WHEN {hi_t} = {lo_t} THEN {lo_v} "
         f"ELSE {lo_v} + ({hi_v} - {lo_v}) * (horizon - {lo_t}) / ({hi_t} - {lo_t}) END")
    return f"""
WITH {COHORT_EPISODES}, {km_ctes()}, hz AS (SELECT CAST(horizon AS DOUBLE) AS horizon FROM (VALUES {vals}) t(horizon))
SELECT horizon, round(least(greatest({v}, 1e-8), 1.0), 6) AS cens FROM hz"""


@register("K4_curve_at_linear", _lin_sql())
def k4_curve_at_linear(spark, sf_dir):
    """Linear (interpolated, clipped) read of the censoring curve of the episode cohort."""
    cur = km_curves(cohort_episodes(spark, sf_dir))
    at = curve_at(cur, _LIN_HZ, "cens", "linear", clip=True)
    return at.select("horizon", r6("cens").alias("cens"))


@register("K5_km_median_by_priority", f"""
WITH {COHORT_ORDERS}, {km_ctes(by='o_orderpriority')}
SELECT o_orderpriority, min(CASE WHEN surv <= 0.5 THEN time END) AS median_time,
       min(CASE WHEN surv <= 0.75 THEN time END) AS q25_time
FROM km GROUP BY o_orderpriority""")
def k5_km_median(spark, sf_dir):
    cur = km_curves(cohort_orders(spark, sf_dir), by=["o_orderpriority"])
    m = km_quantile(cur, 0.5, by=["o_orderpriority"]).withColumnRenamed("time_at_p", "median_time")
    q = km_quantile(cur, 0.75, by=["o_orderpriority"]).withColumnRenamed("time_at_p", "q25_time")
    return m.join(q, "o_orderpriority")


def _ipcw_sql():
    hz = ", ".join(f"(CAST({h} AS DOUBLE))" for h in HORIZONS)
    gh = ("least(greatest(CASE WHEN (SELECT max(time) FROM km WHERE time <= horizon) IS NULL THEN 1.0 "
          "WHEN (SELECT min(time) FROM km WHERE time >= horizon) IS NULL THEN (SELECT cens FROM km WHERE time <= horizon ORDER BY time DESC LIMIT 1) "
          "WHEN (SELECT min(time) FROM km WHERE time >= horizon) = (SELECT max(time) FROM km WHERE time <= horizon) "
          "THEN (SELECT cens FROM km WHERE time <= horizon ORDER BY time DESC LIMIT 1) "
          "ELSE (SELECT cens FROM km WHERE time <= horizon ORDER BY time DESC LIMIT 1) + "
          "((SELECT cens FROM km WHERE time >= horizon ORDER BY time LIMIT 1) - (SELECT cens FROM km WHERE time <= horizon ORDER BY time DESC LIMIT 1)) "
          "* (horizon - (SELECT max(time) FROM km WHERE time <= horizon)) / "
          "((SELECT min(time) FROM km WHERE time >= horizon) - (SELECT max(time) FROM km WHERE time <= horizon)) END, 1e-8), 1.0)")
    return f"""
WITH {COHORT_ORDERS}, {km_ctes()},
hz AS (SELECT horizon, {gh} AS g_h FROM (VALUES {hz}) t(horizon)),
w AS (
  SELECT c.subject_id, hz.horizon,
         CASE WHEN c.time <= hz.horizon AND c.event = 1 THEN 1.0 / least(greatest(k.cens, 1e-8), 1.0)
              WHEN c.time > hz.horizon THEN 1.0 / hz.g_h ELSE 0.0 END AS weight
  FROM cohort c JOIN km k ON k.time = c.time CROSS JOIN hz)
SELECT horizon, count(*) AS n, round(sum(weight), 4) AS sum_weight, round(max(weight), 6) AS max_weight,
       CAST(sum(CASE WHEN weight = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_zero
FROM w GROUP BY horizon"""


@register("K6_ipcw_weights", _ipcw_sql())
def k6_ipcw(spark, sf_dir):
    w = ipcw_weights(cohort_orders(spark, sf_dir), HORIZONS)
    return w.groupBy("horizon").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("weight"), 4).alias("sum_weight"),
        r6(F.max("weight")).alias("max_weight"),
        F.sum(F.when(F.col("weight") == 0, 1).otherwise(0)).cast("bigint").alias("n_zero"),
    )
