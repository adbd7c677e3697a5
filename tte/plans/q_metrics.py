"""Registered queries: concordance, Brier, IBS, AUC, calibration and decision curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from tte.operators.calibration import (
    bin_edges, calibration_mae, decision_curve_ipcw, decision_curve_naive, reliability_ipcw, reliability_naive,
)
from tte.operators.metrics import (
    bootstrap_auc, bootstrap_brier, bootstrap_concordance, brier_score, dynamic_auc, integrated_brier,
)
from tte.operators.pairs import concordance, concordance_events_only
from tte.plans.registry import r6, register
from tte.plans.sqltext import COHORT_EPISODES, COHORT_ORDERS, RISK, draws_cte, km_ctes
from tte.sources.testdata import BINS, HORIZONS, THRESHOLDS, cohort_episodes, cohort_orders, standin_long, with_standin

HZ_SQL = ", ".join(f"(CAST({h} AS DOUBLE))" for h in HORIZONS)
PRED_CTE = f"""
scored AS (SELECT *, {RISK} AS risk FROM cohort),
pred AS (SELECT s.*, hz.horizon, exp(-exp(risk - 1.5) * hz.horizon / 1000.0) AS surv
         FROM scored s CROSS JOIN (VALUES {HZ_SQL}) hz(horizon))"""


def _conc_sql(src_cte: str, risk_expr: str, by: str = "") -> str:
    bysel = f"a.{by}, " if by else ""
    byjoin = f" AND b.{by} = a.{by}" if by else ""
    grp = f"GROUP BY a.{by}" if by else ""
    return f"""
WITH {src_cte}, p AS (SELECT *, {risk_expr} AS risk FROM cohort),
pairs AS (
  SELECT {bysel}
    CAST(sum(CASE WHEN b.risk < a.risk THEN 1 ELSE 0 END) AS DOUBLE) AS concordant,
    CAST(sum(CASE WHEN b.risk > a.risk THEN 1 ELSE 0 END) AS DOUBLE) AS discordant,
    CAST(sum(CASE WHEN b.risk = a.risk THEN 1 ELSE 0 END) AS DOUBLE) AS tied_risk,
    CAST(sum(CASE WHEN b.time = a.time THEN 1 ELSE 0 END) AS DOUBLE) AS tied_time,
    CAST(count(*) AS DOUBLE) AS comparable
  FROM p a JOIN p b ON a.event = 1 AND (b.time > a.time OR (b.time = a.time AND b.event = 0)){byjoin}
  {grp})
SELECT *, round((concordant + 0.5 * tied_risk) / comparable, 6) AS c_index FROM pairs"""


def _conc(df, by=()):
    c = concordance(df, by=by)
    return c.select(*by, r6("c_index").alias("c_index"), "concordant", "discordant", "tied_risk", "tied_time",
                    "comparable")


@register("M1_concordance_orders", _conc_sql(COHORT_ORDERS, RISK))
def m1_orders(spark, sf_dir):
    return _conc(with_standin(cohort_orders(spark, sf_dir)))


@register("M1_concordance_episodes", _conc_sql(COHORT_EPISODES, "x1"))
def m1_episodes(spark, sf_dir):
    """Risk = the signup value x1 (has tied risks and tied times)."""
    return _conc(cohort_episodes(spark, sf_dir).withColumn("risk", F.col("x1")))


@register("M1_concordance_by_segment", _conc_sql(COHORT_ORDERS, RISK, by="c_mktsegment"))
def m1_by_segment(spark, sf_dir):
    return _conc(with_standin(cohort_orders(spark, sf_dir)), by=["c_mktsegment"])


@register("M2_concordance_events_only", f"""
WITH {COHORT_EPISODES},
pairs AS (
  SELECT CAST(sum(CASE WHEN a.x1 > b.x1 THEN 1 ELSE 0 END) AS DOUBLE) AS correct, CAST(count(*) AS DOUBLE) AS pairs
  FROM cohort a JOIN cohort b ON a.event = 1 AND b.event = 1 AND a.time < b.time)
SELECT round(CASE WHEN pairs > 0 THEN correct / pairs ELSE 0 END, 6) AS concordance, correct, pairs FROM pairs""")
def m2_events_only(spark, sf_dir):
    c = concordance_events_only(cohort_episodes(spark, sf_dir).withColumn("risk", F.col("x1")))
    return c.select(r6("concordance").alias("concordance"), "correct", "pairs")


BRIER_SQL_CTE = f"""
{COHORT_ORDERS}, {PRED_CTE}, {km_ctes()},
gh AS (SELECT horizon, coalesce((SELECT cens_ef FROM km WHERE km.time <= hz.horizon ORDER BY km.time DESC LIMIT 1), 1.0) AS g_h
       FROM (VALUES {HZ_SQL}) hz(horizon)),
contrib AS (
  SELECT p.horizon,
    CASE WHEN p.time <= p.horizon AND p.event = 1 THEN CASE WHEN k.cens_ef > 0 THEN p.surv * p.surv / k.cens_ef ELSE 0 END
         WHEN p.time > p.horizon THEN CASE WHEN gh.g_h > 0 THEN (1 - p.surv) * (1 - p.surv) / gh.g_h ELSE 0 END
         ELSE 0 END AS c
  FROM pred p JOIN km k ON k.time = p.time JOIN gh ON gh.horizon = p.horizon),
brier AS (SELECT horizon, avg(c) AS brier, count(*) AS n FROM contrib GROUP BY horizon)"""


@register("M3_brier", f"WITH {BRIER_SQL_CTE} SELECT horizon, round(brier, 6) AS brier, n FROM brier")
def m3_brier(spark, sf_dir):
    co = cohort_orders(spark, sf_dir)
    b = brier_score(co, standin_long(co), HORIZONS, same_times=True)
    return b.select("horizon", r6("brier").alias("brier"), "n")


@register("M4_integrated_brier", f"""WITH {BRIER_SQL_CTE},
seg AS (SELECT horizon, brier, lag(horizon) OVER (ORDER BY horizon) AS h0, lag(brier) OVER (ORDER BY horizon) AS b0 FROM brier)
SELECT round(sum((horizon - h0) * (brier + b0) / 2.0) / (max(horizon) - min(horizon)), 6) AS ibs FROM seg""")
def m4_ibs(spark, sf_dir):
    co = cohort_orders(spark, sf_dir)
    b = brier_score(co, standin_long(co), HORIZONS, same_times=True)
    return integrated_brier(b).select(r6("ibs").alias("ibs"))


AUC_HZ = (90.0, 365.0, 1000.0, 1825.0, 2600.0)
AUC_HZ_SQL = ", ".join(f"(CAST({h} AS DOUBLE))" for h in AUC_HZ)
AUC_CTE = f"""
{COHORT_ORDERS}, {km_ctes()},
s AS (SELECT c.*, {RISK} AS risk, k.cens_ef AS g_t FROM cohort c JOIN km k ON k.time = c.time),
hz AS (SELECT horizon FROM (VALUES {AUC_HZ_SQL}) t(horizon) WHERE horizon < (SELECT max(time) FROM cohort)),
cases AS (SELECT hz.horizon, s.risk, 1.0 / s.g_t AS w FROM s JOIN hz ON s.time <= hz.horizon AND s.event = 1 AND s.g_t > 0),
ctrls AS (SELECT hz.horizon, s.risk FROM s JOIN hz ON s.time > hz.horizon),
num AS (SELECT a.horizon, sum(a.w * CASE WHEN a.risk > b.risk THEN 1.0 WHEN a.risk = b.risk THEN 0.5 ELSE 0.0 END) AS num
        FROM cases a JOIN ctrls b ON a.horizon = b.horizon GROUP BY a.horizon),
auc AS (SELECT num.horizon, num.num / ((SELECT sum(w) FROM cases c WHERE c.horizon = num.horizon)
                                       * (SELECT count(*) FROM ctrls k WHERE k.horizon = num.horizon)) AS auc FROM num)"""


@register("M5_dynamic_auc", f"WITH {AUC_CTE} SELECT horizon, round(auc, 6) AS auc FROM auc")
def m5_auc(spark, sf_dir):
    co = with_standin(cohort_orders(spark, sf_dir))
    auc, _ = dynamic_auc(co, co, AUC_HZ, same_times=True)
    return auc.select("horizon", r6("auc").alias("auc"))


@register("M5_mean_auc", f"""WITH {AUC_CTE},
sat AS (SELECT auc.horizon, auc.auc,
          coalesce((SELECT surv FROM km WHERE km.time <= auc.horizon ORDER BY km.time DESC LIMIT 1), 1.0) AS surv FROM auc),
d AS (SELECT auc, surv, horizon, coalesce(lag(surv) OVER (ORDER BY horizon), 1.0) - surv AS drop FROM sat)
SELECT round(sum(auc * drop) / (1.0 - arg_max(surv, horizon)), 6) AS mean_auc FROM d""")
def m5_mean_auc(spark, sf_dir):
    co = with_standin(cohort_orders(spark, sf_dir))
    _, mean = dynamic_auc(co, co, AUC_HZ, same_times=True)
    return mean.select(r6("mean_auc").alias("mean_auc"))


def _bin_sql(p: str, bins: int) -> str:
    edges = bin_edges(bins)
    parts = " ".join(f"WHEN {p} >= CAST('{repr(e)}' AS DOUBLE) THEN {i}" for i, e in reversed(list(enumerate(edges))))
    return f"CASE {parts} ELSE -1 END"


def _gh_linear_sql(value: str = "cens") -> str:
    lo_t = "(SELECT max(time) FROM km WHERE time <= hz.horizon)"
    lo_v = f"(SELECT {value} FROM km WHERE time <= hz.horizon ORDER BY time DESC LIMIT 1)"
    hi_t = "(SELECT min(time) FROM km WHERE time >= hz.horizon)"
    hi_v = f"(SELECT {value} FROM km WHERE time >= hz.horizon ORDER BY time LIMIT 1)"
    v = (f"CASE WHEN {lo_t} IS NULL THEN 1.0 WHEN {hi_t} IS NULL THEN {lo_v} WHEN {hi_t} = {lo_t} THEN {lo_v} "
         f"ELSE {lo_v} + ({hi_v} - {lo_v}) * (hz.horizon - {lo_t}) / ({hi_t} - {lo_t}) END")
    return f"least(greatest({v}, 1e-8), 1.0)"


IPCW_CTE = f"""
{COHORT_ORDERS}, {PRED_CTE}, {km_ctes()},
gh AS (SELECT hz.horizon, {_gh_linear_sql()} AS g_h FROM (VALUES {HZ_SQL}) hz(horizon)),
wt AS (
  SELECT p.*, least(greatest(p.surv, 0.0), 1.0) AS pc,
    CASE WHEN p.time <= p.horizon AND p.event = 1 THEN 1.0 / least(greatest(k.cens, 1e-8), 1.0)
         WHEN p.time > p.horizon THEN 1.0 / gh.g_h ELSE 0.0 END AS w
  FROM pred p JOIN km k ON k.time = p.time JOIN gh ON gh.horizon = p.horizon)"""


@register("M7_reliability_ipcw", f"""WITH {IPCW_CTE},
b AS (SELECT *, {_bin_sql('pc', BINS)} AS bin FROM wt),
g AS (SELECT horizon AS time, bin, sum(w) AS sw, sum(CASE WHEN time > horizon THEN w ELSE 0 END) AS sy,
             avg(pc) AS expected, count(*) AS count
      FROM b WHERE bin >= 0 AND bin < {BINS} GROUP BY horizon, bin HAVING sum(w) > 0),
o AS (SELECT *, sy / sw AS observed, sqrt(greatest((sy / sw) * (1 - sy / sw), 1e-8) / sw) AS se FROM g)
SELECT time, bin, round(expected, 6) AS expected, round(observed, 6) AS observed,
       round(greatest(observed - 1.96 * se, 0.0), 6) AS ci_lower, round(least(observed + 1.96 * se, 1.0), 6) AS ci_upper,
       count FROM o""")
def m7_reliability(spark, sf_dir):
    co = cohort_orders(spark, sf_dir)
    r = reliability_ipcw(standin_long(co), HORIZONS, BINS)
    return r.select("time", "bin", *[r6(c).alias(c) for c in ("expected", "observed", "ci_lower", "ci_upper")], "count")


@register("M8_reliability_naive", f"""WITH {COHORT_ORDERS}, {PRED_CTE},
b AS (SELECT *, {_bin_sql('surv', BINS)} AS bin FROM pred)
SELECT horizon AS time, bin, round(avg(surv), 6) AS expected,
       round(avg(CASE WHEN time > horizon OR event = 0 THEN 1.0 ELSE 0.0 END), 6) AS observed, count(*) AS count
FROM b WHERE bin >= 0 AND bin < {BINS} GROUP BY horizon, bin""")
def m8_reliability_naive(spark, sf_dir):
    r = reliability_naive(standin_long(cohort_orders(spark, sf_dir)), BINS)
    return r.select("time", "bin", r6("expected").alias("expected"), r6("observed").alias("observed"), "count")


@register("M9_calibration_mae", f"""WITH {IPCW_CTE},
b AS (SELECT *, {_bin_sql('pc', BINS)} AS bin FROM wt),
g AS (SELECT horizon AS time, bin, sum(CASE WHEN time > horizon THEN w ELSE 0 END) / sum(w) AS observed, avg(pc) AS expected
      FROM b WHERE bin >= 0 AND bin < {BINS} GROUP BY horizon, bin HAVING sum(w) > 0)
SELECT time, round(avg(abs(expected - observed)), 6) AS mae FROM g GROUP BY time""")
def m9_mae(spark, sf_dir):
    r = reliability_ipcw(standin_long(cohort_orders(spark, sf_dir)), HORIZONS, BINS)
    return calibration_mae(r).select("time", r6("mae").alias("mae"))


THR_SQL = ", ".join(f"(CAST({t} AS DOUBLE))" for t in THRESHOLDS)


@register("M10_decision_curve_ipcw", f"""WITH {IPCW_CTE},
x AS (SELECT w.*, 1.0 - w.pc AS r, CASE WHEN w.time <= w.horizon AND w.event = 1 THEN w.w ELSE 0.0 END AS ew,
             CASE WHEN w.time > w.horizon THEN w.w ELSE 0.0 END AS nw FROM wt w),
n AS (SELECT horizon, count(*) AS n, sum(ew) AS sew FROM x GROUP BY horizon),
t AS (SELECT x.horizon, th.thr, sum(CASE WHEN r >= th.thr THEN ew ELSE 0 END) AS tp, sum(CASE WHEN r >= th.thr THEN nw ELSE 0 END) AS fp
      FROM x CROSS JOIN (VALUES {THR_SQL}) th(thr) GROUP BY x.horizon, th.thr)
SELECT t.horizon AS time, t.thr AS threshold,
       round(t.tp / n.n - t.fp / n.n * (t.thr / greatest(1 - t.thr, 1e-8)), 6) AS net_benefit,
       round(n.sew / n.n - (1 - n.sew / n.n) * (t.thr / greatest(1 - t.thr, 1e-8)), 6) AS treat_all,
       CAST(0.0 AS DOUBLE) AS treat_none
FROM t JOIN n USING (horizon)""")
def m10_decision(spark, sf_dir):
    d = decision_curve_ipcw(standin_long(cohort_orders(spark, sf_dir)), HORIZONS, THRESHOLDS)
    return d.select("time", "threshold", r6("net_benefit").alias("net_benefit"), r6("treat_all").alias("treat_all"),
                    "treat_none")


@register("M11_decision_curve_naive", f"""WITH {COHORT_ORDERS}, {PRED_CTE}
SELECT horizon AS time, th.thr AS threshold,
  round(sum(CASE WHEN 1 - surv >= th.thr AND time <= horizon AND event = 1 THEN 1.0 ELSE 0.0 END) / count(*)
        - sum(CASE WHEN 1 - surv >= th.thr THEN 1.0 ELSE 0.0 END) / count(*) * th.thr, 6) AS net_benefit
FROM pred CROSS JOIN (VALUES {THR_SQL}) th(thr) GROUP BY horizon, th.thr""")
def m11_decision_naive(spark, sf_dir):
    d = decision_curve_naive(standin_long(cohort_orders(spark, sf_dir)), THRESHOLDS)
    return d.select("time", "threshold", r6("net_benefit").alias("net_benefit"))


REPS = 200


def _interval(df, *keys):
    return df.select(*keys, *[r6(c).alias(c) for c in ("estimate", "ci_lower", "ci_upper", "std")], "reps")


def _interval_sql(source: str, value: str, keys: str = "", estimate: str = "") -> str:
    group = f"GROUP BY {keys}" if keys else ""
    sep = f"{keys}, " if keys else ""
    return f"""
ci AS (SELECT {sep}quantile_cont({value}, 0.025) AS lo, quantile_cont({value}, 0.975) AS hi, count({value}) AS reps FROM {source} {group})
SELECT {sep}round(e.estimate, 6) AS estimate, round(lo, 6) AS ci_lower, round(hi, 6) AS ci_upper, round((hi - lo) / 3.92, 6) AS std, reps
FROM ci {f"JOIN {estimate} e USING ({keys})" if keys else f"CROSS JOIN {estimate} e"}"""


@register("M6_bootstrap_concordance")
def m6_bootstrap(spark, sf_dir):
    """Percentile interval of C over 200 replicates; the same over episodes has SQL (all pairs of orders are too many)."""
    co = with_standin(cohort_orders(spark, sf_dir))
    return _interval(bootstrap_concordance(co, "subject_id", reps=REPS, seed=42))


@register("M6_bootstrap_concordance_episodes", f"""
WITH {COHORT_EPISODES}, {draws_cte(42, REPS)},
pairs AS (
  SELECT a.subject_id AS i, b.subject_id AS j, CASE WHEN b.x1 < a.x1 THEN 1.0 WHEN b.x1 = a.x1 THEN 0.5 ELSE 0.0 END AS s
  FROM cohort a JOIN cohort b ON a.event = 1 AND (b.time > a.time OR (b.time = a.time AND b.event = 0))),
per_i AS (
  SELECT p.i, w.rep, sum(w.bw * s) AS good, sum(w.bw) AS n FROM pairs p JOIN draws w ON w.subject_id = p.j GROUP BY p.i, w.rep),
per_rep AS (
  SELECT q.rep, sum(w.bw * good) / nullif(sum(w.bw * n), 0) AS c FROM per_i q JOIN draws w ON w.subject_id = q.i AND w.rep = q.rep GROUP BY q.rep),
point AS (SELECT sum(s) / count(*) AS estimate FROM pairs), {_interval_sql("per_rep", "c", estimate="point")}""")
def m6_bootstrap_episodes(spark, sf_dir):
    co = cohort_episodes(spark, sf_dir).withColumn("risk", F.col("x1"))
    return _interval(bootstrap_concordance(co, "subject_id", reps=REPS, seed=42))


@register("E2_bin_equal", f"""WITH {COHORT_ORDERS}, {PRED_CTE}
SELECT horizon, {_bin_sql('surv', BINS)} AS bin, count(*) AS n FROM pred GROUP BY 1, 2""")
def e2_bins(spark, sf_dir):
    """Equal-width bins on the literal numpy edges (1.0 falls outside: bin 10)."""
    from tte.operators.calibration import bin_equal

    lp = standin_long(cohort_orders(spark, sf_dir))
    return lp.groupBy("horizon", bin_equal(F.col("surv"), BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@register("E3_interp_curve", f"""WITH {COHORT_ORDERS}, {km_ctes()},
hz AS (SELECT CAST(h AS DOUBLE) AS horizon FROM (VALUES (100.5), (365.25), (1000.75)) t(h))
SELECT hz.horizon, round({_gh_linear_sql('surv')}, 6) AS surv FROM hz""")
def e3_interp(spark, sf_dir):
    """Piecewise-linear read of the KM survival curve between curve times."""
    from tte.operators.curves import curve_at, km_curves

    cur = km_curves(cohort_orders(spark, sf_dir))
    return curve_at(cur, [100.5, 365.25, 1000.75], "surv", "linear", clip=True).select("horizon", r6("surv").alias("surv"))


@register("V8_bootstrap_weights", f"""WITH {COHORT_ORDERS}, {draws_cte(42, 20)}
SELECT rep, sum(bw) AS total_weight, round(avg(CASE WHEN bw = 0 THEN 1.0 ELSE 0.0 END), 6) AS zero_share FROM draws GROUP BY rep""")
def v8_bootstrap(spark, sf_dir):
    """Hashed Poisson(1) weights for 20 replicates; per replicate the weight sum is about n and the share of
    zero weights about e^-1."""
    from tte.operators.replicates import bootstrap_weights

    w = bootstrap_weights(cohort_orders(spark, sf_dir), "subject_id", 20, 42)
    return w.groupBy("rep").agg(F.sum("bw").alias("total_weight"), r6(F.avg((F.col("bw") == 0).cast("double"))).alias("zero_share"))


BOOT_BRIER_CTE = f"""
{BRIER_SQL_CTE.replace("p.horizon,", "p.subject_id, p.horizon,", 1)}, {draws_cte(42, REPS)},
per_rep AS (SELECT horizon, rep, sum(bw * c) / nullif(sum(bw), 0) AS b FROM contrib JOIN draws USING (subject_id) GROUP BY horizon, rep)"""


@register("M6_bootstrap_brier", f"""WITH {BOOT_BRIER_CTE}, point AS (SELECT horizon, brier AS estimate FROM brier),
{_interval_sql("per_rep", "b", "horizon", "point")}""")
def m6_brier(spark, sf_dir):
    """Brier per horizon over 200 replicates; the estimate is M3's."""
    co = cohort_orders(spark, sf_dir)
    return _interval(bootstrap_brier(co, standin_long(co), HORIZONS, "subject_id", reps=REPS, same_times=True)[0], "horizon")


@register("M6_bootstrap_ibs", f"""WITH {BOOT_BRIER_CTE},
seg AS (SELECT rep, horizon, b, lag(horizon) OVER w AS h0, lag(b) OVER w AS b0 FROM
        (SELECT * FROM per_rep UNION ALL SELECT horizon, -1, brier FROM brier) WINDOW w AS (PARTITION BY rep ORDER BY horizon)),
area AS (SELECT rep, sum((horizon - h0) * (b + b0) / 2.0) / (max(horizon) - min(horizon)) AS ibs FROM seg GROUP BY rep),
reps AS (SELECT ibs FROM area WHERE rep >= 0), point AS (SELECT ibs AS estimate FROM area WHERE rep = -1), {_interval_sql("reps", "ibs", estimate="point")}""")
def m6_ibs(spark, sf_dir):
    """Integrated Brier over 200 replicates."""
    co = cohort_orders(spark, sf_dir)
    return _interval(bootstrap_brier(co, standin_long(co), HORIZONS, "subject_id", reps=REPS, same_times=True)[1])


@register("M6_bootstrap_auc")
def m6_auc(spark, sf_dir):
    """Dynamic AUC per horizon over 200 replicates (tested against the AUC of repeated rows)."""
    co = with_standin(cohort_orders(spark, sf_dir))
    return _interval(bootstrap_auc(co, co, HORIZONS, "subject_id", reps=REPS, same_times=True), "horizon")
