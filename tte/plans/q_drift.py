"""Registered queries: feature statistics and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from tte.operators.drift import (
    categorical_drift, distribution_drift, drift_relative, drift_scores, feature_stats, quality_drift, target_drift,
)
from tte.operators.quality import quality_metrics
from tte.plans.registry import r6, register
from tte.plans.sqltext import COHORT_ORDERS, DRIFT_FRAME, QUALITY_FRAME
from tte.sources.testdata import cohort_orders, drift_frame, quality_frame

NUM = ("o_totalprice", "c_acctbal")
CAT = ("o_orderstatus", "o_orderpriority", "c_mktsegment")


def _stats_sql_body():
    parts = []
    for c in NUM:
        parts.append(f"SELECT period, '{c}' AS col, 'numeric' AS kind, avg({c}) AS mean, stddev_samp({c}) AS std, "
                     f"min({c}) AS min, max({c}) AS max, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate, "
                     f"CAST(NULL AS DOUBLE) AS unique_count, CAST(NULL AS DOUBLE) AS top_category_rate FROM df GROUP BY period")
    for c in CAT:
        parts.append(f"SELECT period, '{c}', 'categorical', NULL, NULL, NULL, NULL, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), "
                     f"CAST(count(DISTINCT {c}) AS DOUBLE), "
                     f"coalesce((SELECT max(k) FROM (SELECT count(*) AS k FROM df d2 WHERE d2.period = df.period AND {c} IS NOT NULL GROUP BY {c})) "
                     f"/ nullif(count({c}), 0), 0.0) FROM df GROUP BY period")
    return " UNION ALL ".join(parts)


STATS_CTE = f"{DRIFT_FRAME}, st AS ({_stats_sql_body()})"


def _stats(spark, sf_dir):
    return feature_stats(drift_frame(spark, sf_dir), NUM, CAT, by=["period"])


@register("D1_feature_stats", f"""WITH {STATS_CTE}
SELECT period, col AS "column", kind, round(mean, 6) AS mean, round(std, 6) AS std, min, max,
       round(missing_rate, 6) AS missing_rate, unique_count, round(top_category_rate, 6) AS top_category_rate FROM st""")
def d1_stats(spark, sf_dir):
    s = _stats(spark, sf_dir)
    return s.select("period", "column", "kind", r6("mean").alias("mean"), r6("std").alias("std"), "min", "max",
                    r6("missing_rate").alias("missing_rate"), "unique_count", r6("top_category_rate").alias("top_category_rate"))


def _split(s):
    return (s.where(F.col("period") == "base").drop("period"), s.where(F.col("period") == "current").drop("period"))


@register("D2_drift_numeric", f"""WITH {STATS_CTE}
SELECT b.col AS "column", b.kind,
  round(CASE WHEN b.kind = 'numeric' THEN CASE WHEN b.std > 0 THEN greatest(abs(c.mean - b.mean) / b.std, abs(c.std - b.std) / b.std) ELSE 0.0 END
       ELSE greatest(abs(c.top_category_rate - b.top_category_rate), abs(c.unique_count - b.unique_count) / greatest(b.unique_count, 1.0)) END, 6) AS drift
FROM st b JOIN st c ON b.col = c.col AND b.period = 'base' AND c.period = 'current'""")
def d2_drift(spark, sf_dir):
    """D2 (numeric) and D3 (categorical) drift scores between the two periods."""
    b, c = _split(_stats(spark, sf_dir))
    return drift_scores(b, c).select("column", "kind", r6("drift").alias("drift"))


@register("D4_drift_relative", f"""WITH {STATS_CTE}
SELECT b.col AS "column", round(least((abs(c.mean - b.mean) / abs(b.mean + 1e-8) + abs(c.std - b.std) / (b.std + 1e-8)) / 2.0, 1.0), 6) AS drift
FROM st b JOIN st c ON b.col = c.col AND b.period = 'base' AND c.period = 'current' WHERE b.kind = 'numeric'""")
def d4_relative(spark, sf_dir):
    b, c = _split(_stats(spark, sf_dir))
    return drift_relative(b, c).select("column", r6("drift").alias("drift"))


def _qm_sql(where):
    cols = ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_discount")
    miss = " + ".join(f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in cols)
    return (f"(SELECT m * 100.0 / (n * 6) AS missing_pct, d * 100.0 / n AS duplicate_pct FROM "
            f"(SELECT count(*) AS n, {miss} AS m FROM qf WHERE {where}) CROSS JOIN "
            f"(SELECT coalesce(sum(k - 1), 0) AS d FROM (SELECT count(*) AS k FROM qf WHERE {where} GROUP BY ALL_C)))"
            ).replace("ALL_C", ", ".join(cols))


@register("D5_quality_drift", f"""WITH {QUALITY_FRAME}, b AS {_qm_sql("l_linestatus = 'F'")}, c AS {_qm_sql("l_linestatus = 'O'")}
SELECT round(c.missing_pct - b.missing_pct, 6) AS missing_change, round(c.duplicate_pct - b.duplicate_pct, 6) AS duplicate_change,
       abs(c.missing_pct - b.missing_pct) > 5 AS missing_drift, abs(c.duplicate_pct - b.duplicate_pct) > 2 AS duplicate_drift FROM b, c""")
def d5_quality_drift(spark, sf_dir):
    """Quality metrics of the shipped ('F') lines against the open ('O') ones."""
    qf = quality_frame(spark, sf_dir)
    b, _ = quality_metrics(qf.where(F.col("l_linestatus") == "F"))
    c, _ = quality_metrics(qf.where(F.col("l_linestatus") == "O"))
    d = quality_drift(b, c)
    return d.select(r6("missing_change").alias("missing_change"), r6("duplicate_change").alias("duplicate_change"),
                    "missing_drift", "duplicate_drift")


def _dist_sql(src_cte, ref_where, cur_where, cols, bins=10):
    u = " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS value, CASE WHEN {ref_where} THEN 0 ELSE 1 END AS side FROM src "
        f"WHERE {c} IS NOT NULL AND (({ref_where}) OR ({cur_where}))" for c in cols)
    return f"""WITH {src_cte},
u AS ({u}),
counts AS (SELECT col, value, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS nr, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS nc FROM u GROUP BY col, value),
tot AS (SELECT col, sum(nr) AS tot_r, sum(nc) AS tot_c FROM counts GROUP BY col),
cdf AS (SELECT k.col, k.value, sum(nr) OVER (PARTITION BY k.col ORDER BY k.value) / t.tot_r - sum(nc) OVER (PARTITION BY k.col ORDER BY k.value) / t.tot_c AS d,
               lead(k.value) OVER (PARTITION BY k.col ORDER BY k.value) AS nxt FROM counts k JOIN tot t USING (col)),
kw AS (SELECT col, max(abs(d)) AS ks, sum(CASE WHEN nxt IS NOT NULL THEN abs(d) * (nxt - value) ELSE 0 END) AS w FROM cdf GROUP BY col),
rng AS (SELECT col, min(value) AS lo, max(value) AS hi FROM u WHERE side = 0 GROUP BY col),
b AS (SELECT u.col, side, CAST(CASE WHEN (hi - lo) / {bins} > 0 THEN least(greatest(floor((value - lo) / ((hi - lo) / {bins})), 0), {bins - 1}) ELSE 0 END AS INT) AS bin FROM u JOIN rng USING (col)),
bins AS (SELECT col, bin FROM rng CROSS JOIN range({bins}) r(bin)),
bc AS (SELECT x.col, x.bin, coalesce(sum(CASE WHEN side = 0 THEN 1.0 ELSE 0.0 END), 0) AS br, coalesce(sum(CASE WHEN side = 1 THEN 1.0 ELSE 0.0 END), 0) AS bcn
       FROM bins x LEFT JOIN b ON b.col = x.col AND b.bin = x.bin GROUP BY x.col, x.bin),
pq AS (SELECT bc.col, br / tot_r AS pr, bcn / tot_c AS qr, greatest(br / tot_r, 1e-4) AS p, greatest(bcn / tot_c, 1e-4) AS q FROM bc JOIN tot USING (col)),
bs AS (SELECT col, sum((q - p) * ln(q / p)) AS psi,
              sqrt(greatest(sum(0.5 * CASE WHEN pr > 0 THEN pr * ln(pr / ((pr + qr) / 2)) ELSE 0 END
                              + 0.5 * CASE WHEN qr > 0 THEN qr * ln(qr / ((pr + qr) / 2)) ELSE 0 END), 0)) AS js FROM pq GROUP BY col)
SELECT col AS "column", round(ks, 6) AS ks, round(w, 6) AS wasserstein, round(psi, 6) AS psi, round(js, 6) AS js FROM kw JOIN bs USING (col)"""


@register("D6_distribution_drift", _dist_sql(DRIFT_FRAME + ", src AS (SELECT * FROM df)", "period = 'base'", "period = 'current'", NUM))
def d6_distribution(spark, sf_dir):
    d = drift_frame(spark, sf_dir)
    r = distribution_drift(d.where(F.col("period") == "base"), d.where(F.col("period") == "current"), list(NUM))
    return r.select("column", *[r6(c).alias(c) for c in ("ks", "wasserstein", "psi", "js")])


@register("D6_categorical_drift", f"""WITH {DRIFT_FRAME},
u AS ({' UNION ALL '.join(f"SELECT '{c}' AS col, {c} AS value, period FROM df WHERE {c} IS NOT NULL" for c in CAT)}),
k AS (SELECT col, value, CAST(sum(CASE WHEN period = 'base' THEN 1 ELSE 0 END) AS DOUBLE) AS nr,
             CAST(sum(CASE WHEN period = 'current' THEN 1 ELSE 0 END) AS DOUBLE) AS nc FROM u GROUP BY col, value),
t AS (SELECT col, sum(nr) AS tot_r, sum(nc) AS tot_c FROM k GROUP BY col),
x AS (SELECT k.col, nr / tot_r AS pr, nc / tot_c AS qr, nr / tot_r * tot_c AS e, nc FROM k JOIN t USING (col))
SELECT col AS "column", round(sum((greatest(qr, 1e-4) - greatest(pr, 1e-4)) * ln(greatest(qr, 1e-4) / greatest(pr, 1e-4))), 6) AS psi,
  round(sqrt(greatest(sum(0.5 * CASE WHEN pr > 0 THEN pr * ln(pr / ((pr + qr) / 2)) ELSE 0 END + 0.5 * CASE WHEN qr > 0 THEN qr * ln(qr / ((pr + qr) / 2)) ELSE 0 END), 0)), 6) AS js,
  round(sum(CASE WHEN e > 0 THEN (nc - e) * (nc - e) / e ELSE 0 END), 6) AS chi2, count(*) - 1 AS dof
FROM x GROUP BY col""")
def d6_categorical(spark, sf_dir):
    d = drift_frame(spark, sf_dir)
    r = categorical_drift(d.where(F.col("period") == "base"), d.where(F.col("period") == "current"), list(CAT))
    return r.select("column", r6("psi").alias("psi"), r6("js").alias("js"), r6("chi2").alias("chi2"), "dof")


@register("D7_target_drift", _dist_sql(COHORT_ORDERS + ", src AS (SELECT time, CAST(event AS DOUBLE) AS event, c_mktsegment FROM cohort)",
                                       "c_mktsegment = 'BUILDING'", "c_mktsegment <> 'BUILDING'", ("time", "event")))
def d7_target(spark, sf_dir):
    """Target drift of the BUILDING segment (reference) against all other segments."""
    co = cohort_orders(spark, sf_dir)
    r = target_drift(co.where(F.col("c_mktsegment") == "BUILDING"), co.where(F.col("c_mktsegment") != "BUILDING"))
    return r.select("column", *[r6(c).alias(c) for c in ("ks", "wasserstein", "psi", "js")])


@register("D3_drift_categorical", f"""WITH {STATS_CTE}
SELECT b.col AS "column", round(greatest(abs(c.top_category_rate - b.top_category_rate),
       abs(c.unique_count - b.unique_count) / greatest(b.unique_count, 1.0)), 6) AS drift
FROM st b JOIN st c ON b.col = c.col AND b.period = 'base' AND c.period = 'current' WHERE b.kind = 'categorical'""")
def d3_categorical(spark, sf_dir):
    b, c = _split(_stats(spark, sf_dir))
    return drift_scores(b, c).where(F.col("kind") == "categorical").select("column", r6("drift").alias("drift"))
