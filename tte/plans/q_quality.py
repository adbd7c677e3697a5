"""Registered queries: profiling, validation and cleansing (Q1-Q23) over the quality frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from tte.operators.quality import (
    Rule, cleanse_missing, cohort_checks, correlations, drop_duplicates, expectations, iqr_outliers,
    profile_columns, profile_flags, profile_survival, quality_metrics, quality_score, remove_outliers,
    top_values, validate,
)
from tte.plans.registry import r6, register
from tte.plans.sqltext import (
    COHORT_ORDERS, QF_COLUMNS, QF_DTYPES, QF_NUMERIC, QF_TEXT, QUALITY_FRAME, km_ctes,
)
from tte.sources.testdata import cohort_orders, quality_frame


def _profile_body() -> str:
    parts = []
    for c in QF_COLUMNS:
        num = c in QF_NUMERIC
        stats = (f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, "
                 f"CAST(max({c}) AS DOUBLE) AS max, round(skewness({c}), 6) AS skewness, round(kurtosis({c}), 6) AS kurtosis, "
                 f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS median, "
                 f"round(quantile_cont({c}, 0.75), 6) AS q75") if num else \
            ", ".join(f"CAST(NULL AS DOUBLE) AS {m}" for m in
                      ("mean", "std", "min", "max", "skewness", "kurtosis", "q25", "median", "q75"))
        parts.append(
            f"SELECT '{c}' AS column, '{QF_DTYPES[c]}' AS dtype, count(*) AS n_total, "
            f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing, "
            f"round(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*), 6) AS missing_pct, "
            f"count(DISTINCT {c}) AS n_unique, {stats} FROM qf")
    return "\nUNION ALL\n".join(parts)


def _profile_sql() -> str:
    return f"WITH {QUALITY_FRAME}\n" + _profile_body()


PROFILE_COLS = ("column", "dtype", "n_total", "n_missing", "missing_pct", "n_unique", "mean", "std", "min", "max",
                "skewness", "kurtosis", "q25", "median", "q75")


@register("Q1_profile_numeric", _profile_sql())
def q1_profile(spark, sf_dir):
    p = profile_columns(quality_frame(spark, sf_dir))
    rnd = {"missing_pct", "mean", "std", "skewness", "kurtosis", "q25", "median", "q75"}
    return p.select(*[r6(c).alias(c) if c in rnd else F.col(c) for c in PROFILE_COLS])


@register("Q2_top_values", f"""WITH {QUALITY_FRAME}
SELECT * FROM (SELECT 'l_returnflag' AS column, l_returnflag AS value, count(*) AS count FROM qf
               WHERE l_returnflag IS NOT NULL GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'l_linestatus' AS column, l_linestatus AS value, count(*) AS count FROM qf
               WHERE l_linestatus IS NOT NULL GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)""")
def q2_top_values(spark, sf_dir):
    return top_values(quality_frame(spark, sf_dir), list(QF_TEXT), 10)


@register("Q3_profile_survival", f"""WITH {COHORT_ORDERS}, {km_ctes()}
SELECT CAST(sum(event) AS BIGINT) AS n_events, CAST(sum(1 - event) AS BIGINT) AS n_censored,
       round(sum(event) / count(*), 6) AS event_rate, min(time) AS time_min, max(time) AS time_max,
       round(avg(time), 6) AS time_mean, round(stddev_samp(time), 6) AS time_std,
       round(avg(CASE WHEN event = 1 THEN time END), 6) AS event_time_mean,
       round(avg(CASE WHEN event = 0 THEN time END), 6) AS censored_time_mean,
       quantile_cont(time, 0.5) AS time_median,
       (SELECT min(time) FROM km WHERE surv <= 0.5) AS km_median,
       CASE WHEN max(time) >= 365 THEN round((SELECT surv FROM km WHERE km.time <= 365 ORDER BY km.time DESC LIMIT 1), 6) END AS km_1year,
       CASE WHEN max(time) >= 1825 THEN round((SELECT surv FROM km WHERE km.time <= 1825 ORDER BY km.time DESC LIMIT 1), 6) END AS km_5year
FROM cohort""")
def q3_profile_survival(spark, sf_dir):
    p = profile_survival(cohort_orders(spark, sf_dir))
    rnd = {"event_rate", "time_mean", "time_std", "event_time_mean", "censored_time_mean", "km_1year", "km_5year"}
    return p.select(*[r6(c).alias(c) if c in rnd else F.col(c) for c in p.columns])


def _corr_sql():
    parts = []
    for i, a in enumerate(QF_NUMERIC):
        for b in QF_NUMERIC[i + 1:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM qf")
    return f"WITH {QUALITY_FRAME}\n" + "\nUNION ALL\n".join(parts)


@register("Q4_correlations", _corr_sql())
def q4_corr(spark, sf_dir):
    c = correlations(quality_frame(spark, sf_dir))
    return c.select("col_a", "col_b", r6("corr").alias("corr"))


@register("Q5_profile_flags", f"""WITH {QUALITY_FRAME}, p AS ({_profile_body()})
SELECT "column", missing_pct > 50 AS is_highly_missing, n_unique <= 1 AS is_constant,
       n_unique > 0.9 * n_total AS is_highly_cardinal FROM p""")
def q5_flags(spark, sf_dir):
    return profile_flags(profile_columns(quality_frame(spark, sf_dir)))


QM_SQL = f"""WITH {QUALITY_FRAME},
d AS (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows FROM
        (SELECT count(*) AS c FROM qf GROUP BY ALL_COLS)),
m AS (SELECT count(*) AS n_rows, CAST({' + '.join(f'sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)' for c in QF_COLUMNS)} AS BIGINT) AS missing_cells FROM qf)
""".replace("GROUP BY ALL_COLS", "GROUP BY " + ", ".join(QF_COLUMNS))


@register("Q6_quality_metrics", QM_SQL + f"""
SELECT n_rows, {len(QF_COLUMNS)} AS n_columns, missing_cells, round(missing_cells * 100.0 / (n_rows * {len(QF_COLUMNS)}), 6) AS missing_pct,
       duplicate_rows, round(duplicate_rows * 100.0 / n_rows, 6) AS duplicate_pct FROM m CROSS JOIN d""")
def q6_quality(spark, sf_dir):
    ds, _ = quality_metrics(quality_frame(spark, sf_dir))
    return ds.select("n_rows", "n_columns", "missing_cells", r6("missing_pct").alias("missing_pct"), "duplicate_rows",
                     r6("duplicate_pct").alias("duplicate_pct"))


def _colq_body():
    parts = []
    for c in QF_COLUMNS:
        uq = f"round(count(DISTINCT {c}) * 100.0 / count(*), 6)" if c in QF_TEXT else "CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS column, round((1 - sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / count(*)) * 100.0, 6) AS completeness, "
                     f"{uq} AS uniqueness FROM qf")
    return "\nUNION ALL\n".join(parts)


def _colq_sql():
    return f"WITH {QUALITY_FRAME}\n" + _colq_body()


@register("Q6_column_quality", _colq_sql())
def q6_columns(spark, sf_dir):
    _, cols = quality_metrics(quality_frame(spark, sf_dir))
    return cols.select("column", r6("completeness").alias("completeness"), r6("uniqueness").alias("uniqueness"))


def _fences_cte():
    parts = [f"SELECT '{c}' AS col, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM qf" for c in QF_NUMERIC]
    return "fences AS (SELECT col, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (" + \
        " UNION ALL ".join(parts) + "))"


def _outl_sql():
    parts = [f"SELECT '{c}' AS column, CAST(sum(CASE WHEN {c} < f.lower OR {c} > f.upper THEN 1 ELSE 0 END) AS BIGINT) AS outliers "
             f"FROM qf CROSS JOIN (SELECT * FROM fences WHERE col = '{c}') f" for c in QF_NUMERIC]
    return f"WITH {QUALITY_FRAME}, {_fences_cte()}\n" + "\nUNION ALL\n".join(parts)


@register("Q7_iqr_outliers", _outl_sql())
def q7_outliers(spark, sf_dir):
    return iqr_outliers(quality_frame(spark, sf_dir))


@register("Q10_quality_score", QM_SQL + f""",
comp AS (SELECT avg(cpl) AS mean_completeness, sum(CASE WHEN cpl < 80 THEN 1 ELSE 0 END) AS n_low FROM ({_colq_body()}) t(col, cpl, u)),
{_fences_cte()},
o AS (SELECT CAST(sum(n) AS BIGINT) AS total_outliers, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) AS n_outl FROM (
   {' UNION ALL '.join(f"SELECT sum(CASE WHEN {c} < f.lower OR {c} > f.upper THEN 1 ELSE 0 END) AS n FROM qf CROSS JOIN (SELECT * FROM fences WHERE col = '{c}') f" for c in QF_NUMERIC)})),
s AS (SELECT m.missing_cells * 100.0 / (m.n_rows * {len(QF_COLUMNS)}) AS missing_pct, d.duplicate_rows * 100.0 / m.n_rows AS duplicate_pct,
             comp.mean_completeness, comp.n_low, o.total_outliers, o.n_outl FROM m, d, comp, o),
sc AS (SELECT *, (100 - missing_pct) * 0.4 + (100 - least(duplicate_pct * 2, 40.0)) * 0.2 + mean_completeness * 0.2 + 100 * 0.2 AS score FROM s)
SELECT round(missing_pct, 6) AS missing_pct, round(duplicate_pct, 6) AS duplicate_pct, round(mean_completeness, 6) AS mean_completeness,
       total_outliers, round(score, 6) AS score,
       CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C' WHEN score >= 60 THEN 'D' ELSE 'F' END AS grade,
       CAST(len(list_filter([CASE WHEN missing_pct > 5 THEN 'm' END, CASE WHEN duplicate_pct > 1 THEN 'd' END,
            CASE WHEN n_low > 0 THEN 'c' END, CASE WHEN n_outl > 0 THEN 'o' END, CASE WHEN score < 80 THEN 's' END], lambda x: x IS NOT NULL)) AS BIGINT) AS n_recommendations
FROM sc""")
def q10_score(spark, sf_dir):
    s = quality_score(quality_frame(spark, sf_dir))
    return s.select(r6("missing_pct").alias("missing_pct"), r6("duplicate_pct").alias("duplicate_pct"),
                    r6("mean_completeness").alias("mean_completeness"), "total_outliers", r6("score").alias("score"),
                    "grade", F.size("recommendations").cast("bigint").alias("n_recommendations"))


# fixed rule set for the registered validation query
QF_RULES = (
    Rule("discount_completeness", "completeness", "l_discount", "error", {"min_completeness": 95.0}),
    Rule("flag_completeness", "completeness", "l_returnflag", "warning", {"min_completeness": 90.0}),
    Rule("quantity_range", "range", "l_quantity", "error", {"min_value": 1, "max_value": 49}),
    Rule("discount_range", "range", "l_discount", "error", {"min_value": 0.0, "max_value": 0.1}),
    Rule("flag_values", "categorical", "l_returnflag", "warning", {"allowed_values": ["A", "N", "R"]}),
    Rule("status_values", "categorical", "l_linestatus", "error", {"allowed_values": ["O", "F"]}),
    Rule("quantity_normal", "normality", "l_quantity", "warning", {}),
    Rule("missing_column", "range", "age", "error", {"min_value": 0, "max_value": 120}),
)


@register("Q16_validate", f"""WITH {QUALITY_FRAME},
a AS (SELECT count(*) AS n,
  sum(CASE WHEN l_discount IS NOT NULL THEN 1 ELSE 0 END) AS d_nn,
  sum(CASE WHEN l_returnflag IS NOT NULL THEN 1 ELSE 0 END) AS f_nn,
  sum(CASE WHEN l_quantity < 1 THEN 1 ELSE 0 END) + sum(CASE WHEN l_quantity > 49 THEN 1 ELSE 0 END) AS q_viol,
  sum(CASE WHEN l_discount < 0.0 THEN 1 ELSE 0 END) + sum(CASE WHEN l_discount > 0.1 THEN 1 ELSE 0 END) AS d_viol,
  sum(CASE WHEN coalesce(l_returnflag IN ('A', 'N', 'R'), false) THEN 0 ELSE 1 END) AS f_bad,
  sum(CASE WHEN coalesce(l_linestatus IN ('O', 'F'), false) THEN 0 ELSE 1 END) AS s_bad,
  count(l_quantity) AS qn, skewness(l_quantity) AS sk, kurtosis(l_quantity) AS ku FROM qf),
r AS (
  SELECT 'discount_completeness' AS rule_id, d_nn * 100.0 / n AS value, d_nn * 100.0 / n >= 95.0 AS ok, 'error' AS sev FROM a
  UNION ALL SELECT 'flag_completeness', f_nn * 100.0 / n, f_nn * 100.0 / n >= 90.0, 'warning' FROM a
  UNION ALL SELECT 'quantity_range', q_viol, q_viol = 0, 'error' FROM a
  UNION ALL SELECT 'discount_range', d_viol, d_viol = 0, 'error' FROM a
  UNION ALL SELECT 'flag_values', f_bad, f_bad = 0, 'warning' FROM a
  UNION ALL SELECT 'status_values', s_bad, s_bad = 0, 'error' FROM a
  UNION ALL SELECT 'missing_column', NULL, false, 'error' FROM a)
SELECT rule_id, CASE WHEN ok THEN 'passed' ELSE 'failed' END AS status,
       CASE WHEN ok THEN 'info' ELSE sev END AS severity, round(CAST(value AS DOUBLE), 6) AS value FROM r""")
def q16_validate(spark, sf_dir):
    """All rules from one aggregate pass (normality is checked in the unit tests: DuckDB's
    skewness/kurtosis are the corrected ones, the Jarque-Bera form uses the population ones)."""
    per_rule, _ = validate(quality_frame(spark, sf_dir), QF_RULES)
    return per_rule.where(F.col("kind") != "normality").select("rule_id", "status", "severity", r6("value").alias("value"))


@register("Q16_validate_summary", f"""WITH {QUALITY_FRAME},
a AS (SELECT count(*) AS n, sum(CASE WHEN l_discount IS NOT NULL THEN 1 ELSE 0 END) AS d_nn,
        sum(CASE WHEN l_returnflag IS NOT NULL THEN 1 ELSE 0 END) AS f_nn,
        sum(CASE WHEN l_quantity < 1 OR l_quantity > 49 THEN 1 ELSE 0 END) AS q_viol,
        sum(CASE WHEN l_discount < 0.0 OR l_discount > 0.1 THEN 1 ELSE 0 END) AS d_viol,
        sum(CASE WHEN coalesce(l_returnflag IN ('A', 'N', 'R'), false) THEN 0 ELSE 1 END) AS f_bad,
        sum(CASE WHEN coalesce(l_linestatus IN ('O', 'F'), false) THEN 0 ELSE 1 END) AS s_bad,
        count(l_quantity) AS qn, avg(l_quantity) AS mu FROM qf),
mo AS (SELECT avg(power(l_quantity - mu, 2)) AS m2, avg(power(l_quantity - mu, 3)) AS m3, avg(power(l_quantity - mu, 4)) AS m4 FROM qf, a),
r AS (
  SELECT d_nn * 100.0 / n >= 95.0 AS ok, 'error' AS sev FROM a
  UNION ALL SELECT f_nn * 100.0 / n >= 90.0, 'warning' FROM a
  UNION ALL SELECT q_viol = 0, 'error' FROM a
  UNION ALL SELECT d_viol = 0, 'error' FROM a
  UNION ALL SELECT f_bad = 0, 'warning' FROM a
  UNION ALL SELECT s_bad = 0, 'error' FROM a
  UNION ALL SELECT exp(-(qn / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4.0)) / 2.0) > 0.05, 'warning' FROM a, mo
  UNION ALL SELECT false, 'error'),
s AS (SELECT count(*) AS n_rules, CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS n_passed,
             CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS n_failed,
             CAST(sum(CASE WHEN NOT ok AND sev = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n_errors,
             CAST(sum(CASE WHEN NOT ok AND sev = 'warning' THEN 1 ELSE 0 END) AS BIGINT) AS n_warnings FROM r)
SELECT *, CASE WHEN n_errors > 0 THEN 'failed' WHEN n_warnings > 0 THEN 'passed_with_warnings' ELSE 'passed' END AS overall FROM s""")
def q16_summary(spark, sf_dir):
    _, summary = validate(quality_frame(spark, sf_dir), QF_RULES)
    return summary


QF_SUITE = {
    "expectation_suite_name": "quality_frame",
    "expectations": [
        {"expectation_type": "expect_table_columns_to_match_ordered_list", "kwargs": {"column_list": list(QF_COLUMNS)}},
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "l_quantity"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "l_discount"}},
        {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "l_returnflag", "value_set": ["A", "N"]}},
        {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "l_quantity", "min_value": 1, "max_value": 50}},
        {"expectation_type": "expect_column_values_to_be_of_type", "kwargs": {"column": "l_quantity", "type_": "double"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "time"}},
    ],
}


@register("Q17_expectations", f"""WITH {QUALITY_FRAME}
SELECT * FROM (VALUES
 (0, 'expect_table_columns_to_match_ordered_list', CAST(NULL AS VARCHAR), true, CAST(0 AS BIGINT)),
 (1, 'expect_column_to_exist', 'l_quantity', true, CAST(0 AS BIGINT)),
 (2, 'expect_column_values_to_not_be_null', 'l_discount', (SELECT count(*) FROM qf WHERE l_discount IS NULL) = 0,
     (SELECT count(*) FROM qf WHERE l_discount IS NULL)),
 (3, 'expect_column_values_to_be_in_set', 'l_returnflag', (SELECT count(*) FROM qf WHERE l_returnflag NOT IN ('A', 'N')) = 0,
     (SELECT count(*) FROM qf WHERE l_returnflag NOT IN ('A', 'N'))),
 (4, 'expect_column_values_to_be_between', 'l_quantity', (SELECT count(*) FROM qf WHERE l_quantity < 1 OR l_quantity > 50) = 0,
     (SELECT count(*) FROM qf WHERE l_quantity < 1 OR l_quantity > 50)),
 (5, 'expect_column_values_to_be_of_type', 'l_quantity', true, CAST(0 AS BIGINT)),
 (6, 'expect_column_values_to_not_be_null', 'time', false, CAST(NULL AS BIGINT))
) t(idx, expectation, "column", success, unexpected_count)""")
def q17_expectations(spark, sf_dir):
    return expectations(quality_frame(spark, sf_dir), QF_SUITE)


@register("Q18_cohort_checks", f"""WITH {COHORT_ORDERS}, a AS (SELECT count(*) AS n, avg(event) AS rate FROM cohort)
SELECT 'sample_size' AS "check", CASE WHEN n < 50 THEN 'error' WHEN n < 200 THEN 'warning' ELSE 'ok' END AS level, CAST(n AS DOUBLE) AS value FROM a
UNION ALL SELECT 'event_rate', CASE WHEN rate < 0.1 OR rate > 0.9 THEN 'warning' ELSE 'ok' END, round(rate, 6) FROM a
UNION ALL SELECT 'missing_pct', 'ok', 0.0 FROM a""")
def q18_cohort_checks(spark, sf_dir):
    c = cohort_checks(cohort_orders(spark, sf_dir))
    return c.select("check", "level", r6("value").alias("value"))


@register("Q20_drop_duplicates", f"WITH {QUALITY_FRAME} SELECT DISTINCT * FROM qf")
def q20_dedup(spark, sf_dir):
    return drop_duplicates(quality_frame(spark, sf_dir))


@register("Q21_cleanse_missing", f"""WITH {QUALITY_FRAME},
c AS (SELECT avg(l_discount) AS d_fill, mode(l_returnflag ORDER BY l_returnflag) AS f_fill FROM qf)
SELECT l_orderkey, l_linenumber, l_quantity, coalesce(l_returnflag, (SELECT min(l_returnflag) FROM
         (SELECT l_returnflag, count(*) AS k FROM qf WHERE l_returnflag IS NOT NULL GROUP BY 1
          QUALIFY k = max(k) OVER ()))) AS l_returnflag,
       l_linestatus, round(coalesce(l_discount, c.d_fill), 6) AS l_discount
FROM qf CROSS JOIN c""")
def q21_cleanse(spark, sf_dir):
    c = cleanse_missing(quality_frame(spark, sf_dir))
    return c.withColumn("l_discount", r6("l_discount"))


@register("Q22_remove_outliers", f"""WITH {QUALITY_FRAME},
f1 AS (SELECT quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.75) AS q3 FROM qf),
s1 AS (SELECT qf.* FROM qf, f1 WHERE l_quantity >= q1 - 1.5 * (q3 - q1) AND l_quantity <= q3 + 1.5 * (q3 - q1)),
f2 AS (SELECT quantile_cont(l_discount, 0.25) AS q1, quantile_cont(l_discount, 0.75) AS q3 FROM s1)
SELECT s1.* FROM s1, f2 WHERE l_discount >= q1 - 1.5 * (q3 - q1) AND l_discount <= q3 + 1.5 * (q3 - q1)""")
def q22_remove_outliers(spark, sf_dir):
    return remove_outliers(quality_frame(spark, sf_dir), ["l_quantity", "l_discount"])


@register("Q8_isolation_scores")
def q8_isolation(spark, sf_dir):
    """Rows-only: isolation-forest flags on the quality frame's numeric columns (share flagged
    is about the contamination, 10 %)."""
    from tte.operators.quality import isolation_scores

    s = isolation_scores(quality_frame(spark, sf_dir), ["l_quantity", "l_discount", "l_linenumber"], trees=50)
    return s.groupBy("is_anomaly").agg(F.count(F.lit(1)).alias("n"), F.avg("anomaly_score").alias("mean_score"))


@register("Q9_domain_checks", f"""WITH {QUALITY_FRAME}, q AS (SELECT l_quantity AS age, l_discount * 100 AS sofa, l_linestatus AS sex FROM qf)
SELECT * FROM (
  SELECT 'age_too_high' AS "check", 'age' AS "column", 'warning' AS level, CAST(sum(CASE WHEN age > 150 THEN 1 ELSE 0 END) AS BIGINT) AS n_rows FROM q
  UNION ALL SELECT 'age_negative', 'age', 'error', CAST(sum(CASE WHEN age < 0 THEN 1 ELSE 0 END) AS BIGINT) FROM q
  UNION ALL SELECT 'sofa_negative', 'sofa', 'error', CAST(sum(CASE WHEN sofa < 0 THEN 1 ELSE 0 END) AS BIGINT) FROM q
  UNION ALL SELECT 'sofa_too_high', 'sofa', 'error', CAST(sum(CASE WHEN sofa > 24 THEN 1 ELSE 0 END) AS BIGINT) FROM q
  UNION ALL SELECT 'values_sex', 'sex', 'warning', CAST(sum(CASE WHEN sex IS NOT NULL AND lower(sex) NOT IN ('male', 'female', 'm', 'f', '0', '1') THEN 1 ELSE 0 END) AS BIGINT) FROM q)
WHERE n_rows > 0""")
def q9_domain(spark, sf_dir):
    """The reference's clinical checks on renamed columns: quantity as age, discount x 100 as SOFA,
    line status as sex (O is not an accepted value)."""
    from tte.operators.quality import domain_checks

    q = quality_frame(spark, sf_dir).select(F.col("l_quantity").alias("age"), (F.col("l_discount") * 100).alias("sofa"),
                                            F.col("l_linestatus").alias("sex"))
    return domain_checks(q)


@register("Q15_rule_normality", f"""WITH {QUALITY_FRAME},
m AS (SELECT count(l_quantity) AS n, avg(l_quantity) AS mu FROM qf),
c AS (SELECT n, avg(power(l_quantity - mu, 2)) AS m2, avg(power(l_quantity - mu, 3)) AS m3, avg(power(l_quantity - mu, 4)) AS m4 FROM qf, m GROUP BY n),
j AS (SELECT n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4.0) AS jb FROM c)
SELECT round(exp(-jb / 2.0), 6) AS p_value, exp(-jb / 2.0) > 0.05 AS passed FROM j""")
def q15_normality(spark, sf_dir):
    """Jarque-Bera from the population moments; p = exp(-JB / 2) (chi-square, 2 dof)."""
    per, _ = validate(quality_frame(spark, sf_dir), [Rule("n", "normality", "l_quantity", "warning", {})])
    return per.select(r6("value").alias("p_value"), (F.col("status") == "passed").alias("passed"))


@register("Q23_cleanse")
def q23_cleanse(spark, sf_dir):
    """Rows-only: dedupe -> fill -> outlier removal with the step summary."""
    from tte.operators.quality import cleanse

    _, summary = cleanse(quality_frame(spark, sf_dir), ["l_quantity", "l_discount"])
    return summary


@register("Q12_rule_completeness", f"""WITH {QUALITY_FRAME}
SELECT round(sum(CASE WHEN l_discount IS NOT NULL THEN 1 ELSE 0 END) * 100.0 / count(*), 6) AS value,
       sum(CASE WHEN l_discount IS NOT NULL THEN 1 ELSE 0 END) * 100.0 / count(*) >= 85.0 AS passed FROM qf""")
def q12_completeness(spark, sf_dir):
    per, _ = validate(quality_frame(spark, sf_dir), [Rule("c", "completeness", "l_discount", "error", {"min_completeness": 85.0})])
    return per.select(r6("value").alias("value"), (F.col("status") == "passed").alias("passed"))


@register("Q13_rule_range", f"""WITH {QUALITY_FRAME}
SELECT CAST(sum(CASE WHEN l_quantity < 5 THEN 1 ELSE 0 END) + sum(CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM qf""")
def q13_range(spark, sf_dir):
    per, _ = validate(quality_frame(spark, sf_dir), [Rule("r", "range", "l_quantity", "error", {"min_value": 5, "max_value": 45})])
    return per.select("violations")


@register("Q14_rule_categorical", f"""WITH {QUALITY_FRAME}
SELECT CAST(sum(CASE WHEN coalesce(l_returnflag IN ('A', 'R'), false) THEN 0 ELSE 1 END) AS BIGINT) AS violations,
       list_sort(list(DISTINCT coalesce(l_returnflag, 'null')) FILTER (WHERE NOT coalesce(l_returnflag IN ('A', 'R'), false)))[1:5] AS examples
FROM qf""")
def q14_categorical(spark, sf_dir):
    """Values outside {A, R}; null counts as bad; up to five sorted examples."""
    per, _ = validate(quality_frame(spark, sf_dir), [Rule("k", "categorical", "l_returnflag", "error", {"allowed_values": ["A", "R"]})])
    return per.select("violations", "examples")
