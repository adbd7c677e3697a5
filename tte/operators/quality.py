"""Data profiling, validation and cleansing (Q1-Q23).

Every profile is one wide ``agg`` pass (plus the exact-quantile pass where quantiles are asked
for), reshaped to long rows ``(column, metric...)``. ``exact=False`` swaps exact quantiles and
distinct counts for ``percentile_approx`` / ``approx_count_distinct`` at scale.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tte.operators.stats import (
    corrected_kurt, corrected_skew, distinct_counts, exact_quantiles, melt, most_frequent, numeric_columns, text_columns,
    value_counts,
)


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], exact: bool) -> DataFrame:
    if exact:
        return exact_quantiles(df, cols, probs)
    rows = df.agg(*[F.percentile_approx(_q(c).cast("double"), list(probs), 10000).alias(c) for c in cols])
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("qs")) for c in cols])
    ex = rows.select(F.explode(arr).alias("_r")).select("_r.column", F.posexplode("_r.qs").alias("_i", "q"))
    pmap = F.array(*[F.lit(float(p)) for p in probs])
    return ex.select("column", F.element_at(pmap, F.col("_i") + 1).alias("p"), "q")


def profile_columns(df: DataFrame, exact: bool = True) -> DataFrame:
    """Q1: one row per column: dtype, n_total, n_missing, missing_pct, n_unique and for numeric
    columns mean, sample std, min, max, median, q25, q75, bias-corrected skew and kurtosis."""
    num = numeric_columns(df)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in df.columns:
        aggs.append(F.sum(_q(c).isNull().cast("long")).alias(f"{c}__miss"))
        aggs.append((F.countDistinct(_q(c)) if exact else F.approx_count_distinct(_q(c))).alias(f"{c}__uniq"))
    for c in num:
        x = _q(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max"), F.skewness(x).alias(f"{c}__g1"), F.kurtosis(x).alias(f"{c}__g2"),
                 F.count(x).alias(f"{c}__cnt")]
    wide = df.agg(*aggs)
    dtypes = dict(df.dtypes)
    structs = []
    for c in df.columns:
        isnum = c in num
        nn = F.col(f"`{c}__cnt`").cast("double") if isnum else None
        structs.append(F.struct(
            F.lit(c).alias("column"), F.lit(dtypes[c]).alias("dtype"),
            F.col("_n").alias("n_total"), F.col(f"`{c}__miss`").alias("n_missing"),
            (F.col(f"`{c}__miss`") * 100.0 / F.col("_n")).alias("missing_pct"),
            F.col(f"`{c}__uniq`").alias("n_unique"),
            *[(F.col(f"`{c}__{m}`") if isnum else F.lit(None).cast("double")).alias(m)
              for m in ("mean", "std", "min", "max")],
            (corrected_skew(F.col(f"`{c}__g1`"), nn) if isnum else F.lit(None).cast("double")).alias("skewness"),
            (corrected_kurt(F.col(f"`{c}__g2`"), nn) if isnum else F.lit(None).cast("double")).alias("kurtosis"),
        ))
    long = wide.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")
    if not num:
        return long.withColumn("q25", F.lit(None).cast("double")).withColumn("median", F.lit(None).cast("double")) \
            .withColumn("q75", F.lit(None).cast("double"))
    qt = _quantile_table(df, num, [0.25, 0.5, 0.75], exact)
    qw = qt.groupBy("column").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q"))
    qw = qw.select("column", F.col("`0.25`").alias("q25"), F.col("`0.5`").alias("median"), F.col("`0.75`").alias("q75"))
    return long.join(qw, "column", "left")


def top_values(df: DataFrame, cols: Sequence[str], k: int = 10) -> DataFrame:
    """Q2: the ``k`` most frequent non-null values per column (count desc, then value), from one table
    of value counts. The rank filter becomes a group limit below the shuffle, so each task passes on
    at most ``k`` rows a column."""
    rank = Window.partitionBy("column").orderBy(F.col("n").desc(), "value")
    return (value_counts(df, cols).withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= k)
            .select("column", "value", F.col("n").alias("count")))


def profile_survival(df: DataFrame, time: str = "time", event: str = "event", exact: bool = True) -> DataFrame:
    """Q3: events, censored, event rate, time stats, mean time by status, KM median, S(365) and
    S(1825) when within the largest time (else null)."""
    from tte.operators.curves import curve_at, km_curves, km_quantile

    t, e = F.col(time).cast("double"), F.col(event)
    base = df.agg(
        F.sum((e == 1).cast("long")).alias("n_events"), F.sum((e == 0).cast("long")).alias("n_censored"),
        (F.sum((e == 1).cast("long")) / F.count(F.lit(1))).alias("event_rate"),
        F.min(t).alias("time_min"), F.max(t).alias("time_max"), F.avg(t).alias("time_mean"),
        F.stddev_samp(t).alias("time_std"),
        F.avg(F.when(e == 1, t)).alias("event_time_mean"), F.avg(F.when(e == 0, t)).alias("censored_time_mean"),
    )
    med = _quantile_table(df.select(t.alias("time")), ["time"], [0.5], exact).select(F.col("q").alias("time_median"))
    km = km_curves(df, time, event).select("time", "surv")
    kmq = km_quantile(km, 0.5).select(F.col("time_at_p").alias("km_median"))
    at = curve_at(km, [365.0, 1825.0], "surv", "step")
    atw = at.groupBy().pivot("horizon", [365.0, 1825.0]).agg(F.first("surv"))
    atw = atw.select(F.col("`365.0`").alias("_s1"), F.col("`1825.0`").alias("_s5"))
    j = base.crossJoin(med).crossJoin(kmq).crossJoin(atw)
    return j.select(
        "*",
        F.when(F.col("time_max") >= 365.0, F.col("_s1")).alias("km_1year"),
        F.when(F.col("time_max") >= 1825.0, F.col("_s5")).alias("km_5year"),
    ).drop("_s1", "_s5")


def correlations(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q4: pairwise Pearson correlation (pairs with a null dropped), long ``(col_a, col_b, corr)``
    for each unordered pair, one ``agg`` pass."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    wide = df.agg(*[F.corr(_q(a).cast("double"), _q(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    arr = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"`{a}__{b}`").alias("corr"))
                    for a, b in pairs])
    return wide.select(F.explode(arr).alias("_r")).select("_r.*")


def profile_flags(profile: DataFrame) -> DataFrame:
    """Q5: flags on Q1 rows: highly missing (> 50 %), constant (<= 1 distinct), highly cardinal
    (distinct > 0.9 n)."""
    return profile.select(
        "column",
        (F.col("missing_pct") > 50).alias("is_highly_missing"),
        (F.col("n_unique") <= 1).alias("is_constant"),
        (F.col("n_unique") > 0.9 * F.col("n_total")).alias("is_highly_cardinal"),
    )


def quality_metrics(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q6: (dataset row, per-column rows).

    Dataset: rows, columns, missing cells and %, duplicate rows (repeats after the first, nulls
    equal) and %. Per column: completeness % and, for text columns, uniqueness % (distinct / rows).
    Duplicates are ``sum(count - 1)`` over a group-by of all columns (partial aggregation first).
    """
    ncols = len(df.columns)
    txt = set(text_columns(df))
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.sum(_q(c).isNull().cast("long")).alias(f"{c}__miss") for c in df.columns])
    dup = df.groupBy(*[_q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_c")).agg(
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))
    miss = sum((F.col(f"`{c}__miss`") for c in df.columns), F.lit(0).cast("long"))
    ds = wide.crossJoin(dup).select(
        "n_rows", F.lit(ncols).alias("n_columns"), miss.alias("missing_cells"),
        (miss * 100.0 / (F.col("n_rows") * ncols)).alias("missing_pct"),
        "duplicate_rows", (F.col("duplicate_rows") * 100.0 / F.col("n_rows")).alias("duplicate_pct"),
    )
    cols = F.array(*[F.struct(
        F.lit(c).alias("column"),
        ((1 - F.col(f"`{c}__miss`") / F.col("n_rows")) * 100.0).alias("completeness"),
        F.when(F.lit(c in txt), F.col("n_rows")).alias("_of"),
    ) for c in df.columns])
    per_col = wide.select(F.explode(cols).alias("_r")).select("_r.*")
    if not txt:
        return ds, per_col.select("column", "completeness", F.lit(None).cast("double").alias("uniqueness"))
    # one row per text column
    distinct = F.broadcast(distinct_counts(df, sorted(txt)).select("column", "n_distinct"))
    return ds, per_col.join(distinct, "column", "left").select(
        "column", "completeness", (F.coalesce("n_distinct", F.lit(0)) * 100.0 / F.col("_of")).alias("uniqueness"))


def iqr_fences(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Q7 helper: ``column, q1, q3, lower, upper`` with lower/upper = q1 -+ 1.5 IQR."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    qt = _quantile_table(df, cols, [0.25, 0.75], exact)
    w = qt.groupBy("column").pivot("p", [0.25, 0.75]).agg(F.first("q"))
    w = w.select("column", F.col("`0.25`").alias("q1"), F.col("`0.75`").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return w.select("column", "q1", "q3", (F.col("q1") - 1.5 * iqr).alias("lower"), (F.col("q3") + 1.5 * iqr).alias("upper"))


def iqr_outliers(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Q7: per numeric column the count of values outside the IQR fences (nulls never count).
    Fences are one small row per column, broadcast; the count is one pass over the melted values."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    f = iqr_fences(df, cols, exact)
    long = melt(df, cols)
    j = long.join(F.broadcast(f), "column")
    out = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return j.groupBy("column").agg(F.sum(F.coalesce(out, F.lit(False)).cast("long")).alias("outliers"))


# fixed advice texts of the quality report
ADVICE_MISSING = "High missing value rate. Consider data imputation or investigate data collection process."
ADVICE_DUPLICATES = "Significant duplicate rate. Review data deduplication procedures."
ADVICE_COMPLETENESS = "Low completeness in some columns. Prioritize data collection for these fields."
ADVICE_OUTLIERS = "Outliers detected. Review outlier handling strategy."
ADVICE_SCORE = ("Overall data quality is below acceptable threshold. "
                "Consider comprehensive data quality improvement program.")


def quality_score(df: DataFrame, outlier_term: str = "reference", exact: bool = True) -> DataFrame:
    """Q10: score = .4 (100 - missing %) + .2 (100 - min(2 dup %, 40)) + .2 mean completeness
    + .2 (100 - outlier penalty); grade A/B/C/D/F at 90/80/70/60; advice list.

    ``outlier_term="reference"``: the reference divides by an empty frame's cell count, so the
    penalty is always 0; ``"cells"``: min(100 x outliers / numeric cells, 20).
    """
    ds, per_col = quality_metrics(df)
    comp = per_col.agg(F.avg("completeness").alias("mean_completeness"),
                       F.sum((F.col("completeness") < 80).cast("int")).alias("_n_low"))
    num = numeric_columns(df)
    outl = iqr_outliers(df, num, exact).agg(F.coalesce(F.sum("outliers"), F.lit(0)).alias("total_outliers"),
                                           F.sum((F.col("outliers") > 0).cast("int")).alias("_n_outl_cols"))
    j = ds.crossJoin(comp).crossJoin(outl)
    if outlier_term == "cells":
        pen = F.least(F.col("total_outliers") * 100.0 / (F.col("n_rows") * max(len(num), 1)), F.lit(20.0))
    else:
        pen = F.lit(0.0)
    score = ((100 - F.col("missing_pct")) * 0.4 + (100 - F.least(F.col("duplicate_pct") * 2, F.lit(40.0))) * 0.2
             + F.col("mean_completeness") * 0.2 + (100 - pen) * 0.2)
    j = j.withColumn("score", score)
    grade = (F.when(F.col("score") >= 90, "A").when(F.col("score") >= 80, "B").when(F.col("score") >= 70, "C")
             .when(F.col("score") >= 60, "D").otherwise("F"))
    advice = F.filter(F.array(
        F.when(F.col("missing_pct") > 5, F.lit(ADVICE_MISSING)),
        F.when(F.col("duplicate_pct") > 1, F.lit(ADVICE_DUPLICATES)),
        F.when(F.col("_n_low") > 0, F.lit(ADVICE_COMPLETENESS)),
        F.when(F.col("_n_outl_cols") > 0, F.lit(ADVICE_OUTLIERS)),
        F.when(F.col("score") < 80, F.lit(ADVICE_SCORE)),
    ), lambda x: x.isNotNull())
    return j.select("missing_pct", "duplicate_pct", "mean_completeness", "total_outliers", "score",
                    grade.alias("grade"), advice.alias("recommendations"))


@dataclass(frozen=True)
class Rule:
    """A validation rule: ``kind`` in completeness / range / categorical / normality."""

    rule_id: str
    kind: str
    column: str
    severity: str = "error"
    params: dict = field(default_factory=dict)


def _rule_aggs(df: DataFrame, rules: Sequence[Rule]) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("_n")]
    for r in rules:
        if r.column not in df.columns:
            continue
        c = _q(r.column)
        p = f"{r.rule_id}__"
        if r.kind == "completeness":
            aggs.append(F.sum(c.isNotNull().cast("long")).alias(p + "nn"))
        elif r.kind == "range":
            lo, hi = r.params.get("min_value"), r.params.get("max_value")
            aggs.append(F.sum((c < lo).cast("long") if lo is not None else F.lit(0)).alias(p + "below"))
            aggs.append(F.sum((c > hi).cast("long") if hi is not None else F.lit(0)).alias(p + "above"))
        elif r.kind == "categorical":
            allowed = list(r.params.get("allowed_values", []))
            bad = ~F.coalesce(c.cast("string").isin(allowed), F.lit(False))
            aggs.append(F.sum(bad.cast("long")).alias(p + "bad"))
        elif r.kind == "normality":
            x = c.cast("double")
            aggs += [F.count(x).alias(p + "n"), F.skewness(x).alias(p + "g1"), F.kurtosis(x).alias(p + "g2")]
    return aggs


def _bad_examples(df: DataFrame, rules: Sequence[Rule], k: int = 5) -> DataFrame:
    """``rule_id, _examples``: the ``k`` smallest distinct offending values of each categorical rule. The
    values are made distinct and ranked in Spark, which keeps the first ``k`` before the shuffle."""
    found = []
    for r in rules:
        if r.kind == "categorical" and r.column in df.columns:
            c = _q(r.column).cast("string")
            bad = ~F.coalesce(c.isin(list(r.params.get("allowed_values", []))), F.lit(False))
            found.append(F.struct(F.lit(r.rule_id).alias("rule_id"), F.when(bad, F.coalesce(c, F.lit("null"))).alias("value")))
    if not found:
        return df.sparkSession.createDataFrame([], "rule_id string, _examples array<string>")
    values = df.select(F.explode(F.array(*found)).alias("x")).select("x.*").where(F.col("value").isNotNull()).distinct()
    first = Window.partitionBy("rule_id").orderBy("value")
    kept = values.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= k)
    return kept.groupBy("rule_id").agg(F.array_sort(F.collect_list("value")).alias("_examples"))


def validate(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Q12-Q16: every rule evaluated from ONE aggregate pass (and one more for the examples of categorical
    rules); returns (per-rule rows, summary).

    completeness: pass if % non-null >= min_completeness (default 95). range: counts below/above,
    nulls pass. categorical: values outside the allowed list, null counts as bad, up to five
    examples. normality: Jarque-Bera p = exp(-JB/2) > 0.05 (the reference's Shapiro-Wilk needs
    the whole column in one place). A missing column or unknown kind fails with severity error.
    Summary: failed if any failed rule has severity error, passed_with_warnings if only warnings.
    """
    wide = df.agg(*_rule_aggs(df, rules))
    rows = []
    for r in rules:
        p = f"`{r.rule_id}__"
        if r.column not in df.columns or r.kind not in ("completeness", "range", "categorical", "normality"):
            rows.append(F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.kind).alias("kind"),
                                 F.lit(r.column).alias("column"), F.lit("failed").alias("status"),
                                 F.lit("error").alias("severity"), F.lit(None).cast("double").alias("value"),
                                 F.lit(None).cast("long").alias("violations"),
                                 F.lit(None).cast("array<string>").alias("examples")))
            continue
        if r.kind == "completeness":
            val = F.col(p + "nn`") * 100.0 / F.col("_n")
            ok = val >= float(r.params.get("min_completeness", 95.0))
            viol = F.col("_n") - F.col(p + "nn`")
            ex = F.lit(None).cast("array<string>")
        elif r.kind == "range":
            viol = F.col(p + "below`") + F.col(p + "above`")
            val = viol.cast("double")
            ok = viol == 0
            ex = F.lit(None).cast("array<string>")
        elif r.kind == "categorical":
            viol = F.col(p + "bad`")
            val = viol.cast("double")
            ok = viol == 0
            ex = F.array().cast("array<string>")
        else:
            n = F.col(p + "n`").cast("double")
            jb = n / 6.0 * (F.col(p + "g1`") ** 2 + (F.col(p + "g2`") ** 2) / 4.0)
            val = F.exp(-jb / 2.0)
            ok = F.coalesce(val > 0.05, F.lit(False))
            viol = F.lit(None).cast("long")
            ex = F.lit(None).cast("array<string>")
        rows.append(F.struct(
            F.lit(r.rule_id).alias("rule_id"), F.lit(r.kind).alias("kind"), F.lit(r.column).alias("column"),
            F.when(ok, "passed").otherwise("failed").alias("status"),
            F.when(ok, "info").otherwise(F.lit(r.severity)).alias("severity"),
            val.cast("double").alias("value"), viol.cast("long").alias("violations"), ex.alias("examples"),
        ))
    per_rule = wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
    if any(r.kind == "categorical" for r in rules):
        per_rule = (per_rule.join(_bad_examples(df, rules), "rule_id", "left")
                    .withColumn("examples", F.coalesce("_examples", "examples")).drop("_examples"))
    summary = per_rule.agg(
        F.count(F.lit(1)).alias("n_rules"),
        F.sum((F.col("status") == "passed").cast("int")).alias("n_passed"),
        F.sum((F.col("status") == "failed").cast("int")).alias("n_failed"),
        F.sum(((F.col("status") == "failed") & (F.col("severity") == "error")).cast("int")).alias("n_errors"),
        F.sum(((F.col("status") == "failed") & (F.col("severity") == "warning")).cast("int")).alias("n_warnings"),
    ).withColumn("overall", F.when(F.col("n_errors") > 0, "failed").when(F.col("n_warnings") > 0, "passed_with_warnings")
                 .otherwise("passed"))
    return per_rule, summary


def expectations(df: DataFrame, suite: dict | str) -> DataFrame:
    """Q17: an expectation suite (JSON text or dict, great_expectations style) checked in one pass:
    ``expect_table_columns_to_match_ordered_list``, ``expect_column_to_exist``,
    ``expect_column_values_to_not_be_null``, ``expect_column_values_to_be_in_set``,
    ``expect_column_values_to_be_of_type``, ``expect_column_values_to_be_between``."""
    if isinstance(suite, str):
        suite = json.loads(suite)
    exps = suite.get("expectations", [])
    dtypes = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_n")]
    rows = []
    for i, e in enumerate(exps):
        kind = e.get("expectation_type")
        kw = e.get("kwargs", {})
        col = kw.get("column")
        name = f"e{i}"
        if kind == "expect_table_columns_to_match_ordered_list":
            ok, unexpected = F.lit(list(kw.get("column_list", [])) == list(df.columns)), F.lit(0).cast("long")
        elif kind == "expect_column_to_exist":
            ok, unexpected = F.lit(col in df.columns), F.lit(0).cast("long")
        elif col not in df.columns:
            ok, unexpected = F.lit(False), F.lit(None).cast("long")
        elif kind == "expect_column_values_to_not_be_null":
            aggs.append(F.sum(_q(col).isNull().cast("long")).alias(name))
            ok, unexpected = F.col(name) == 0, F.col(name)
        elif kind == "expect_column_values_to_be_in_set":
            vals = [str(v) for v in kw.get("value_set", [])]
            aggs.append(F.sum((_q(col).isNotNull() & ~_q(col).cast("string").isin(vals)).cast("long")).alias(name))
            ok, unexpected = F.col(name) == 0, F.col(name)
        elif kind == "expect_column_values_to_be_between":
            lo, hi = kw.get("min_value"), kw.get("max_value")
            bad = F.lit(False)
            if lo is not None:
                bad = bad | (_q(col) < lo)
            if hi is not None:
                bad = bad | (_q(col) > hi)
            aggs.append(F.sum(F.coalesce(bad, F.lit(False)).cast("long")).alias(name))
            ok, unexpected = F.col(name) == 0, F.col(name)
        elif kind == "expect_column_values_to_be_of_type":
            want = str(kw.get("type_", kw.get("type", ""))).lower()
            ok, unexpected = F.lit(want in dtypes[col].lower() or dtypes[col].lower() in want), F.lit(0).cast("long")
        else:
            ok, unexpected = F.lit(False), F.lit(None).cast("long")
        rows.append(F.struct(F.lit(i).alias("idx"), F.lit(kind).alias("expectation"), F.lit(col).alias("column"),
                             ok.alias("success"), unexpected.alias("unexpected_count")))
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def cohort_checks(df: DataFrame, event: str = "event") -> DataFrame:
    """Q18: sample size (< 50 error, < 200 warning), event rate (< .1 or > .9 warning) and
    missing share (> 20 % error, > 5 % warning) as rows ``check, level, value``."""
    ncols = len(df.columns)
    miss = sum((_q(c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    a = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(event).cast("double")).alias("rate"),
               (F.sum(miss) * 100.0 / (F.count(F.lit(1)) * ncols)).alias("miss"))
    rows = F.array(
        F.struct(F.lit("sample_size").alias("check"),
                 F.when(F.col("n") < 50, "error").when(F.col("n") < 200, "warning").otherwise("ok").alias("level"),
                 F.col("n").cast("double").alias("value")),
        F.struct(F.lit("event_rate").alias("check"),
                 F.when((F.col("rate") < 0.1) | (F.col("rate") > 0.9), "warning").otherwise("ok").alias("level"),
                 F.col("rate").alias("value")),
        F.struct(F.lit("missing_pct").alias("check"),
                 F.when(F.col("miss") > 20, "error").when(F.col("miss") > 5, "warning").otherwise("ok").alias("level"),
                 F.col("miss").alias("value")),
    )
    return a.select(F.explode(rows).alias("_r")).select("_r.*")


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Q20: whole-row duplicates removed (first kept; nulls equal)."""
    return df.dropDuplicates()


# fixed value: numeric columns the reference fills with the median instead of the mean
MEDIAN_FILL_COLUMNS = ("age", "sofa")


def cleanse_missing(df: DataFrame, median_cols: Sequence[str] = MEDIAN_FILL_COLUMNS, drop_above_pct: float = 50.0,
                    exact: bool = True) -> DataFrame:
    """Q21: drop columns more than 50 % missing; fill the rest: median for ``median_cols``, mean for
    other numbers, most frequent value (smallest on ties) or "unknown" for text.
    Constants come from one aggregate pass (plus exact medians), then one ``select``."""
    num = set(numeric_columns(df))
    means = [c for c in df.columns if c in num and c not in median_cols]
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(_q(c).isNull().cast("long")).alias(f"{c}__miss") for c in df.columns],
                 *[F.avg(_q(c)).alias(f"{c}__fill") for c in means]).first()
    kept = [c for c in df.columns if not row["_n"] or (row[f"{c}__miss"] or 0) * 100.0 / row["_n"] <= drop_above_pct]
    fill = {c: row[f"{c}__fill"] for c in means}
    gaps = [c for c in kept if row[f"{c}__miss"]]
    medians = [c for c in gaps if c in num and c in median_cols]
    if medians:
        fill |= {r["column"]: r["q"] for r in _quantile_table(df, medians, [0.5], exact).collect()}
    fill |= {c: "unknown" if v is None else v for c, v in most_frequent(df, [c for c in gaps if c not in num]).items()}
    # the constants are numbers and short texts of the driver: literals, so the plan is one projection
    return df.select(*[F.coalesce(_q(c), F.lit(fill[c]).cast(df.schema[c].dataType)).alias(c)
                       if c in gaps and fill.get(c) is not None else _q(c).alias(c) for c in kept])


def remove_outliers(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Q22: keep rows inside the IQR fences, column by column with the fences recomputed on what is
    left (rows with a null in the column go too, as the comparison drops them). Each column's two
    fences come to the driver and enter the next plan as literals, so the plan is a chain of filters
    over one scan, however many columns there are."""
    out = df
    for c in cols:
        f = iqr_fences(out, [c], exact).select("lower", "upper").first()
        if f is None or f["lower"] is None:
            return out.limit(0)
        out = out.where((_q(c) >= F.lit(f["lower"])) & (_q(c) <= F.lit(f["upper"])))
    return out


# fixed values of the reference's domain checks: (check id, column, condition, level)
DOMAIN_RULES = (
    ("age_negative", "age", "< 0", "error"),
    ("age_too_high", "age", "> 150", "warning"),
    ("sofa_negative", "sofa", "< 0", "error"),
    ("sofa_too_high", "sofa", "> 24", "error"),
)
# fixed values: accepted spellings of sex / gender
SEX_VALUES = ("male", "female", "m", "f", "0", "1")


def domain_checks(df: DataFrame, rules=DOMAIN_RULES, numeric_expect: Sequence[str] = (),
                  sex_columns: Sequence[str] = ("sex", "gender")) -> DataFrame:
    """Q9: data-driven clinical range checks in one aggregate: each (column, condition) rule that
    applies to an existing column counts offending rows; listed numeric columns that are not
    numeric are a type mismatch; sex/gender columns with other values are flagged.
    Output rows ``check, column, level, n_rows`` for the checks that fire."""
    num = set(numeric_columns(df))
    aggs, meta = [F.count(F.lit(1)).alias("_n")], []
    for cid, col, cond, level in rules:
        if col in df.columns:
            aggs.append(F.sum(F.coalesce(F.expr(f"`{col}` {cond}"), F.lit(False)).cast("long")).alias(cid))
            meta.append((cid, col, level))
    for col in numeric_expect:
        if col in df.columns and col not in num:
            aggs.append(F.lit(1).cast("long").alias(f"type_{col}"))
            meta.append((f"type_{col}", col, "error"))
    for col in sex_columns:
        if col in df.columns:
            bad = _q(col).isNotNull() & ~F.lower(_q(col).cast("string")).isin(list(SEX_VALUES))
            aggs.append(F.sum(bad.cast("long")).alias(f"values_{col}"))
            meta.append((f"values_{col}", col, "warning"))
    wide = df.agg(*aggs)
    if not meta:
        return df.sparkSession.createDataFrame([], "check string, column string, level string, n_rows long")
    arr = F.array(*[F.struct(F.lit(c).alias("check"), F.lit(col).alias("column"), F.lit(lv).alias("level"),
                             F.col(c).cast("long").alias("n_rows")) for c, col, lv in meta])
    return wide.select(F.explode(arr).alias("_r")).select("_r.*").where(F.col("n_rows") > 0)


def cleanse(df: DataFrame, outlier_columns: Sequence[str] = (), remove: bool = True, exact: bool = True):
    """Q23: drop duplicates -> fill / drop gappy columns -> remove outliers (T9: for real, behind
    ``remove``), returning (clean DataFrame, one-row summary with shapes and step counts).
    Counts are small actions; the clean table stays lazy."""
    n0, c0 = df.count(), len(df.columns)
    d = drop_duplicates(df)
    n1 = d.count()
    m = cleanse_missing(d, exact=exact)
    out = remove_outliers(m, [c for c in outlier_columns if c in m.columns], exact) if remove else m
    n2 = out.count()
    summary = df.sparkSession.createDataFrame(
        [(n0, c0, n2, len(out.columns), n0 - n1, n1 - n2, c0 - len(m.columns))],
        "rows_before long, columns_before int, rows_after long, columns_after int, duplicates_removed long, "
        "outlier_rows_removed long, columns_removed int")
    return out, summary


def tree_draws(hashed: DataFrame, trees: int, share: float, seed: int) -> DataFrame:
    """The rows with a draw ``_u`` below ``share`` in tree ``_t``, by a hash of (``_row``, tree, seed). A row's draws are rows, which
    compiled code makes and drops again; as an array they would be made by interpreted functions."""
    draw = F.pmod(F.xxhash64("_row", "_t", F.lit(seed)), F.lit(1 << 53)).cast("double") / float(1 << 53)
    each = hashed.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("_t"))
    return each.withColumn("_u", draw).where(F.col("_u") < share)


def flat_tree(tree: tuple, leaf: Callable[[int], float]) -> tuple[np.ndarray, ...]:
    """A grown isolation tree as arrays by node: column and cut, left and right child (a leaf's are itself), and path length."""
    nodes: list[list] = []

    def add(node: tuple, depth: int) -> int:
        at = len(nodes)
        if node[0] == "leaf":
            nodes.append([0, 0.0, at, at, depth + leaf(node[1])])
            return at
        nodes.append([node[1], node[2], 0, 0, 0.0])
        nodes[at][2], nodes[at][3] = add(node[3], depth + 1), add(node[4], depth + 1)
        return at

    add(tree, 0)
    column, cut, left, right, length = zip(*nodes, strict=True)
    return np.array(column), np.array(cut), np.array(left), np.array(right), np.array(length, dtype=float)


def path_lengths(flat: tuple[np.ndarray, ...], x: np.ndarray, depth: int) -> np.ndarray:
    """Path length of each row: all rows go down one level at a time, whatever the number of nodes."""
    column, cut, left, right, length = flat
    at, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    for _ in range(depth):
        at = np.where(x[rows, column[at]] < cut[at], left[at], right[at])
    return length[at]


def isolation_scores(df: DataFrame, cols: Sequence[str], trees: int = 100, sample: int = 256,
                     contamination: float = 0.1, seed: int = 42, id_col: str | None = None) -> DataFrame:
    """Q8: isolation-forest score per row and a flag for the top ``contamination`` share.

    Columns are mean-filled and standardised (one aggregate). Each tree is grown on the driver
    from ``sample`` rows picked by hash (a bounded ``trees x sample`` draw, taken with a
    distributed top-k by hash), the small forest is broadcast, and every row is scored in
    ``mapInPandas``. The cut is the (1 - contamination) ``percentile_approx`` of the scores."""
    import pandas as pd

    st = df.agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"m_{c}") for c in cols],
                *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).collect()[0]
    mu = {c: st[f"m_{c}"] or 0.0 for c in cols}
    sd = {c: (st[f"s_{c}"] or 1.0) or 1.0 for c in cols}
    n = max(int(st["_n"]), 1)
    z = df.select("*", *[((F.coalesce(_q(c).cast("double"), F.lit(mu[c])) - mu[c]) / sd[c]).alias(f"_z_{c}") for c in cols])
    # each tree draws with its own hash of (row, tree): about 2 x sample candidates per tree, of which
    # those with the smallest hashes stay, so every tree has min(sample, n) rows at any n
    share = min(1.0, 2.0 * sample / n)
    hashed = z.select(*[f"_z_{c}" for c in cols], F.xxhash64(*[_q(c) for c in df.columns]).alias("_row"))
    cand = tree_draws(hashed, trees, share, seed).drop("_row")
    w = Window.partitionBy("_t").orderBy("_u")
    picked = cand.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= sample).drop("_rn", "_u")
    pdf = picked.toPandas()  # trees x sample rows: bounded by the parameters, not by the data
    rng = np.random.default_rng(seed)
    limit = int(np.ceil(np.log2(max(sample, 2))))

    def grow(x, depth):
        if depth >= limit or len(x) <= 1:
            return ("leaf", len(x))
        j = int(rng.integers(x.shape[1]))
        lo, hi = x[:, j].min(), x[:, j].max()
        if lo == hi:
            return ("leaf", len(x))
        s = float(rng.uniform(lo, hi))
        return ("node", j, s, grow(x[x[:, j] < s], depth + 1), grow(x[x[:, j] >= s], depth + 1))

    zc = [f"_z_{c}" for c in cols]
    forest = [grow(g[zc].to_numpy(float), 0) for _, g in pdf.groupby("_t")]
    m = min(sample, n)

    def c_of(n):
        return 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n if n > 2 else (1.0 if n == 2 else 0.0)

    cm = c_of(m) or 1.0
    bforest = df.sparkSession.sparkContext.broadcast([flat_tree(t, c_of) for t in forest])

    def score(it):
        fr = bforest.value
        for b in it:
            x = b[zc].to_numpy(float)
            h = np.mean([path_lengths(t, x, limit) for t in fr], axis=0) if len(x) else np.zeros(0)
            b = b.drop(columns=zc)
            b["anomaly_score"] = np.power(2.0, -h / cm)
            yield b

    schema = z.drop(*zc).schema.add("anomaly_score", "double")
    scored = z.mapInPandas(score, schema).persist()  # scored once, for the cut and for the result
    cut = scored.agg(F.percentile_approx("anomaly_score", 1 - contamination, 10000).alias("_cut"))
    return scored.crossJoin(F.broadcast(cut)).withColumn("is_anomaly", F.col("anomaly_score") >= F.col("_cut")).drop("_cut")
