"""Scoring and stratification (I1-I12): column expressions over scored rows, plus the running
count for reference percentiles. No per-row Python, no row cap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tte.functions.expr import sigmoid
from tte.operators.scan import prefix_sum

# fixed values: default category thresholds of the scoring service (first threshold >= value wins)
INFERENCE_THRESHOLDS = (("low", 0.25), ("moderate", 0.50), ("high", 0.75), ("very_high", 1.0))
# fixed values: thresholds of the clinical stratifier, checked in this order
STRATIFY_THRESHOLDS = (("low", 0.2), ("moderate", 0.4), ("high", 0.7), ("very_high", 1.0))
# fixed values: factor names that make a high-risk subject urgent
CRITICAL_FACTORS = ("sofa", "ventilator", "sepsis", "shock")
# fixed values: recommendation texts by category, then by factor
CATEGORY_ADVICE = {
    "very_high": ["Immediate clinical intervention required", "Consider intensive care unit admission",
                  "Activate rapid response team", "Evaluate for advanced therapies"],
    "high": ["Close monitoring required", "Consider specialist consultation", "Implement preventive measures",
             "Schedule follow-up within 24-48 hours"],
    "moderate": ["Routine monitoring", "Address modifiable risk factors", "Schedule follow-up as clinically indicated"],
    "low": ["Continue routine care", "Monitor for changes in clinical status"],
}
FACTOR_ADVICE_AGE = "Consider age-appropriate screening and interventions"
FACTOR_ADVICE_SOFA = "Monitor organ function closely - SOFA score elevation indicates dysfunction"
FACTOR_ADVICE_STAGE = "Advanced disease stage - consider palliative care consultation"


def score_batch(df: DataFrame, model, horizons: Sequence[float]) -> DataFrame:
    """Risk and survival at the horizons for every row (the model's own column expressions,
    so a linear model stays inside whole-stage codegen)."""
    return model.survival(model.risk(df), horizons)


def risk_percentile(df: DataFrame, reference: DataFrame, risk: str = "risk") -> DataFrame:
    """``risk_percentile`` = 100 x share of reference risks <= the row's risk, and ``ecdf`` the
    same share in [0, 1]. Both sides are reduced to their distinct risks first; the banded running sum
    counts the reference rows over those, and each row reads its risk's share by an equi-join."""
    n_ref = reference.agg(F.count(F.lit(1)).alias("_nref"))
    risks = (reference.select(F.col(risk).cast("double").alias("_r"), F.lit(1).alias("_isref"))
             .unionByName(df.select(F.col(risk).cast("double").alias("_r"), F.lit(0).alias("_isref"))))
    counts = risks.groupBy("_r").agg(F.sum("_isref").alias("_n"))
    ecdf = F.col("cum__n") / F.col("_nref")
    read = prefix_sum(counts, "_r", ["_n"]).crossJoin(F.broadcast(n_ref)).select("_r", ecdf.alias("ecdf"))
    return (df.join(read, F.col(risk).cast("double").eqNullSafe(F.col("_r")))
            .select(*df.columns, "ecdf", (F.col("ecdf") * 100.0).alias("risk_percentile")))


def category_by_thresholds(value: Column, thresholds=INFERENCE_THRESHOLDS, otherwise: str = "very_high") -> Column:
    """I3 core: the first threshold (in ascending order) that is >= value."""
    ordered = sorted(thresholds, key=lambda kv: kv[1])
    expr = None
    for name, th in ordered:
        cond = value <= F.lit(float(th))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(otherwise))


def risk_category(df: DataFrame, risk: str = "risk", ecdf: str | None = None, thresholds=INFERENCE_THRESHOLDS) -> DataFrame:
    """Category from the reference ECDF when given, else from sigmoid(risk) (T14: the ECDF is
    in [0, 1], the percentile column in [0, 100])."""
    v = F.col(ecdf) if ecdf else sigmoid(F.col(risk))
    return df.withColumn("risk_category", category_by_thresholds(v, thresholds))


def survival_wide(df: DataFrame, horizons: Sequence[float], surv: str = "surv") -> DataFrame:
    """I4: ``surv_prob_{h}d`` columns from the survival array."""
    cols = [F.element_at(F.col(surv), i + 1).alias(f"surv_prob_{int(h)}d") for i, h in enumerate(horizons)]
    return df.select(*[c for c in df.columns if c != surv], *cols)


def median_survival(df: DataFrame, horizons: Sequence[float], surv: str = "surv") -> DataFrame:
    """First horizon with S <= 0.5, else null."""
    hz = F.array(*[F.lit(float(h)) for h in horizons])
    pairs = F.arrays_zip(hz.alias("h"), F.col(surv).alias("s"))
    hit = F.filter(pairs, lambda x: x["s"] <= 0.5)
    return df.withColumn("median_survival", F.when(F.size(hit) > 0, hit[0]["h"]))


def risk_band(df: DataFrame, risk: str = "risk") -> DataFrame:
    """>= 0.7 high_risk, >= 0.3 medium_risk, else low_risk."""
    r = F.col(risk)
    return df.withColumn("risk_band", F.when(r >= 0.7, "high_risk").when(r >= 0.3, "medium_risk").otherwise("low_risk"))


def stratify(df: DataFrame, risk: str = "risk", contributions: str | None = None,
             thresholds=STRATIFY_THRESHOLDS) -> DataFrame:
    """Category (first threshold in the given order with risk <= it, else ``unknown``),
    interval risk -+ 0.1 kept in [0, 1], risk factors (contribution > .05) and protective factors
    (< -.05) from an ``ARRAY<STRUCT<name, value>>`` of contributions."""
    r = F.col(risk)
    cat = None
    for name, th in thresholds:
        cat = F.when(r <= th, F.lit(name)) if cat is None else cat.when(r <= th, F.lit(name))
    out = df.withColumn("risk_category", cat.otherwise(F.lit("unknown")))
    out = out.withColumn("ci_lower", F.greatest(r - 0.1, F.lit(0.0))).withColumn("ci_upper", F.least(r + 0.1, F.lit(1.0)))
    if contributions:
        c = F.col(contributions)
        out = out.withColumn("risk_factors", F.transform(F.filter(c, lambda x: x["value"] > 0.05), lambda x: x["name"]))
        out = out.withColumn("protective_factors", F.transform(F.filter(c, lambda x: x["value"] < -0.05), lambda x: x["name"]))
    else:
        empty = F.array().cast("array<string>")
        out = out.withColumn("risk_factors", empty).withColumn("protective_factors", empty)
    return out


def urgency(df: DataFrame) -> DataFrame:
    """I8: very_high -> critical; high with a critical factor (name, lower case) -> urgent; else
    routine."""
    crit = F.array(*[F.lit(x) for x in CRITICAL_FACTORS])
    has = F.arrays_overlap(F.transform(F.col("risk_factors"), lambda x: F.lower(x)), crit)
    u = F.when(F.col("risk_category") == "very_high", "critical") \
        .when((F.col("risk_category") == "high") & F.coalesce(has, F.lit(False)), "urgent").otherwise("routine")
    return df.withColumn("urgency", u)


def recommendations(df: DataFrame) -> DataFrame:
    """The fixed advice list of the category (low for anything else), then factor advice:
    ``age`` as a factor; any factor containing ``sofa``; any containing ``stage``."""
    cat = F.col("risk_category")
    by_cat = F.when(cat == "very_high", F.array(*[F.lit(x) for x in CATEGORY_ADVICE["very_high"]])) \
        .when(cat == "high", F.array(*[F.lit(x) for x in CATEGORY_ADVICE["high"]])) \
        .when(cat == "moderate", F.array(*[F.lit(x) for x in CATEGORY_ADVICE["moderate"]])) \
        .otherwise(F.array(*[F.lit(x) for x in CATEGORY_ADVICE["low"]]))
    rf = F.col("risk_factors")
    extra = F.filter(F.array(
        F.when(F.array_contains(rf, "age"), F.lit(FACTOR_ADVICE_AGE)),
        F.when(F.exists(rf, lambda x: F.lower(x).contains("sofa")), F.lit(FACTOR_ADVICE_SOFA)),
        F.when(F.exists(rf, lambda x: F.lower(x).contains("stage")), F.lit(FACTOR_ADVICE_STAGE)),
    ), lambda x: x.isNotNull())
    return df.withColumn("recommendations", F.concat(by_cat, extra))


def cohort_summary(df: DataFrame, risk: str = "risk") -> DataFrame:
    """Totals, mean risk, counts per category and urgency, high-risk count."""
    cnt = lambda col, v: F.sum((F.col(col) == v).cast("long")).alias(f"{col}_{v}")
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.avg(risk).alias("average_risk"),
        *[cnt("risk_category", c) for c in ("low", "moderate", "high", "very_high")],
        *[cnt("urgency", u) for u in ("routine", "urgent", "critical")],
        F.sum(F.col("risk_category").isin("high", "very_high").cast("long")).alias("high_risk_patients"),
    )


def cohort_flags(df: DataFrame, top_k: int = 3, share: float = 0.2) -> DataFrame:
    """Any very_high subject; high > 0.5 x moderate; the top ``top_k`` risk factors by count
    that occur in more than ``share`` of subjects (exploded factors, grouped count, top-k)."""
    base = df.agg(F.count(F.lit(1)).alias("_n"),
                  F.sum((F.col("risk_category") == "very_high").cast("long")).alias("_vh"),
                  F.sum((F.col("risk_category") == "high").cast("long")).alias("_h"),
                  F.sum((F.col("risk_category") == "moderate").cast("long")).alias("_m"))
    facs = df.select(F.explode("risk_factors").alias("factor")).groupBy("factor").agg(F.count(F.lit(1)).alias("k")) \
        .orderBy(F.col("k").desc(), "factor").limit(top_k)
    common = facs.crossJoin(base.select("_n")).where(F.col("k") > share * F.col("_n")) \
        .agg(F.array_sort(F.collect_list("factor")).alias("common_factors"))
    return base.crossJoin(common).select(
        (F.col("_vh") > 0).alias("has_very_high"), (F.col("_h") > 0.5 * F.col("_m")).alias("high_exceeds_half_moderate"),
        "common_factors")


def compare_scores(df: DataFrame, risk_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Per model mean, population std, min, max; pairwise correlation (one pass each)."""
    stats = df.agg(*[f(c).alias(f"{c}__{n}") for c in risk_cols for n, f in
                     (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))])
    arr = F.array(*[F.struct(F.lit(c).alias("model"), *[F.col(f"{c}__{n}").alias(n) for n in ("mean", "std", "min", "max")])
                    for c in risk_cols])
    per_model = stats.select(F.explode(arr).alias("_r")).select("_r.*")
    pairs = [(a, b) for i, a in enumerate(risk_cols) for b in risk_cols[i + 1:]]
    corr = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    carr = F.array(*[F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), F.col(f"{a}__{b}").alias("corr")) for a, b in pairs])
    return per_model, corr.select(F.explode(carr).alias("_r")).select("_r.*")
