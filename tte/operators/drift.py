"""Feature statistics and drift scores.

Statistics are one wide ``agg`` per period (grouped by a period column when both periods live in
one table); drift scores are joins of those small per-column tables. Distribution tests (D6) count
values per distinct value or per bin, then use banded running counts for the CDFs: no sample is
collected anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tte.operators.scan import BAND, band_of, plan_bands, prefix_sum
from tte.operators.stats import distinct_counts, melt


def _q(c):
    return F.col(f"`{c}`")


def feature_stats(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Long rows ``by..., column, kind, mean, std, min, max, missing_rate, unique_count,
    top_category_rate``. Numeric: sample std; categorical: distinct non-null values (as text) and the
    share of the most frequent value among non-null rows (0 when all null), from one table of value
    counts for all categorical columns. Rows whose period is null are a period of their own."""
    by = list(by)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in numeric:
        x = _q(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max"), F.avg(x.isNull().cast("double")).alias(f"{c}__miss")]
    for c in categorical:
        aggs += [F.avg(_q(c).isNull().cast("double")).alias(f"{c}__miss"), F.count(_q(c)).alias(f"{c}__nn")]
    wide = df.groupBy(*by).agg(*aggs)
    null = F.lit(None).cast("double")
    rows = []
    for c in numeric:
        rows.append(F.struct(F.lit(c).alias("column"), F.lit("numeric").alias("kind"),
                             *[F.col(f"`{c}__{m}`").alias(m) for m in ("mean", "std", "min", "max")],
                             F.col(f"`{c}__miss`").alias("missing_rate"), F.lit(None).cast("long").alias("_nn")))
    for c in categorical:
        rows.append(F.struct(F.lit(c).alias("column"), F.lit("categorical").alias("kind"),
                             null.alias("mean"), null.alias("std"), null.alias("min"), null.alias("max"),
                             F.col(f"`{c}__miss`").alias("missing_rate"), F.col(f"`{c}__nn`").alias("_nn")))
    long = wide.select(*by, F.explode(F.array(*rows)).alias("_r")).select(*by, "_r.*")
    if not categorical:
        return long.drop("_nn").withColumns({"unique_count": null, "top_category_rate": null})
    counts = distinct_counts(df, categorical, by).select(
        *[_q(b).alias(f"_by_{b}") for b in by], F.col("column").alias("_column"), "n_distinct", "n_top")
    same = [F.col("column") == F.col("_column"), *[_q(b).eqNullSafe(_q(f"_by_{b}")) for b in by]]
    is_cat = F.col("kind") == "categorical"
    return long.join(counts, same, "left").select(
        *by, "column", "kind", "mean", "std", "min", "max", "missing_rate",
        F.when(is_cat, F.coalesce("n_distinct", F.lit(0)).cast("double")).alias("unique_count"),
        F.when(is_cat & (F.col("_nn") > 0), F.col("n_top") / F.col("_nn")).when(is_cat, 0.0).alias("top_category_rate"))


def _pair(base: DataFrame, cur: DataFrame) -> DataFrame:
    b = base.select("column", "kind", *[F.col(c).alias(f"b_{c}") for c in base.columns if c not in ("column", "kind")])
    c = cur.select("column", *[F.col(x).alias(f"c_{x}") for x in cur.columns if x not in ("column", "kind")])
    return b.join(c, "column")


def drift_scores(base: DataFrame, cur: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """D2 + D3 on two D1 tables: numeric max(|dmean|/std0, |dstd|/std0), 0 when std0 = 0;
    categorical max(|dtop share|, |ddistinct| / max(distinct0, 1)). ``by``: columns of ``cur`` that tell its periods
    apart; each is compared with ``base``."""
    j = _pair(base, cur)
    num = F.when(F.col("b_std") > 0, F.greatest(F.abs(F.col("c_mean") - F.col("b_mean")) / F.col("b_std"),
                                                F.abs(F.col("c_std") - F.col("b_std")) / F.col("b_std"))).otherwise(F.lit(0.0))
    cat = F.greatest(F.abs(F.col("c_top_category_rate") - F.col("b_top_category_rate")),
                     F.abs(F.col("c_unique_count") - F.col("b_unique_count")) / F.greatest(F.col("b_unique_count"), F.lit(1.0)))
    return j.select(*[F.col(f"c_{b}").alias(b) for b in by], "column", "kind", F.when(F.col("kind") == "numeric", num).otherwise(cat).alias("drift"))


def drift_relative(base: DataFrame, cur: DataFrame) -> DataFrame:
    """Numeric only: mean of |dmean| / |mean0 + 1e-8| and |dstd| / (std0 + 1e-8), capped at 1."""
    j = _pair(base, cur).where(F.col("kind") == "numeric")
    m = F.abs(F.col("c_mean") - F.col("b_mean")) / F.abs(F.col("b_mean") + 1e-8)
    s = F.abs(F.col("c_std") - F.col("b_std")) / (F.col("b_std") + 1e-8)
    return j.select("column", F.least((m + s) / 2.0, F.lit(1.0)).alias("drift"))


def quality_drift(base_metrics: DataFrame, cur_metrics: DataFrame) -> DataFrame:
    """On two Q6 dataset rows: missing % moved by more than 5 points, duplicate % by more
    than 2."""
    b = base_metrics.select(F.col("missing_pct").alias("b_m"), F.col("duplicate_pct").alias("b_d"))
    c = cur_metrics.select(F.col("missing_pct").alias("c_m"), F.col("duplicate_pct").alias("c_d"))
    j = b.crossJoin(c)
    return j.select((F.col("c_m") - F.col("b_m")).alias("missing_change"),
                    (F.col("c_d") - F.col("b_d")).alias("duplicate_change"),
                    (F.abs(F.col("c_m") - F.col("b_m")) > 5).alias("missing_drift"),
                    (F.abs(F.col("c_d") - F.col("b_d")) > 2).alias("duplicate_drift"))


def _with_next_value(counts: DataFrame, by: Sequence[str], plan: list[float]) -> DataFrame:
    """Add ``_next`` = the next larger ``value`` within ``by`` (lead within the bands of ``plan``)."""
    by = list(by)
    b = counts.withColumn(BAND, band_of("value", plan))
    local = b.withColumn("_loc_next", F.lead("value").over(Window.partitionBy(*by, BAND).orderBy("value")))
    first = b.groupBy(*by, BAND).agg(F.min("value").alias("_bmin"))
    nxt = first.select(*by, BAND, F.lead("_bmin").over(Window.partitionBy(*by).orderBy(BAND)).alias("_band_next"))
    return local.join(nxt, [*by, BAND]).select(*counts.columns, F.coalesce("_loc_next", "_band_next").alias("_next"))


def distribution_drift(ref: DataFrame, cur: DataFrame, cols: Sequence[str], bins: int = 10, eps: float = 1e-4) -> DataFrame:
    """D6 (numeric): per column the two-sample Kolmogorov-Smirnov statistic, Wasserstein-1 distance
    (exact, from the two empirical CDFs), PSI and Jensen-Shannon distance (natural log) over
    ``bins`` equal-width bins spanning the reference range (values outside go to the end bins;
    shares floored at ``eps``)."""
    r = melt(ref, cols).where(F.col("value").isNotNull()).withColumn("_side", F.lit(0))
    c = melt(cur, cols).where(F.col("value").isNotNull()).withColumn("_side", F.lit(1))
    u = r.unionByName(c)
    counts = u.groupBy("column", "value").agg(F.sum((F.col("_side") == 0).cast("long")).alias("nr"),
                                              F.sum((F.col("_side") == 1).cast("long")).alias("nc"))
    tot = counts.groupBy("column").agg(F.sum("nr").alias("_Nr"), F.sum("nc").alias("_Nc"))
    plan = plan_bands(counts, "value")
    cdf = prefix_sum(counts, "value", ["nr", "nc"], by=["column"], plan=plan).join(F.broadcast(tot), "column")
    cdf = _with_next_value(cdf, ["column"], plan)
    d = F.col("cum_nr") / F.col("_Nr") - F.col("cum_nc") / F.col("_Nc")
    ks_w = cdf.groupBy("column").agg(F.max(F.abs(d)).alias("ks"),
                                     F.sum(F.when(F.col("_next").isNotNull(), F.abs(d) * (F.col("_next") - F.col("value")))
                                           .otherwise(F.lit(0.0))).alias("wasserstein"))
    rng = r.groupBy("column").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    bidx = F.when(width > 0, F.least(F.greatest(F.floor((F.col("value") - F.col("_lo")) / width), F.lit(0)), F.lit(bins - 1))) \
        .otherwise(F.lit(0)).cast("int")
    binned = u.join(F.broadcast(rng), "column").withColumn("bin", bidx)
    bc = binned.groupBy("column", "bin").agg(F.sum((F.col("_side") == 0).cast("double")).alias("br"),
                                             F.sum((F.col("_side") == 1).cast("double")).alias("bcn"))
    allbins = rng.select("column", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    bc = allbins.join(bc, ["column", "bin"], "left").fillna(0.0, ["br", "bcn"]).join(F.broadcast(tot), "column")
    p = F.greatest(F.col("br") / F.col("_Nr"), F.lit(eps))
    q = F.greatest(F.col("bcn") / F.col("_Nc"), F.lit(eps))
    pr, qr = F.col("br") / F.col("_Nr"), F.col("bcn") / F.col("_Nc")
    m = (pr + qr) / 2.0
    kl = lambda a: F.when(a > 0, a * F.log(a / m)).otherwise(F.lit(0.0))
    binstats = bc.groupBy("column").agg(F.sum((q - p) * F.log(q / p)).alias("psi"),
                                        F.sqrt(F.greatest(F.sum(0.5 * kl(pr) + 0.5 * kl(qr)), F.lit(0.0))).alias("js"))
    return ks_w.join(binstats, "column")


def categorical_drift(ref: DataFrame, cur: DataFrame, cols: Sequence[str], eps: float = 1e-4) -> DataFrame:
    """D6 (categorical): per column PSI, Jensen-Shannon distance and the chi-square statistic of
    the current counts against the reference shares (full outer join of the two count tables)."""
    r = melt(ref, cols, "string").where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).cast("double").alias("nr"))
    c = melt(cur, cols, "string").where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).cast("double").alias("nc"))
    j = r.join(c, ["column", "value"], "full").fillna(0.0, ["nr", "nc"])
    tot = j.groupBy("column").agg(F.sum("nr").alias("_Nr"), F.sum("nc").alias("_Nc"))
    j = j.join(F.broadcast(tot), "column")
    pr, qr = F.col("nr") / F.col("_Nr"), F.col("nc") / F.col("_Nc")
    p, q = F.greatest(pr, F.lit(eps)), F.greatest(qr, F.lit(eps))
    m = (pr + qr) / 2.0
    kl = lambda a: F.when(a > 0, a * F.log(a / m)).otherwise(F.lit(0.0))
    exp = pr * F.col("_Nc")
    return j.groupBy("column").agg(
        F.sum((q - p) * F.log(q / p)).alias("psi"),
        F.sqrt(F.greatest(F.sum(0.5 * kl(pr) + 0.5 * kl(qr)), F.lit(0.0))).alias("js"),
        F.sum(F.when(exp > 0, (F.col("nc") - exp) * (F.col("nc") - exp) / exp).otherwise(F.lit(0.0))).alias("chi2"),
        (F.count(F.lit(1)) - 1).alias("dof"),
    )


def target_drift(ref: DataFrame, cur: DataFrame, time: str = "time", event: str = "event") -> DataFrame:
    """D6 on the survival target: distribution tests on ``time`` and ``event``."""
    return distribution_drift(ref.select(time, F.col(event).cast("double").alias(event)),
                              cur.select(time, F.col(event).cast("double").alias(event)), [time, event])
