"""Explanations and what-if analyses (X1-X11) as Spark jobs: contributions are column arithmetic,
permutations are joins of two hashed rank orders, grids and draws are exploded literal arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tte.operators.permute import drawn_numbers, permutation_keys, row_numbers, with_permuted
from tte.operators.replicates import id_hash
from tte.operators.stats import exact_quantiles
from tte.session import ensure_checkpoint_dir


def linear_contributions(df: DataFrame, coef: dict[str, float], means: dict[str, float] | None = None) -> DataFrame:
    """Exact Shapley values of a linear risk: beta_j (x_j - mean_j). Means from ``df`` unless
    given (one aggregate). Adds ``contrib`` ARRAY<STRUCT<name, value>> in feature order."""
    feats = list(coef)
    if means is None:
        row = df.agg(*[F.avg(f).alias(f) for f in feats]).collect()[0]
        means = {f: row[f] for f in feats}
    arr = F.array(*[F.struct(F.lit(f).alias("name"), (F.lit(float(coef[f])) * (F.col(f) - F.lit(float(means[f])))).alias("value"))
                    for f in feats])
    return df.withColumn("contrib", arr)


def top_features(contrib_df: DataFrame, n: int = 10, contrib: str = "contrib") -> DataFrame:
    """Mean |contribution| per feature, top ``n`` (melt + grouped mean + top-k)."""
    long = contrib_df.select(F.explode(contrib).alias("_c")).select("_c.name", "_c.value")
    return long.groupBy("name").agg(F.avg(F.abs("value")).alias("mean_abs")).orderBy(F.col("mean_abs").desc(), "name").limit(n)


def explain_rows(contrib_df: DataFrame, contrib: str = "contrib") -> DataFrame:
    """Per row the contributions sorted by |value| desc (name breaks ties), a top-3 sentence,
    findings (top 5 with |value| > .05), confidence .9 / .7 / .5 at total |value| > .5 / > .2,
    and a strength label per finding at |value| >= .7 strong, >= .4 moderate, else weak."""
    srt = F.array_sort(F.col(contrib), lambda a, b: F.when(F.abs(a["value"]) > F.abs(b["value"]), -1)
                       .when(F.abs(a["value"]) < F.abs(b["value"]), 1)
                       .when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0))
    out = contrib_df.withColumn("_sorted", srt)
    top3 = F.slice("_sorted", 1, 3)
    words = F.transform(top3, lambda x: F.concat(x["name"], F.when(x["value"] > 0, F.lit(" (increases risk)")).otherwise(F.lit(" (decreases risk)"))))
    total = F.aggregate(F.col(contrib), F.lit(0.0), lambda acc, x: acc + F.abs(x["value"]))
    findings = F.slice(F.filter("_sorted", lambda x: F.abs(x["value"]) > 0.05), 1, 5)
    strength = F.transform(findings, lambda x: F.struct(x["name"].alias("name"), x["value"].alias("value"),
                                                        F.when(F.abs(x["value"]) >= 0.7, "strong").when(F.abs(x["value"]) >= 0.4, "moderate")
                                                        .otherwise("weak").alias("strength")))
    return out.select(*[c for c in contrib_df.columns],
                      F.concat(F.lit("Main drivers: "), F.array_join(words, ", ")).alias("summary"),
                      strength.alias("findings"),
                      F.when(total > 0.5, 0.9).when(total > 0.2, 0.7).otherwise(0.5).alias("confidence"))


def population_insights(contrib_df: DataFrame, contrib: str = "contrib", top: int = 5) -> DataFrame:
    """For every feature the mean contribution, mean |contribution|, share of subjects with
    |value| > .05, its ``rank`` by mean |contribution| and whether it is among the ``top`` ones."""
    long = contrib_df.select(F.explode(contrib).alias("_c")).select("_c.name", "_c.value")
    g = long.groupBy("name").agg(F.avg("value").alias("mean_contribution"), F.avg(F.abs("value")).alias("mean_abs"),
                                 F.avg((F.abs("value") > 0.05).cast("double")).alias("share_relevant"))
    w = Window.orderBy(F.col("mean_abs").desc(), "name")  # one row per feature
    return g.withColumn("rank", F.row_number().over(w)).withColumn("is_top", F.col("rank") <= top)


def risk_distribution(df: DataFrame, risk: str = "risk", probs: Sequence[float] = (0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """The population's risks: count, mean, std, min, max and exact quantiles, one row."""
    q = exact_quantiles(df, [risk], probs).groupBy().pivot("p", [float(p) for p in probs]).agg(F.first("q"))
    q = q.select(*[F.col(f"`{float(p)}`").alias(f"q{round(100 * p)}") for p in probs])
    m = df.agg(F.count(risk).alias("n"), F.avg(risk).alias("mean"), F.stddev_samp(risk).alias("std"),
               F.min(risk).alias("min"), F.max(risk).alias("max"))
    return m.crossJoin(F.broadcast(q))  # one row each


def partial_dependence(df: DataFrame, score_fn, feature: str, grid: Sequence[float]) -> DataFrame:
    """Mean prediction with ``feature`` set to each grid value: rows x a literal grid array
    (explode), one scoring expression, grouped mean."""
    g = F.explode(F.array(*[F.lit(float(v)) for v in grid])).alias("grid_value")
    x = df.select("*", g).withColumn(feature, F.col("grid_value"))
    return score_fn(x).groupBy("grid_value").agg(F.avg("risk").alias("mean_risk"))


def treatment_effect(df: DataFrame, score_fn, feature: str, values: Sequence[float]) -> DataFrame:
    """X9 (point estimates): mean / std of the predicted risk per value, effect vs the first value."""
    pd_ = df.select("*", F.explode(F.array(*[F.lit(float(v)) for v in values])).alias("value")).withColumn(feature, F.col("value"))
    g = score_fn(pd_).groupBy("value").agg(F.avg("risk").alias("mean_risk"), F.stddev_samp("risk").alias("std_risk"))
    first = g.where(F.col("value") == float(values[0])).select(F.col("mean_risk").alias("_base"))
    return g.crossJoin(F.broadcast(first)).select("value", "mean_risk", "std_risk", (F.col("mean_risk") - F.col("_base")).alias("effect"))


def treatment_effect_interval(df: DataFrame, id_col: str, score_fn, feature: str, values: Sequence[float], reps: int = 200,
                              seed: int = 42, level: float = 0.95) -> DataFrame:
    """X9 with a percentile bootstrap interval of each effect against the first value: every subject
    has a hashed Poisson weight per replicate, and the replicates' weighted means are one matrix product a
    batch of rows (``replicate_sums``)."""
    from tte.operators.replicates import replicate_sums

    x = df.select("*", F.explode(F.array(*[F.lit(float(v)) for v in values])).alias("value")).withColumn(feature, F.col("value"))
    scored = score_fn(x).select(id_col, "value", "risk")
    means = replicate_sums(scored, id_col, ["risk"], reps, seed, ["value"]).select(
        "value", F.posexplode(F.zip_with("risk", "w", lambda r, w: F.when(w > 0, r / w))).alias("rep", "_m"))
    base = means.where(F.col("value") == float(values[0])).select("rep", F.col("_m").alias("_b"))
    effects = means.join(base, "rep").select("value", (F.col("_m") - F.col("_b")).alias("_e"))
    lo, hi = (1 - level) / 2, 1 - (1 - level) / 2
    ci = effects.groupBy("value").agg(F.percentile("_e", lo).alias("ci_lower"), F.percentile("_e", hi).alias("ci_upper"))
    return treatment_effect(df, score_fn, feature, values).join(ci, "value")


def permuted_copies(df: DataFrame, id_col: str, features: Sequence[str], repeats: int, seed: int) -> DataFrame:
    """All rows once per (``permuted``, ``rep``): the named feature's values are those of the rows that a keyed permutation of
    the row numbers leads to, all else is the row's own. The rows are numbered once, and one join by number
    reads the values of all features and repeats; each value is used as often as it occurs."""
    feats = list(features)
    ensure_checkpoint_dir(df.sparkSession)
    numbered, n = row_numbers(df, id_col)
    numbered = numbered.checkpoint()  # read twice, and numbered by a sort
    tasks = F.array(*[F.struct(F.lit(f).alias("permuted"), F.lit(r).alias("rep"), F.array(*[F.lit(k) for k in permutation_keys(seed, f"{f}:{r}")])
                               .cast("array<bigint>").alias("_keys")) for f in feats for r in range(repeats)])
    asked = numbered.select("*", F.explode(tasks).alias("_t")).select("*", "_t.*").drop("_t")
    asked = with_permuted(asked, "_row", "_keys", n, "_from")
    values = numbered.select(F.col("_row").alias("_from"), *[F.col(f).alias(f"_v_{f}") for f in feats])
    new = [F.when(F.col("permuted") == f, F.col(f"_v_{f}")).otherwise(F.col(f)).alias(f) for f in feats]
    return asked.join(values, "_from").select(*[c for c in df.columns if c not in feats], *new, "permuted", "rep")


def permute_column(df: DataFrame, id_col: str, column: str, seed: int) -> DataFrame:
    """``df`` with the values of one column permuted over its rows."""
    return permuted_copies(df, id_col, [column], 1, seed).select(*df.columns)


def permutation_importance(df: DataFrame, id_col: str, score_fn, features: Sequence[str], repeats: int = 3,
                           seed: int = 42, time: str = "time", event: str = "event") -> DataFrame:
    """Drop in Harrell's C when a feature is permuted, mean and std over repeats, sorted desc.
    All features and repeats are scored as one table and counted by one grouped concordance."""
    from tte.operators.pairs import concordance

    base = concordance(score_fn(df), time=time, event=event).select(F.col("c_index").alias("_base"))
    each = concordance(score_fn(permuted_copies(df, id_col, features, repeats, seed)), time=time, event=event, by=["permuted", "rep"])
    drops = each.crossJoin(F.broadcast(base)).select(F.col("permuted").alias("feature"), (F.col("_base") - F.col("c_index")).alias("drop"))  # one base row
    return drops.groupBy("feature").agg(F.avg("drop").alias("importance"), F.stddev_samp("drop").alias("std")) \
        .orderBy(F.col("importance").desc(), "feature")


def permutation_shift(df: DataFrame, id_col: str, score_fn, features: Sequence[str], repeats: int = 3, seed: int = 42) -> DataFrame:
    """|change of mean risk| when a feature is permuted. For a linear model this is about 0 by
    construction (a permutation keeps the column mean)."""
    base = score_fn(df).agg(F.avg("risk").alias("_b"))
    means = score_fn(permuted_copies(df, id_col, features, repeats, seed)).groupBy("permuted", "rep").agg(F.avg("risk").alias("_m"))
    shifts = means.crossJoin(F.broadcast(base)).select(F.col("permuted").alias("feature"), F.abs(F.col("_m") - F.col("_b")).alias("shift"))  # one base row
    return shifts.groupBy("feature").agg(F.avg("shift").alias("shift"))


def counterfactual_search(df: DataFrame, id_col: str, score_fn, bounds: dict[str, tuple[float, float]], target: float,
                          n_draws: int = 50, max_dist: float = 1.0, metric: str = "l2", seed: int = 42,
                          n: int | None = None) -> DataFrame:
    """Random search per subject: each draw moves every feature by U(-.2, .2) x its range (hashed
    uniforms of (id, draw, feature, seed)) and stays within its ``bounds`` ``(lo, hi)``; keep draws
    within ``max_dist`` (L2 or L1 over the relative moves made) and pick the one whose risk is closest
    to ``target`` (``min_by`` per subject). Subjects with risk above the median are searched; ``n``
    asks for that many of them, those with the smallest id hashes."""
    scored = score_fn(df)
    med = scored.agg(F.percentile_approx("risk", 0.5, 10000).alias("_med"))
    subj = scored.crossJoin(F.broadcast(med)).where(F.col("risk") > F.col("_med")).drop("_med", "risk")
    if n is not None:
        subj = subj.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), id_col).limit(n)
    x = subj.select("*", F.explode(F.sequence(F.lit(1), F.lit(n_draws))).alias("draw"))
    moves = []
    for i, (f, (lo, hi)) in enumerate(bounds.items()):
        u = F.pmod(F.xxhash64(F.col(id_col), F.col("draw"), F.lit(i), F.lit(seed)), F.lit(1 << 30)).cast("double") / float(1 << 30)
        moved = F.least(F.greatest(F.col(f) + (u * 0.4 - 0.2) * float(hi - lo), F.lit(float(lo))), F.lit(float(hi)))
        x = x.withColumn(f"_orig_{f}", F.col(f)).withColumn(f, moved)
        moves.append((F.col(f) - F.col(f"_orig_{f}")) / float(hi - lo))
    if metric == "l2":
        dist = F.sqrt(sum((m * m for m in moves), F.lit(0.0)))
    else:
        dist = sum((F.abs(m) for m in moves), F.lit(0.0))
    x = x.withColumn("distance", dist).where(F.col("distance") <= max_dist)
    s = score_fn(x).withColumn("_gap", F.abs(F.col("risk") - F.lit(float(target))))
    best = s.groupBy(id_col).agg(F.min_by(F.struct("draw", "risk", "distance", *bounds, *[f"_orig_{f}" for f in bounds]),
                                          F.struct("_gap", "draw")).alias("_b"))
    return best.select(id_col, "_b.*")


def counterfactual_summary(cf: DataFrame, features: Sequence[str]) -> DataFrame:
    """X11: per feature mean change; count and mean / min / max distance."""
    return cf.agg(F.count(F.lit(1)).alias("n"), F.avg("distance").alias("mean_distance"),
                  F.min("distance").alias("min_distance"), F.max("distance").alias("max_distance"),
                  *[F.avg(F.col(f) - F.col(f"_orig_{f}")).alias(f"mean_change_{f}") for f in features])


def sampled_shapley(df: DataFrame, id_col: str, score_fn, features: Sequence[str], background: DataFrame,
                    draws: int = 32, seed: int = 42) -> DataFrame:
    """Monte Carlo Shapley values for any scoring function (a Column-expression model or one
    scored in ``mapInPandas``). For each (subject, draw) a hashed feature order and a drawn background row
    (``background`` needs ``id_col``); the walk from the background row to the subject's takes over one
    feature after the other, and every step's change of risk belongs to its feature.

    All points of all walks are scored as one table. A point counts for the feature that led to it and
    against the one that leads on, so the steps are one grouped sum per feature, a row a subject: no join of scores, and a
    subject's values add up to f(x) minus the mean of f over its background rows."""
    feats = list(features)
    numbered, nb = row_numbers(background.select(id_col, *feats), id_col)
    bg = numbered.select(F.col("_row").alias("_bg"), *[F.col(f).alias(f"_bg_{f}") for f in feats])
    x = df.select(id_col, *feats, id_hash(id_col).alias("_id_hash")).select("*", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("_draw"))
    x = x.withColumn("_bg", drawn_numbers(F.col("_id_hash"), F.col("_draw"), draws, nb, seed)).join(bg, "_bg")
    # a feature's place in the order is how many hashes are smaller (equal ones: names), so that nothing is sorted in a row
    x = x.withColumns({f"_h{i}": F.xxhash64(F.col(id_col), F.col("_draw"), F.lit(i), F.lit(seed + 2)) for i in range(len(feats))})

    def place(i: int) -> Column:
        before = [F.col(f"_h{j}") <= F.col(f"_h{i}") if feats[j] < feats[i] else F.col(f"_h{j}") < F.col(f"_h{i}") for j in range(len(feats)) if j != i]
        return sum((b.cast("int") for b in before), F.lit(1))

    places = [f"_place{i}" for i in range(len(feats))]
    x = x.withColumns({p: place(i) for i, p in enumerate(places)}).withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(len(feats)))))
    points = x.select(F.col(id_col), "_at", *places, *[F.when(F.col(p) <= F.col("_at"), F.col(f)).otherwise(F.col(f"_bg_{f}")).alias(f)
                                                       for f, p in zip(feats, places, strict=True)])
    part = lambda p: F.when(F.col(p) == F.col("_at"), F.col("risk")).when(F.col(p) == F.col("_at") + 1, -F.col("risk"))
    sums = score_fn(points).groupBy(id_col).agg(*[F.sum(part(p)).alias(p) for p in places])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), (F.col(p) / draws).alias("shapley")) for f, p in zip(feats, places, strict=True)])
    return sums.select(id_col, F.explode(rows).alias("p")).select(id_col, "p.*")
