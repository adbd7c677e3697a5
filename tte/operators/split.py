"""Splits and folds (V1-V3, V5, V8): every draw is a hash of (id, seed), so a retried task gives
the same rows; ranks come from the banded running count (no single-partition window)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tte.operators.scan import BAND_ROWS, prefix_sum
from tte.session import ensure_checkpoint_dir, shuffle_partitions


def hashed_rank(df: DataFrame, id_col: str, seed: int, by: Sequence[str] = (), keep: Sequence[str] | None = None) -> DataFrame:
    """Adds ``_rank``, 1 to n without gaps or repeats, in the order of ``xxhash64(id, seed)`` within
    ``by``; equal hashes are ordered by the id, and rows that repeat an id by a hash of the whole row.

    The hash stays a 64-bit number: its high bits cut the rows into buckets of about ``BAND_ROWS``, a
    window numbers each bucket, and bucket offsets come from the bucket counts. Of the columns only those of ``keep`` (default:
    all) are sorted and returned; the ranks are the same."""
    by = list(by)
    n = df.count()
    bits = max(1, max(shuffle_partitions(df.sparkSession), -(-n // BAND_ROWS)).bit_length())
    h = df.withColumn("_h", F.xxhash64(F.col(id_col), F.lit(seed))).withColumn("_hb", F.shiftright("_h", 64 - bits))
    columns = list(df.columns if keep is None else keep)
    h = h.select(*dict.fromkeys([*columns, id_col, *by]), "_h", "_hb", F.xxhash64(*df.columns).alias("_whole"))
    order = Window.partitionBy(*by, "_hb").orderBy("_h", id_col, "_whole")
    counts = h.groupBy(*by, "_hb").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], F.col("_hb").alias("_ob"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = [F.col(c).eqNullSafe(F.col(f"_by_{i}")) for i, c in enumerate(by)] + [F.col("_hb") == F.col("_ob")]
    numbered = h.withColumn("_row", F.row_number().over(order))
    return numbered.join(offsets, same).select(*columns, (F.col("_row") + F.col("_before")).cast("long").alias("_rank"))


def stratified_split(df: DataFrame, id_col: str, event: str = "event", test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """V1: tag ``split`` = train/test. n_test = int(n s), n_pos = int(pos s), the rest of the test
    rows negatives; each stratum takes its first rows in hashed order. Error unless 0 < s < 1."""
    if not 0 < test_size < 1:
        raise ValueError("test_size must be within (0, 1)")
    c = df.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col(event) == 1).cast("long")).alias("pos")).collect()[0]
    n_test = int(c["n"] * test_size)
    n_pos = int((c["pos"] or 0) * test_size)
    n_neg = n_test - n_pos
    r = hashed_rank(df, id_col, seed, by=[event])
    is_test = F.when(F.col(event) == 1, F.col("_rank") <= n_pos).otherwise(F.col("_rank") <= n_neg)
    return r.withColumn("split", F.when(is_test, "test").otherwise("train")).drop("_rank")


def kfold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, stratify: str | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """V2: ``fold`` in 0..k-1 from the hashed rank (optionally within the strata of ``stratify``),
    so fold sizes differ by at most one per stratum. ``keep``: the columns to return beside it (default: all)."""
    r = hashed_rank(df, id_col, seed, by=[stratify] if stratify else [], keep=keep)
    return r.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def contiguous_folds(df: DataFrame, order: str, k: int = 5) -> DataFrame:
    """V3: fold i holds the rows with 0-based rank in [i n / k, (i + 1) n / k) of ``order``
    (ties in ``order`` share a rank, hence a fold). The scan runs over the distinct values."""
    counts = df.groupBy(F.col(order).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    n = counts.agg(F.sum("_n")).first()[0] or 0
    ranked = prefix_sum(counts, "_v", ["_n"], exclusive=True)
    fold = F.least(F.floor(F.col("cum__n") * k / F.lit(max(n, 1))), F.lit(k - 1)).cast("int")
    folds = ranked.select("_v", fold.alias("fold"))
    return df.join(folds, F.col(order).eqNullSafe(F.col("_v"))).select(*df.columns, "fold")


def cross_validate(df: DataFrame, fit: Callable[[DataFrame], object], score: Callable[[object, DataFrame], DataFrame],
                   k: int = 5, id_col: str = "subject_id", seed: int = 42, stratify: str | None = "event"):
    """V5: out-of-fold scores: for each fold a model fitted on the other folds scores it (one Spark
    job per fold, driven from the driver), then a final model on all rows.
    Returns ``(oof DataFrame with fold column, final model)``."""
    folded = kfold(df, id_col, k, seed, stratify).persist()
    parts = []
    for f in range(k):
        model = fit(folded.where(F.col("fold") != f))
        parts.append(score(model, folded.where(F.col("fold") == f)))
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    final = fit(df)
    return oof, final


def grid(params: dict[str, list]) -> list[dict]:
    """All combinations of a parameter grid, in a fixed order."""
    import itertools

    keys = sorted(params)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[params[k] for k in keys])]


def nested_cv(df: DataFrame, make_fit: Callable[[dict], Callable[[DataFrame], object]], score: Callable[[object, DataFrame], float],
              params: dict[str, list], outer: int = 3, inner: int = 3, id_col: str = "subject_id", seed: int = 42):
    """V6: for each outer fold, every grid point is scored by the mean inner-fold score on the
    outer-train rows; the best is refit on the outer-train rows and scored on the outer fold.
    Global parameters = those of the best outer fold. One Spark job per fit / score.
    Returns (list of (outer fold, params, inner score, outer score), best params)."""
    folded = kfold(df, id_col, outer, seed, "event").persist()
    rows = []
    try:
        for f in range(outer):
            tr, te = folded.where(F.col("fold") != f).drop("fold"), folded.where(F.col("fold") == f).drop("fold")
            inner_f = kfold(tr, id_col, inner, seed + 1, "event").persist()
            best, best_s = None, None
            for p in grid(params):
                ss = []
                for g in range(inner):
                    m = make_fit(p)(inner_f.where(F.col("fold") != g))
                    ss.append(score(m, inner_f.where(F.col("fold") == g)))
                s = float(sum(ss) / len(ss))
                if best_s is None or s > best_s:
                    best, best_s = p, s
            inner_f.unpersist()
            rows.append((f, best, best_s, score(make_fit(best)(tr), te)))
    finally:
        folded.unpersist()
    top = max(rows, key=lambda r: r[3])
    return rows, top[1]


def random_search(df: DataFrame, make_fit, score, space: dict[str, tuple], trials: int = 5, k: int = 3,
                  id_col: str = "subject_id", seed: int = 42):
    """V7: random draws from a space of ``("float", lo, hi, log)``, ``("int", lo, hi)`` or
    ``("cat", [values])``, each scored by the mean k-fold score. Returns (trials, best params)."""
    import numpy as np

    rng = np.random.default_rng(seed)
    folded = kfold(df, id_col, k, seed, "event").persist()
    out = []
    try:
        for t in range(trials):
            p = {}
            for name, spec in sorted(space.items()):
                if spec[0] == "float":
                    lo, hi, log = spec[1], spec[2], (spec[3] if len(spec) > 3 else False)
                    p[name] = float(np.exp(rng.uniform(np.log(lo), np.log(hi)))) if log else float(rng.uniform(lo, hi))
                elif spec[0] == "int":
                    p[name] = int(rng.integers(spec[1], spec[2] + 1))
                else:
                    p[name] = spec[1][int(rng.integers(len(spec[1])))]
            ss = [score(make_fit(p)(folded.where(F.col("fold") != f)), folded.where(F.col("fold") == f)) for f in range(k)]
            out.append((t, p, float(sum(ss) / len(ss))))
    finally:
        folded.unpersist()
    return out, max(out, key=lambda r: r[2])[1]


def leakage_probe(df: DataFrame, prepare, make_fit, score, features: list[str], k: int = 3, id_col: str = "subject_id",
                  seed: int = 42, time: str = "time", event: str = "event", threshold: float = 0.1):
    """Does preparing the data see the held-out fold?

    ``prepare(train, rows)`` returns ``rows`` prepared with what it learned from ``train``. Each fold
    is scored twice: prepared honestly (learned from the training folds), and as the pipeline would if
    it were fitted before splitting (learned from all rows, the held-out outcomes among them). A
    preparation that only summarises features gains nothing from that; one that uses the outcome (for
    example target means per group) does. Returns (honest mean score, leaky mean score, whether the
    gain exceeds ``threshold``).

    ``prepare`` may be a dict of preparations by name; they share the folds, and the result is a dict. A fit that can take
    many tables ``together`` (``cox_cv.CoxFit``) fits all folds of all preparations so, and a score that has
    ``together`` (``cox_cv.CIndex``) scores them so; others run one after the other."""
    named = prepare if isinstance(prepare, dict) else {None: prepare}
    ensure_checkpoint_dir(df.sparkSession)
    folded = kfold(df, id_col, k, seed, event).checkpoint()  # every preparation's plan begins here
    trains, tests = [], []
    for prepared_by in named.values():
        for leaky in (False, True):
            for f in range(k):
                train, test = folded.where(F.col("fold") != f), folded.where(F.col("fold") == f)
                seen = folded if leaky else train
                trains.append(prepared_by(seen, train))
                tests.append(prepared_by(seen, test))
    fit = make_fit(list(features))
    models = fit.together(trains) if hasattr(fit, "together") else [_fitted(fit, t) for t in trains]
    scores = score.together(models, tests) if hasattr(score, "together") else [score(m, t) for m, t in zip(models, tests, strict=True)]
    out = {}
    for i, name in enumerate(named):
        own = scores[2 * k * i: 2 * k * (i + 1)]
        base, leaked = float(sum(own[:k]) / k), float(sum(own[k:]) / k)
        out[name] = base, leaked, (leaked - base) > threshold
    return out if isinstance(prepare, dict) else out[None]


def _fitted(fit, rows: DataFrame):
    rows = rows.persist()  # a fit reads its rows several times
    try:
        return fit(rows)
    finally:
        rows.unpersist()
