"""Unique hashed ranks, lookups at hot values, probes, bounds and edge rows of the models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tte.operators.curves import km_curves, lookup_curve
from tte.operators.explain import counterfactual_search, permute_column
from tte.operators.models.cox import CoxPH
from tte.operators.models.hazard import person_period
from tte.operators.models.linear import LinearRisk
from tte.operators.score import risk_percentile
from tte.operators.split import contiguous_folds, hashed_rank, leakage_probe


@pytest.fixture
def repeated_ids(frame):
    return frame(id=[i // 2 for i in range(1000)], x=[float(i % 17) for i in range(1000)], g=[i % 3 for i in range(1000)])


def test_ranks_are_a_numbering_even_with_repeated_ids(repeated_ids):
    got = sorted(r._rank for r in hashed_rank(repeated_ids, "id", 1).collect())
    assert got == list(range(1, 1001))
    per = {}
    for r in hashed_rank(repeated_ids, "id", 1, by=["g"]).collect():
        per.setdefault(r.g, []).append(r._rank)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in per.values())


def test_permutation_keeps_rows_and_values(repeated_ids):
    out = permute_column(repeated_ids, "id", "x", 5).collect()
    assert len(out) == 1000
    assert sorted(r.x for r in out) == sorted(float(i % 17) for i in range(1000))


def test_folds_at_a_hot_value(frame):
    v = [5.0] * 400 + [float(i) for i in range(600)]
    got = contiguous_folds(frame(v=v), "v", 4).collect()
    a = np.array(v)
    assert all(r.fold == min(int(np.sum(a < r.v) * 4 / 1000), 3) for r in got) and len(got) == 1000


@pytest.mark.parametrize("lookup", ["step", "linear"])
def test_lookup_at_a_hot_time_and_fine_times(frame, lookup):
    rng = np.random.default_rng(3)
    train = frame(time=rng.integers(1, 50, 300).astype(float), event=rng.integers(0, 2, 300))
    curve = sorted((r.time, r.cens) for r in km_curves(train).collect())
    ts = [7.0] * 200 + [7.0 + 1e-9, 0.5, 100.0] + list(rng.uniform(0, 60, 50))
    got = lookup_curve(frame(t=ts), km_curves(train).select("time", "cens"), "t", "cens", lookup).collect()
    assert len(got) == len(ts)
    x, y = np.array([c[0] for c in curve]), np.array([c[1] for c in curve])
    for r in got:
        i = np.searchsorted(x, r.t, side="right") - 1
        if i < 0:
            want = 1.0
        elif lookup == "step" or i == len(x) - 1 or x[i] == r.t:
            want = y[i]
        else:
            want = y[i] + (y[i + 1] - y[i]) * (r.t - x[i]) / (x[i + 1] - x[i])
        assert r.cens == pytest.approx(want if lookup == "step" else min(max(want, 1e-8), 1.0), abs=1e-9)


def test_percentile_at_a_hot_risk(frame):
    ref = [1.0] * 300 + [float(i) for i in range(10)]
    got = risk_percentile(frame(id=range(400), risk=[1.0] * 390 + [-5.0] * 5 + [50.0] * 5), frame(risk=ref)).collect()
    share = {v: np.mean(np.array(ref) <= v) for v in (1.0, -5.0, 50.0)}
    assert len(got) == 400 and all(r.ecdf == pytest.approx(share[r.risk]) for r in got)


def test_probe_catches_an_early_fit_and_passes_an_honest_one(frame):
    rng = np.random.default_rng(2)
    df = frame(subject_id=range(200), x=rng.normal(size=200), time=rng.integers(1, 400, 200).astype(float), event=[1] * 200)

    def centred(train, rows):
        return rows.withColumn("x", F.col("x") - F.lit(train.agg(F.avg("x")).first()[0]))

    def target(train, rows):
        means = train.select(F.col("subject_id").alias("_i"), F.col("time").alias("_m"))
        return rows.join(means, rows["subject_id"] == means["_i"], "left").withColumn("x", -F.coalesce("_m", F.lit(0.0))).drop("_i", "_m")

    from tte.operators.pairs import concordance
    fit = lambda feats: (lambda d: LinearRisk(dict.fromkeys(feats, 1.0)))
    score = lambda m, d: concordance(m.risk(d)).first()["c_index"] or 0.0
    assert leakage_probe(df, centred, fit, score, ["x"], k=2)[2] is False
    assert leakage_probe(df, target, fit, score, ["x"], k=2)[2] is True


def test_counterfactuals_stay_in_bounds(frame):
    rng = np.random.default_rng(1)
    df = frame(id=range(300), a=rng.uniform(0, 1, 300), b=rng.uniform(-1, 1, 300))
    model = LinearRisk({"a": 1.0, "b": 1.0})
    cf = counterfactual_search(df, "id", model.risk, {"a": (0.0, 1.0), "b": (-1.0, 1.0)}, target=5.0).collect()
    assert cf and all(0 <= r.a <= 1 and -1 <= r.b <= 1 for r in cf)
    assert counterfactual_search(df, "id", model.risk, {"a": (0.0, 1.0), "b": (-1.0, 1.0)}, 0.0, n=7).count() == 7


def test_person_period_keeps_events_at_time_zero(frame):
    rows = person_period(frame(id=[1, 2], time=[0.0, 3.0], event=[1, 0]), [2.0, 4.0]).collect()
    assert sorted((r.id, r.interval, r.target) for r in rows) == [(1, 1, 1.0), (2, 1, 0.0), (2, 2, 0.0)]


def test_cox_reports_convergence_and_excluded_rows(frame):
    rng = np.random.default_rng(5)
    x = np.append(rng.normal(size=400), np.nan)
    t = np.append(rng.exponential(np.exp(-x[:-1])), 1.0)
    df = frame(x=x, time=t, event=[1] * 401)
    model = CoxPH(["x"]).fit(df.withColumn("x", F.nanvl("x", F.lit(None).cast("double"))))
    assert model.converged_ and model.n_excluded_ == 1 and model.coef_[0] == pytest.approx(1.0, abs=0.2)
    with pytest.warns(UserWarning):
        assert not CoxPH(["x"], n_iter=1).fit(df.limit(400)).converged_


def test_probed_preparations_are_fitted_together_as_one_by_one(spark, frame):
    from tte.operators.models.cox_cv import CIndex, CoxFit

    rng = np.random.default_rng(4)
    n = 400
    x, g = rng.normal(size=n), rng.integers(0, 80, n)
    df = frame(subject_id=range(n), x=x, g=g.astype(float), time=np.ceil(rng.exponential(np.exp(-0.5 * x)) * 50), event=rng.integers(0, 2, n))
    df = df.withColumn("x", F.when(F.col("subject_id") % 50 != 0, F.col("x")))  # rows without a feature are left out

    def centred(train, rows):
        return rows.crossJoin(train.agg(F.avg("x").alias("_a"))).withColumn("x", F.col("x") - F.col("_a")).drop("_a")

    def target(train, rows):
        means = train.groupBy(F.col("g").alias("_g")).agg(F.avg("time").alias("_m"))
        return rows.join(means, rows["g"] == means["_g"], "left").withColumn("g", F.coalesce("_m", F.lit(50.0))).drop("_g", "_m")

    one_by_one = {name: leakage_probe(df, f, lambda feats: (lambda d: CoxPH(feats).fit(d)), lambda m, d: CIndex()(m, d), ["x", "g"], k=2)
                  for name, f in (("centred", centred), ("target", target))}
    spark.sparkContext.setJobGroup("probe", "together")
    try:
        together = leakage_probe(df, {"centred": centred, "target": target}, CoxFit, CIndex(), ["x", "g"], k=2)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert together.keys() == one_by_one.keys()
    for name, want in one_by_one.items():
        assert together[name][:2] == pytest.approx(want[:2], abs=1e-12) and together[name][2] is want[2]
    assert together["target"][2] is True
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("probe")) < 150  # 8 fits and 8 scores one by one: about 350


def test_cox_tables_are_scaled_and_counted_by_table(frame):
    from tte.operators.models.cox import cox_tables

    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 2))
    t = np.round(rng.exponential(np.exp(-x[:, 0])) * 20)
    a = frame(p=x[:, 0], q=x[:, 1], time=t, event=rng.integers(0, 2, 300))
    b = a.select((F.col("p") * 1000 + 5).alias("p"), F.when(F.col("q") < 1, F.col("q")).alias("q"), "time", "event")
    empty = a.where("p > 1e9")
    for table, m in zip((a, b, empty), cox_tables([a, b, empty], ["p", "q"], alpha=0.1), strict=True):
        alone = CoxPH(["p", "q"], alpha=0.1).fit(table)
        assert np.allclose(m.coef_, alone.coef_, atol=1e-10) and m.converged_ == alone.converged_ and m.n_excluded_ == alone.n_excluded_
        assert m.loglik_ == pytest.approx(alone.loglik_, abs=1e-6) and m.intercept_shift_ == pytest.approx(alone.intercept_shift_, abs=1e-6)
