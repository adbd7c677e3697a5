"""Log-time fits, ensembles, classifier kinds and bootstrap intervals."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tte.operators.explain import treatment_effect_interval
from tte.operators.metrics import bootstrap_auc, bootstrap_brier, brier_score, dynamic_auc
from tte.operators.replicates import bootstrap_weights
from tte.operators.models.aft import LocationScaleAFT
from tte.operators.models.ensemble import CLASSIFIERS, Bagging, average_arrays, dynamic_scores, horizon_classifier, stacked_scores
from tte.operators.models.linear import LinearRisk
from tte.operators.monitor import best_average, experiment_means, select_ensemble


@pytest.fixture(scope="module")
def cohort(spark):
    import pandas as pd

    rng = np.random.default_rng(8)
    n = 1500
    x = rng.normal(size=n)
    t = np.exp(2.0 + 0.7 * x + 0.5 * rng.logistic(size=n))
    c = rng.uniform(1, 60, n)
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "x": x, "time": np.minimum(t, c).round(3) + 0.001, "event": (t <= c).astype(int)})).cache()


@pytest.mark.parametrize("dist", ["normal", "logistic"])
def test_log_time_fit_is_a_maximum(cohort, dist):
    m = LocationScaleAFT(["x"], dist).fit(cohort)
    assert m.converged_ and m.n_excluded_ == 0
    if dist == "logistic":
        assert (m.intercept_, m.coef_[0], m.sigma_) == pytest.approx((2.0, 0.7, 0.5), abs=0.08)
    rows = cohort.select("x", "time", "event").toPandas()
    import math

    def loglik(b0, b1, s):
        z = (np.log(rows.time) - b0 - b1 * rows.x) / s
        if dist == "logistic":
            f, surv = z - 2 * np.log1p(np.exp(z)), -np.log1p(np.exp(z))
        else:
            f = -0.5 * z ** 2 - 0.5 * np.log(2 * np.pi)
            surv = np.array([math.log(0.5 * math.erfc(v / math.sqrt(2))) for v in z])
        return float(np.where(rows.event == 1, f - np.log(s), surv).sum())

    best = loglik(m.intercept_, m.coef_[0], m.sigma_)
    assert best == pytest.approx(m.loglik_, rel=1e-8)
    for d in ((0.02, 0, 0), (0, 0.02, 0), (0, 0, 0.02)):
        assert loglik(m.intercept_ + d[0], m.coef_[0] + d[1], m.sigma_ + d[2]) < best
        assert loglik(m.intercept_ - d[0], m.coef_[0] - d[1], m.sigma_ - d[2]) < best
    s = m.survival(cohort.limit(20), [1.0, 10.0, 50.0]).collect()
    assert all(1 >= r.surv[0] >= r.surv[1] >= r.surv[2] >= 0 for r in s)


def test_bagging_survival_is_the_members_mean(cohort):
    df = cohort.withColumn("y", F.col("x") * 0.5 + (F.col("id") % 7))
    bag = Bagging(["x", "y"], n=2, feat_frac=0.5, seed=3).fit(df, "id")
    some = df.where("id < 30")
    got = {r.id: r.surv for r in bag.survival(some, [5.0, 20.0]).collect()}
    parts = [{r.id: r.surv for r in m.survival(some, [5.0, 20.0]).collect()} for m in bag.members_]
    for i, s in got.items():
        assert s == pytest.approx([np.mean([p[i][k] for p in parts]) for k in range(2)])


def test_combined_scores(frame):
    df = frame(a=[1.0, 3.0], b=[0.0, 2.0])
    rows = stacked_scores(df, ["a", "b"], [0.5, 0.25], 0.1, [100.0]).collect()
    assert [r.risk for r in rows] == pytest.approx([0.6, 2.1]) and rows[0].surv[0] == pytest.approx(np.exp(-0.06))
    assert [r.risk for r in dynamic_scores(df, ["a", "b"], [10.0]).collect()] == [0.5, 2.5]
    assert average_arrays(frame(i=[1]).select(F.array(F.lit(1.0)).alias("p"), F.array(F.lit(3.0)).alias("q")), ["p", "q"]).first().surv == [2.0]


@pytest.mark.parametrize("kind", sorted(CLASSIFIERS))
def test_every_classifier_orders_the_risks(cohort, kind):
    score = horizon_classifier(cohort, ["x"], 8.0, kind=kind)
    rows = score(cohort.select("id", "x")).collect()
    assert len(rows) == 1500 and all(0 <= r.risk <= 1 for r in rows)
    x, p = np.array([r.x for r in rows]), np.array([r.risk for r in rows])
    assert p[x < -1].mean() > p[x > 1].mean() + 0.1


def test_bootstrap_intervals_follow_the_hashed_weights(cohort):
    hs = [5.0, 20.0]
    scored = cohort.withColumn("risk", -F.col("x"))
    long = scored.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in hs]))).withColumn("surv", F.exp(-F.col("horizon") * F.exp(F.col("risk")) / 40))
    brier, ibs = bootstrap_brier(cohort, long, hs, "id", reps=8, same_times=True)
    point = {r.horizon: r.brier for r in brier_score(cohort, long, hs, same_times=True).collect()}
    got = {r.horizon: r for r in brier.collect()}
    assert all(got[h].estimate == pytest.approx(point[h]) and got[h].ci_lower < got[h].ci_upper and got[h].reps == 8 for h in hs)
    one = ibs.first()
    assert one.estimate == pytest.approx(sum(point.values()) / 2) and one.ci_lower <= one.ci_upper
    auc = {r.horizon: r for r in bootstrap_auc(cohort, scored, hs, "id", reps=5, same_times=True).collect()}
    want = {r.horizon: r.auc for r in dynamic_auc(cohort, scored, hs, same_times=True)[0].collect()}
    # a replicate is the AUC of the rows repeated by their weights, with G of the given rows
    w = bootstrap_weights(scored, "id", 5, 42).select("id", "rep", "bw").toPandas()
    assert set(w.rep) == set(range(5)) and w.groupby("rep").bw.sum().between(1300, 1700).all()
    assert all(auc[h].estimate == pytest.approx(want[h]) and abs(auc[h].ci_lower - want[h]) < 0.1 for h in hs)


def test_treatment_interval(cohort):
    model = LinearRisk({"x": 0.5})
    r = {row.value: row for row in treatment_effect_interval(cohort, "id", model.risk, "x", [0.0, 2.0], reps=10).collect()}
    assert r[2.0].effect == pytest.approx(1.0) and r[2.0].ci_lower == pytest.approx(1.0) and r[0.0].ci_upper == pytest.approx(0.0)


def test_choice_of_models(frame):
    ranked = frame(model=["a", "b", "c"], score=[0.9, 0.8, 0.7], rank=[1, 2, 3])
    assert {r.model: r.weight for r in select_ensemble(ranked, 2).collect()} == {"a": 0.5, "b": 0.5}
    both = ranked.withColumn("metric", F.lit("c")).unionByName(frame(model=["a", "b", "c"], score=[0.3, 0.1, 0.2], rank=[3, 1, 2]).withColumn("metric", F.lit("b")))
    assert best_average(both).first().model == "b"
    means = {r.experiment: (r.n_runs, r.mean_m) for r in experiment_means(frame(experiment=["x", "x", "y"], m=[1.0, 2.0, 5.0]), ["m"]).collect()}
    assert means == {"x": (2, 1.5), "y": (1, 5.0)}


def test_group_fits_are_those_of_each_group_alone(spark, cohort):
    from tte.operators.models.cox import cox_newton_local
    from tte.operators.models.ensemble import fit_per_group

    # one group in several bands, small ones inside a band, a null key, a group without an event and one of unusable rows
    g = (F.when(F.col("id") % 10 < 7, "large").when(F.col("id") % 10 == 7, F.lit(None)).when(F.col("id") % 50 == 8, "none").when(F.col("id") % 50 == 9, "bad")
         .otherwise(F.concat(F.lit("s"), F.col("id") % 5)))
    df = (cohort.withColumn("g", g).withColumn("event", F.when(F.col("g") == "none", 0).otherwise(F.col("event")))
          .withColumn("x", F.when((F.col("g") == "bad") | (F.col("id") % 97 == 0), F.lit(None)).otherwise(F.col("x"))))
    got = {r.g: (r.n, r.coef_x) for r in fit_per_group(df, "g", ["x"], alpha=0.1).collect()}
    rows = df.toPandas()
    assert set(got) == set(rows.g.unique())
    for key, part in rows.groupby("g", dropna=False):
        part = part.dropna(subset=["x"])
        n, coef = got[None if key != key else key]
        assert n == len(part)
        if key in ("none", "bad"):
            assert coef is None
        else:
            want = cox_newton_local(part[["x"]].to_numpy(float), part.time.to_numpy(float), part.event.to_numpy(float), 0.1)[0]
            assert coef == pytest.approx(want, abs=1e-8)
