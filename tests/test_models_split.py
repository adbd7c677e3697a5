"""Cox against the local Newton, splits and folds (properties), preprocessing constants."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tte.operators.models.cox import CoxPH, cox_newton_local
from tte.operators.prep import OneHot, SimpleImputer, StandardScaler, build_pipeline
from tte.operators.split import kfold, stratified_split


def test_cox_matches_local(frame):
    rng = np.random.default_rng(5)
    n = 500
    x = rng.normal(size=(n, 2))
    t = np.round(rng.exponential(np.exp(-(0.7 * x[:, 0] - 0.3 * x[:, 1]))) * 100)
    e = rng.integers(0, 2, n).astype(float)
    df = frame(a=x[:, 0], b=x[:, 1], time=t, event=e)
    m = CoxPH(["a", "b"], alpha=0.1).fit(df)
    ref = cox_newton_local(x, t, e, alpha=0.1)
    assert np.allclose(m.coef_, ref, atol=1e-6)
    s = m.survival(df, [10.0, 50.0, 200.0]).select("surv").collect()
    assert all(0 <= r.surv[2] <= r.surv[1] <= r.surv[0] <= 1 for r in s)


@settings(max_examples=5, deadline=None)
@given(test_size=st.floats(0.1, 0.9), seed=st.integers(0, 1000))
def test_stratified_split_properties(spark, test_size, seed):
    rows = [(i, int(i % 3 == 0), 20 + i % 50) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, event int, age int")
    s = stratified_split(df, "id", "event", test_size, seed)
    tr = s.where("split = 'train'").select("id").collect()
    te = s.where("split = 'test'").select("id").collect()
    assert len(tr) + len(te) == 300 and not ({r.id for r in tr} & {r.id for r in te})
    assert len(te) == int(300 * test_size)
    ev = s.groupBy("split").agg(F.avg("event").alias("r")).collect()
    rates = {r.split: r.r for r in ev}
    if len(rates) == 2:
        assert abs(rates["train"] - rates["test"]) <= 0.2


def test_split_invalid(frame):
    with pytest.raises(ValueError):
        stratified_split(frame(id=[1], event=[0]), "id", "event", 1.0, 1)


def test_kfold_deterministic_and_balanced(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(103)], "id int, event int")
    a = {r.id: r.fold for r in kfold(df, "id", 5, 7, "event").collect()}
    b = {r.id: r.fold for r in kfold(df, "id", 5, 7, "event").collect()}
    assert a == b
    sizes = np.bincount(list(a.values()))
    assert sizes.max() - sizes.min() <= 2


def test_prep_fit_on_train_only(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, None), (None, "b")], "x double, c string")
    test = spark.createDataFrame([(100.0, "zz"), (None, "a")], "x double, c string")
    pipe = build_pipeline([("imputer", {"strategy": "mean"}), ("scaler", {}), ("encoder", {})], ["x"], ["c"]).fit(train)
    out = pipe.transform(test).collect()
    assert out[1].x == pytest.approx(0.0)  # imputed with the train mean, then centred on it
    assert (out[0].c_a, out[0].c_b) == (0.0, 0.0) and out[1].c_a == 1.0
    sc = StandardScaler(["x"]).fit(spark.createDataFrame([(2.0,), (2.0,)], "x double"))
    assert sc.scale_["x"] == 1.0
    with pytest.raises(ValueError):
        OneHot(["c"], max_levels=1).fit(train)
    assert SimpleImputer(["c"], "most_frequent").fit(train).fill_["c"] == "a"


def test_fit_per_group_big_group_distributed(spark):
    from tte.operators.models.ensemble import fit_per_group

    rng = np.random.default_rng(9)
    n = 600
    g = np.where(np.arange(n) < 400, "big", np.where(np.arange(n) % 2 == 0, "s1", "s2"))
    x = rng.normal(size=n)
    t = np.round(rng.exponential(np.exp(-0.8 * x)) * 50) + 1
    e = rng.integers(0, 2, n).astype(float)
    import pandas as pd
    df = spark.createDataFrame(pd.DataFrame(dict(g=g, x=x, time=t, event=e)))
    from tte.operators.models.cox import cox_newton_local

    b = {r.g: r.coef_x for r in fit_per_group(df, "g", ["x"]).collect()}
    assert b.keys() == {"big", "s1", "s2"}
    assert all(abs(cox_newton_local(x[g == k, None], t[g == k], e[g == k])[0] - b[k]) < 1e-6 for k in b)
