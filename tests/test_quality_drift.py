"""Profiling, validation, cleansing and drift against the reference's test numbers."""

import numpy as np
import pytest

from tte.operators.drift import drift_scores, feature_stats
from tte.operators.quality import (
    Rule, cleanse_missing, iqr_outliers, profile_columns, quality_metrics, remove_outliers, top_values, validate,
)
from tte.operators.stats import exact_quantiles


def test_monitor_stats(frame):
    df = frame(num=[1.0, 2.0, 3.0, 4.0, 5.0], txt=["A", "B", "A", "C", "B"])
    st = {r.column: r for r in feature_stats(df, ["num"], ["txt"]).collect()}
    assert st["num"].mean == pytest.approx(3.0) and st["num"].std == pytest.approx(1.581139, abs=1e-6)
    assert st["txt"].unique_count == 3.0 and st["txt"].top_category_rate == pytest.approx(0.4)


def test_missing_completeness(spark):
    rows = [(i, None if i % 5 == 0 else 60.0 + i % 20) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, age double")
    _, cols = quality_metrics(df)
    comp = {r.column: r.completeness for r in cols.collect()}
    assert comp["age"] == pytest.approx(80.0)


def test_outliers_fixture(spark):
    age = [65.0] * 95 + [200.0, 5.0, 150.0, 0.0, -10.0]
    sofa = [8.0] * 95 + [30.0, 35.0, -5.0, 50.0, 25.0]
    df = spark.createDataFrame(list(zip(age, sofa)), "age double, sofa double")
    out = {r.column: r.outliers for r in iqr_outliers(df).collect()}
    assert out == {"age": 5, "sofa": 5}
    assert remove_outliers(df, ["age"]).count() == 95


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    v = rng.integers(0, 50, 1001).astype(float)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    q = {r.p: r.q for r in exact_quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.9]).collect()}
    for p in (0.1, 0.25, 0.5, 0.9):
        assert q[p] == pytest.approx(float(np.quantile(v, p)))


def test_profile_skew_kurt_corrected(spark):
    import pandas as pd

    v = [1.0, 2.0, 2.0, 3.0, 9.0, 4.0, 4.5]
    df = spark.createDataFrame([(x,) for x in v], "x double")
    p = profile_columns(df).collect()[0]
    s = pd.Series(v)
    assert p.skewness == pytest.approx(s.skew()) and p.kurtosis == pytest.approx(s.kurtosis())
    assert p.median == pytest.approx(s.median()) and p.q25 == pytest.approx(s.quantile(0.25))


def test_validate_rules(spark):
    df = spark.createDataFrame([(1.0, "M"), (None, "F"), (200.0, None), (50.0, "x")], "age double, sex string")
    rules = [Rule("c", "completeness", "age", "error", {"min_completeness": 95.0}),
             Rule("r", "range", "age", "warning", {"min_value": 0, "max_value": 120}),
             Rule("k", "categorical", "sex", "error", {"allowed_values": ["M", "F"]}),
             Rule("m", "range", "nope", "error", {})]
    per, summ = validate(df, rules)
    st = {r.rule_id: r for r in per.collect()}
    assert st["c"].status == "failed" and st["r"].violations == 1 and st["k"].violations == 2
    assert st["k"].examples == ["null", "x"] and st["m"].status == "failed"
    assert summ.collect()[0].overall == "failed"


def test_cleanse_missing(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (None, None, "a"), (3.0, None, None), (4.0, 1.0, "b")],
                               "x double, mostly_null double, t string")
    out = cleanse_missing(df)
    assert out.columns == ["x", "t"]
    rows = out.collect()
    assert rows[1].x == pytest.approx(8.0 / 3) and rows[2].t == "a"


def test_drift_scores(frame):
    a = frame(v=[1.0, 2.0, 3.0, 4.0], c=["x", "x", "y", "z"])
    b = frame(v=[3.0, 4.0, 5.0, 6.0], c=["x", "y", "y", "y"])
    d = {r.column: r.drift for r in drift_scores(feature_stats(a, ["v"], ["c"]), feature_stats(b, ["v"], ["c"])).collect()}
    assert d["v"] == pytest.approx(2.0 / np.std([1, 2, 3, 4], ddof=1))
    assert d["c"] == pytest.approx(1 / 3)  # max(|0.75 - 0.5|, |2 - 3| / 3)


def test_exact_quantiles_banded_path(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=3001).round(3)
    df = spark.createDataFrame([(float(x), int(i % 2)) for i, x in enumerate(v)], "x double, g int")
    q = {(r.g, r.p): r.q for r in exact_quantiles(df, ["x"], [0.05, 0.5, 0.95], by=["g"]).collect()}
    for g in (0, 1):
        for p in (0.05, 0.5, 0.95):
            assert q[(g, p)] == pytest.approx(float(np.quantile(v[np.arange(3001) % 2 == g], p)))


def test_categorical_statistics_by_period_with_nulls(spark):
    rows = [("a", "x"), ("a", "x"), ("a", "y"), ("a", None), ("b", None), (None, "z")]
    df = spark.createDataFrame(rows, "g string, c string")
    got = {r.g: (r.unique_count, r.top_category_rate, r.missing_rate) for r in feature_stats(df, [], ["c"], by=["g"]).collect()}
    assert got == {"a": (2.0, 2 / 3, 0.25), "b": (0.0, 0.0, 1.0), None: (1.0, 1.0, 0.0)}


def test_top_values_breaks_ties_by_value_and_leaves_nulls_out(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", None), ("c", 2), (None, 3)], "s string, n int")
    got = [tuple(r) for r in top_values(df, ["s", "n"], 2).collect()]
    assert sorted(got) == [("n", "1", 2), ("n", "2", 1), ("s", "a", 1), ("s", "c", 2)]
    assert "WindowGroupLimit" in top_values(df, ["s"], 2)._jdf.queryExecution().executedPlan().toString()


def test_batch_report_with_gaps(spark):
    """Rows without an outcome or prediction count as samples and enter no score; a batch without any outcome has null
    scores; the features' drift is against the first batch."""
    from pyspark.sql import functions as F

    from tte.operators.metrics import brier_score, integrated_brier
    from tte.operators.monitor import alerts, batch_report
    from tte.operators.pairs import concordance

    rows = [(f"2024-01-0{1 + i % 3}", float(1 + i * 7 % 11), int(i % 4 != 0), float(i * 5 % 13), "ab"[i % 2] if i % 6 else None) for i in range(60)]
    rows += [("2024-01-01", None, 1, 3.0, "a"), ("2024-01-02", 4.0, 1, None, "a"), ("2024-01-04", None, None, 1.0, "a"), (None, 1.0, 1, 1.0, "a")]
    df = spark.createDataFrame(rows, "day string, time double, event int, x double, c string").withColumn("day", F.to_date("day"))
    surv = [F.exp(-h * F.col("x") / 100) for h in (6.0, 3.0, 9.0)]
    r = batch_report(df, {"m": (F.col("x"), surv)}, "day", [6.0, 3.0, 9.0], ["x"], ["c"])
    got = {x.ts.day: x for x in r.metrics.collect()}
    assert sorted(got) == [1, 2, 3, 4] and [got[d].n_samples for d in (1, 2, 3, 4)] == [21, 21, 20, 1]
    for d in (1, 2, 3):
        part = df.where((F.dayofmonth("day") == d) & F.col("time").isNotNull())
        long = part.where("x is not null").withColumn("p", F.explode(F.array(*[F.struct(F.lit(h).alias("h"), s.alias("s")) for h, s in zip((6.0, 3.0, 9.0), surv)])))
        long = long.select("time", "event", F.col("p.h").alias("horizon"), F.col("p.s").alias("surv"))
        ibs = integrated_brier(brier_score(part, long, [3.0, 6.0, 9.0], same_times=True)).first()["ibs"]
        c = concordance(part.where("x is not null"), risk="x").first()["c_index"]
        assert abs(got[d].brier - ibs) < 1e-9 and abs(got[d].concordance - c) < 1e-9
    assert (got[4].brier, got[4].concordance) == (None, None)
    f = {(x.ts.day, x.column): x for x in r.features.collect()}
    assert f[1, "x"].drift == 0 and f[1, "c"].drift == 0 and f[2, "x"].missing_rate == 1 / 21
    assert all(got[d].drift == max(f[d, "x"].drift or 0, f[d, "c"].drift) for d in (1, 2, 3))
    assert alerts(r.metrics.na.fill(0.5)).columns[:2] == ["ts", "model"]


def test_isolation_draws_and_flat_trees(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from tte.operators.quality import flat_tree, path_lengths, tree_draws

    rows = spark.range(300).select(F.xxhash64("id").alias("_row"))
    drawn = tree_draws(rows, 4, 0.3, 7)
    assert "lambda" not in drawn._jdf.queryExecution().optimizedPlan().toString()  # compiled
    u = lambda t: F.pmod(F.xxhash64("_row", F.lit(t), F.lit(7)), F.lit(1 << 53)).cast("double") / float(1 << 53)
    expected = {(r._row, t) for t in range(4) for r in rows.where(u(t) < 0.3).collect()}
    assert {(r._row, r._t) for r in drawn.collect()} == expected
    tree = ("node", 0, 1.0, ("leaf", 3), ("node", 1, 5.0, ("leaf", 1), ("leaf", 2)))
    x = np.array([[0.0, 9.0], [1.0, 4.0], [2.0, 5.0]])
    assert path_lengths(flat_tree(tree, lambda n: n / 10), x, 8).tolist() == [1.3, 2.1, 2.2]
