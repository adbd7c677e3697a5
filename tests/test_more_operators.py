"""Isolation forest, Shapley, iterative imputer, domain checks, stream alert idempotency, monitor."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F


def test_isolation_flags_outliers(spark):
    rng = np.random.default_rng(0)
    rows = [(float(x), float(y)) for x, y in rng.normal(size=(2000, 2))] + [(15.0, 15.0), (-14.0, 16.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    from tte.operators.quality import isolation_scores

    s = isolation_scores(df, ["a", "b"], trees=30, sample=128, contamination=0.05)
    flagged = s.where("is_anomaly").count()
    assert 0.03 * 2002 <= flagged <= 0.08 * 2002
    far = s.where("a > 10 OR a < -10").collect()
    assert all(r.is_anomaly for r in far)


def test_sampled_shapley_linear(spark):
    from tte.operators.explain import sampled_shapley
    from tte.operators.models.linear import LinearRisk

    df = spark.createDataFrame([(i, float(i % 7), float(i % 3)) for i in range(60)], "id int, a double, b double")
    bg = spark.createDataFrame([(1000, 0.0, 0.0)], "id int, a double, b double")
    m = LinearRisk({"a": 0.5, "b": -2.0})
    sh = {(r.id, r.feature): r.shapley for r in sampled_shapley(df, "id", m.risk, ["a", "b"], bg, draws=4).collect()}
    for r in df.collect():
        assert sh[(r.id, "a")] == pytest.approx(0.5 * r.a) and sh[(r.id, "b")] == pytest.approx(-2.0 * r.b)


def test_iterative_imputer_recovers_linear(spark):
    from tte.operators.prep import IterativeImputer

    rows = [(float(i), None if i % 4 == 0 else 2.0 * i + 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "x double, y double")
    imp = IterativeImputer(["x", "y"], max_iter=5).fit(df)
    out = df.select("x", imp.exprs(df)["y"].alias("y")).collect()
    assert all(r.y == pytest.approx(2.0 * r.x + 1.0, abs=1e-4) for r in out)


def test_domain_checks(spark):
    from tte.operators.quality import domain_checks

    df = spark.createDataFrame([(200.0, 5.0, "M"), (-1.0, 30.0, "x"), (50.0, 1.0, None)], "age double, sofa double, sex string")
    got = {r.check: r.n_rows for r in domain_checks(df).collect()}
    assert got == {"age_negative": 1, "age_too_high": 1, "sofa_too_high": 1, "values_sex": 1}


def test_stream_alerts_idempotent(spark, tmp_path):
    from tte.streaming.stream import read_stream, stream_alerts

    rules = spark.createDataFrame([("v", "column_completeness_value", "==", 100.0, "info", True)],
                                  "rule_id string, metric string, condition string, threshold double, severity string, enabled boolean")
    path, counts = os.path.join(str(tmp_path), "alerts"), []
    for _ in range(2):  # the second run finds the checkpoint and adds nothing
        s = read_stream(spark, "/root/testdata/sf0.001/events.parquet")
        q = stream_alerts(s, rules, ["value"]).writeStream.format("parquet").option("path", path).option(
            "checkpointLocation", os.path.join(str(tmp_path), "chk")).trigger(availableNow=True).start()
        q.awaitTermination()
        counts.append(spark.read.parquet(path).count())
    assert counts[0] == counts[1]
    a = spark.read.parquet(path)
    assert a.count() == a.select("rule_id", "window_start").distinct().count() > 0


def test_alert_state_fold(spark):
    from tte.operators.monitor import alert_state

    log = spark.createDataFrame([("a", 1, "create"), ("a", 2, "resolve"), ("a", 3, "acknowledge"),
                                 ("b", 1, "create"), ("b", 2, "acknowledge"),
                                 ("c", 1, "acknowledge"), ("c", 2, "create")], "alert_id string, ts int, action string")
    st = {r.alert_id: r.status for r in alert_state(log).collect()}
    assert st == {"a": "resolved", "b": "acknowledged", "c": "active"}


def test_alerts_window(spark):
    from tte.operators.monitor import alerts

    rows = [(f"2024-01-0{d}", "m", 100, c, 0.1, 0.0) for d, c in [(1, 0.8), (2, 0.8), (3, 0.8), (4, 0.6)]]
    h = spark.createDataFrame(rows, "ts string, model string, n_samples int, concordance double, brier double, drift double") \
        .withColumn("ts", F.to_timestamp("ts"))
    a = alerts(h).collect()
    assert [(r.ts.day, r.metric) for r in a] == [(4, "concordance")]
