"""K1-K6 on the hand-worked tables of FIXTURES.md section 3 and edge inputs."""

import pytest

from tte.operators.curves import curve_at, ipcw_weights, km_curves, km_quantile, risk_table


def test_fixture_c_km(frame):
    df = frame(time=[1, 2, 2, 3, 3, 4.0], event=[1, 1, 0, 1, 1, 0])
    rows = {r.time: r for r in km_curves(df).collect()}
    assert [round(rows[t].surv, 6) for t in (1, 2, 3, 4)] == [0.833333, 0.666667, 0.222222, 0.222222]
    assert [round(rows[t].cens, 6) for t in (1, 2, 3, 4)] == [1.0, 0.8, 0.8, 0.0]
    ef = {r.time: r.cens for r in km_curves(df, ties="events_first").collect()}
    assert [round(ef[t], 6) for t in (1, 2, 3, 4)] == [1.0, 0.75, 0.75, 0.0]


def test_risk_table_counts(frame):
    df = frame(time=[1, 2, 2, 3, 3, 4.0], event=[1, 1, 0, 1, 1, 0])
    rt = {r.time: (r.n_at_risk, r.d, r.c) for r in risk_table(df).collect()}
    assert rt == {1.0: (6, 1, 0), 2.0: (5, 1, 1), 3.0: (3, 2, 0), 4.0: (1, 0, 1)}


def test_partition_count_independent(spark, frame):
    import numpy as np

    rng = np.random.default_rng(1)
    t = rng.integers(1, 500, 3000).astype(float)
    e = rng.integers(0, 2, 3000)
    df = frame(time=t, event=e)
    ref = {r.time: r.surv for r in km_curves(df).collect()}
    for parts in (1, 4, 37):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = {r.time: r.surv for r in km_curves(df).collect()}
        assert got.keys() == ref.keys()
        assert all(abs(got[k] - ref[k]) < 1e-12 for k in ref)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_step_and_linear_lookup(frame):
    df = frame(time=[4, 6, 12, 15.0], event=[1, 0, 1, 1])
    cur = km_curves(df)
    lin = {r.horizon: r.cens for r in curve_at(cur, [5, 10, 3, 20], "cens", "linear", clip=True).collect()}
    assert lin[5.0] == pytest.approx(5 / 6)
    assert lin[10.0] == pytest.approx(2 / 3)
    assert lin[3.0] == 1.0
    step = {r.horizon: r.surv for r in curve_at(cur, [5, 12], "surv", "step").collect()}
    assert step[5.0] == pytest.approx(0.75) and step[12.0] == pytest.approx(0.375)


def test_ipcw_weights_fixture_a(frame):
    df = frame(time=[4, 6, 12, 15.0], event=[1, 0, 1, 1], sid=[1, 2, 3, 4])
    w = {(r.sid, r.horizon): r.weight for r in ipcw_weights(df, [5.0, 10.0]).collect()}
    assert [round(w[(i, 5.0)], 6) for i in (1, 2, 3, 4)] == [1.0, 1.2, 1.2, 1.2]
    assert [round(w[(i, 10.0)], 6) for i in (1, 2, 3, 4)] == [1.0, 0.0, 1.5, 1.5]


def test_edges(frame, spark):
    empty = spark.createDataFrame([], "time double, event int")
    assert km_curves(empty).collect() == []
    one = frame(time=[3.0], event=[1])
    assert km_curves(one).collect()[0].surv == 0.0
    cens = frame(time=[1.0, 2.0, 3.0], event=[0, 0, 0])
    assert all(r.surv == 1.0 for r in km_curves(cens).collect())
    assert km_quantile(km_curves(cens)).collect()[0].time_at_p is None
    withnull = spark.createDataFrame([(1.0, 1), (None, 1), (2.0, None), (3.0, 0)], "time double, event int")
    assert {r.time for r in km_curves(withnull).collect()} == {1.0, 3.0}


def test_curve_scans_read_the_subjects_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf.assign(time=(pdf["id"] % 9).astype(float), event=pdf["id"] % 2).drop(columns="id")

    curve = km_curves(spark.range(60).mapInPandas(read, "time double, event long"))
    assert curve.count() == 9 and curve_at(curve, [3.0], "surv").count() == 1
    assert seen.value == 60
