"""M3, M4, M7, M10 on the hand-worked fixtures A, B and C."""

import pandas as pd
import pytest

from tte.operators.calibration import bin_equal, decision_curve_ipcw, reliability_ipcw
from tte.operators.metrics import brier_score, integrated_brier


def _long(spark, times, events, surv_by_h):
    rows = []
    for h, ss in surv_by_h.items():
        for i, (t, e, s) in enumerate(zip(times, events, ss)):
            rows.append((i, float(t), int(e), float(h), float(s)))
    return spark.createDataFrame(rows, "sid int, time double, event int, horizon double, surv double")


def test_reliability_fixture_a(spark):
    lp = _long(spark, [4, 6, 12, 15], [1, 0, 1, 1], {5: [.8, .6, .4, .2], 10: [.7, .5, .3, .1]})
    got = {(r.time, r.bin): r for r in reliability_ipcw(lp, [5.0, 10.0], bins=2).collect()}
    exp = {(5.0, 0): (0.3, 1.0, 0.999873, 1.0, 2), (5.0, 1): (0.7, 0.545455, 0.0, 1.0, 2),
           (10.0, 0): (0.2, 1.0, 0.999887, 1.0, 2), (10.0, 1): (0.6, 0.0, 0.0, 0.000196, 2)}
    assert set(got) == set(exp)
    for k, (e, o, lo, hi, n) in exp.items():
        r = got[k]
        assert (round(r.expected, 6), round(r.observed, 6), round(r.ci_lower, 6), round(r.ci_upper, 6), r["count"]) == \
            (e, o, lo, hi, n)


def test_decision_fixture_b(spark):
    lp = _long(spark, [5, 7, 9, 12], [1, 0, 1, 1], {8: [.6, .5, .4, .3]})
    got = {round(r.threshold, 2): r for r in decision_curve_ipcw(lp, [8.0], [0.2, 0.25, 0.45]).collect()}
    assert got[0.2].net_benefit == pytest.approx(0.0625) and got[0.2].treat_all == pytest.approx(0.0625)
    assert got[0.25].net_benefit == pytest.approx(0.0, abs=1e-12)
    assert got[0.45].net_benefit == pytest.approx(-0.613636, abs=1e-6)
    assert got[0.45].treat_all == pytest.approx(-0.363636, abs=1e-6)


def test_brier_ibs_fixture_c(spark):
    times, events = [1, 2, 2, 3, 3, 4], [1, 1, 0, 1, 1, 0]
    s = [.2, .4, .5, .6, .7, .9]
    lp = _long(spark, times, events, {2: s, 3: s})
    train = lp.where("horizon = 2.0").select("time", "event")
    b = {r.horizon: r.brier for r in brier_score(train, lp, [2.0, 3.0]).collect()}
    assert b[2.0] == pytest.approx(0.1) and b[3.0] == pytest.approx(0.233333, abs=1e-6)
    ibs = integrated_brier(brier_score(train, lp, [2.0, 3.0])).collect()[0].ibs
    assert ibs == pytest.approx(0.166667, abs=1e-6)


def test_bin_edges_drop_one(frame):
    df = frame(p=[0.0, 0.1, 0.3, 0.30000000000000004, 0.999, 1.0])
    bins = [r.b for r in df.select(bin_equal(df["p"], 10).alias("b")).collect()]
    assert bins == [0, 1, 2, 3, 9, 10]
