"""Discrete-time hazard models: boosted trees on weighted cells, hazards per subject."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from tte.operators.models import hazard
from tte.operators.models.hazard import DiscreteHazard, person_period

EDGES = (2.0, 4.0, 6.0)


@pytest.fixture
def cohort(frame):
    rng = np.random.default_rng(4)
    n = 1200
    a, b = rng.integers(0, 9, n).astype(float), rng.integers(-2, 3, n).astype(float)
    rare = (np.arange(n) % 100 == 0).astype(float)
    time = np.round(rng.exponential(6 / (1 + 0.4 * a + 5 * rare)), 2)
    return frame(id=list(range(n)), a=a.tolist(), b=b.tolist(), rare=rare.tolist(), time=time.tolist(),
                 event=(rng.random(n) < 0.4 + 0.1 * b).astype(int).tolist())


def fitted(df, kind="gbt"):
    return DiscreteHazard(["a", "b", "rare"], EDGES, kind, n_trees=5, depth=3, rounds=5).fit(df)


def risks(model, df):
    return {r.id: (r.risk, *r.surv) for r in model.survival(df, "id").collect()}


def test_boosted_trees_on_cells_are_those_on_rows(cohort, monkeypatch):
    by_row = risks(fitted(cohort), cohort)
    given = []
    fit = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df: (given.append(df), fit(self, df))[1])
    monkeypatch.setattr(hazard, "ROWS_ONE_BY_ONE", 0)
    model = fitted(cohort)
    by_cell = risks(model, cohort)
    assert by_cell.keys() == by_row.keys() and len(by_cell) == 1200
    assert all(np.allclose(by_cell[i], by_row[i], atol=1e-9) for i in by_row)
    monkeypatch.setattr(hazard, "BROADCAST_ROWS", 0)
    assert risks(model, cohort) == by_cell
    rows = person_period(cohort, EDGES).count()
    got = given[0].agg(F.count(F.lit(1)).alias("n"), F.sum("_weight").alias("w")).first()
    assert got.w == rows and got.n <= 9 * 5 * 2 * 3 * 2 < rows


def test_more_rows_make_no_more_cells(frame, monkeypatch):
    monkeypatch.setattr(hazard, "ROWS_ONE_BY_ONE", 0)
    rng = np.random.default_rng(5)

    def cells(n):
        df = frame(id=list(range(n)), a=rng.normal(size=n).tolist(), b=[1.0] * n, rare=[0.0] * n,
                   time=rng.exponential(4, n).tolist(), event=[1] * n)
        m = DiscreteHazard(["a", "b", "rare"], EDGES, "gbt", rounds=1)
        m.cuts_ = m._plan(df)
        return m._cells(df).count(), m, df

    most = (2 * hazard.BANDS - 1) * len(EDGES) * 2
    assert cells(500)[0] <= most and cells(4000)[0] <= most
    _, m, df = cells(500)
    gap = df.withColumn("a", F.when(F.col("id") % 50 != 0, F.col("a")))
    with pytest.raises(Exception, match="NaN"):  # as on rows
        m.fit(gap)
    m.fit(df)
    assert len(risks(m, gap)) == 500


@pytest.mark.parametrize("kind, limit", [("gbt", 0), ("gbt", 10**9), ("forest", 0)])
def test_repeated_and_null_ids(cohort, monkeypatch, kind, limit):
    monkeypatch.setattr(hazard, "ROWS_ONE_BY_ONE", limit)
    model = fitted(cohort, kind)
    single = risks(model, cohort)
    odd = cohort.withColumn("id", F.when(F.col("id") >= 10, F.floor(F.col("id") / 2).cast("long"))).where("id < 300 or id is null")
    got = model.survival(odd, "id")
    assert got.columns == ["id", "a", "b", "rare", "time", "event", "risk", "surv"]
    rows = got.collect()
    assert len(rows) == 590  # ten null ids are left out
    for r in rows:
        assert r.risk == pytest.approx(single[2 * r.id][0] + single[2 * r.id + 1][0]) and len(r.surv) == 6
        assert r.surv[-1] == pytest.approx(single[2 * r.id][-1] * single[2 * r.id + 1][-1])
