"""Array scans, Cox fits made together, replicate weights, keyed permutations, level tables, buffers."""

import os
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tte.operators.explain import permuted_copies, sampled_shapley
from tte.operators.metrics import bootstrap_auc, bootstrap_concordance
from tte.operators.models.cox import CoxPH, cox_derivatives, cox_newton_local, cox_rows
from tte.operators.models.cox_cv import cox_nested_cv, cox_oof
from tte.operators.models.linear import LinearRisk
from tte.operators.pairs import concordance
from tte.operators.permute import digits, permutation_keys, permuted, row_numbers, with_permuted
from tte.operators.replicates import bootstrap_weights, coefficients, id_hash, replicate_sums, weight_matrix
from tte.operators.vector_scan import band_offsets, moments, ranged, running

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hot(spark):
    """600 subjects, four features, a third of them at one time."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 4))
    t = np.ceil(rng.exponential(np.exp(-0.6 * x[:, 0])) * 6)
    t[:200] = 3.0
    pdf = pd.DataFrame({"id": np.arange(600), **{f"x{i}": x[:, i] for i in range(4)}, "time": t, "event": rng.integers(0, 2, 600)})
    return spark.createDataFrame(pdf).repartition(5).persist(), pdf


def test_running_vectors_with_a_key_in_several_bands(spark, hot):
    df, pdf = hot
    bands = ranged(df.select(F.col("time").alias("t"), "x0", "x1", "id"), "t", 600, descending=True)
    offsets = band_offsets(bands, "t", lambda _, b: np.column_stack((b["x0"], b["x1"])))

    def scan(batches):
        import pyarrow as pa

        from tte.operators.vector_scan import band_of_batches
        n, b = band_of_batches(batches)
        if b:
            v = np.column_stack((b["x0"], b["x1"]))
            up, below = (running(b["t"], v, offsets[n, 0], exclusive=x) for x in (False, True))
            yield pa.RecordBatch.from_pydict({"id": pa.array(b["id"]), "a": pa.array(up[:, 0]), "b": pa.array(below[:, 1])})

    got = bands.mapInArrow(scan, "id long, a double, b double").toPandas().set_index("id")
    bands.unpersist()
    assert len({k[0] for k in offsets}) > 4
    for r in pdf.itertuples():
        assert got.a[r.id] == pytest.approx(pdf.x0[pdf.time >= r.time].sum(), abs=1e-9)
        assert got.b[r.id] == pytest.approx(pdf.x1[pdf.time > r.time].sum(), abs=1e-9)


def test_cox_with_a_hot_time_and_its_folds(hot):
    df, pdf = hot
    feats = ["x0", "x1", "x2", "x3"]
    m = CoxPH(feats, alpha=0.2).fit(df)
    want = cox_newton_local(pdf[feats].to_numpy(), pdf.time.to_numpy(), pdf.event.to_numpy(), alpha=0.2)
    assert m.converged_ and np.allclose(m.coef_, want, atol=1e-8)
    oof, models = cox_oof(df, feats, alpha=0.2, k=3, id_col="id")
    rows = oof.toPandas()
    for f in range(3):
        part = rows[rows.fold != f]
        alone = cox_newton_local(part[feats].to_numpy(), part.time.to_numpy(), part.event.to_numpy(), alpha=0.2)
        assert np.allclose(models[f].coef_, alone, atol=1e-7)
        held = rows[rows.fold == f]
        assert np.allclose(held.risk, held[feats].to_numpy() @ alone, atol=1e-6)


def test_derivatives_far_out_do_not_overflow(hot):
    df, pdf = hot
    data = ranged(cox_rows(df, ["x0"], np.zeros(1), np.ones(1), "time", "event"), "t", 600, descending=True)
    ll, grad, _ = cox_derivatives(data, {0: np.array([400.0])})[0]
    near, _, _ = cox_derivatives(data, {0: np.array([0.5])})[0]
    data.unpersist()
    assert np.isfinite(ll) and np.isfinite(grad).all() and ll < near


def test_plan_of_a_hundred_features_is_as_small_as_of_two(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 100))
    pdf = pd.DataFrame({**{f"x{i}": x[:, i] for i in range(100)}, "time": rng.exponential(size=400), "event": 1})
    df = spark.createDataFrame(pdf)
    feats = [f"x{i}" for i in range(100)]
    m = CoxPH(feats, alpha=5.0, n_iter=30).fit(df)
    assert np.allclose(m.coef_, cox_newton_local(x, pdf.time.to_numpy(), pdf.event.to_numpy(), alpha=5.0), atol=1e-7)
    data = ranged(cox_rows(df, feats, np.zeros(100), np.ones(100), "time", "event"), "t", 400)
    assert len(data.columns) == 3
    data.unpersist()


def test_nested_search_picks_by_inner_scores(hot):
    df, _ = hot
    got = cox_nested_cv(df, ["x0", "x1"], [0.0, 1e6], outer=2, inner=2, id_col="id").collect()
    assert [r.outer_fold for r in got] == [0, 1] and all(r.inner_c > 0.5 and r.outer_c > 0.5 for r in got)


def test_moments_are_one_matrix(hot):
    df, pdf = hot
    n, s, q = moments(df.withColumn("x1", F.when(F.col("id") > 9, F.col("x1"))), ["x0", "x1"])
    part = pdf[pdf.id > 9]
    x = part[["x0", "x1"]].to_numpy()
    assert n == len(part) and np.allclose(s, x.sum(axis=0)) and np.allclose(q, x.T @ x)


def test_weights_are_the_same_everywhere(spark, hot):
    df, _ = hot
    rows = bootstrap_weights(df.select("id", "x0"), "id", 6, 9).toPandas()
    ids = df.select("id", id_hash("id").alias("x")).toPandas()
    matrix = weight_matrix(ids.x.to_numpy(), coefficients(9, 6))
    want = {(i, r): matrix[k, r] for k, i in enumerate(ids.id) for r in range(6)}
    assert all(want[r.id, r.rep] == r.bw for r in rows.itertuples())
    assert 0.9 < matrix.mean() < 1.1 and abs((matrix == 0).mean() - np.exp(-1)) < 0.04 and matrix.max() >= 4
    got = replicate_sums(df, "id", ["x0"], 6, 9, ["event"]).collect()
    for r in got:
        own = df.where(F.col("event") == r.event).select("id", "x0").toPandas().set_index("id").x0
        assert np.allclose(r.x0, [sum(want[i, k] * v for i, v in own.items()) for k in range(6)])


def test_replicates_of_c_and_auc_are_those_of_repeated_rows(spark, hot):
    df, _ = hot
    scored = df.withColumn("risk", F.round("x0", 1))
    reps = 5
    drawn = bootstrap_weights(scored, "id", reps, 42).where("bw > 0")
    c = sorted(r.c_index for r in concordance(drawn, by=["rep"], weight="bw").collect())
    ci = bootstrap_concordance(scored, "id", reps=reps).first()
    assert (ci.ci_lower, ci.ci_upper) == pytest.approx((np.quantile(c, 0.025), np.quantile(c, 0.975)))
    w = drawn.select("id", "rep", "bw").toPandas()
    from tte.operators.metrics import _g_at_times
    g = _g_at_times(scored, scored, "time", "event", True).toPandas().set_index("id")
    for h, r in {x.horizon: x for x in bootstrap_auc(scored, scored, [3.0, 6.0], "id", reps=reps, same_times=True).collect()}.items():
        aucs = []
        for rep in range(reps):
            own = w[w.rep == rep].set_index("id").bw
            rows = g.loc[own.index]
            case, late = (rows.time <= h) & (rows.event == 1) & (rows.g_t > 0), rows.time > h
            cw, kw = own[case] / rows.g_t[case], own[late]
            above = (rows.risk[case].to_numpy()[:, None] > rows.risk[late].to_numpy()) + 0.5 * (rows.risk[case].to_numpy()[:, None] == rows.risk[late].to_numpy())
            aucs.append(cw.to_numpy() @ above @ kw.to_numpy() / (cw.sum() * kw.sum()))
        assert (r.ci_lower, r.ci_upper) == pytest.approx((np.quantile(aucs, 0.025), np.quantile(aucs, 0.975)))


@pytest.mark.parametrize("n", [1, 2, 5, 97, 600, 1000])
def test_permutation_is_one_to_one(spark, n):
    a, b = digits(n)
    assert n <= a * b < n + a
    keys = F.array(*[F.lit(k) for k in permutation_keys(3, "f")]).cast("array<bigint>")
    got = [r[0] for r in spark.range(n).select(permuted(F.col("id"), keys, n)).collect()]
    assert sorted(got) == list(range(n))
    if n > 90:
        assert sum(i == x for i, x in enumerate(got)) < 10 and abs(np.corrcoef(np.arange(n), got)[0, 1]) < 0.25


def test_copies_keep_every_value(spark, hot):
    df, pdf = hot
    rows = df.withColumn("id", F.when(F.col("id") < 590, F.col("id")))  # ids that repeat, being null
    numbered, n = row_numbers(rows, "id")
    assert n == 600 and sorted(r._row for r in numbered.select("_row").collect()) == list(range(600))
    got = permuted_copies(df, "id", ["x0", "x1"], 2, 42).toPandas()
    assert len(got) == 4 * 600
    for (f, _), part in got.groupby(["permuted", "rep"]):
        other = "x1" if f == "x0" else "x0"
        own = pdf.set_index("id").loc[part.id]
        assert Counter(part[f].round(12)) == Counter(pdf[f].round(12)) and np.allclose(part[other], own[other])
        assert (np.abs(part[f].to_numpy() - own[f].to_numpy()) > 1e-9).mean() > 0.9


def test_shapley_values_add_up(hot):
    df, pdf = hot

    def score(x):
        return x.withColumn("risk", F.col("x0") * F.col("x1") + F.exp(F.col("x2")) - F.col("x3"))

    feats = ["x0", "x1", "x2", "x3"]
    background = df.where("id = 7")  # one row, so the mean over the draws is its score
    values = sampled_shapley(df, "id", score, feats, background, draws=3)
    total = {r.id: r.s for r in values.groupBy("id").agg(F.sum("shapley").alias("s")).collect()}
    f = pdf.x0 * pdf.x1 + np.exp(pdf.x2) - pdf.x3
    assert all(total[i] == pytest.approx(f[i] - f[7], abs=1e-9) for i in pdf.id)
    one = {r.feature: r.shapley for r in sampled_shapley(df.where("id = 3"), "id", LinearRisk({"x0": 2.0, "x3": -1.0}).risk, ["x0", "x3"], background, draws=2).collect()}
    assert one["x0"] == pytest.approx(2 * (pdf.x0[3] - pdf.x0[7])) and one["x3"] == pytest.approx(-(pdf.x3[3] - pdf.x3[7]))


def test_level_dictionary_has_no_limit(spark):
    from tte.operators.prep import LevelDictionary, OneHot

    small = spark.createDataFrame([(1, "b", "x"), (2, "a", None), (3, "b", "y"), (4, "c", "x")], "id long, c string, d string")
    d = LevelDictionary(["d", "c"]).fit(small)
    wide = OneHot(["c", "d"]).fit(small)
    columns = [f"{c}_{v}" for c in ("c", "d") for v in wide.levels_[c]]
    dense = small.select("id", *[e.alias(n) for n, e in wide.exprs(small).items()]).collect()
    got = {r.id: r.levels.toArray().tolist() for r in d.transform(small, "id").collect()}
    assert d.size_ == len(columns) == 5 and got == {r.id: [r[c] for c in columns] for r in dense}
    unknown = d.transform(spark.createDataFrame([(9, "zz", "y")], "id long, c string, d string"), "id").first()
    assert unknown.levels.indices.tolist() == [columns.index("d_y")]
    many = spark.range(100_000).select("id", F.concat(F.lit("level "), "id").alias("c"), F.lit(1).alias("kept"))
    d = LevelDictionary(["c"]).fit(many)
    out = d.transform(many.where("id % 1000 = 0"), "id")
    assert d.size_ == 100_000 and out.columns == ["id", "kept", "levels"]
    assert len({r.levels.indices[0] for r in out.collect()}) == 100


@pytest.mark.parametrize("files", [1, 5])
def test_update_buffer_hands_the_newest_rows_on(spark, tmp_path, files):
    from tte.streaming.stream import read_stream, run_available_now, stream_update_buffer

    ev = spark.read.parquet(os.path.join(SF, "events.parquet")).select("event_id", "ts", "event_type", "value").orderBy("ts", "event_id").toPandas()
    for i, part in enumerate(np.array_split(np.arange(len(ev)), files)):  # the files come in order of time
        spark.createDataFrame(ev.iloc[part]).coalesce(1).write.parquet(f"{tmp_path}/src/{i}")
    stream = read_stream(spark, f"{tmp_path}/src/*", schema=spark.createDataFrame(ev.head(1)).schema, max_files_per_trigger=1)
    out, _ = run_available_now(stream_update_buffer(stream, "event_type", ["event_id", "value"], ["ts", "event_id"], 30, 20), "buffer")
    got = sorted((r.event_type, r.signal, r.event_id) for r in out.collect())
    want = []
    for kind, part in ev.groupby("event_type"):
        ids = part.event_id.tolist()
        want += [(kind, k + 1, i) for k in range(len(ids) // 30) for i in ids[30 * k + 10: 30 * k + 30]]
    assert got == sorted(want) and len(got) > 40


@pytest.mark.parametrize("n", [1, 7, 600, 1001])
def test_permuted_column_is_that_of_the_expression(spark, n):
    rows = spark.range(n).withColumn("keys", F.array(*[F.lit(k) for k in permutation_keys(5, "f")]).cast("array<bigint>"))
    moved = with_permuted(rows, "id", "keys", n, "to")
    assert moved.columns == ["id", "keys", "to"]
    assert moved.where(~F.col("to").eqNullSafe(permuted(F.col("id"), F.col("keys"), n))).count() == 0
    # each digit is made once: as one expression it is repeated wherever a round reads it
    assert str(moved._jdf.queryExecution().optimizedPlan().toString()).count("40503") < 185


def test_a_walks_order_is_not_sorted_in_the_row(spark):
    df = spark.createDataFrame([(i, float(i), float(i % 3)) for i in range(12)] + [(3, 1.0, 2.0), (None, 4.0, 5.0)], "id long, a double, b double")
    model = LinearRisk({"a": 2.0, "b": -1.0})
    out = sampled_shapley(df, "id", model.risk, ["a", "b"], df, draws=4)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan and "lambda" not in plan and "decimal" not in plan
    # a repeated id is one subject of twice the draws, as is a null one
    assert out.count() == 2 * 13 and out.where("shapley is null").count() == 0


def test_subjects_rows_share_their_weights(spark):
    df = spark.createDataFrame([(i, h, float(i + h)) for i in range(5) for h in range(3)], "id long, h int, v double").coalesce(1)
    rows = list(df.select(id_hash("id").alias("x"), "h", "v").toPandas().itertuples())
    got = {r.h: r for r in replicate_sums(df, "id", ["v"], 4, 1, ["h"]).collect()}
    for h in range(3):
        own = [r for r in rows if r.h == h]
        w = weight_matrix(np.array([r.x for r in own]), coefficients(1, 4))
        assert np.allclose(got[h].v, w.T @ [r.v for r in own]) and np.allclose(got[h].w, w.sum(axis=0))
