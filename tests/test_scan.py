"""B1 banded scans equal the plain window and keep no unpartitioned window over rows."""

import numpy as np

from tte.operators import scan


def test_prefix_sum_banded_equals_plain(frame):
    rng = np.random.default_rng(2)
    k = rng.integers(0, 300, 2000).astype(float)
    g = rng.integers(0, 3, 2000)
    df = frame(k=k, v=np.ones(2000), g=g)
    plain = {(int(a), float(b)): float(np.sum((g == a) & (k <= b))) for a, b in zip(g, k, strict=True)}
    banded = {(r.g, r.k): r.cum_v for r in scan.prefix_sum(df, "k", ["v"], by=["g"], k=7).collect()}
    assert plain == banded
    excl = {(r.g, r.k): r.cum_v for r in scan.prefix_sum(df, "k", ["v"], by=["g"], k=7, exclusive=True).collect()}
    for (gg, kk), val in excl.items():
        assert val == float(np.sum((g == gg) & (k < kk)))


def test_banded_plan_has_partitioned_window(frame):
    df = frame(k=np.arange(100.0), v=np.ones(100))
    plan = scan.prefix_sum(df, "k", ["v"], k=4)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and scan.BAND in plan


def test_carry_forward(frame):
    df = frame(key=[1, 1, 1, 1, 2, 2], o=[1, 2, 3, 4, 1, 2], v=[10.0, None, None, 20.0, None, 5.0])
    df = df.withColumn("o", df["o"].cast("long"))
    for k in (None, 3):
        got = {(r.key, r.o): r.prev for r in scan.carry_forward(df, ["key"], "o", "v", "prev", k=k).collect()}
        assert got[(1, 1)] is None and got[(1, 2)] == 10.0 and got[(1, 4)] == 10.0 and got[(2, 2)] is None


def test_every_size_is_banded(frame):
    """No window over data rows without the band among its partition keys, whatever the size."""
    import re

    for n in (3, 400):
        df = frame(k=np.arange(float(n)), v=np.ones(n))
        for out in (scan.prefix_sum(df, "k", ["v"]), scan.carry_forward(df.withColumn("o", df["k"].cast("long")), ["v"], "o", "k", "prev")):
            plan = out._jdf.queryExecution().optimizedPlan().toString()
            windows = re.findall(r"Window \[(?:first|last|sum)\((?:v|k)#.*", plan)
            assert windows and all(scan.BAND in w for w in windows)


def test_more_rows_more_bands_and_new_data_new_plan(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(scan, "BAND_ROWS", 20)
    assert len(scan.plan_bands(frame(k=np.arange(1000.0)), "k")) == 49
    path = str(tmp_path / "t")
    frame(k=np.arange(10.0)).write.parquet(path)
    few = scan.plan_bands(spark.read.parquet(path), "k")
    frame(k=np.arange(1000.0) + 5).write.mode("overwrite").parquet(path)
    spark.catalog.refreshByPath(path)
    assert max(scan.plan_bands(spark.read.parquet(path), "k")) > max(few)


def test_band_ids_are_monotone_and_single_out_cut_points(frame):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 50, 500).astype(float)
    for cuts in ([], [3.0], sorted(set(rng.integers(0, 50, 17).astype(float)))):
        rows = frame(x=x).withColumn("b", scan.band_of("x", cuts)).collect()
        assert all(r.b == 2 * sum(c < r.x for c in cuts) + (r.x in cuts) for r in rows)


def test_compiled_bands_are_those_of_the_expression(spark):
    x = [None, float("nan"), float("-inf"), float("inf"), -0.0, 0.0, 1.0, 1.5, 2.0, 3.0, -1.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    for cuts in ([], [1.0], [-0.0, 2.0], [-1.0, 0.0, 1.0, 2.0, 3.0], [1.0, float("inf")]):
        rows = scan.banded(df, "x", cuts, "b").withColumn("e", scan.band_of("x", cuts)).collect()
        assert [r.b for r in rows] == [r.e for r in rows]
