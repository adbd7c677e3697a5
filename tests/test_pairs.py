"""B3 / M1 / M2 against brute force, hand-worked ties and invariants."""

import numpy as np
import pandas as pd
import pytest

from tte.operators.pairs import concordance, concordance_events_only, dominance_counts


def brute(t, e, r):
    con = dis = tr = tt = 0
    for i in range(len(t)):
        if not e[i]:
            continue
        for j in range(len(t)):
            if t[j] > t[i] or (t[j] == t[i] and e[j] == 0):
                con += r[j] < r[i]
                tr += r[j] == r[i]
                dis += r[j] > r[i]
                tt += t[j] == t[i]
    return con, dis, tr, tt


def test_fixture_c(frame):
    df = frame(time=[1, 2, 2, 3, 3, 4.0], event=[1, 1, 0, 1, 1, 0], risk=[.9, .5, .5, .7, .2, .1])
    r = concordance(df).collect()[0]
    assert (r.concordant, r.discordant, r.tied_risk, r.tied_time, r.comparable) == (9, 1, 1, 1, 11)
    assert r.c_index == pytest.approx(0.863636, abs=1e-6)
    m2 = concordance_events_only(df).collect()[0]
    assert m2.concordance == pytest.approx(0.8)


@pytest.mark.parametrize("k", [1, 4, 37])
def test_brute_force_heavy_ties(frame, k):
    rng = np.random.default_rng(k)
    n = 300
    t = rng.integers(0, 20, n).astype(float)
    e = rng.integers(0, 2, n)
    r = rng.integers(0, 15, n).astype(float)
    df = frame(time=t, event=e, risk=r)
    got = concordance(df, k=k).collect()[0]
    assert (got.concordant, got.discordant, got.tied_risk, got.tied_time) == brute(t, e, r)


def test_by_groups_and_symmetry(frame):
    rng = np.random.default_rng(3)
    n = 400
    t = rng.exponential(10, n).round(3)
    e = rng.integers(0, 2, n)
    r = rng.normal(size=n)
    g = rng.integers(0, 3, n)
    df = frame(time=t, event=e, risk=r, g=g)
    by = {row.g: row for row in concordance(df, by=["g"], k=4).collect()}
    for gv, row in by.items():
        m = g == gv
        assert (row.concordant, row.discordant, row.tied_risk, row.tied_time) == brute(t[m], e[m], r[m])
    a = concordance(df).collect()[0].c_index
    b = concordance(df.withColumn("risk", -df["risk"])).collect()[0].c_index
    assert a + b == pytest.approx(1.0)


def test_kernel_direct():
    less, eq, greater = dominance_counts(np.array([4, 8]), np.array([1.0, 2.0]), np.array([1.0, 1.0]),
                                         np.array([1]), np.array([1.5]), np.array([2.0]))
    assert (less, eq, greater) == (2.0, 0.0, 2.0)


def test_no_comparable_pair(frame):
    df = frame(time=[1.0, 2.0], event=[0, 0], risk=[0.1, 0.2])
    assert concordance(df).collect()[0].c_index is None
    assert concordance_events_only(df).collect() == [] or concordance_events_only(df).collect()[0].concordance == 0.0


@pytest.mark.parametrize("hot", ["time", "risk"])
def test_hot_key_third_of_rows(frame, hot):
    """A third of the rows share one time (or one risk): still exact under banding; the hot value
    gets its own single-valued band and is counted without a Python group."""
    rng = np.random.default_rng(11)
    n = 360
    t = rng.integers(0, 50, n).astype(float)
    e = rng.integers(0, 2, n)
    r = rng.normal(size=n).round(2)
    if hot == "time":
        t[: n // 3] = 17.0
    else:
        r[: n // 3] = 0.5
    df = frame(time=t, event=e, risk=r)
    got = concordance(df, k=8).collect()[0]
    assert (got.concordant, got.discordant, got.tied_risk, got.tied_time) == brute(t, e, r)


def test_shuffle_partition_count_independent(spark, frame):
    """Band count comes from spark.sql.shuffle.partitions when k is not given."""
    rng = np.random.default_rng(21)
    t = rng.integers(0, 100, 2000).astype(float)
    e = rng.integers(0, 2, 2000)
    r = rng.normal(size=2000).round(2)
    df = frame(time=t, event=e, risk=r)
    ref = brute(t, e, r)
    try:
        for parts in (1, 4, 37):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            got = concordance(df).collect()[0]
            assert (got.concordant, got.discordant, got.tied_risk, got.tied_time) == ref
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_concordance_by_a_column_with_an_inner_name(spark):
    rows = [(g, float(t), int(t % 3 != 0), float(t * 7 % 5)) for g in (1, 2) for t in range(1, 25)]
    df = spark.createDataFrame(rows, "_b int, time double, event int, risk double")
    got = [r.c_index for r in concordance(df, by=["_b"]).collect()]
    want = concordance(df.where("_b = 1")).first()["c_index"]
    assert len(got) == 2 and want is not None and all(abs(c - want) < 1e-12 for c in got)


def test_concordance_reads_its_rows_once(spark):
    from pyspark.sql import functions as F

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(300).select((F.col("id") % 50).cast("double").alias("time"), (F.col("id") % 2).cast("int").alias("event"),
                                   (F.col("id") % 7).cast("double").alias("risk"))
    got = concordance(rows.mapInArrow(counted, rows.schema)).collect()
    assert len(got) == 1 and read.value == 300


def test_kernels_run_once_and_bands_are_compiled(spark):
    from tte.operators.pairs import dominance, plan_points
    from tte.operators.scan import banded

    pts = spark.range(500).selectExpr("cast(id % 90 as double) xv", "cast(id % 2 as int) tie", "cast(id % 70 as double) y", "1.0d w").checkpoint()
    plan = lambda df: df._jdf.queryExecution().toString()
    assert "FlatMapGroupsInPandas" not in plan(dominance(pts, plan=plan_points(pts, 4)))  # the pass and the sums read the kernels' written rows
    assert "lambda" not in plan(banded(pts, "y", [10.0, 20.0, 30.0], "rb"))


def test_few_times_are_bands_and_cells_follow_the_largest_group(spark, frame):
    from pyspark.sql import functions as F

    from tte.operators import pairs

    rng = np.random.default_rng(8)
    n = 3000
    t, e, r, g = rng.integers(0, 6, n).astype(float), rng.integers(0, 2, n), rng.normal(size=n).round(2), rng.integers(0, 3, n)
    r[:900] = 0.5  # a hot risk
    df = frame(time=t, event=e, risk=r, g=g)
    for row in concordance(df, by=["g"]).collect():
        m = g == row.g
        assert (row.concordant, row.discordant, row.tied_risk, row.tied_time) == brute(t[m], e[m], r[m])
    pts = df.select("g", F.col("time").alias("xv"), (1 - F.col("event")).alias("tie"), F.col("risk").alias("y"), F.lit(1.0).alias("w"))
    times = pts.groupBy("g", "xv").agg(F.count(F.lit(1)).alias("_tte_n"))
    rows, cuts_t, cuts_r = pairs.plan_points(pts, rows=True, by=["g"], times=times)
    assert rows == n and cuts_t == [float(x) for x in range(6)]  # no time is shared by a band: there is no kernel over a time band
    assert len(cuts_r) <= 2  # 8 partitions and 3 groups: 3 bands of each group, not 8


def test_counts_in_levels_of_the_key_equal_all_pairs():
    rng = np.random.default_rng(9)
    for n, keys, ys, shape in ((1, 1, 1, ()), (200, 3, 50, ()), (150, 90_000, 4, (2,)), (120, 40, 30, (1,))):
        ik, iy, iw = 2 * rng.integers(0, keys, n), rng.integers(0, ys, n).astype(float), rng.integers(0, 4, (n, *shape)).astype(float)
        qk, qy, qw = 2 * rng.integers(0, keys, n) + 1, rng.integers(0, ys, n).astype(float), rng.integers(0, 4, (n, *shape)).astype(float)
        later = ik[None] > qk[:, None]
        for got, test in zip(dominance_counts(ik, iy, iw, qk, qy, qw), (np.less, np.equal, np.greater), strict=True):
            want = np.einsum("qi,q...,i...->...", (later & test(iy[None], qy[:, None])).astype(float), qw, iw)
            assert np.shape(got) == shape and np.array_equal(got, want)
