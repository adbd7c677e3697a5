"""S1 / S2 / S4 / S8 / E8 on small inputs."""

import os

import pytest

from tte.sources.cohort import apply_types, dataset_summary, read_cohort, split_external, subject_filter


def test_read_cohort_checks(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 1, float("nan")), (2.0, 0, 3.0)], "time double, event int, x double")
    p = os.path.join(str(tmp_path), "c.parquet")
    df.write.parquet(p)
    back = read_cohort(spark, p)
    assert [r.x for r in back.orderBy("time").collect()] == [None, 3.0]  # NaN read as null
    with pytest.raises(ValueError, match="missing required columns"):
        read_cohort(spark, p, required=("time", "status"))
    with pytest.raises(ValueError, match="unsupported file type"):
        read_cohort(spark, os.path.join(str(tmp_path), "c.xlsx"))


def test_apply_types(spark):
    df = spark.createDataFrame([("3", "3.7", "a", "true"), ("x", "2", "b", "0")], "i string, f string, c string, b string")
    out = apply_types(df, {"i": "int", "f": "int", "c": "category", "b": "bool"}).collect()
    assert (out[0].i, out[0].f, out[0].b) == (3, None, 1) and (out[1].i, out[1].f, out[1].b) == (None, 2, 0)


def test_split_summary_filter(spark):
    df = spark.createDataFrame([(1, 1.0, 1, "A"), (2, 2.0, 0, "B"), (3, 3.0, 1, "C")], "id int, time double, event int, g string")
    s = split_external(df, "g", "A", "B")
    assert sorted(r["__split"] for r in s.collect()) == ["external", "train"]
    summ = dataset_summary(s, split_col="__split").collect()[0]
    assert (summ.n_rows, summ.n_events, summ.n_external) == (2, 1, 1)
    ids = spark.createDataFrame([(3,), (3,)], "id int")
    assert [r.id for r in subject_filter(df, ids, "id").collect()] == [3]
