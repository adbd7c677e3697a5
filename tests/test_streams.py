"""Streams equal the batch query, drop late rows, and restart from their checkpoint."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tte.streaming.stream import read_stream, run_available_now, stream_quality

SF = "/root/testdata/sf0.01"


def _stage(spark, folder, df, name):
    df.coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, name))


def test_stream_equals_batch(spark):
    out, _ = run_available_now(stream_quality(read_stream(spark, os.path.join(SF, "events.parquet")), ["value"]), "t1")
    ev = spark.read.parquet(os.path.join(SF, "events.parquet")).withColumn("ts", F.col("ts").cast("timestamp"))
    wm = ev.agg(F.max("ts")).collect()[0][0]
    batch = ev.groupBy(F.window("ts", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("w.end") <= F.lit(wm) - F.expr("INTERVAL 1 HOUR"))
    a = {r.window_start: r.n_rows for r in out.collect()}
    b = {r.w.start: r.n for r in batch.collect()}
    assert a == b and sum(a.values()) > 0


def test_late_rows_and_restart(spark):
    base = tempfile.mkdtemp(prefix="tte-stream-")
    src = os.path.join(base, "src")
    os.makedirs(src)
    ev = spark.read.parquet(os.path.join(SF, "events.parquet")).select("event_id", "ts", "value", "props")
    schema = ev.schema
    day = lambda d: F.lit(f"2024-01-{d:02d}").cast("timestamp_ntz")
    _stage(spark, os.path.join(src, "a"), ev.where(F.col("ts") < day(10)), "p")
    chk = os.path.join(base, "chk")
    outp = os.path.join(base, "out")

    def run():
        s = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src) \
            .withColumn("ts", F.col("ts").cast("timestamp"))
        q = stream_quality(s, ["value"]).writeStream.format("parquet").option("path", outp) \
            .option("checkpointLocation", chk).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    first = spark.read.parquet(outp).count()
    # second slice, plus one late row for day 2 (long closed by the watermark): restart from checkpoint
    late = ev.where(F.col("ts") < day(2)).limit(1)
    _stage(spark, os.path.join(src, "b"), ev.where(F.col("ts") >= day(10)).unionByName(late), "p")
    run()
    res = spark.read.parquet(outp)
    days = {r.window_start.day: r.n_rows for r in res.collect()}
    batch_day1 = ev.where((F.col("ts") >= day(1)) & (F.col("ts") < day(2))).count()
    assert days[1] == batch_day1  # the late row did not change the closed window
    assert res.count() > first and len(days) == res.count()  # each window written once


def _files(spark, df, parts):
    base = tempfile.mkdtemp(prefix="tte-stream-")
    df.repartition(parts).write.mode("overwrite").parquet(os.path.join(base, "src"))
    return os.path.join(base, "src")


@pytest.mark.parametrize("files", [1, 6])
def test_update_gate_loses_no_row_in_any_batching(spark, files):
    from tte.streaming.stream import stream_update_gate

    ev = spark.read.parquet(os.path.join(SF, "events.parquet")).select("event_id", "ts", "event_type")
    s = read_stream(spark, _files(spark, ev, files), max_files_per_trigger=1)
    out, _ = run_available_now(stream_update_gate(s, "event_type", 50), "gate")
    got = {}
    for r in out.collect():
        got.setdefault(r.event_type, []).append(r.signal)
    want = {r.event_type: r["count"] // 50 for r in ev.groupBy("event_type").count().collect()}
    assert {k: sorted(v) for k, v in got.items()} == {k: list(range(1, n + 1)) for k, n in want.items() if n}


def test_alerts_judge_whole_closed_windows(spark):
    """One day comes in two batches, ten gaps first: only the whole day is judged, and the last,
    open day not at all."""
    from tte.streaming.stream import stream_alerts

    base = tempfile.mkdtemp(prefix="tte-stream-")
    row = "id long, ts timestamp, value double"
    day = "2024-01-0{} {:02d}:00:00"
    import datetime as dt
    at = lambda d, h: dt.datetime.fromisoformat(day.format(d, h))
    first = [(i, at(1, 1), None) for i in range(10)]
    second = [(i, at(1, 2), 1.0) for i in range(10, 1000)]
    third = [(2000, at(3, 5), None)]
    rules = spark.createDataFrame([("low", "column_completeness_value", "<", 50.0, "high", True), ("ok", "column_completeness_value", ">=", 98.9, "info", True)],
                                  "rule_id string, metric string, condition string, threshold double, severity string, enabled boolean")
    for i, rows in enumerate((first, second, third)):
        spark.createDataFrame(rows, row).coalesce(1).write.parquet(os.path.join(base, "src", str(i)))
        s = spark.readStream.schema(row).option("recursiveFileLookup", "true").parquet(os.path.join(base, "src"))
        q = stream_alerts(s, rules, ["value"]).writeStream.format("parquet").option("path", os.path.join(base, "out")).option(
            "checkpointLocation", os.path.join(base, "chk")).trigger(availableNow=True).start()
        q.awaitTermination()
    got = spark.read.parquet(os.path.join(base, "out")).collect()
    assert [(r.rule_id, round(r.value, 6), r.window_start.day) for r in got] == [("ok", 99.0, 1)]


def test_dedup_keeps_every_event_once(spark):
    from tte.streaming.stream import stream_dedup

    ev = spark.read.parquet(os.path.join(SF, "events.parquet")).select("event_id", "ts")
    s = read_stream(spark, _files(spark, ev.unionByName(ev.where("event_id % 4 = 0")), 1))
    out, _ = run_available_now(stream_dedup(s, ["event_id"]), "dedup")
    assert sorted(r.event_id for r in out.collect()) == sorted(r.event_id for r in ev.collect())


@pytest.mark.parametrize("files", [1, 5])
def test_window_stats_stay_within_the_sketches_bounds(spark, files):
    """Windows merged from panes: exact moments; distinct values, quantiles and the top share within the bounds that
    the docstring gives; a column of nulls, empty texts and a far-off mean."""
    import numpy as np

    from tte.streaming.stream import stream_window_stats

    n = 60_000
    rows = spark.range(n, numPartitions=2).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 6 * 86400 / n).alias("ts"), (1e6 + F.xxhash64("id") % 100_000 / 100).alias("x"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 20_011).alias("many"),
        F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, "b").alias("few"),
        F.lit(None).cast("double").alias("none"), F.lit(None).cast("string").alias("nothing"))
    s = read_stream(spark, _files(spark, rows, files), max_files_per_trigger=1 if files == 1 else None)
    stats = stream_window_stats(s, ["x", "none"], ["many", "few", "nothing"], "2 days", "1 day", "0 seconds", center={"x": 1e6})
    out, _ = run_available_now(stats, "bounds")
    got = {(r.window_start.day, r.column): r for r in out.where("window_start >= timestamp_seconds(1704067200)").collect()}
    data = rows.toPandas()
    days = (data.ts.astype("int64") // 10 ** (9 if data.ts.dtype == "datetime64[ns]" else 6) - 1_704_067_200) // 86400
    assert sorted({d for d, _ in got}) == [1, 2, 3, 4]  # the window that ends with the last row is open
    for d in range(1, 5):
        part = data[(days >= d - 1) & (days < d + 1)]
        x = got[d, "x"]
        assert x.n_rows == len(part) and x.missing_rate == 0 and x.min == part.x.min() and x.max == part.x.max()
        assert abs(x["mean"] - part.x.mean()) < 1e-6 and abs(x["std"] - part.x.std()) < 1e-6
        for p, q in zip((0.25, 0.5, 0.75), x.quantiles, strict=True):
            assert abs((part.x <= q).mean() - p) < 0.01
        many, few = got[d, "many"], got[d, "few"]
        assert abs(many.unique_count / part.many.nunique() - 1) < 0.03 and abs(many.missing_rate - part.many.isna().mean()) < 1e-9
        assert (few.unique_count, round(few.top_category_rate, 3)) == (2.0, 0.5)
        none, nothing = got[d, "none"], got[d, "nothing"]
        assert none.missing_rate == 1 and (none["mean"], none["std"], none["min"], none.quantiles) == (None,) * 4
        assert (nothing.missing_rate, nothing.unique_count, nothing.top_category_rate) == (1.0, 0.0, 0.0)
    assert np.isclose(max(r.top_category_rate for r in out.where("column = 'few'").collect()), 0.5, atol=0.01)
