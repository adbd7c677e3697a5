"""Structured Streaming forms of the quality, drift, scoring and alert operators.

The reference polls files in a thread; here every operator is a streaming DataFrame transform
(event time, watermark, windowed aggregation, append mode), so a window is written once, after the
watermark has passed its end; rows older than the watermark are dropped from windowed state.
``run_available_now`` drives a stream over the files present, into a parquet folder under the
cluster's shared checkpoint folder, and returns the written table.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tte.operators.drift import drift_scores
from tte.session import ensure_checkpoint_dir


def read_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
                ts: str = "ts", max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream with an explicit schema (taken from the files when not given);
    ``ts`` is cast to ``timestamp`` (watermarks refuse TIMESTAMP_NTZ)."""
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if os.path.isfile(path):
        # the file source watches a folder: watch the file's folder, keep only that file name
        r = r.option("pathGlobFilter", os.path.basename(path))
        path = os.path.dirname(path)
    return r.load(path).withColumn(ts, F.col(ts).cast("timestamp"))


def run_available_now(stream: DataFrame, name: str, output_mode: str = "append", base: str | None = None) -> tuple[DataFrame, str]:
    """Process everything available, write parquet under ``<checkpoint dir>/streams/<name>-<uuid>``
    (fresh checkpoint and output folders) and return (written table, folder)."""
    spark = stream.sparkSession
    root = base or os.path.join(ensure_checkpoint_dir(spark), "streams")
    folder = os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
    q = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("path", os.path.join(folder, "out")).option("checkpointLocation", os.path.join(folder, "chk"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover
        raise q.exception()
    schema = stream.schema
    return spark.read.schema(schema).parquet(os.path.join(folder, "out")), folder


def stream_quality(stream: DataFrame, columns: Sequence[str], window: str = "1 day", watermark: str = "1 hour",
                   ts: str = "ts") -> DataFrame:
    """Per tumbling window: rows, missing cells, and completeness % of each column."""
    w = stream.withWatermark(ts, watermark).groupBy(F.window(ts, window).alias("w"))
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.sum(F.col(c).isNull().cast("long")).alias(f"{c}__miss") for c in columns]
    out = w.agg(*aggs)
    miss = sum((F.col(f"{c}__miss") for c in columns), F.lit(0).cast("long"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_rows",
                      miss.alias("missing_cells"),
                      *[((1 - F.col(f"{c}__miss") / F.col("n_rows")) * 100.0).alias(f"completeness_{c}") for c in columns])


def stream_feature_stats(stream: DataFrame, feature: str, baseline: DataFrame, window: str = "2 days",
                         slide: str = "1 day", watermark: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Per sliding window mean, sample std, min, max of ``feature`` and its D2 drift against a
    static baseline row (``base_mean``, ``base_std``) by a stream-static join."""
    agg = stream.withWatermark(ts, watermark).groupBy(F.window(ts, window, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(feature).alias("mean"), F.stddev_samp(feature).alias("std"),
        F.min(feature).alias("min"), F.max(feature).alias("max"))
    j = agg.crossJoin(F.broadcast(baseline))
    drift = F.when(F.col("base_std") > 0, F.greatest(F.abs(F.col("mean") - F.col("base_mean")) / F.col("base_std"),
                                                    F.abs(F.col("std") - F.col("base_std")) / F.col("base_std"))).otherwise(F.lit(0.0))
    return j.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "mean", "std",
                    "min", "max", drift.alias("drift"))


def stream_window_stats(stream: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), window: str = "2 days", slide: str = "1 day",
                        watermark: str = "1 hour", ts: str = "ts", center: dict[str, float] | None = None, quantiles: Sequence[float] = (0.25, 0.5, 0.75),
                        lg_k: int = 14, kll_k: int = 1000, top_items: int = 4096) -> DataFrame:
    """W2 in full: the D1 statistics of every column per sliding window, long rows ``window_start, window_end, n_rows,
    column, kind, mean, std, min, max, quantiles, missing_rate, unique_count, top_category_rate``.

    A row is added once, to the pane of one ``slide``; a window merges the states of its panes, so a long window
    with a short slide costs no more per row. A pane's state has a fixed size whatever the data: moments (of the
    distance to ``center``, a column's usual mean, 0 if not given), a KLL sketch of ``kll_k`` (about 0.3 % of rank at
    1000) for the quantiles, an HLL sketch of ``2 ** lg_k`` registers (about 0.8 % at 14; exact for some hundred values)
    for the distinct values and a frequent-items sketch of ``top_items`` (exact up to three quarters as many distinct values)
    for the share of the most frequent value among those present. ``window`` is a whole multiple of ``slide``. Mean, std,
    min, max and missing rate are exact. Values of categorical columns count as text; a column without any value in a
    window has null moments and quantiles, 0 distinct values and a top share of 0."""
    center = center or {}
    col = {c: F.col(f"`{c}`") for c in (*numeric, *categorical)}
    one, two = [F.count(F.lit(1)).alias("n")], [F.sum("n").alias("n")]
    for i, c in enumerate(numeric):
        x = col[c].cast("double")
        d = x - float(center.get(c, 0.0))
        one += [F.count(x).alias(f"m{i}_n"), F.sum(d).alias(f"m{i}_s"), F.sum(d * d).alias(f"m{i}_q"), F.min(x).alias(f"m{i}_min"),
                F.max(x).alias(f"m{i}_max"), F.kll_sketch_agg_double(x, kll_k).alias(f"m{i}_kll")]
        two += [*(F.sum(f"m{i}_{k}").alias(f"m{i}_{k}") for k in ("n", "s", "q")), F.min(f"m{i}_min").alias(f"m{i}_min"),
                F.max(f"m{i}_max").alias(f"m{i}_max"), F.kll_merge_agg_double(f"m{i}_kll", kll_k).alias(f"m{i}_kll")]
    for i, c in enumerate(categorical):
        # the distinct sketch passes over empty texts, so each value gets a mark
        x = F.concat(F.lit("="), col[c].cast("string"))
        one += [F.count(x).alias(f"c{i}_n"), F.hll_sketch_agg(x, lg_k).alias(f"c{i}_hll"),
                F.call_function("approx_top_k_accumulate", x, F.lit(top_items)).alias(f"c{i}_top")]
        two += [F.sum(f"c{i}_n").alias(f"c{i}_n"), F.hll_union_agg(f"c{i}_hll", True).alias(f"c{i}_hll"),
                F.call_function("approx_top_k_combine", F.col(f"c{i}_top"), F.lit(top_items)).alias(f"c{i}_top")]
    panes = stream.withWatermark(ts, watermark).groupBy(F.window(ts, slide).alias("pane")).agg(*one)
    merged = panes.groupBy(F.window(F.window_time("pane"), window, slide).alias("w")).agg(*two)

    null = F.lit(None).cast("double")
    none = F.lit(None).cast("array<double>")
    rows = []
    for i, c in enumerate(numeric):
        n, s, q = (F.col(f"m{i}_{k}") for k in ("n", "s", "q"))
        some = n > 0
        rows.append(F.struct(
            F.lit(c).alias("column"), F.lit("numeric").alias("kind"), F.when(some, F.lit(float(center.get(c, 0.0))) + s / n).alias("mean"),
            F.when(n > 1, F.sqrt(F.greatest((q - s * s / n) / (n - 1), F.lit(0.0)))).alias("std"),
            F.col(f"m{i}_min").alias("min"), F.col(f"m{i}_max").alias("max"),
            F.when(some, F.kll_sketch_get_quantile_double(f"m{i}_kll", F.array(*[F.lit(float(p)) for p in quantiles]))).alias("quantiles"),
            (1 - n / F.col("n")).alias("missing_rate"), null.alias("unique_count"), null.alias("top_category_rate")))
    for i, c in enumerate(categorical):
        n = F.col(f"c{i}_n")
        top = F.call_function("approx_top_k_estimate", F.col(f"c{i}_top"), F.lit(1))
        rows.append(F.struct(
            F.lit(c).alias("column"), F.lit("categorical").alias("kind"), null.alias("mean"), null.alias("std"), null.alias("min"), null.alias("max"),
            none.alias("quantiles"), (1 - n / F.col("n")).alias("missing_rate"),
            F.when(n > 0, F.hll_sketch_estimate(f"c{i}_hll").cast("double")).otherwise(0.0).alias("unique_count"),
            F.when(n > 0, top[0]["count"] / n).otherwise(0.0).alias("top_category_rate")))
    long = merged.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), F.col("n").alias("n_rows"),
                         F.explode(F.array(*rows)).alias("r"))
    return long.select("window_start", "window_end", "n_rows", "r.*")


def stream_window_drift(stats: DataFrame, base: DataFrame) -> DataFrame:
    """The D2 and D3 drift of each window and column of ``stream_window_stats`` against a static D1 table:
    ``window_start, window_end, column, kind, drift``. The static side has a row per column."""
    return drift_scores(F.broadcast(base), stats, by=["window_start", "window_end"])


def stream_score(stream: DataFrame, risk: Column, horizons: Sequence[float], scale: float = 1000.0) -> DataFrame:
    """The batch scoring expressions on a stream (stateless, append): ``risk`` and the
    exponential-baseline survival at the horizons."""
    s = stream.withColumn("risk", risk)
    return s.withColumn("surv", F.array(*[F.exp(-F.exp(F.col("risk")) * float(h) / scale) for h in horizons]))


def stream_sessions(stream: DataFrame, key: str, gap: str = "30 minutes", watermark: str = "1 hour",
                    ts: str = "ts") -> DataFrame:
    """Activity sessions per key with ``session_window``; a session is written once the
    watermark passes its end."""
    g = stream.withWatermark(ts, watermark).groupBy(key, F.session_window(ts, gap).alias("s"))
    return g.agg(F.count(F.lit(1)).alias("n_events")).select(
        key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n_events")


def stream_dedup(stream: DataFrame, keys: Sequence[str], watermark: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Drop repeated records (same ``keys``) arriving within the watermark delay."""
    return stream.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


def stream_alerts(stream: DataFrame, rules: DataFrame, columns: Sequence[str], window: str = "1 day",
                  watermark: str = "1 hour", ts: str = "ts") -> DataFrame:
    """The rule table (N7) against the quality of each closed window.

    Counts run on per window (W1) and a window is judged once, when the watermark has passed its end,
    whatever batches its rows came in. All windows meet the rules in one stream-static join; a rule on
    a metric the windows do not have gives no alert, except ``outlier_count_*``, which counts as 0.
    Written by a checkpointed append sink, each (rule, window) is stored once across restarts.
    Metrics: ``missing_values_percentage`` and ``column_completeness_<column>``."""
    from tte.operators.monitor import rule_is_met

    q = stream_quality(stream, columns, window, watermark, ts)
    cells = F.col("n_rows") * F.lit(len(columns))
    metrics = F.map_from_arrays(
        F.array(F.lit("missing_values_percentage"), *[F.lit(f"column_completeness_{c}") for c in columns]),
        F.array(F.col("missing_cells") * 100.0 / cells, *[F.col(f"completeness_{c}") for c in columns]))
    j = q.select("window_start", "window_end", metrics.alias("_m")).crossJoin(F.broadcast(rules.where(F.col("enabled"))))
    j = j.withColumn("value", F.when(F.col("metric").startswith("outlier_count_"), F.lit(0.0)).otherwise(
        F.try_element_at("_m", F.col("metric"))))
    return j.where(F.col("value").isNotNull() & rule_is_met(F.col("value"))).select(
        "window_start", "window_end", "rule_id", "metric", "value", "threshold", "severity", F.lit("active").alias("status"))


def _partial_counts(batches):
    """Rows per key of one task: what crosses the shuffle is a row per key and task."""
    counts: dict = {}
    for batch in batches:
        for item in batch.column(0).value_counts().to_pylist():
            counts[item["values"]] = counts.get(item["values"], 0) + item["counts"]
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), type=batch.column(0).type), pa.array(list(counts.values()), pa.int64())],
                                         names=[batch.schema.names[0], "n"])


def stream_update_gate(stream: DataFrame, key: str, min_samples: int = 50) -> DataFrame:
    """One "update due" row per ``min_samples`` rows of a key: ``key, signal`` (1, 2, ...) and
    ``buffered``, the rows it stands for.

    Each task sends its counts per key, so a key with a third of the rows costs no more than others.
    The state is two numbers per key: rows not yet signalled and signals so far. No row is lost, and
    the signals do not depend on how the rows fall into batches."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    out_schema = T.StructType([T.StructField(key, stream.schema[key].dataType), T.StructField("signal", T.LongType()),
                               T.StructField("buffered", T.LongType())])
    state_schema = T.StructType([T.StructField("waiting", T.LongType()), T.StructField("signals", T.LongType())])

    def gate(k, pdfs, state):
        waiting, signals = state.get if state.exists else (0, 0)
        waiting += sum(int(pdf["n"].sum()) for pdf in pdfs)
        due, waiting = divmod(waiting, min_samples)
        state.update((waiting, signals + due))
        if due:
            yield pd.DataFrame({key: [k[0]] * due, "signal": range(signals + 1, signals + due + 1), "buffered": [min_samples] * due})

    counts_schema = T.StructType([T.StructField(key, stream.schema[key].dataType), T.StructField("n", T.LongType())])
    return (stream.select(key).mapInArrow(_partial_counts, counts_schema).groupBy(key)
            .applyInPandasWithState(gate, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_update_buffer(stream: DataFrame, key: str, columns: Sequence[str], order: Sequence[str], min_samples: int = 50,
                         max_buffer: int = 10_000) -> DataFrame:
    """The rows for an update, handed on: ``key, signal, columns...``.

    Per key the newest ``max_buffer`` rows that no update has had yet are kept as state. When ``min_samples`` rows have
    come since the last signal, the kept rows are emitted with the signal's number (1, 2, ...) and the buffer
    is cleared. Rows of one batch count in the order of the columns ``order``, so if batches come in that order, the
    result does not depend on where one batch ends. The state of a key is at most ``max_buffer`` rows (a list
    state) and two numbers; a batch's rows of a key are sorted in its task, so a source with a large
    backlog wants a limit on its files per batch. A null key is a key like any other."""
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)  # list states need it
    names = [*dict.fromkeys([*columns, *order])]
    row_schema = T.StructType([stream.schema[c] for c in names])
    out_schema = T.StructType([T.StructField(key, stream.schema[key].dataType), T.StructField("signal", T.LongType()),
                               *(stream.schema[c] for c in columns)])

    class Buffer(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.rows = handle.getListState("rows", row_schema)
            self.counts = handle.getValueState("counts", "waiting long, signals long")

        def handleInputRows(self, key_value, rows, timerValues):
            waiting, signals = self.counts.get() if self.counts.exists() else (0, 0)
            new = pd.concat([pdf[names] for pdf in rows]).sort_values([*order], kind="stable")
            kept, out, at = None, [], 0
            while at < len(new):
                part = new.iloc[at: at + min_samples - waiting]
                at, waiting = at + len(part), waiting + len(part)
                if kept is None:
                    old = list(self.rows.get())
                    kept = pd.DataFrame(old, columns=names).astype(new.dtypes.to_dict()) if old else new.iloc[:0]
                kept = pd.concat([kept, part]).tail(max_buffer) if len(kept) else part.tail(max_buffer)
                if waiting == min_samples:
                    waiting, signals = 0, signals + 1
                    out.append(kept[list(columns)].assign(**{key: key_value[0], "signal": signals})[out_schema.names])
                    kept = new.iloc[:0]
            self.rows.clear()
            if len(kept):
                self.rows.put([tuple(x.to_pydatetime() if isinstance(x, pd.Timestamp) else None if x is pd.NaT else x for x in r)
                               for r in kept.astype(object).itertuples(index=False)])
            self.counts.update((waiting, signals))
            yield from out

        def close(self) -> None:
            pass

    return stream.select(*dict.fromkeys([key, *names])).groupBy(key).transformWithStateInPandas(
        statefulProcessor=Buffer(), outputStructType=out_schema, outputMode="Append", timeMode="None")
