"""Registered queries: streaming operators driven over the events table.

Each query streams ``events.parquet`` through a file source (explicit schema, ``ts`` as
timestamp), trigger ``availableNow``, into a fresh folder under the checkpoint directory, and
returns what the stream wrote. Append mode writes a window once the watermark (max event time
minus the delay) has passed its end; the oracle SQL states exactly that set of windows.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tte.plans.registry import r6, register
from tte.streaming.stream import (
    read_stream, run_available_now, stream_dedup, stream_feature_stats, stream_quality, stream_score, stream_sessions,
    stream_update_gate, stream_window_drift, stream_window_stats,
)


def _events(spark, sf_dir):
    return read_stream(spark, os.path.join(sf_dir, "events.parquet"))


WM = "CAST(ts AS TIMESTAMP)"
CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@register("W1_stream_quality", f"""
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, count(*) AS n_rows,
       CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) + sum(CASE WHEN props IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_cells,
       round((1 - sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) / count(*)) * 100.0, 6) AS completeness_value,
       round((1 - sum(CASE WHEN props IS NULL THEN 1 ELSE 0 END) / count(*)) * 100.0, 6) AS completeness_props
FROM events GROUP BY 1, 2 HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= {CLOSED}""")
def w1_quality(spark, sf_dir):
    out, _ = run_available_now(stream_quality(_events(spark, sf_dir), ["value", "props"]), "w1")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "n_rows", "missing_cells",
                      r6("completeness_value").alias("completeness_value"), r6("completeness_props").alias("completeness_props"))


@register("W2_stream_feature_stats", f"""
WITH b AS (SELECT avg(value) AS base_mean, stddev_samp(value) AS base_std FROM events WHERE ts < TIMESTAMP '2024-01-02'),
w AS (SELECT d.start AS window_start, d.start + INTERVAL 2 DAY AS window_end, e.value
      FROM (SELECT DISTINCT date_trunc('day', ts) AS start FROM events UNION SELECT DISTINCT date_trunc('day', ts) - INTERVAL 1 DAY FROM events) d
      JOIN events e ON e.ts >= d.start AND e.ts < d.start + INTERVAL 2 DAY),
g AS (SELECT window_start, window_end, count(*) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max
      FROM w GROUP BY 1, 2 HAVING window_end <= {CLOSED})
SELECT window_start, window_end, n, round(mean, 6) AS mean, round(std, 6) AS std, min, max,
       round(CASE WHEN base_std > 0 THEN greatest(abs(mean - base_mean) / base_std, abs(std - base_std) / base_std) ELSE 0.0 END, 6) AS drift
FROM g CROSS JOIN b""")
def w2_feature_stats(spark, sf_dir):
    """Sliding 2-day windows (1-day slide) of the event value against the first day's baseline."""
    from tte.sources.tables import table
    base = table(spark, sf_dir, "events").where(F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz")).agg(
        F.avg("value").alias("base_mean"), F.stddev_samp("value").alias("base_std"))
    out, _ = run_available_now(stream_feature_stats(_events(spark, sf_dir), "value", base), "w2")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "n",
                      r6("mean").alias("mean"), r6("std").alias("std"), "min", "max", r6("drift").alias("drift"))


WINDOW_STATS = f"""w AS (SELECT d.start AS window_start, d.start + INTERVAL 3 DAY AS window_end, e.value, e.event_type
      FROM (SELECT DISTINCT date_trunc('day', ts) - i * INTERVAL 1 DAY AS start FROM events, range(3) t(i)) d
      JOIN events e ON e.ts >= d.start AND e.ts < d.start + INTERVAL 3 DAY WHERE d.start + INTERVAL 3 DAY <= {CLOSED}),
v AS (SELECT window_start, window_end, event_type, count(*) AS k FROM w WHERE event_type IS NOT NULL GROUP BY ALL),
st AS (SELECT window_start, window_end, count(*) AS n_rows, 'value' AS "column", 'numeric' AS kind, avg(value) AS mean, stddev_samp(value) AS std,
         min(value) AS min, max(value) AS max, 1 - count(value) / count(*) AS missing_rate, NULL::DOUBLE AS unique_count,
         NULL::DOUBLE AS top_category_rate FROM w GROUP BY 1, 2
       UNION ALL
       SELECT w.window_start, w.window_end, count(*), 'event_type', 'categorical', NULL, NULL, NULL, NULL, 1 - count(event_type) / count(*),
         count(DISTINCT event_type)::DOUBLE, coalesce((SELECT max(k) / sum(k) FROM v WHERE v.window_start = w.window_start), 0.0)
       FROM w GROUP BY 1, 2)"""


def _window_stats(spark, sf_dir):
    return stream_window_stats(_events(spark, sf_dir), ["value"], ["event_type"], "3 days", "1 day")


@register("W2_stream_window_stats", f"""WITH {WINDOW_STATS}
SELECT window_start, window_end, n_rows, "column", kind, round(mean, 6) AS mean, round(std, 6) AS std, min, max, round(missing_rate, 6) AS missing_rate,
       unique_count, round(top_category_rate, 6) AS top_category_rate FROM st""")
def w2_window_stats(spark, sf_dir):
    """All D1 statistics of 3-day windows (1-day slide), merged from the sketches of the days."""
    out, _ = run_available_now(_window_stats(spark, sf_dir), "w2s")
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "n_rows", "column", "kind",
                      r6("mean").alias("mean"), r6("std").alias("std"), "min", "max", r6("missing_rate").alias("missing_rate"), "unique_count",
                      r6("top_category_rate").alias("top_category_rate"))


@register("W2_stream_window_drift", f"""WITH {WINDOW_STATS},
e0 AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-04'),
b AS (SELECT avg(value) AS mean, stddev_samp(value) AS std, count(DISTINCT event_type) AS u,
        (SELECT max(k) / sum(k) FROM (SELECT count(*) AS k FROM e0 WHERE event_type IS NOT NULL GROUP BY event_type)) AS top FROM e0)
SELECT window_start, window_end, "column", kind, round(CASE WHEN kind = 'numeric' THEN
         CASE WHEN b.std > 0 THEN greatest(abs(st.mean - b.mean) / b.std, abs(st.std - b.std) / b.std) ELSE 0.0 END
       ELSE greatest(abs(top_category_rate - b.top), abs(unique_count - b.u) / greatest(b.u, 1)) END, 6) AS drift
FROM st CROSS JOIN b""")
def w2_window_drift(spark, sf_dir):
    """Drift of both kinds of columns in 3-day windows against the first three days."""
    from tte.operators.drift import feature_stats
    from tte.sources.tables import table

    base = feature_stats(table(spark, sf_dir, "events").where(F.col("ts") < F.lit("2024-01-04").cast("timestamp_ntz")), ["value"], ["event_type"])
    out, _ = run_available_now(stream_window_drift(_window_stats(spark, sf_dir), base), "w2d")
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "column", "kind", r6("drift").alias("drift"))


@register("W4_stream_score", """
SELECT event_id, round((value - 25.0) / 10.0, 6) AS risk,
       round(exp(-exp((value - 25.0) / 10.0) * 30.0 / 1000.0), 6) AS s30, round(exp(-exp((value - 25.0) / 10.0) * 90.0 / 1000.0), 6) AS s90
FROM events""")
def w4_score(spark, sf_dir):
    s = stream_score(_events(spark, sf_dir), (F.col("value") - 25.0) / 10.0, [30.0, 90.0])
    out, _ = run_available_now(s.select("event_id", "risk", "surv"), "w4")
    return out.select("event_id", r6("risk").alias("risk"), r6(F.element_at("surv", 1)).alias("s30"),
                      r6(F.element_at("surv", 2)).alias("s90"))


@register("W5_stream_sessions", f"""
WITH o AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                                   OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new_s FROM events),
s AS (SELECT user_id, ts, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o),
g AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events FROM s GROUP BY user_id, sid)
SELECT * FROM g WHERE session_end <= {CLOSED}""")
def w5_sessions(spark, sf_dir):
    out, _ = run_available_now(stream_sessions(_events(spark, sf_dir), "user_id"), "w5")
    return out.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                      F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n_events")


@register("W7_stream_dedup", """
SELECT event_id, user_id, event_type, value FROM events""")
def w7_dedup(spark, sf_dir):
    """Every event once, though the stream repeats some (rule: every id divisible by 3 comes twice,
    every id divisible by 7 once more)."""
    events = _events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "ts")
    times = 1 + (F.col("event_id") % 3 == 0).cast("int") + (F.col("event_id") % 7 == 0).cast("int")
    repeated = events.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")
    out, _ = run_available_now(stream_dedup(repeated, ["event_id"]), "w7")
    return out.drop("ts")


@register("W6_stream_update_gate", """
SELECT event_type, unnest(generate_series(1, n // 50)) AS signal, CAST(50 AS BIGINT) AS buffered
FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)""")
def w6_gate(spark, sf_dir):
    """Per event type, one 'update due' row per 50 rows."""
    out, _ = run_available_now(stream_update_gate(_events(spark, sf_dir), "event_type", 50), "w6")
    return out


@register("W6_stream_update_buffer", """
WITH r AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i FROM events),
c AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)
SELECT event_type, CAST(i // 60 + 1 AS BIGINT) AS signal, event_id, value FROM r JOIN c USING (event_type)
WHERE i < n // 60 * 60 AND i % 60 >= 20""")
def w6_buffer(spark, sf_dir):
    """Per event type, the newest 40 of every 60 rows."""
    from tte.streaming.stream import stream_update_buffer

    out, _ = run_available_now(stream_update_buffer(_events(spark, sf_dir), "event_type", ["event_id", "value"], ["ts", "event_id"], 60, 40), "w6b")
    return out


@register("W3_stream_alerts", f"""
WITH w AS (SELECT date_trunc('day', ts) AS window_start, count(*) AS n, count(value) AS v, count(props) AS p
           FROM events GROUP BY 1 HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= {CLOSED}),
m AS (SELECT window_start, 'column_completeness_props' AS metric, (1 - (n - p) / n) * 100.0 AS value FROM w
      UNION ALL SELECT window_start, 'column_completeness_value', (1 - (n - v) / n) * 100.0 FROM w
      UNION ALL SELECT window_start, 'missing_values_percentage', (2 * n - v - p) * 100.0 / (2 * n) FROM w),
r AS (SELECT * FROM (VALUES ('props_complete', 'column_completeness_props', '<', 100.0), ('value_complete', 'column_completeness_value', '==', 100.0),
                            ('few_missing', 'missing_values_percentage', '<=', 20.0)) t(rule_id, metric, condition, threshold))
SELECT window_start, rule_id, metric, round(value, 6) AS value FROM r JOIN m USING (metric)
WHERE CASE condition WHEN '<' THEN value < threshold WHEN '<=' THEN value <= threshold ELSE abs(value - threshold) < 1e-6 END""")
def w3_alerts(spark, sf_dir):
    """Quality rules on each closed day of the events stream."""
    from tte.streaming.stream import stream_alerts

    rules = spark.createDataFrame(
        [("props_complete", "column_completeness_props", "<", 100.0, "low", True),
         ("value_complete", "column_completeness_value", "==", 100.0, "info", True),
         ("few_missing", "missing_values_percentage", "<=", 20.0, "info", True),
         ("switched_off", "missing_values_percentage", ">=", 0.0, "info", False)],
        "rule_id string, metric string, condition string, threshold double, severity string, enabled boolean")
    out, _ = run_available_now(stream_alerts(_events(spark, sf_dir), rules, ["value", "props"]), "w3")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "rule_id", "metric", r6("value").alias("value"))
