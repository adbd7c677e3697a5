"""Episodes and first-later-event times from event tables (S9), for any table and columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tte.operators.scan import carry_forward, next_value


def episodes(events: DataFrame, key: str, ts: str, event_id: str, is_start: Column, is_end: Column,
             study_end: Column | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Each start row of ``events`` opens an episode of its ``key``; the event is the key's first end row
    strictly after it and not after the key's next start (for the last one: not after the study's end).
    Otherwise the episode is censored there. Seconds are whole.

    ``study_end`` is an aggregate over ``events`` (default: its last timestamp). Returns ``episode_id``
    (the start row's ``event_id``), ``key, start_ts, start_s, end_s, event`` and the start row's
    ``carry`` columns. Rows without a key or time are left out.

    Plan (no pair join): starts and ends are one table; each end takes the id of the last start before
    it (banded carry-forward, so a hot key is split over tasks); the first end per episode is a grouped
    minimum; the next start is the mirror scan."""
    at = F.col(ts).cast("timestamp")
    last = events.agg((F.max(at) if study_end is None else study_end).alias("_study_end"))
    ev = events.select(F.col(event_id).alias("_id"), F.col(key).alias("_key"), at.alias("_ts"), is_start.alias("_start"), is_end.alias("_end"),
                       *[F.col(c).alias(f"_carry_{c}") for c in carry])
    ev = ev.where((F.col("_start") | F.col("_end")) & F.col("_key").isNotNull() & F.col("_ts").isNotNull())
    marked = (ev.withColumn("_us", F.unix_micros("_ts"))
              .withColumn("_sid", F.when(F.col("_start"), F.col("_id"))).withColumn("_sus", F.when(F.col("_start"), F.col("_us"))))
    ends = carry_forward(marked, ["_key"], "_us", "_sid", "episode_id").where(F.col("_end") & F.col("episode_id").isNotNull())
    starts = next_value(marked, ["_key"], "_us", "_sus", "_next_us").where("_start")
    first = ends.groupBy("episode_id").agg(F.min("_us").alias("_first_us"), F.min(F.unix_seconds("_ts")).alias("_first_s"))
    j = (starts.crossJoin(F.broadcast(last))  # one row
         .withColumnRenamed("_id", "episode_id").join(first, "episode_id", "left"))
    # an end at the next start's instant still belongs to this episode (not after it)
    hit = F.col("_first_us").isNotNull() & (F.col("_first_us") <= F.coalesce(F.col("_next_us"), F.unix_micros("_study_end")))
    censored = F.coalesce(F.floor(F.col("_next_us") / 1_000_000).cast("bigint"), F.unix_seconds("_study_end"))
    return j.select("episode_id", F.col("_key").alias(key), F.col("_ts").alias("start_ts"), F.unix_seconds("_ts").alias("start_s"),
                    F.when(hit, F.col("_first_s")).otherwise(censored).alias("end_s"), hit.cast("int").alias("event"),
                    *[F.col(f"_carry_{c}").alias(c) for c in carry])


def first_after(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str, out: str = "first_after") -> DataFrame:
    """Every row of ``left`` with the time of its key's first ``right`` row strictly later than it (null
    if there is none).

    The distinct (key, time) points of both sides are one table and the next right time is carried
    backward (banded), so neither a hot key nor a hot time meets in one task; rows read their point by
    an equi-join. Null keys and times read null."""
    points = (left.select(F.col(on).alias("_k"), F.unix_micros(F.col(left_ts).cast("timestamp")).alias("_us"), F.lit(False).alias("_right"))
              .unionByName(right.select(F.col(on).alias("_k"), F.unix_micros(F.col(right_ts).cast("timestamp")).alias("_us"), F.lit(True).alias("_right")))
              .where(F.col("_k").isNotNull() & F.col("_us").isNotNull())
              .groupBy("_k", "_us").agg(F.max("_right").alias("_right"))
              .withColumn("_value", F.when(F.col("_right"), F.col("_us"))))
    nxt = next_value(points, ["_k"], "_us", "_value", "_next", unique=True).select("_k", "_us", "_next")
    j = left.join(nxt, (F.col(on) == F.col("_k")) & (F.unix_micros(F.col(left_ts).cast("timestamp")) == F.col("_us")), "left")
    return j.select(*left.columns, F.timestamp_micros("_next").alias(out))
