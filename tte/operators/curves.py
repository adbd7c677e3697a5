"""Curves over the risk set: risk table, Kaplan-Meier survival and censoring, lookups, IPCW weights.

A curve is a DataFrame with one row per (stratum, distinct time): ``time, n_at_risk, d, c`` plus the
curve value. Subject rows are first aggregated to distinct times (partial aggregation map-side),
then the ordered scans of ``tte.operators.scan`` run over that much smaller table.
Rows with a null ``time`` or ``event`` are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tte.operators.scan import AUTO, plan_bands, prefix_product, prefix_sum
from tte.session import ensure_checkpoint_dir

CLIP_LO = 1e-8  # fixed value: censoring curve lower clip used by the weighted metrics


def risk_table(df: DataFrame, time: str = "time", event: str = "event", by: Sequence[str] = (),
               weight: str | None = None) -> DataFrame:
    """K1: per distinct time the events ``d``, censored ``c`` and number at risk ``n_at_risk``
    (rows with time >= t), optionally per stratum ``by`` and weighted."""
    by = list(by)
    w = F.col(weight).cast("double") if weight else F.lit(1)
    ev = F.col(event).cast("int")
    base = df.where(F.col(time).isNotNull() & F.col(event).isNotNull())
    agg = base.groupBy(*by, F.col(time).cast("double").alias("time")).agg(
        F.sum(F.when(ev == 1, w).otherwise(0)).alias("d"),
        F.sum(F.when(ev == 1, 0).otherwise(w)).alias("c"),
    ).withColumn("m", F.col("d") + F.col("c"))
    # the scans read a row per distinct time several times; the subjects are read once
    ensure_checkpoint_dir(df.sparkSession)
    agg = agg.checkpoint()
    plan = plan_bands(agg, "time")
    scanned = prefix_sum(agg, "time", ["m"], by=by, exclusive=True, plan=plan)
    totals = agg.groupBy(*by).agg(F.sum("m").alias("_total"))
    if by:
        scanned = scanned.join(totals, on=by, how="inner")
    else:
        scanned = scanned.crossJoin(F.broadcast(totals))
    out = scanned.select(
        *by, "time", (F.col("_total") - F.col("cum_m")).alias("n_at_risk"), "d", "c"
    )
    out._tte_plan = plan  # same (by, time) keys: later scans of this table reuse the band plan
    return out


def _km_factor(num: Column, den: Column) -> Column:
    """1 - num/den with 0/0 read as factor 1."""
    return F.when(den > 0, 1.0 - num / den).otherwise(F.lit(1.0))


def km_curves(df: DataFrame, time: str = "time", event: str = "event", by: Sequence[str] = (),
              ties: str = "all", weight: str | None = None) -> DataFrame:
    """K2 + K3 in one pass: ``surv`` = prod(1 - d/n), ``cens`` = prod(1 - c/n) (``ties="all"``:
    subjects with an event at t still count at risk of censoring) or prod(1 - c/(n - d))
    (``ties="events_first"``)."""
    if ties not in ("all", "events_first"):
        raise ValueError("ties must be 'all' or 'events_first'")
    rt = risk_table(df, time, event, by, weight)
    n = F.col("n_at_risk")
    cens_den = n if ties == "all" else n - F.col("d")
    cur = prefix_product(
        rt, "time",
        {"surv": _km_factor(F.col("d"), n), "cens": _km_factor(F.col("c"), cens_den)},
        by=by, plan=getattr(rt, "_tte_plan", AUTO),
    )
    return cur


def km_survival(df: DataFrame, time: str = "time", event: str = "event", by: Sequence[str] = ()) -> DataFrame:
    """K2: Kaplan-Meier survival curve."""
    return km_curves(df, time, event, by).drop("cens")


def km_censoring(df: DataFrame, time: str = "time", event: str = "event", by: Sequence[str] = (),
                 ties: str = "all") -> DataFrame:
    """K3: Kaplan-Meier curve of the censoring distribution G(t)."""
    return km_curves(df, time, event, by, ties=ties).drop("surv")


def curve_at(curve: DataFrame, horizons: Sequence[float], value: str = "surv", lookup: str = "step",
             by: Sequence[str] = (), clip: bool = False, left: float = 1.0) -> DataFrame:
    """K4: read a curve at a few horizons, one conditional aggregate per horizon (no join).

    ``step``: value at the largest curve time <= h, ``left`` before the first time.
    ``linear``: piecewise-linear between the neighbouring curve times, ``left`` before the first
    time, last value after the last (the reference's G(t) read); ``clip`` keeps it in [1e-8, 1].
    Output: ``by..., horizon, <value>``.
    """
    by = list(by)
    aggs = []
    for i, h in enumerate(horizons):
        h = float(h)
        le = F.when(F.col("time") <= h, F.col("time"))
        ge = F.when(F.col("time") >= h, F.col("time"))
        aggs += [
            F.max(le).alias(f"_lt{i}"),
            F.max_by(F.col(value), le).alias(f"_lv{i}"),
            F.min(ge).alias(f"_ht{i}"),
            F.min_by(F.col(value), ge).alias(f"_hv{i}"),
        ]
    wide = curve.groupBy(*by).agg(*aggs)
    rows = []
    for i, h in enumerate(horizons):
        h = float(h)
        lt, lv, ht, hv = (F.col(f"_lt{i}"), F.col(f"_lv{i}"), F.col(f"_ht{i}"), F.col(f"_hv{i}"))
        if lookup == "step":
            v = F.when(lt.isNull(), F.lit(float(left))).otherwise(lv)
        elif lookup == "linear":
            v = (
                F.when(lt.isNull(), F.lit(float(left)))
                .when(ht.isNull(), lv)
                .when(ht == lt, lv)
                .otherwise(lv + (hv - lv) * (F.lit(h) - lt) / (ht - lt))
            )
        else:
            raise ValueError("lookup must be 'step' or 'linear'")
        if clip:
            v = F.least(F.greatest(v, F.lit(CLIP_LO)), F.lit(1.0))
        rows.append(F.struct(F.lit(h).alias("horizon"), v.alias(value)))
    return wide.select(*by, F.explode(F.array(*rows)).alias("_r")).select(*by, "_r.horizon", f"_r.{value}")


def km_quantile(curve: DataFrame, p: float = 0.5, value: str = "surv", by: Sequence[str] = ()) -> DataFrame:
    """K5: first time with value <= p (null if never reached)."""
    return curve.groupBy(*by).agg(F.min(F.when(F.col(value) <= p, F.col("time"))).alias("time_at_p"))


def ipcw_weights(df: DataFrame, horizons: Sequence[float], time: str = "time", event: str = "event",
                 ties: str = "all", lookup: str = "linear", train: DataFrame | None = None,
                 exploded: bool = False, times_in_curve: bool | None = None) -> DataFrame:
    """K6: inverse-probability-of-censoring weights per subject and horizon.

    event by the horizon: 1/G(T); still event-free after it: 1/G(horizon); censored by it: 0.
    G is the censoring curve of ``train`` (default: ``df`` itself). ``lookup="linear"`` clips G
    to [1e-8, 1] like the reference; ``"step"`` leaves zero weights where G is 0.
    ``exploded=False``: ``df`` is one row per subject and is crossed with the (few, broadcast)
    horizons; ``exploded=True``: ``df`` already has a ``horizon`` column (long predictions).
    When every T is a curve time (``train`` is the same subjects) G(T) is an equi-join on time,
    otherwise a banded range lookup. Adds ``g_t, g_h, weight``.
    """
    src = train if train is not None else df
    if times_in_curve is None:
        times_in_curve = train is None
    cens = km_censoring(src, time, event, ties=ties)
    g_h = curve_at(cens, horizons, value="cens", lookup=lookup, clip=(lookup == "linear"))
    g_h = g_h.select("horizon", F.col("cens").alias("g_h"))
    if times_in_curve:
        g_t = cens.select(F.col("time").alias("_gt_time"), F.col("cens").alias("g_t"))
        if lookup == "linear":
            g_t = g_t.withColumn("g_t", F.least(F.greatest(F.col("g_t"), F.lit(CLIP_LO)), F.lit(1.0)))
        joined = df.join(g_t, F.col(time).cast("double") == F.col("_gt_time"), "left").drop("_gt_time")
    else:
        joined = lookup_curve(df, cens.select("time", "cens"), time, "cens", lookup).withColumnRenamed("cens", "g_t")
    if exploded:
        out = joined.join(F.broadcast(g_h), "horizon")
    else:
        out = joined.crossJoin(F.broadcast(g_h))
    t, e, h = F.col(time), F.col(event), F.col("horizon")
    weight = (
        F.when((t <= h) & (e == 1) & (F.col("g_t") > 0), 1.0 / F.col("g_t"))
        .when(t > h, F.when(F.col("g_h") > 0, 1.0 / F.col("g_h")).otherwise(F.lit(0.0)))
        .otherwise(F.lit(0.0))
    )
    return out.withColumn("weight", weight)


def lookup_curve(df: DataFrame, curve: DataFrame, time: str, value: str, lookup: str = "step") -> DataFrame:
    """Read ``curve`` at each row's ``time`` when the times are not curve times (other table).

    Range join done as a sort over the distinct times of both sides: the last curve value at or before
    each time is carried forward (banded scan; for ``linear`` the next curve point is carried backward
    as well), and the rows read their time's value by an equi-join, whose hot times the skew join
    splits. A null time reads a null.
    """
    from tte.operators.scan import carry_forward, next_value

    point = F.struct(F.col("time").cast("double").alias("_t"), F.col(value).cast("double").alias("_v"))
    cur = curve.where(F.col("time").isNotNull()).select(F.col("time").cast("double").alias("_t"), point.alias("_vt"))
    asked = df.select(F.col(time).cast("double").alias("_t")).where(F.col("_t").isNotNull()).distinct()
    u = asked.withColumn("_asked", F.lit(True)).join(cur, "_t", "full").withColumn("_k", F.lit(0))
    prev = carry_forward(u, ["_k"], "_t", "_vt", "_prev", unique=True)
    if lookup == "linear":
        prev = next_value(prev, ["_k"], "_t", "_vt", "_next", unique=True)
    at = prev.where(F.col("_asked"))
    last = F.coalesce(F.col("_vt"), F.col("_prev"))
    pv, pt = last["_v"], last["_t"]
    if lookup == "step":
        v = F.coalesce(pv, F.lit(1.0))
    else:
        nt, nv = F.col("_next")["_t"], F.col("_next")["_v"]
        v = (
            F.when(pv.isNull(), F.lit(1.0))
            .when(nv.isNull() | (pt == F.col("_t")), pv)
            .otherwise(pv + (nv - pv) * (F.col("_t") - pt) / (nt - pt))
        )
        v = F.least(F.greatest(v, F.lit(CLIP_LO)), F.lit(1.0))
    read = at.select(F.col("_t").alias("_read_t"), v.alias("_read_v"))
    return df.join(read, F.col(time).cast("double") == F.col("_read_t"), "left").select(*df.columns, F.col("_read_v").alias(value))
