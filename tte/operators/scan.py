"""Ordered scans without an unbounded single-partition window (building blocks B1, B2).

Spark has no distributed running sum: ``Window.orderBy`` with no ``partitionBy`` pulls every row
into one task. Every scan here first runs one small action on its (usually pre-aggregated) input: the
row count and approximate quantiles of the ordering key. The key is cut into value bands (equal keys
always share a band, and a retry gives the same bands because the cut points are literals in the
plan), the window runs inside each ``(by, band)`` partition, and per-band offsets come from the band
totals, a table of at most ``|by| x k`` rows. The plan is the same at every size; only the number of
bands follows the number of rows (``BAND_ROWS`` in each, and at least as many as the session has
shuffle partitions).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tte.session import shuffle_partitions

BAND = "_tte_band"
BAND_ROWS = 100_000
MAX_BANDS = 4096


def plan_bands(df: DataFrame, order: str, k: int | None = None, accuracy: int = 10000) -> list[float]:
    """Cut points of the bands, from one action (two when the table needs more bands than the session
    has shuffle partitions). Scans of tables with the same keys can share a plan: pass it on."""
    def cuts_for(bands: int):
        row = df.agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx(F.col(order).cast("double"), [i / bands for i in range(1, bands)], accuracy).alias("cuts"),
        ).collect()[0]
        return row["n"], sorted({float(c) for c in (row["cuts"] or []) if c is not None})

    bands = k or max(2, shuffle_partitions(df.sparkSession))
    if bands < 2:
        return []
    n, cuts = cuts_for(bands)
    wanted = min(MAX_BANDS, -(-n // BAND_ROWS))
    return cuts_for(wanted)[1] if k is None and wanted > bands else cuts


def band_of(order: str, cuts: Sequence[float]) -> Column:
    """Band id, monotone in the key: 2 x (cut points strictly below the key), plus 1 when the key
    equals a cut point. A hot key spans several quantiles, so it is a cut point and gets an odd
    band of its own (single-valued); keys between cut points share the even bands.

    One binary search over the cut points, as one fold over its step sizes: a row costs the logarithm of their number."""
    key = F.col(order).cast("double")
    if not cuts:
        return F.lit(0)
    n = len(cuts)
    known = F.array(*[F.lit(float(c)) for c in cuts])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
    # ``at``: so many cut points are known to lie below the key
    further = lambda at, step: F.when((at + step <= n) & (F.get(known, at + step - 1) < key), at + step).otherwise(at)
    equal = lambda at: F.coalesce(F.get(known, at) == key, F.lit(False)).cast("int")
    return F.when(key.isNotNull(), F.aggregate(steps, F.lit(0), further, lambda at: at * 2 + equal(at)))


def banded(df: DataFrame, order: str, cuts: Sequence[float], name: str) -> DataFrame:
    """``df`` with ``band_of`` as the column ``name``, for tables of any size: the cut points are searched by MLlib's
    ``Bucketizer``, which is compiled, and a fold over an array is not."""
    known = sorted({float(c) + 0.0 for c in cuts})  # + 0.0: a negative zero is a zero
    if not known or not all(math.isfinite(c) for c in known):
        return df.withColumn(name, band_of(order, cuts))
    key, n = F.col("_tte_key"), len(known)
    at = F.col("_tte_at").cast("int")  # cut points at or below the key
    equal = F.coalesce(F.get(F.array(*[F.lit(c) for c in known]), at - 1) == key, F.lit(False)).cast("int")
    search = Bucketizer(splits=[float("-inf"), *known, float("inf")], inputCol="_tte_key", outputCol="_tte_at", handleInvalid="keep")
    found = search.transform(df.withColumn("_tte_key", F.col(order).cast("double") + F.lit(0.0)))
    return found.withColumn(name, F.when(F.isnan(key), 2 * n).when(key.isNotNull(), at * 2 - equal)).drop("_tte_key", "_tte_at")


def with_band(df: DataFrame, order: str, k: int | None = None, name: str = BAND) -> DataFrame:
    """Add a band column on ``order`` with about ``k`` value bands."""
    return banded(df, order, plan_bands(df, order, k), name)


AUTO = "auto"


def prefix_sum(df: DataFrame, order: str, values: Sequence[str], by: Sequence[str] = (),
               prefix: str = "cum_", k: int | None = None, exclusive: bool = False, plan=AUTO) -> DataFrame:
    """Running sums of ``values`` in ascending ``order`` within ``by``.

    Rows with equal ``order`` get the same (tie-inclusive) sum; ``exclusive=True`` gives the sum
    over strictly smaller keys. Output: the input columns plus ``prefix + v`` per value column.
    """
    by = list(by)
    values = list(values)
    # ``plan``: a result of ``plan_bands`` for a table of the same keys (e.g. the previous Newton
    # step), reused instead of planning again
    cuts = plan_bands(df, order, k) if plan is AUTO else plan
    part = [*by, BAND]
    src = banded(df, order, cuts, BAND)
    w = Window.partitionBy(*part).orderBy(order).rangeBetween(Window.unboundedPreceding, 0)
    wt = Window.partitionBy(*part, order)
    local = src.select("*", *[F.sum(v).over(w).alias(f"_loc_{v}") for v in values],
                       *([F.sum(v).over(wt).alias(f"_tie_{v}") for v in values] if exclusive else []))
    totals = src.groupBy(*part).agg(*[F.sum(v).alias(f"_tot_{v}") for v in values])
    wb = Window.partitionBy(*by).orderBy(BAND).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, *[F.sum(f"_tot_{v}").over(wb).alias(f"_off_{v}") for v in values])
    out = local.join(offsets, on=part, how="inner")
    exprs = []
    for v in values:
        running = F.col(f"_loc_{v}") + F.coalesce(F.col(f"_off_{v}"), F.lit(0))
        if exclusive:
            running = running - F.col(f"_tie_{v}")
        exprs.append(running.alias(prefix + v))
    return out.select(*df.columns, *exprs)


def prefix_product(df: DataFrame, order: str, factors: dict[str, Column], by: Sequence[str] = (),
                   k: int | None = None, plan=AUTO) -> DataFrame:
    """Running products (building block B2) of factor expressions in [0, 1].

    Each product is ``exp(sum(log f))``; factors equal to 0 are counted separately, so once one has
    occurred the product is exactly 0 (no ``log(0)``). Output column per key of ``factors``.
    """
    tmp = df
    sums = []
    for name, f in factors.items():
        tmp = tmp.withColumn(f"_lg_{name}", F.when(f > 0, F.log(f)).otherwise(F.lit(0.0)))
        tmp = tmp.withColumn(f"_z_{name}", F.when(f <= 0, F.lit(1)).otherwise(F.lit(0)))
        sums += [f"_lg_{name}", f"_z_{name}"]
    scanned = prefix_sum(tmp, order, sums, by=by, k=k, plan=plan)
    outs = [
        F.when(F.col(f"cum__z_{name}") > 0, F.lit(0.0)).otherwise(F.exp(F.col(f"cum__lg_{name}"))).alias(name)
        for name in factors
    ]
    return scanned.select(*df.columns, *outs)


def carry_forward(df: DataFrame, key: Sequence[str], order: str, value: str, out: str, k: int | None = None,
                  unique: bool = False) -> DataFrame:
    """``out`` = last non-null ``value`` at a strictly smaller ``order`` within ``key``.

    ``order`` must be integral (e.g. ``unix_micros(ts)``), or, of any number type, ``unique`` in ``key``. Banded like ``prefix_sum`` so one hot
    key is spread over ``k`` tasks; the value carried into a band comes from the band-level table.
    """
    key = list(key)
    part = [*key, BAND]
    src = with_band(df, order, k)
    w = Window.partitionBy(*part).orderBy(order)
    w = w.rowsBetween(Window.unboundedPreceding, -1) if unique else w.rangeBetween(Window.unboundedPreceding, -1)
    local = src.withColumn("_loc", F.last(value, ignorenulls=True).over(w))
    band_last = src.groupBy(*part).agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order))).alias("_blast")
    )
    wb = Window.partitionBy(*key).orderBy(BAND).rowsBetween(Window.unboundedPreceding, -1)
    carry = band_last.select(*part, F.last("_blast", ignorenulls=True).over(wb).alias("_carry"))
    res = local.join(carry, on=part, how="left")
    return res.select(*df.columns, F.coalesce(F.col("_loc"), F.col("_carry")).alias(out))


def next_value(df: DataFrame, key: Sequence[str], order: str, value: str, out: str, k: int | None = None,
               unique: bool = False) -> DataFrame:
    """``out`` = first non-null ``value`` at a strictly larger ``order`` within ``key``
    (``carry_forward`` on the negated key)."""
    neg = df.withColumn("_neg_order", -F.col(order))
    res = carry_forward(neg, key, "_neg_order", value, out, k, unique)
    return res.drop("_neg_order")
