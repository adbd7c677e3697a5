"""Distributed exact quantiles and column melting shared by profiling, quality and drift.

``exact_quantiles`` gives the linear-interpolation quantile (pandas default, SQL
``quantile_cont``) without collecting a column anywhere: values are counted per distinct value,
ranked with the banded running count of ``tte.operators.scan``, and the two order statistics that
bracket rank p(n-1) are picked by a join on the rank interval.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tte.operators.scan import prefix_sum

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def melt(df: DataFrame, cols: Sequence[str], value_type: str = "double", keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``(keep..., column, value)``; nulls kept."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast(value_type).alias("value")) for c in cols])
    return df.select(*keep, F.explode(arr).alias("_kv")).select(*keep, "_kv.column", "_kv.value")


def value_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by..., column, value, n``: rows of each non-null value, as text, of each column. One scan, narrow rows
    that are counted before the shuffle, and no task that holds a column's values."""
    long = melt(df, cols, "string", keep=by).where(F.col("value").isNotNull())
    return long.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by..., column, n_distinct, n_top``: distinct non-null values, compared as text, and rows of the most
    frequent one; columns without a value have no row."""
    return value_counts(df, cols, by).groupBy(*by, "column").agg(
        F.count(F.lit(1)).alias("n_distinct"), F.max("n").alias("n_top"))


def most_frequent(df: DataFrame, cols: Sequence[str]) -> dict:
    """The most frequent non-null value of each column (the smallest on a tie; None without values).

    Counted per distinct value, so no task holds a column's values; one row per column reaches the
    driver. Numbers are compared as doubles, everything else as text."""
    number = set(numeric_columns(df))
    out: dict = dict.fromkeys(cols)
    for names, kind in (([c for c in cols if c in number], "double"), ([c for c in cols if c not in number], "string")):
        if names:
            counts = (melt(df, names, kind).where(F.col("value").isNotNull()).groupBy("column", "value")
                      .agg(F.count(F.lit(1)).alias("n")))
            best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
            out |= {r["column"]: r["value"] for r in best.collect()}
    return out


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles per (by..., column): output ``by..., column, p, q``.

    Nulls and NaN are ignored. Work: one shuffle to count distinct values, a banded running count,
    and a join of the (few) wanted ranks against the value intervals.
    """
    by = list(by)
    long = melt(df, cols, keep=by).where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = long.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    ranked = prefix_sum(counts, "value", ["cnt"], by=[*by, "column"])  # cum_cnt = rows <= value
    ranked = ranked.withColumn("_lo_rank", F.col("cum_cnt") - F.col("cnt"))  # rows < value
    n = counts.groupBy(*by, "column").agg(F.sum("cnt").alias("_n"))
    ps = df.sparkSession.createDataFrame([(float(p),) for p in probs], "p double")
    want = n.crossJoin(F.broadcast(ps)).select(
        *by, "column", "p", (F.col("p") * (F.col("_n") - 1)).alias("_pos"),
    ).select(*by, "column", "p", "_pos",
             F.floor("_pos").cast("long").alias("_r0"), F.ceil("_pos").cast("long").alias("_r1"))
    # the order statistics of 0-based ranks r0 and r1 are the values whose rank interval
    # [_lo_rank, cum_cnt) holds them; one range join picks both (at most two value rows per want)
    # ``want`` is columns x probs rows (bounded): broadcast it, so the ranked values stay spread
    # over their partitions instead of meeting in one task per column
    j = F.broadcast(want).alias("w").join(
        ranked.alias("a"),
        [*[F.col(f"w.{b}") == F.col(f"a.{b}") for b in by], F.col("w.column") == F.col("a.column"),
         F.col("a._lo_rank") <= F.col("w._r1"), F.col("w._r0") < F.col("a.cum_cnt")],
    )
    hit0 = (F.col("a._lo_rank") <= F.col("w._r0")) & (F.col("w._r0") < F.col("a.cum_cnt"))
    hit1 = (F.col("a._lo_rank") <= F.col("w._r1")) & (F.col("w._r1") < F.col("a.cum_cnt"))
    g = j.groupBy(*[F.col(f"w.{b}").alias(b) for b in by], F.col("w.column").alias("column"), F.col("w.p").alias("p"),
                  F.col("w._pos").alias("_pos"), F.col("w._r0").alias("_r0")).agg(
        F.max(F.when(hit0, F.col("a.value"))).alias("_v0"), F.max(F.when(hit1, F.col("a.value"))).alias("_v1"))
    frac = F.col("_pos") - F.col("_r0")
    return g.select(*by, "column", "p", (F.col("_v0") + (F.col("_v1") - F.col("_v0")) * frac).alias("q"))


def corrected_skew(g1, n):
    """Bias-corrected sample skewness from the population one (pandas / DuckDB)."""
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurt(g2, n):
    """Bias-corrected sample excess kurtosis from the population one (pandas / DuckDB)."""
    return F.when(n > 3, ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)))
