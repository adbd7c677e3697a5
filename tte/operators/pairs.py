"""Exact pair counts without an n^2 pair join (building block B3).

Harrell's C needs, for every event subject i, the number of subjects j with a later time (or the
same time and censored) and a lower / equal / higher risk: a weighted 2-D dominance count. Ordered by
(time, censored after events) the time rule is a strict comparison of one key.

Plan: the points get a time band and a risk band (value cut points, so ties share a band; a hot value is
a band of its own). A pair (i, j) is counted in exactly one place:

* same risk band: by an exact kernel over the risk band's points;
* same time band, other risk band: by an exact kernel over the time band's points, risks compared by band;
* other time band and other risk band: decided by the bands. One pass over the cells in order of risk
  keeps a vector of the weights below by time band, so a query meets all lower risks at once.

A band of a single hot time has no pair in it. The pairs of one single hot risk are all ties: they are
counted like those of different risk bands, by time band kernels and by the pass, and never form a group.
So one shuffle deals every point to the kernels of its two bands, each of bounded size, and the pass
reads cells only.

A point's weight may be a vector of replicate weights: all replicates go through the same sorts, and
subjects are not multiplied by the number of replicates.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tte.operators.scan import BAND_ROWS, MAX_BANDS, banded
from tte.session import ensure_checkpoint_dir, shuffle_partitions

#: Replicates whose weights are in a kernel's matrices at once.
REPLICATES_AT_ONCE = 32


def dominance_counts(item_key: np.ndarray, item_y: np.ndarray, item_w: np.ndarray,
                     query_key: np.ndarray, query_y: np.ndarray, query_w: np.ndarray):
    """Sum over queries q and items j with key_j > key_q of w_j * w_q, split by y_j <, =, > y_q.

    Keys of items and queries must never be equal (callers use even / odd integer keys). Weights are
    one number a row or a row of replicate weights; the sums have the shape of one row.
    """
    one = np.zeros(item_w.shape[1:])
    if len(item_key) == 0 or len(query_key) == 0:
        return one, one, one
    if one.shape == (1,):  # numpy sums one row much faster than one column
        return tuple(x[None] for x in dominance_counts(item_key, item_y, item_w[:, 0], query_key, query_y, query_w[:, 0]))
    later = np.unique(-np.concatenate([item_key, query_key]).astype(np.int64), return_inverse=True)[1].astype(np.int64)
    yr = np.unique(np.concatenate([item_y, query_y]), return_inverse=True)[1].astype(np.int64)
    w = np.concatenate([item_w, query_w]).astype(np.float64)
    n = len(w)
    less, eq, greater = one, one, one
    base = np.argsort(yr, kind="stable")
    later, yr, asks, w = later[base], yr[base].astype(np.int32), base >= len(item_key), w[base]
    if later.max() < 1 << 16:
        later = later.astype(np.uint16)  # sorted by radix
    # Rows in the order of y within blocks of equal leading bits of the key's rank: a pair is counted at the first bit that differs
    for bit in reversed(range(int(later.max()).bit_length())):
        at = np.argsort(later >> (bit + 1), kind="stable") if later.max() >> (bit + 1) else np.arange(n)
        key, y, ask = later[at], yr[at], asks[at]
        low = (key >> bit & 1) == 0  # the larger keys
        items, queries = np.flatnonzero(low & ~ask), np.flatnonzero(~low & ask)
        if not len(items) or not len(queries):
            continue
        block = key >> (bit + 1)
        begins = np.append(True, block[1:] != block[:-1])
        runs = begins.copy()
        runs[1:] |= y[1:] != y[:-1]
        block_at, run_at = np.append(np.flatnonzero(begins), n), np.append(np.flatnonzero(runs), n)
        run, own = np.cumsum(runs, dtype=np.int32)[queries] - 1, np.cumsum(begins, dtype=np.int32)[queries] - 1
        # items before the place where a block or a run of one y begins
        of_block, of_run = np.searchsorted(items, block_at), np.searchsorted(items, run_at)
        sums = np.concatenate((one[None], np.cumsum(w[at[items]], axis=0)))
        a, b = sums[of_run[run]], sums[of_run[run + 1]]
        q = w[at[queries]]
        less = less + (q * (a - sums[of_block[own]])).sum(axis=0)
        eq = eq + (q * (b - a)).sum(axis=0)
        greater = greater + (q * (sums[of_block[own + 1]] - b)).sum(axis=0)
    return less, eq, greater


def _solve(xv: np.ndarray, tie: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """(less, eq, greater) by replicate of queries (points without the tie flag) and items (all points) with
    a later key (time, tie flag)."""
    key = 2 * np.unique(xv, return_inverse=True)[1].astype(np.int64) + tie
    asks = tie == 0
    parts = [np.stack(dominance_counts(2 * key, y, w[:, lo: lo + REPLICATES_AT_ONCE],
                                       2 * key[asks] + 1, y[asks], w[asks, lo: lo + REPLICATES_AT_ONCE]))
             for lo in range(0, w.shape[1], REPLICATES_AT_ONCE)]
    return np.concatenate(parts, axis=1)


Weights = Callable[[pd.Series], np.ndarray]


def plain_weights(w: pd.Series) -> np.ndarray:
    return w.to_numpy(np.float64)[:, None]


#: The kinds of groups that points are dealt to: a risk band, a time band, a share of the points of single risks.
RISK_BAND, TIME_BAND, CELLS_ONLY = 0, 1, 2


def _kernels(by: list[str], weights: Weights, schema: pa.Schema):
    """Points dealt by band (``kind``, ``gid``), all groups of a task at once, to sums and cells."""

    def summed(rb: np.ndarray, tb: np.ndarray, tie: np.ndarray, w: np.ndarray):
        """Per cell the weights of all points and of those that ask."""
        code = rb * (tb.max() + 1) + tb
        order = np.argsort(code, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))
        asks = np.where(tie[:, None] == 0, w, 0.0)
        cells = order[first]
        return zip(rb[cells].tolist(), tb[cells].tolist(), *(np.add.reduceat(x[order], first, axis=0).tolist() for x in (w, asks)), strict=True)

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        group = table.select([*by, "kind", "gid"]).to_pandas().groupby([*by, "kind", "gid"], sort=False, dropna=False).ngroup().to_numpy()
        order = np.argsort(group, kind="stable")
        columns = {c: table.column(c).to_numpy()[order] for c in ("xv", "tie", "y", "rb", "tb", "kind")}
        ws = table.column("w").to_pandas().iloc[order]
        first = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
        rows = []
        for lo, hi in zip(first, np.append(first[1:], len(order)), strict=True):
            key = tuple(table.column(c)[int(order[lo])].as_py() for c in by)
            xv, tie, y, rb, tb = (columns[c][lo:hi] for c in ("xv", "tie", "y", "rb", "tb"))
            w, kind = weights(ws.iloc[lo:hi]), columns["kind"][lo]
            if kind != CELLS_ONLY:
                total = _solve(xv, tie, y if kind == RISK_BAND else rb.astype(np.float64), w)
                if kind == TIME_BAND:  # the same risk band has its own kernel, unless it is a single risk
                    single = rb % 2 == 1
                    total[1] = _solve(xv[single], tie[single], rb[single].astype(np.float64), w[single])[1] if single.any() else 0.0
                rows.append((*key, None, None, *(x.tolist() for x in total)))
            if kind != TIME_BAND:
                rows += [(*key, r, t, a, b, None) for r, t, a, b in summed(rb.astype(np.int64), tb.astype(np.int64), tie, w)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _across(by: list[str], schema: pa.Schema):
    """Cells in order (by, risk band, time band) to the sums over pairs that differ in time band, and in risk
    band unless that is a single risk."""

    def numbers(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def run(batches):
        now = low = None  # group; weights of lower risk bands by time band
        band: dict[int, list[np.ndarray]] = {}
        at_band = None

        def ordered(cells: dict[int, list[np.ndarray]]):
            times = sorted(cells)
            return times, np.array([cells[t][0] for t in times]), np.array([cells[t][1] for t in times])

        def close_band():
            nonlocal less, eq, same
            if not band:
                return
            times, w, q = ordered(band)
            later = lambda m: np.concatenate((np.cumsum(m[::-1], axis=0)[::-1], 0 * m[:1]))  # noqa: E731  sums from each place on
            if low:
                lt = sorted(low)
                lw = later(np.array([low[t] for t in lt]))
                less = less + (q * lw[np.searchsorted(lt, times, side="right")]).sum(axis=0)
            own = (q * later(w)[1:]).sum(axis=0)
            same = same + own
            if at_band % 2:
                eq = eq + own
            for t, x, z in zip(times, w, q, strict=True):
                low[t] = low[t] + x if t in low else x
                asked[t] = asked[t] + z if t in asked else z

        def close_group():
            close_band()
            times = sorted(low)
            w, q = np.array([low[t] for t in times]), np.array([asked[t] for t in times])
            after = np.concatenate((np.cumsum(w[::-1], axis=0)[::-1], 0 * w[:1]))[1:]
            return (*now, less.tolist(), eq.tolist(), ((q * after).sum(axis=0) - less - same).tolist())

        out = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [*(c.to_pylist() for c in batch.columns[:-2]), *map(numbers, batch.columns[-2:])]
            for *key, rb, tb, w, q in zip(*cols, strict=True):
                if key != now:
                    if now is not None:
                        out.append(close_group())
                    now, low, asked, band, at_band = key, {}, {}, {}, rb
                    less = eq = same = np.zeros(len(w))
                if rb != at_band:
                    close_band()
                    band, at_band = {}, rb
                have = band.get(tb)
                band[tb] = [w, q] if have is None else [have[0] + w, have[1] + q]
        if now is not None:
            out.append(close_group())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def dominance(points: DataFrame, by: Sequence[str] = (), k: int | None = None, weights: Weights = plain_weights,
              plan: tuple[int, list[float], list[float]] | None = None) -> DataFrame:
    """Dominance totals ``less, eq, greater`` (arrays, one number a replicate) per ``by`` group over
    ``points(by..., xv, tie, y, w)``: queries are the points with ``tie`` 0, items all points; an item counts
    for the queries with a smaller ``(xv, tie)``. ``weights`` turns the column ``w`` into a matrix."""
    by = list(by)
    n, cuts_t, cuts_r = plan or plan_points(points, k)
    spark = points.sparkSession
    # the two halves of a hot time, events and censored, are bands of their own
    pts = banded(banded(points, "y", cuts_r, "rb"), "xv", cuts_t, "_tte_time_band").withColumn(
        "tb", 2 * F.col("_tte_time_band") + F.when(F.col("_tte_time_band") % 2 == 1, F.col("tie")).otherwise(0))
    group = lambda kind, gid: F.struct(F.lit(kind).alias("kind"), gid.cast("int").alias("gid"))
    hot = F.pmod(F.xxhash64("xv", "tie", "w"), F.lit(max(1, -(-n // BAND_ROWS))))
    to = F.array(F.when(F.col("rb") % 2 == 0, group(RISK_BAND, F.col("rb"))).otherwise(group(CELLS_ONLY, hot)),
                 F.when(F.col("_tte_time_band") % 2 == 0, group(TIME_BAND, F.col("tb"))))
    dealt = pts.select(*by, "xv", "tie", "y", "w", "rb", "tb", F.explode(to).alias("_to")).where(F.col("_to").isNotNull()).select(
        *by, "xv", "tie", "y", "w", "rb", "tb", "_to.kind", "_to.gid")
    # small groups share a task
    parts = max(shuffle_partitions(spark), -(-2 * n // BAND_ROWS), k or 1)
    own = [points.schema[c] for c in by]
    sums = [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("a", "b", "c")]
    kernel_schema = T.StructType([*own, T.StructField("rb", T.LongType()), T.StructField("tb", T.LongType()), *sums])
    kernel_arrow = pa.schema([pa.field(f.name, _arrow_type(f.dataType)) for f in kernel_schema])
    # by number, or the few bytes of a group would let several groups run one after the other in one task
    solved = dealt.repartition(parts, *by, "kind", "gid").mapInArrow(_kernels(by, weights, kernel_arrow), kernel_schema)
    solved = _kept(solved)  # the pass over the cells and the sums both read it: the kernels run once
    schema = T.StructType([*own, *(T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("less", "eq", "greater"))])
    arrow = pa.schema([*(pa.field(c.name, _arrow_type(c.dataType)) for c in own), *(pa.field(c, pa.list_(pa.float64())) for c in ("less", "eq", "greater"))])
    cells = solved.where("rb is not null").select(*by, "rb", "tb", F.col("a"), F.col("b"))
    cells = (cells.repartition(*by) if by else cells.repartition(1)).sortWithinPartitions(*by, "rb", "tb")
    across = cells.mapInArrow(_across(by, arrow), schema)
    inside = solved.where("rb is null").select(*by, F.col("a").alias("less"), F.col("b").alias("eq"), F.col("c").alias("greater"))
    return add_arrays(inside.unionByName(across), by, ("less", "eq", "greater"))


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def add_arrays(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sums of array columns of equal length, place by place."""
    rows = df.select(*by, F.posexplode(F.arrays_zip(*columns)).alias("_i", "_x"))
    summed = rows.groupBy(*by, "_i").agg(*[F.sum(F.col("_x")[c]).alias(c) for c in columns])
    ordered = summed.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_i", *columns))).alias("_x"))
    return ordered.select(*by, *[F.col(f"_x.{c}").alias(c) for c in columns])


def _kept(rows: DataFrame) -> DataFrame:
    """The rows of the kernels, or a finished result, written."""
    ensure_checkpoint_dir(rows.sparkSession)
    return rows.checkpoint()


def _held(points: DataFrame) -> DataFrame:
    """The distinct points in columns until ``_finished``: the bands, the tied times and the kernels read some of them each, and
    whatever scores the rows runs once."""
    return points.persist(StorageLevel.MEMORY_AND_DISK)


def _finished(held: Sequence[DataFrame], result: DataFrame) -> DataFrame:
    """``result``, one row a group, written, so that the points may go."""
    try:
        return _kept(result)
    finally:
        for rows in held:
            rows.unpersist()


#: A band may hold so many times ``BAND_ROWS`` of the rows of all groups, in the worst case of one group.
GROUPS_IN_BAND = 8
#: Every time is a band of its own where that makes at most one cell for so many points.
POINTS_A_CELL = 16


def plan_points(points: DataFrame, k: int | None = None, rows: bool = False, by: Sequence[str] = (),
                times: DataFrame | None = None) -> tuple[int, list[float], list[float]]:
    """About how many distinct points there are (``rows``: how many rows), and the cut points of the time and
    risk bands, from one action (two where there are more than ``BAND_ROWS`` for each shuffle partition).

    ``times`` has the number of points ``_tte_n`` per ``by`` and ``xv``. Every group of ``by`` is split by the same bands, into up to as
    many cells as the square of their number, so the bands then follow the largest group's rows, as far as the rows of all groups
    leave bands of bounded size. And where the times are few, each is a band: pairs of one time band then need no kernel."""
    def cuts_for(bands: int, columns: tuple[str, ...] = ("xv", "y")):
        shares = [i / bands for i in range(1, bands)]
        n = F.count(F.lit(1)) if rows else F.approx_count_distinct(F.struct("xv", "tie", "y"))
        row = points.agg(n.alias("n"), *(
            F.percentile_approx(F.col(c), shares, 10_000).alias(c) for c in columns)).first()
        return row, [sorted({float(c) for c in row[x] or []}) for x in columns]

    bands = k or max(2, shuffle_partitions(points.sparkSession))
    if bands < 2:
        return 1, [], []
    if times is not None and k is None:
        size = times.groupBy(*by).agg(F.sum("_tte_n").alias("_tte_n")).agg(
            F.count(F.lit(1)).alias("groups"), F.sum("_tte_n").alias("n"), F.max("_tte_n").alias("most")).first()
        n, most = size["n"] or 0, size["most"] or 0
        wanted = min(MAX_BANDS, max(2, -(-bands // max(1, size["groups"])), -(-most // BAND_ROWS), -(-n // (GROUPS_IN_BAND * BAND_ROWS))))
        few = min(MAX_BANDS, most // (2 * POINTS_A_CELL * wanted))  # each time makes a cell of its events and one of the others
        known = [r["xv"] for r in times.select("xv").distinct().limit(few + 1).collect()] if few else []
        if few and len(known) <= few and all(map(math.isfinite, known)):
            return n, sorted(known), cuts_for(wanted, ("y",))[1][0]
        return n, *cuts_for(wanted)[1]
    row, (cuts_t, cuts_r) = cuts_for(bands)
    wanted = min(MAX_BANDS, -(-row["n"] // BAND_ROWS))
    if k is None and wanted > bands:
        row, (cuts_t, cuts_r) = cuts_for(wanted)
    return row["n"], cuts_t, cuts_r


def concordance(df: DataFrame, risk: str = "risk", time: str = "time", event: str = "event",
                by: Sequence[str] = (), k: int | None = None, weight: str | None = None) -> DataFrame:
    """M1: Harrell's concordance (scikit-survival's convention).

    Pair (i, j) is comparable when i had the event and T_i < T_j, or T_i = T_j and j is censored.
    Concordant when risk_i > risk_j, tied risk counts 0.5 (exact equality). ``tied_time`` counts
    the comparable pairs with equal times. Output per ``by``: ``c_index, concordant, discordant,
    tied_risk, tied_time, comparable`` (counts as DOUBLE: they pass 2^63 at scale). ``c_index`` is
    null when there is no comparable pair. Rows with a null time, event or risk are left out.
    """
    by = list(by)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    base = df.where(F.col(time).isNotNull() & F.col(event).isNotNull() & F.col(risk).isNotNull())
    rows = base.select(*by, F.col(time).cast("double").alias("xv"), F.when(F.col(event).cast("int") == 1, 0).otherwise(1).alias("tie"),
                       F.col(risk).cast("double").alias("y"), w.alias("w"))
    pts = _held(rows.groupBy(*by, "xv", "tie", "y").agg(F.sum("w").alias("w")))
    times = _held(pts.groupBy(*by, "xv").agg(F.sum(F.when(F.col("tie") == 0, F.col("w")).otherwise(0.0)).alias("_q"),
                                             F.sum(F.when(F.col("tie") == 1, F.col("w")).otherwise(0.0)).alias("_c"), F.count(F.lit(1)).alias("_tte_n")))
    tot = dominance(pts, by, k, plan=plan_points(pts, k, rows=True, by=by, times=times))
    tied = times.groupBy(*by).agg(F.sum(F.col("_q") * F.col("_c")).alias("tied_x"))
    if by:
        same = [F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in by]
        tot = tied.alias("_r").join(tot.alias("_l"), same, "left").select(*[F.col(f"_r.{c}") for c in by], "less", "eq", "greater", "tied_x")
    else:
        tot = tied.join(tot, F.lit(True), "left")
    tot = tot.select(*by, *[F.coalesce(F.get(c, F.lit(0)), F.lit(0.0)).alias(c) for c in ("less", "eq", "greater")], F.coalesce("tied_x", F.lit(0.0)).alias("tied_x"))
    comparable = F.col("less") + F.col("eq") + F.col("greater")
    return _finished((times, pts), tot.select(
        *by,
        F.when(comparable > 0, (F.col("less") + 0.5 * F.col("eq")) / comparable).alias("c_index"),
        F.col("less").alias("concordant"),
        F.col("greater").alias("discordant"),
        F.col("eq").alias("tied_risk"),
        F.col("tied_x").alias("tied_time"),
        comparable.alias("comparable"),
    ))


def concordance_events_only(df: DataFrame, risk: str = "risk", time: str = "time", event: str = "event",
                            by: Sequence[str] = (), k: int | None = None) -> DataFrame:
    """M2: the simple concordance of the reference's test helper, never called C-index.

    Only pairs where both had the event and the times differ; correct when the earlier one has the
    strictly higher risk; ties get no credit; 0 when there is no such pair.
    """
    by = list(by)
    base = df.where(F.col(time).isNotNull() & F.col(risk).isNotNull() & (F.col(event) == 1))
    rows = base.select(*by, F.col(time).cast("double").alias("xv"), F.lit(0).alias("tie"), F.col(risk).cast("double").alias("y"))
    pts = _held(rows.groupBy(*by, "xv", "tie", "y").agg(F.count(F.lit(1)).cast("double").alias("w")))
    times = _held(pts.groupBy(*by, "xv").agg(F.count(F.lit(1)).alias("_tte_n")))
    tot = dominance(pts, by, k, plan=plan_points(pts, k, rows=True, by=by, times=times))
    if not by:  # a table without pairs has no totals
        tot = df.sparkSession.range(1).select().join(tot, F.lit(True), "left")
    tot = tot.select(*by, *[F.coalesce(F.get(c, F.lit(0)), F.lit(0.0)).alias(c) for c in ("less", "eq", "greater")])
    pairs = F.col("less") + F.col("eq") + F.col("greater")
    return _finished((times, pts), tot.select(
        *by,
        F.when(pairs > 0, F.col("less") / pairs).otherwise(F.lit(0.0)).alias("concordance"),
        F.col("less").alias("correct"),
        pairs.alias("pairs"),
    ))
