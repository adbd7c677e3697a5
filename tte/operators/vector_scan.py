"""Ordered scans whose state is a vector, for sums that would be hundreds of window columns.

Rows are ranged by their key into bands, sorted, and kept; a band is one task's arrays. A scan takes two
passes. First every band reports the vector sums of all its rows and of the rows at its first and last
key: ``bands x length`` numbers, the only ones that reach the driver. Their running sums are the offsets
that the bands start from in the second pass. Equal keys may lie in several bands, so a key that holds a
third of the rows is split like any other; what the neighbours hold of a band's first and last key
is part of its offsets. The plan has the same size whatever the length of the vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tte.operators.scan import BAND_ROWS
from tte.session import shuffle_partitions

#: A band's columns by name, each an array with one row for each of the band's rows.
Band = dict[str, np.ndarray]


class Offsets(NamedTuple):
    """What lies outside a band, for a scan in the bands' order: the sums ``before`` it, and of these and of the
    rows ``after`` it those that share its first (``head``) and last (``tail``) key."""

    before: np.ndarray
    head: np.ndarray
    tail: np.ndarray


def ranged(df: DataFrame, order: str, rows: int, descending: bool = False, group: str | None = None, pack: bool = False) -> DataFrame:
    """``df`` in bands of about ``BAND_ROWS`` of its ``rows`` rows, sorted by ``group`` (if any) and ``order`` (columns
    without nulls), persisted; ``pack`` keeps them as ``packed`` does. Equal keys are split by a hash of the row."""
    key = [F.col(order).desc() if descending else F.col(order).asc()]
    if group:
        key.insert(0, F.col(group).asc())
    bands = max(shuffle_partitions(df.sparkSession), -(-rows // BAND_ROWS))
    out = df.withColumn("_tie", F.xxhash64(*df.columns))
    out = out.repartitionByRange(bands, *key, F.col("_tie")).sortWithinPartitions(*key, F.col("_tie")).drop("_tie")
    if pack:
        out = packed(out)
    return out.persist(StorageLevel.MEMORY_AND_DISK)


def packed(bands: DataFrame) -> DataFrame:
    """``bands`` of columns of numbers, or of equally long arrays of numbers, with each Arrow batch as one row: ``_rows``, its number of
    rows, and the columns' doubles as bytes. Passes that read the bands again and again convert no rows; ``band_of_batches`` reads
    both forms."""
    fields = [(f.name, isinstance(f.dataType, T.ArrayType)) for f in bands.schema]
    schema = T.StructType([T.StructField("_rows", T.IntegerType()), *(T.StructField(n + "[]" * many, T.BinaryType()) for n, many in fields)])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                columns = [batch.column(name).flatten() if many else batch.column(name) for name, many in fields]
                held = [np.ascontiguousarray(c.to_numpy(zero_copy_only=False), dtype=np.float64).tobytes() for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int32()), *(pa.array([x], pa.binary()) for x in held)], names=schema.names)

    return bands.mapInArrow(run, schema)


def band_of_batches(batches) -> tuple[int, Band]:
    """All rows of a task as arrays; list columns become matrices."""
    held = [b for b in batches if b.num_rows]
    number = TaskContext.get().partitionId()
    if not held:
        return number, {}
    table, out = pa.Table.from_batches(held).combine_chunks(), {}
    if table.column_names[0] == "_rows":
        n = sum(table.column(0).to_pylist())
        for name in table.column_names[1:]:
            x = np.concatenate([np.frombuffer(v.as_buffer(), np.float64) for chunk in table.column(name).chunks for v in chunk])
            out[name.removesuffix("[]")] = x.reshape(n, -1) if name.endswith("[]") else x
        return number, out
    for name in table.column_names:
        column = table.column(name).combine_chunks()
        if pa.types.is_list(column.type):
            out[name] = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
        else:
            out[name] = column.to_numpy(zero_copy_only=False)
    return number, out


def _lists(row: np.ndarray) -> pa.Array:
    return pa.array([np.asarray(row, dtype=np.float64).ravel().tolist()], pa.list_(pa.float64()))


def whole(band: Band):
    """A band as the one part of a single problem."""
    yield 0, band


def rows_where(band: Band, keep: np.ndarray) -> Band:
    return {name: column[keep] for name, column in band.items()}


def band_offsets(bands: DataFrame, order: str, values: Callable[[int, Band], np.ndarray] | None = None,
                 sums: Callable[[int, Band], tuple[np.ndarray, np.ndarray, np.ndarray]] | None = None,
                 parts: Callable[[Band], Iterable[tuple[int, Band]]] = whole) -> dict[tuple[int, int], Offsets]:
    """The offsets of every (band, problem) with rows. ``parts`` gives the problems (whole numbers) that a band has
    rows of, with these rows; problems may share rows, and each is a scan of its own. ``values`` gives one row of
    the scanned vector per row; or ``sums`` the sums themselves, over all rows and those of the first and last key."""

    def summed(problem: int, part: Band):
        if sums:
            return sums(problem, part)
        key, v = part[order], values(problem, part)
        return v.sum(axis=0), v[key == key[0]].sum(axis=0), v[key == key[-1]].sum(axis=0)

    def report(batches):
        number, band = band_of_batches(batches)
        for problem, part in parts(band) if band else ():
            key = part[order]
            if len(key):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([problem], pa.int32()), pa.array([float(key[0])]), pa.array([float(key[-1])]),
                     *map(_lists, summed(problem, part))], names=["band", "problem", "first", "last", "total", "head", "tail"])

    rows = bands.mapInArrow(report, "band int, problem int, first double, last double, total array<double>, head array<double>, "
                                    "tail array<double>").toPandas().sort_values(["problem", "band"])
    out = {}
    for problem, own in rows.groupby("problem"):
        n = len(own)
        total, head, tail = (np.array(own[c].tolist(), dtype=np.float64).reshape(n, -1) for c in ("total", "head", "tail"))
        first, last = own["first"].to_numpy(), own["last"].to_numpy()
        before = np.cumsum(total, axis=0) - total
        # of the bands before, those that end in this band's first key; of those after, those that begin with its last
        same_before, same_after = np.zeros_like(total), np.zeros_like(total)
        for i in range(1, n):
            if last[i - 1] == first[i]:
                same_before[i] = tail[i - 1] + (same_before[i - 1] if first[i - 1] == last[i - 1] else 0.0)
        for i in range(n - 2, -1, -1):
            if first[i + 1] == last[i]:
                same_after[i] = head[i + 1] + (same_after[i + 1] if first[i + 1] == last[i + 1] else 0.0)
        for i, band in enumerate(own["band"]):
            out[int(band), int(problem)] = Offsets(before[i], same_before[i], same_after[i])
    return out


def running(key: np.ndarray, values: np.ndarray, offsets: Offsets, exclusive: bool = False) -> np.ndarray:
    """Sums of all rows up to each row's key in the bands' order, those of equal keys included or (``exclusive``) not."""
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    group = np.cumsum(np.append(True, key[1:] != key[:-1])) - 1
    sums = np.cumsum(values, axis=0)
    if exclusive:
        at = np.concatenate((np.zeros((1, values.shape[1])), sums))[new]
        at = at + offsets.before
        at[0] -= offsets.head
    else:
        at = sums[np.append(new[1:], len(key)) - 1] + offsets.before
        at[-1] += offsets.tail
    return at[group]


def band_sums(bands: DataFrame, part: Callable[[int, int, Band], np.ndarray],
              parts: Callable[[Band], Iterable[tuple[int, Band]]] = whole) -> dict[int, np.ndarray]:
    """Per problem the sum over all bands of the vector that ``part(band number, problem, rows)`` makes, added up on
    the executors."""

    def run(batches):
        number, band = band_of_batches(batches)
        for problem, rows in parts(band) if band else ():
            if len(next(iter(rows.values()))):
                out = np.asarray(part(number, problem, rows), dtype=np.float64).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(out), problem, dtype=np.int32)), pa.array(np.arange(len(out), dtype=np.int32)),
                                                  pa.array(out)], names=["problem", "i", "x"])

    rows = bands.mapInArrow(run, "problem int, i int, x double").groupBy("problem", "i").agg(F.sum("x").alias("x")).toPandas()
    return {int(p): own["x"].to_numpy(dtype=np.float64) for p, own in rows.sort_values(["problem", "i"]).groupby("problem")}


def moments(df: DataFrame, columns: list[str], weight: str | None = None) -> tuple[float, np.ndarray, np.ndarray]:
    """Weight, sums and sums of products of the columns over the rows without a null in them, as one matrix
    product a batch: (n, sums, products)."""
    x = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x"),
                  (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w")).where(
        " and ".join(f"x[{i}] is not null" for i in range(len(columns))) + " and w is not null")
    p = len(columns)

    def run(batches):
        total = np.zeros((p + 1, p + 1))
        for batch in batches:
            rows = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, p)
            rows = np.column_stack((np.ones(len(rows)), rows))
            total += (rows * batch.column("w").to_numpy(zero_copy_only=False)[:, None]).T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["i", "x"])

    rows = x.mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toPandas().sort_values("i")
    full = rows["x"].to_numpy(dtype=np.float64).reshape(p + 1, p + 1) if len(rows) else np.zeros((p + 1, p + 1))
    return float(full[0, 0]), full[0, 1:].copy(), full[1:, 1:].copy()
