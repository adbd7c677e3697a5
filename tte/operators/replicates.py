"""Poisson bootstrap weights as vectors.

A subject's weight in a replicate is a Poisson(1) draw from a hash of its id: with x the id's MD5 modulo
the prime ``PRIME``, the uniform is a cubic polynomial in x modulo ``PRIME`` whose four coefficients belong
to the replicate (any four subjects' draws are independent). The same whole-number arithmetic is a Spark
expression, a NumPy matrix and plain SQL, and a retried task draws the same. Kernels carry a row of
weights per subject, so subjects are never multiplied by the number of replicates.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tte.operators.pairs import add_arrays

PRIME = 2 ** 31 - 1
#: A draw above the k-th cut has a weight above k: the Poisson(1) distribution function, times ``PRIME``.
CUTS = [math.floor(sum(math.exp(-1.0) / math.factorial(j) for j in range(k + 1)) * PRIME - 0.5) for k in range(11)]


def coefficients(seed: int, reps: int) -> list[tuple[int, int, int, int]]:
    """The polynomial of each replicate."""
    out = []
    for r in range(reps):
        digest = hashlib.md5(f"{seed}:{r}".encode()).digest()
        out.append(tuple(int.from_bytes(digest[4 * i: 4 * i + 4], "big") % PRIME for i in range(4)))
    return out


def id_hash(id_col: str) -> Column:
    """The id modulo ``PRIME`` by its MD5 (a null id counts as the empty text)."""
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % PRIME


def _poisson(u: Column) -> Column:
    return sum((F.when(u > c, 1.0).otherwise(0.0) for c in CUTS[1:]), F.when(u > CUTS[0], 1.0).otherwise(0.0))


def poisson_weight(id_col: str, seed: int, rep: str | Column = "rep", reps: int = 1) -> Column:
    """The weight (double) in the replicate that the column ``rep`` names, one of the first ``reps``."""
    which = (F.col(rep) if isinstance(rep, str) else rep).cast("int") + 1
    a, b, c, d = (F.element_at(F.array(*[F.lit(x) for x in column]).cast("array<bigint>"), which)
                  for column in zip(*coefficients(seed, reps), strict=True))
    x = id_hash(id_col)
    return _poisson((((((a * x + b) % PRIME) * x + c) % PRIME) * x + d) % PRIME)


def bootstrap_weights(df: DataFrame, id_col: str, reps: int, seed: int) -> DataFrame:
    """V8: every row with its weight ``bw`` in each of the replicates ``rep``, as rows. For a handful of
    replicates; sums over many take ``replicate_sums`` or a kernel with ``weight_matrix``."""
    x = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep"))
    return with_poisson_weight(x, id_col, seed, "rep", reps, "bw")


def with_poisson_weight(df: DataFrame, id_col: str, seed: int, rep: str, reps: int, out: str) -> DataFrame:
    """``df`` with ``poisson_weight`` as ``out``. The id's hash and the uniform are columns of their own: in one expression the
    cuts repeat the uniform eleven times, and each of these the MD5 three times."""
    a, b, c, d = (F.element_at(F.array(*[F.lit(x) for x in column]).cast("array<bigint>"), F.col(rep).cast("int") + 1)
                  for column in zip(*coefficients(seed, reps), strict=True))
    x = F.col("_id_hash")
    u = df.withColumn("_id_hash", id_hash(id_col)).withColumn("_uniform", (((((a * x + b) % PRIME) * x + c) % PRIME) * x + d) % PRIME)
    return u.withColumn(out, _poisson(F.col("_uniform"))).drop("_id_hash", "_uniform")


def weight_matrix(x: np.ndarray, polynomials: Sequence[tuple[int, int, int, int]]) -> np.ndarray:
    """Weights of subjects (by ``id_hash``) in replicates, one column each."""
    a, b, c, d = (np.array(column, dtype=np.uint64) for column in zip(*polynomials, strict=True))
    x, p = x.astype(np.uint64)[:, None], np.uint64(PRIME)
    u = (((((a * x + b) % p) * x + c) % p) * x + d) % p
    return np.searchsorted(np.array(CUTS, dtype=np.uint64), u.ravel(), side="left").reshape(u.shape).astype(np.float64)


def replicate_sums(df: DataFrame, id_col: str, values: Sequence[str], reps: int, seed: int, by: Sequence[str] = ()) -> DataFrame:
    """Per ``by`` group, over the replicates: ``w``, the sum of weights, and for each of ``values`` the weighted sum,
    as arrays with one number a replicate. Each batch of rows is one matrix product; only groups x
    batches rows are shuffled. Null values count as 0."""
    by, values = list(by), list(values)
    polynomials = coefficients(seed, reps)
    rows = df.select(*by, id_hash(id_col).alias("_x"), *[F.coalesce(F.col(v).cast("double"), F.lit(0.0)).alias(v) for v in values])
    schema = T.StructType([*(rows.schema[c] for c in by), *(T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("w", *values))])

    def run(batches):
        for pdf in batches:
            ids, own = np.unique(pdf["_x"].to_numpy(), return_inverse=True)  # a subject's rows share its weights
            weights = weight_matrix(ids, polynomials)
            groups = pdf.groupby(by, sort=False, dropna=False).indices.items() if by else [((), np.arange(len(pdf)))]
            out = []
            for key, at in groups:
                key = key if isinstance(key, tuple) else (key,)
                w = weights[own[at]]
                out.append((*key, w.sum(axis=0).tolist(), *((w.T @ pdf[v].to_numpy()[at]).tolist() for v in values)))
            yield pd.DataFrame(out, columns=schema.names)

    return add_arrays(rows.mapInPandas(run, schema), by, ["w", *values])


def interval(per_rep: DataFrame, value: str, by: Sequence[str], level: float) -> DataFrame:
    """Percentile interval over the replicates' rows, their number, and the spread of a normal interval as wide."""
    lo, hi = (1 - level) / 2, 1 - (1 - level) / 2
    ci = per_rep.groupBy(*by).agg(F.percentile(value, lo).alias("ci_lower"), F.percentile(value, hi).alias("ci_upper"),
                                  F.count(value).alias("reps"))
    return ci.withColumn("std", (F.col("ci_upper") - F.col("ci_lower")) / 3.92)
