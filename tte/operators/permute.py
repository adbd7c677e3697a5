"""Keyed permutations and draws over row numbers.

Rows are numbered once. A permutation of the numbers is a Feistel network with a key: a number below ``n`` is
split into two digits, four rounds add to each digit a hash of the other, and a result that is not below ``n`` goes
through the network again (cycle walking), so the map is one to one on the numbers. Any number of
permutations of a table then needs no sort, only a join by number. All arithmetic is on whole numbers, so
plain SQL states the same map.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tte.operators.replicates import PRIME, coefficients
from tte.operators.scan import prefix_sum

ROUNDS = 4


def row_numbers(df: DataFrame, id_col: str, name: str = "_row") -> tuple[DataFrame, int]:
    """``df`` with its rows numbered from 0 in the order of the id (nulls first; rows that repeat an id by a hash of the
    row), and their number. The numbers come from a banded running count over the ids."""
    ids = df.groupBy(F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    n = ids.agg(F.sum("_n")).first()[0] or 0
    first = prefix_sum(ids.withColumn("_o", F.coalesce(F.col("_id").cast("double"), F.lit(float("-inf")))), "_o", ["_n"], exclusive=True)
    within = Window.partitionBy(id_col).orderBy(F.xxhash64(*df.columns))
    numbered = df.withColumn("_k", F.row_number().over(within) - 1)
    out = numbered.join(first.select("_id", "cum__n"), F.col(id_col).eqNullSafe(F.col("_id")))
    return out.select(*df.columns, (F.col("cum__n") + F.col("_k")).cast("long").alias(name)), n


def permutation_keys(seed: int, which: str) -> list[int]:
    """Four round keys below 2 ** 31 of the permutation called ``which``."""
    digest = hashlib.md5(f"{seed}:{which}".encode()).digest()
    return [int.from_bytes(digest[4 * i: 4 * i + 4], "big") % PRIME for i in range(ROUNDS)]


def digits(n: int) -> tuple[int, int]:
    """Sizes of the two digits: their product is at least ``n`` and less than ``n`` plus the first."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def mixed(x: Column, key: Column) -> Column:
    """The round's hash of a digit, below 2 ** 31."""
    y = (x + key) % PRIME
    return (y * y + F.lit(40_503) * y + key) % PRIME


def permuted(number: Column, keys: Column, n: int) -> Column:
    """Where the permutation with ``keys`` (array of ``ROUNDS`` longs) sends a row number below ``n``."""
    a, b = digits(n)

    def once(x: Column) -> Column:
        left, right = F.floor(x / F.lit(b)).cast("long"), x % b
        for i in range(ROUNDS):
            if i % 2 == 0:
                left = (left + mixed(right, keys[i])) % a
            else:
                right = (right + mixed(left, keys[i])) % b
        return left * b + right

    # fewer than ``a`` numbers are not below ``n``, about one in ``a`` of all: as many turns as could be needed, or 30
    turns = F.sequence(F.lit(1), F.lit(min(max(a * b - n, 0), 30) + 1))
    return F.aggregate(turns, number.cast("long"), lambda at, turn: F.when((turn == 1) | (at >= n), once(at)).otherwise(at))


def with_permuted(df: DataFrame, number: str, keys: str, n: int, out: str) -> DataFrame:
    """``df`` with ``permuted`` of the columns ``number`` and ``keys`` as ``out``, for tables of any size.

    The one expression repeats a digit wherever a round reads it, 185 times in all, and is interpreted. Here
    every round is a projection of its own, so each digit is made once, by compiled code; only the about one in ``a`` rows
    that have to go through the network again use the expression."""
    a, b = digits(n)
    x = df.withColumns({"_left": F.floor(F.col(number).cast("long") / F.lit(b)).cast("long"), "_right": F.col(number).cast("long") % b})
    for i in range(ROUNDS):
        own, other, size = ("_left", "_right", a) if i % 2 == 0 else ("_right", "_left", b)
        key = F.col(keys)[i]
        x = x.withColumn("_y", (F.col(other) + key) % PRIME)
        x = x.withColumn(own, (F.col(own) + (F.col("_y") * F.col("_y") + F.lit(40_503) * F.col("_y") + key) % PRIME) % size)
    x = x.withColumn("_at", F.col("_left") * b + F.col("_right"))
    return x.withColumn(out, F.when(F.col("_at") < n, F.col("_at")).otherwise(permuted(F.col("_at"), F.col(keys), n))).drop("_left", "_right", "_y", "_at")


def drawn_numbers(x: Column, draw: Column, draws: int, n: int, seed: int) -> Column:
    """A row number below ``n`` per (id, draw), draws from 0: the replicates' hash, scaled. ``x`` is a column with the
    ids' ``id_hash``; the polynomial reads it three times."""
    a, b, c, d = (F.element_at(F.array(*[F.lit(x) for x in column]).cast("array<bigint>"), draw.cast("int") + 1)
                  for column in zip(*coefficients(seed, draws), strict=True))
    u = (((((a * x + b) % PRIME) * x + c) % PRIME) * x + d) % PRIME
    if n < 1 << 32:  # the product is below 2 ** 63
        return F.call_function("div", u * F.lit(n), F.lit(PRIME)).cast("long")
    return F.call_function("div", u.cast("decimal(10,0)") * F.lit(n).cast("decimal(18,0)"), F.lit(PRIME).cast("decimal(10,0)")).cast("long")
