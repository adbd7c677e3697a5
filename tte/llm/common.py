"""Shared pieces: tables in the cluster's shared folder, held-out folds, size-checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tte.session import ensure_checkpoint_dir, ship_package

#: Rows up to which a side with a few fixed-width columns is broadcast (checked by a count before);
#: beyond it the same join is a shuffle join.
BROADCAST_ROWS = 500_000

#: Rows in one Arrow batch of a Python task. Texts are long, and a batch is held by the JVM and by
#: Python at once, so the default of 10,000 rows would take hundreds of megabytes a task.
BATCH_ROWS = 500

_SCRATCH: list[str] = []


def ready(spark: SparkSession) -> None:
    """Prepare a session for these operators: checkpoint folder, code on the workers, small batches."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the cluster names in ``spark.checkpoint.dir``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:16]}"
    _SCRATCH.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, and a lost
    executor costs only a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(hadoop).delete(p, True)
        if path in _SCRATCH:
            _SCRATCH.remove(path)


def paths_of(df: DataFrame) -> list[str]:
    """The scratch tables that a frame reads."""
    roots = {f.rpartition("/")[0] for f in df.inputFiles()}
    return [p for p in _SCRATCH if any(r.rstrip("/").endswith(p.rpartition("/")[2]) for r in roots)]


def drop_frame(df: DataFrame) -> None:
    """Delete the scratch table a frame made by ``written`` reads."""
    drop_written(df.sparkSession, *paths_of(df))


def scratch_now() -> set[str]:
    """Paths of the scratch tables that exist now; the difference of two calls is what was written
    between them."""
    return set(_SCRATCH)


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n`` (null ids count as the empty text)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Hint a broadcast if ``df`` (a written table of a few narrow columns) has at most
    ``BROADCAST_ROWS`` rows; otherwise leave the join to the shuffle."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def small_lists(df: DataFrame, column: str) -> DataFrame:
    """Like ``small_side`` for a written table with an array column: by the number of all its elements."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(column).cast("long")).alias("m")).first()
    return small_side(df, row["n"] + (row["m"] or 0) // 4)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
