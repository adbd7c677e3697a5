"""Reading, typing, splitting, selecting and writing cohort tables."""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".jsonl": "json", ".ndjson": "json"}


@dataclass(frozen=True)
class CohortSpec:
    """Column roles of a cohort table."""

    time: str = "time"
    event: str = "event"
    id: str | None = None
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    drop: tuple[str, ...] = field(default=())


def _nan_to_null(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_cohort(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None,
                required: Sequence[str] = ("time", "event"), **options) -> DataFrame:
    """Read CSV / Parquet / JSON(L) by suffix (or ``fmt``); NaN becomes null; missing required
    columns fail with the missing and the available names."""
    if fmt is None:
        ext = os.path.splitext(path.rstrip("/"))[1].lower()
        if ext not in FORMATS:
            raise ValueError(f"unsupported file type {ext!r} for {path}; use one of {sorted(FORMATS)}")
        fmt = FORMATS[ext]
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
        if schema is None:
            reader = reader.option("inferSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.options(**options).load(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; available: {df.columns}")
    return _nan_to_null(df)


def apply_types(df: DataFrame, meta: dict[str, str]) -> DataFrame:
    """Cast by metadata in one ``select``; bad values become null, also under ANSI mode.

    ``float`` -> double, ``int`` -> bigint (through double; non-integers become null),
    ``category``/``string`` -> string, ``bool`` -> int 0/1.
    """
    out = []
    for c in df.columns:
        kind = meta.get(c)
        col = F.col(c)
        if kind == "float":
            out.append(F.expr(f"try_cast(`{c}` AS DOUBLE)").alias(c))
        elif kind == "int":
            d = F.expr(f"try_cast(`{c}` AS DOUBLE)")
            out.append(F.when(d == F.floor(d), d.cast("bigint")).alias(c))
        elif kind in ("category", "string"):
            out.append(col.cast("string").alias(c))
        elif kind == "bool":
            s = F.lower(col.cast("string"))
            out.append(F.when(s.isin("1", "true", "1.0"), 1).when(s.isin("0", "false", "0.0"), 0).alias(c))
        else:
            out.append(col)
    return df.select(*out)


def split_external(df: DataFrame, group_col: str, train_value, external_value,
                   external: DataFrame | None = None) -> DataFrame:
    """Tag rows ``train`` / ``external``. With a second table, union it as external; else the
    group value (compared as text) decides and other groups are dropped. Adds ``__split``."""
    if external is not None:
        a = df.withColumn("__split", F.lit("train"))
        b = external.withColumn("__split", F.lit("external"))
        return a.unionByName(b, allowMissingColumns=True)
    g = F.col(group_col).cast("string")
    tagged = df.withColumn(
        "__split",
        F.when(g == str(train_value), F.lit("train")).when(g == str(external_value), F.lit("external")),
    )
    return tagged.where(F.col("__split").isNotNull())


def split_target(df: DataFrame, spec: CohortSpec = CohortSpec(), group: str | None = None):
    """(features, target) where target = (id?, time DOUBLE, event INT)."""
    keep = [spec.id] if spec.id else []
    target = df.select(*keep, F.col(spec.time).cast("double").alias("time"), F.col(spec.event).cast("int").alias("event"))
    drop = [spec.time, spec.event] + ([group] if group else [])
    return df.drop(*drop), target


def select_features(df: DataFrame, spec: CohortSpec, drop_missing: bool = False, keep: Iterable[str] = ()) -> DataFrame:
    """Drop the listed columns, keep numeric + categorical features that exist (plus ``keep``),
    optionally drop rows with a null feature."""
    base = df.drop(*spec.drop)
    feats = [c for c in (*spec.numeric, *spec.categorical) if c in base.columns]
    out = base.select(*list(keep), *feats)
    return out.dropna(subset=feats) if drop_missing else out


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                mode: str = "overwrite") -> None:
    """Write a result table (csv with header, json lines or parquet)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def dataset_summary(df: DataFrame, time: str = "time", event: str = "event", split_col: str | None = None) -> DataFrame:
    """Rows, columns, events, event rate, missing-cell percentage (one ``agg`` pass) and,
    with a split column, the external row count."""
    ncols = len(df.columns)
    miss = sum((F.col(f"`{c}`").isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(ncols).alias("n_columns"),
        F.sum(F.col(event).cast("long")).alias("n_events"),
        F.avg(F.col(event).cast("double")).alias("event_rate"),
        (F.sum(miss) * 100.0 / (F.count(F.lit(1)) * ncols)).alias("missing_pct"),
    ]
    if split_col:
        aggs.append(F.sum((F.col(split_col) == "external").cast("long")).alias("n_external"))
    return df.agg(*aggs)


def subject_filter(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Keep the listed subjects (left semi join; Spark broadcasts the id list when it is small,
    otherwise a shuffle semi join, so no size assumption is needed)."""
    return df.join(ids.select(id_col).distinct(), on=id_col, how="left_semi")
