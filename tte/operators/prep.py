"""Preprocessing fitted on one table and applied to any.

``fit`` runs one aggregate pass and keeps only constants on the driver (a few numbers per
column, or the sorted level list of a categorical column, checked against ``max_levels``);
``transform`` is a single ``select`` of Column expressions with those constants as literals, so
applying a fitted pipeline to test data cannot leak anything from it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tte.operators.stats import exact_quantiles, most_frequent


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


@dataclass
class SimpleImputer:
    """Fill nulls with the mean, the median (exact, linear) or the most frequent value
    (smallest on ties)."""

    columns: Sequence[str]
    strategy: str = "mean"
    fill_: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "SimpleImputer":
        cols = list(self.columns)
        if self.strategy == "mean":
            row = df.agg(*[F.avg(_q(c)).alias(c) for c in cols]).collect()[0]
            self.fill_ = {c: row[c] for c in cols}
        elif self.strategy == "median":
            rows = exact_quantiles(df, cols, [0.5]).collect()
            self.fill_ = {r["column"]: r["q"] for r in rows}
        elif self.strategy == "most_frequent":
            self.fill_ = most_frequent(df, cols)
        else:
            raise ValueError(f"unknown strategy {self.strategy!r}")
        return self

    def exprs(self, df: DataFrame) -> dict[str, Column]:
        return {c: F.coalesce(_q(c), F.lit(self.fill_.get(c)).cast(df.schema[c].dataType)) for c in self.columns}


@dataclass
class StandardScaler:
    """(x - mean) / population std; a zero std is read as 1 (scikit-learn's rule)."""

    columns: Sequence[str]
    mean_: dict = field(default_factory=dict)
    scale_: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "StandardScaler":
        aggs = []
        for c in self.columns:
            aggs += [F.avg(_q(c).cast("double")).alias(f"{c}__m"), F.stddev_pop(_q(c).cast("double")).alias(f"{c}__s")]
        row = df.agg(*aggs).collect()[0]
        for c in self.columns:
            s = row[f"{c}__s"]
            self.mean_[c] = row[f"{c}__m"]
            self.scale_[c] = s if s not in (None, 0.0) else 1.0
        return self

    def exprs(self, df: DataFrame) -> dict[str, Column]:
        return {c: ((_q(c).cast("double") - F.lit(self.mean_[c])) / F.lit(self.scale_[c])) for c in self.columns}


@dataclass
class OneHot:
    """One 0/1 column ``{col}_{level}`` per sorted level seen at fit; unknown levels (and null)
    give all zeros. Levels are a bounded list: more than ``max_levels`` is an error."""

    columns: Sequence[str]
    max_levels: int = 1000
    levels_: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "OneHot":
        arr = F.array(*[F.struct(F.lit(c).alias("column"), _q(c).cast("string").alias("level")) for c in self.columns])
        lv = (df.select(F.explode(arr).alias("_r")).select("_r.*").where(F.col("level").isNotNull()).distinct()
              .groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("level")).alias("levels")))
        counts = lv.select("column", "n").collect()
        big = [r["column"] for r in counts if r["n"] > self.max_levels]
        if big:
            raise ValueError(f"columns {big} have more than {self.max_levels} levels")
        self.levels_ = {r["column"]: list(r["levels"]) for r in lv.collect()}
        return self

    def exprs(self, df: DataFrame) -> dict[str, Column]:
        out = {}
        for c in self.columns:
            for lev in self.levels_.get(c, []):
                out[f"{c}_{lev}"] = F.coalesce((_q(c).cast("string") == F.lit(lev)).cast("double"), F.lit(0.0))
        return out


class LevelDictionary:
    """P4 for columns of any number of levels: a numbered table of the levels seen at fit, joined to the rows, and one
    sparse vector per row. ``OneHot`` makes a column per level and is bounded; this one has no limit.

    Levels are numbered from 0 in order of column, then level: the places that the sorted 0/1 columns of ``OneHot`` would
    have. The numbers come from a banded running count, so no task or driver holds the levels; ``table_`` is
    written to the shared folder. Unknown levels and nulls give no entry."""

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)
        self.table_: DataFrame | None = None
        self.size_ = 0

    def fit(self, df: DataFrame) -> "LevelDictionary":
        arr = F.array(*[F.struct(F.lit(i).alias("c"), _q(c).cast("string").alias("level")) for i, c in enumerate(sorted(self.columns))])
        levels = df.select(F.explode(arr).alias("x")).select("x.*").where("level is not null").distinct()
        # ranges of the sorted levels, numbered within and shifted by what lies before
        ranged = levels.repartitionByRange("c", "level").sortWithinPartitions("c", "level").withColumn("part", F.spark_partition_id())
        ranged = ranged.withColumn("at", F.monotonically_increasing_id()).checkpoint()
        counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("least")).orderBy("part").collect()
        before, shifts = 0, []
        for r in counts:  # a row per partition
            shifts.append((r["part"], before - r["least"]))
            before += r["n"]
        table = df.sparkSession.createDataFrame(shifts, "part int, shift long")
        self.table_ = ranged.join(F.broadcast(table), "part").select("c", "level", (F.col("at") + F.col("shift")).cast("int").alias("number"))
        self.size_ = before
        return self

    def transform(self, df: DataFrame, id_col: str, out: str = "levels") -> DataFrame:
        """Every row with ``out``, a sparse vector of ``size_`` places, and the columns taken out; ``id_col`` tells rows apart."""
        from pyspark.ml.functions import array_to_vector  # noqa: F401  the vector type
        from pyspark.ml.linalg import Vectors, VectorUDT

        size = self.size_

        @F.udf(VectorUDT())
        def sparse(places):
            return Vectors.sparse(size, [(p, 1.0) for p in sorted(places or [])])

        arr = F.array(*[F.struct(F.lit(i).alias("c"), _q(c).cast("string").alias("level")) for i, c in enumerate(sorted(self.columns))])
        asked = df.select(F.col(id_col).alias("_id"), F.explode(arr).alias("x")).select("_id", "x.*").where("level is not null")
        found = asked.join(self.table_, ["c", "level"]).groupBy("_id").agg(F.sort_array(F.collect_set("number")).alias("_places"))
        rest = [c for c in df.columns if c not in self.columns]
        return df.join(found, F.col(id_col).eqNullSafe(F.col("_id")), "left").select(*[_q(c) for c in rest], sparse("_places").alias(out))


@dataclass
class Pipeline:
    """P5: ordered steps; each later step sees the earlier steps' output. Columns no step names
    pass through. ``fit`` on train, ``transform`` anywhere (P6)."""

    steps: list

    def fit(self, df: DataFrame) -> "Pipeline":
        cur = df
        for s in self.steps:
            s.fit(cur)
            cur = self._apply(cur, s)
        return self

    @staticmethod
    def _apply(df: DataFrame, step) -> DataFrame:
        ex = step.exprs(df)
        if isinstance(step, OneHot):
            kept = [_q(c) for c in df.columns if c not in step.columns]
            return df.select(*kept, *[e.alias(n) for n, e in ex.items()])
        return df.select(*[ex[c].alias(c) if c in ex else _q(c) for c in df.columns])

    def transform(self, df: DataFrame) -> DataFrame:
        cur = df
        for s in self.steps:
            cur = self._apply(cur, s)
        return cur


def build_pipeline(spec: list[tuple[str, dict]], numeric: Sequence[str], categorical: Sequence[str]) -> Pipeline:
    """P5: steps by name: ``imputer`` (numeric), ``imputer_cat`` (categorical), ``scaler``,
    ``encoder``. Steps whose name has "encoder" or "imputer_cat" act on the categorical columns,
    the rest on the numeric ones."""
    steps = []
    for name, params in spec:
        cols = list(categorical) if ("encoder" in name or "imputer_cat" in name) else list(numeric)
        if "imputer" in name:
            strategy = params.get("strategy", "most_frequent" if "imputer_cat" in name else "mean")
            steps.append(SimpleImputer(cols, strategy))
        elif "scaler" in name:
            steps.append(StandardScaler(cols))
        elif "encoder" in name:
            steps.append(OneHot(cols, params.get("max_levels", 1000)))
        else:
            raise ValueError(f"unknown step {name!r}")
    return Pipeline(steps)


def fit_transform_split(pipe: Pipeline, train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Constants from ``train`` only, applied to both."""
    pipe.fit(train)
    return pipe.transform(train), pipe.transform(test)


@dataclass
class IterativeImputer:
    """Each gappy numeric column regressed on the others, in rounds (scikit-learn's idea with
    a ridge instead of its Bayesian ridge: same fixed point idea, not equal digits).

    Start from the column means (``initial="mean"``); in each round and for each column with gaps,
    one aggregate pass gives the Gram matrix X'X and X'y over rows where the column is observed
    (the other columns at their current fill), the small ridge system is solved on the driver and
    the fill expression is updated. Only (p+1)^2 numbers per column reach the driver."""

    columns: Sequence[str]
    max_iter: int = 10
    ridge: float = 1e-6
    coef_: dict = field(default_factory=dict)
    mean_: dict = field(default_factory=dict)

    def _filled(self, df: DataFrame) -> dict[str, Column]:
        cur = {c: F.coalesce(_q(c).cast("double"), F.lit(self.mean_[c])) for c in self.columns}
        for c in self.columns:
            if c in self.coef_:
                b = self.coef_[c]
                pred = F.lit(b[0])
                for j, o in enumerate([x for x in self.columns if x != c]):
                    pred = pred + F.lit(b[j + 1]) * cur[o]
                cur[c] = F.coalesce(_q(c).cast("double"), pred)
        return cur

    def fit(self, df: DataFrame) -> "IterativeImputer":
        import numpy as np

        cols = list(self.columns)
        row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.sum(_q(c).isNull().cast("long")).alias(f"n_{c}") for c in cols]).collect()[0]
        self.mean_ = {c: row[f"m_{c}"] or 0.0 for c in cols}
        gappy = [c for c in cols if row[f"n_{c}"] > 0]
        for _ in range(self.max_iter):
            changed = 0.0
            for c in gappy:
                cur = self._filled(df)
                others = [o for o in cols if o != c]
                xs = [F.lit(1.0)] + [cur[o] for o in others]
                obs = df.where(_q(c).isNotNull())
                aggs = [F.sum(xs[i] * xs[j]).alias(f"g{i}_{j}") for i in range(len(xs)) for j in range(i, len(xs))]
                aggs += [F.sum(xs[i] * _q(c).cast("double")).alias(f"y{i}") for i in range(len(xs))]
                r = obs.agg(*aggs).collect()[0]
                k = len(xs)
                g = np.zeros((k, k))
                for i in range(k):
                    for j in range(i, k):
                        g[i, j] = g[j, i] = r[f"g{i}_{j}"] or 0.0
                y = np.array([r[f"y{i}"] or 0.0 for i in range(k)])
                b = np.linalg.solve(g + self.ridge * np.eye(k), y)
                old = np.array(self.coef_.get(c, np.zeros(k)))
                changed = max(changed, float(np.max(np.abs(b - old))))
                self.coef_[c] = [float(v) for v in b]
            if changed < 1e-6:
                break
        return self

    def exprs(self, df: DataFrame) -> dict[str, Column]:
        return self._filled(df)
