"""Discrete-time hazard models (L3-L5) replacing the random survival forest and boosted Cox:
subjects are expanded to one row per interval at risk (person-period), an MLlib classifier learns
the interval hazard, and survival is the running product of (1 - hazard) over the intervals."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tte.operators.scan import banded
from tte.session import ensure_checkpoint_dir

#: Subjects times intervals up to which boosted trees are fitted row by row; beyond, equal rows are merged into weighted cells.
ROWS_ONE_BY_ONE = 2_000_000
#: Quantile bands of a feature in the cells, as many as MLlib makes bins.
BANDS = 32
#: Most rows of predictions by band that are broadcast.
BROADCAST_ROWS = 100_000


def person_period(df: DataFrame, edges: Sequence[float], time: str = "time", event: str = "event") -> DataFrame:
    """L3: one row per subject and interval (edges[k-1], edges[k]] the subject is at risk in;
    ``target`` = 1 when the event falls in that interval. Adds ``interval`` (1-based) and
    ``interval_start``. A subject with time 0 is at risk at the start of the first interval and has one
    row there. Rows per subject are bounded by the number of edges."""
    e = [float(x) for x in edges]
    starts = F.array(*[F.lit(v) for v in [0.0] + e[:-1]])
    ends = F.array(*[F.lit(v) for v in e])
    x = df.select("*", F.posexplode(F.arrays_zip(starts.alias("s"), ends.alias("e"))).alias("_k", "_iv"))
    x = x.where((F.col(time) > F.col("_iv.s")) | ((F.col(time) == 0) & (F.col("_k") == 0)))
    tgt = ((F.col(event) == 1) & (F.col(time) <= F.col("_iv.e"))).cast("double")
    return x.select(*df.columns, (F.col("_k") + 1).alias("interval"), F.col("_iv.s").alias("interval_start"), tgt.alias("target"))


class DiscreteHazard:
    """L4 (``kind="forest"``) / L5 (``kind="gbt"``): interval hazards from an MLlib classifier on
    the person-period table, with the interval start as a feature. ``risk`` = sum of hazards over
    the intervals; survival at each edge = prod(1 - h)."""

    def __init__(self, features: Sequence[str], edges: Sequence[float], kind: str = "forest", n_trees: int = 50,
                 depth: int = 5, min_leaf: int = 5, lr: float = 0.1, rounds: int = 30, seed: int = 42,
                 time: str = "time", event: str = "event"):
        self.features, self.edges, self.kind = list(features), [float(e) for e in edges], kind
        self.n_trees, self.depth, self.min_leaf, self.lr, self.rounds, self.seed = n_trees, depth, min_leaf, lr, rounds, seed
        self.time, self.event = time, event
        self.model_, self.cuts_ = None, None

    def _vec(self, df: DataFrame, start: str = "interval_start") -> DataFrame:
        names = [f"_tte_{i}" for i in range(len(self.features))] if self.cuts_ else self.features
        return VectorAssembler(inputCols=[*names, start], outputCol="_features", handleInvalid="keep").transform(df)

    def _banded(self, df: DataFrame) -> DataFrame:
        """``df`` with the band of every feature as ``_tte_<i>``, where the model was fitted on cells."""
        for i, cuts in enumerate(self.cuts_ or []):
            df = banded(df, self.features[i], cuts, f"_tte_{i}")
        return df

    def _plan(self, df: DataFrame) -> list[list[float]] | None:
        """Cut points of the features' bands over all subjects (every value of a feature that has at most ``BANDS``, else
        quantiles), or None where the rows are few enough to be fitted one by one."""
        shares = [i / BANDS for i in range(1, BANDS)]
        values = [F.col(f).cast("double") for f in self.features]
        row = df.agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(v, shares, 10_000).alias(f"q{i}") for i, v in enumerate(values)],
                     *[F.approx_count_distinct(v).alias(f"d{i}") for i, v in enumerate(values)]).first()
        if row["n"] * len(self.edges) <= ROWS_ONE_BY_ONE:
            return None
        cuts = []
        for i, v in enumerate(values):
            known = df.select(v.alias("v")).where("v is not null").distinct().limit(BANDS + 1).collect() if row[f"d{i}"] <= 2 * BANDS else []
            cuts.append(sorted({r.v for r in known} if 0 < len(known) <= BANDS else set(row[f"q{i}"] or [])))
        return cuts

    def _cells(self, df: DataFrame) -> DataFrame:
        """The person-period table by bands of the features: one row per distinct (bands, interval, target) and how many
        rows it stands for as ``_weight``. A tree that splits between bands has the same sums over cells as over rows."""
        names = [f"_tte_{i}" for i in range(len(self.features))]
        finite = [F.when(F.abs(F.col(f).cast("double")) < float("inf"), F.col(n)).alias(n) for f, n in zip(self.features, names, strict=True)]
        pp = person_period(self._banded(df).select(self.time, self.event, *finite), self.edges, self.time, self.event)
        ensure_checkpoint_dir(df.sparkSession)
        return pp.groupBy(*names, "interval_start", "target").agg(F.count(F.lit(1)).cast("double").alias("_weight")).checkpoint()

    def fit(self, df: DataFrame) -> "DiscreteHazard":
        """Boosted trees over more than ``ROWS_ONE_BY_ONE`` rows are fitted on weighted cells, whose number follows the
        bands and not the rows; up to that, and for a forest (its bootstrap draws rows), on the rows."""
        self.cuts_ = None
        pp = person_period(df, self.edges, self.time, self.event)
        if self.kind == "forest":
            clf = RandomForestClassifier(featuresCol="_features", labelCol="target", numTrees=self.n_trees,
                                         maxDepth=self.depth, minInstancesPerNode=self.min_leaf, seed=self.seed)
        elif self.kind == "gbt":
            clf = GBTClassifier(featuresCol="_features", labelCol="target", maxDepth=self.depth, maxIter=self.rounds,
                                stepSize=self.lr, seed=self.seed)
            self.cuts_ = self._plan(df)
            if self.cuts_:
                pp = self._cells(df)
                # MLlib looks for splits in a sample of maxBins ^ 2 rows: as many as there are cells, and no band is merged
                clf.setWeightCol("_weight").setMaxBins(max(2 * BANDS + 1, len(self.edges), math.isqrt(pp.count()) + 1))
        else:
            raise ValueError("kind must be forest or gbt")
        self.model_ = clf.fit(self._vec(pp))
        return self

    def _hazards(self, df: DataFrame) -> DataFrame:
        """``df`` with the hazards of a row's intervals, in order, as ``_h``: ARRAY<STRUCT<_k, hazard>>. One model
        column per interval, so rows are not multiplied."""
        x, hazards = df, []
        to = {self.model_.rawPredictionCol: "_tte_raw", self.model_.probabilityCol: "_tte_p", self.model_.predictionCol: ""}
        for k, start in enumerate([0.0] + self.edges[:-1]):
            x = self.model_.transform(self._vec(x.withColumn("_tte_start", F.lit(start)), "_tte_start"), to)
            x = x.withColumn(f"_tte_h{k}", vector_to_array("_tte_p")[1]).drop("_features", "_tte_raw", "_tte_p")
            hazards.append(F.struct(F.lit(k).alias("_k"), F.col(f"_tte_h{k}").alias("hazard")))
        return x.select(*df.columns, F.array(*hazards).alias("_h"))

    def _hazards_by_band(self, df: DataFrame) -> DataFrame:
        """``_hazards`` of a model on cells: rows with the same bands have the same, so each is predicted once."""
        names = [f"_tte_{i}" for i in range(len(self.features))]
        x = self._banded(df)
        ensure_checkpoint_dir(df.sparkSession)
        known = self._hazards(x.select(*names).distinct()).checkpoint()
        known = F.broadcast(known) if known.count() <= BROADCAST_ROWS else known
        same = [F.col(f"_l.{n}").eqNullSafe(F.col(f"_r.{n}")) for n in names]
        return x.alias("_l").join(known.alias("_r"), same).select(*[F.col(f"_l.{c}") for c in df.columns], "_h")

    def survival(self, df: DataFrame, id_col: str) -> DataFrame:
        """Per subject ``risk`` and ``surv`` (ARRAY over the edges), multiplied in order of the intervals. Rows with a null
        id are left out; rows that repeat an id share the hazards of all of them."""
        x = df.where(F.col(id_col).isNotNull())
        x = self._hazards_by_band(x) if self.cuts_ else self._hazards(x)
        x = x.withColumn("_all", F.collect_list("_h").over(Window.partitionBy(id_col)))
        x = x.withColumn("_h", F.when(F.size("_all") == 1, F.col("_h")).otherwise(F.sort_array(F.flatten("_all"))))
        surv = F.transform(F.col("_h"), lambda x, i: F.aggregate(F.slice(F.col("_h"), 1, i + 1), F.lit(1.0),
                                                                  lambda acc, y: acc * (1 - y["hazard"])))
        risk = F.aggregate(F.col("_h"), F.lit(0.0), lambda acc, y: acc + y["hazard"])
        return x.select(id_col, *[c for c in df.columns if c != id_col], risk.alias("risk"), surv.alias("surv"))
