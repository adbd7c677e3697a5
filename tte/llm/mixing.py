"""Mixing sources to target weights by hash-threshold histograms.

Every row gets a 60-bit hash of its id. Per source the sizes are summed by hash bucket (a histogram
of at most 4096 rows a source, pre-aggregated on the map side), a running sum over the buckets finds
the one bucket in which the budget runs out, and only the rows of that bucket are summed again by the
next 12 bits, until the threshold is a single hash value. Rows are then kept by comparing their hash
with their source's threshold: nothing is sorted, and a source that holds a third of all rows costs
no more per task than any other. Thresholds are nested: a larger budget takes a superset, and the
second repeat of a source takes a subset of what the first one took.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tte.llm.common import BROADCAST_ROWS, written

HASH_HEX = 15  # hex digits of the hash: 60 bits
LEVEL_HEX = 3  # hex digits refined at a time: 4096 buckets
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of ``WORD`` matches; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(key: Column) -> Column:
    """First 60 bits of the MD5 of the key's decimal text, as a long (null: the empty text)."""
    hexed = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(hexed, 1, HASH_HEX), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2),
                   cap: int = 2) -> DataFrame:
    """Targets per source from ``(source, source_size)``.

    Sources in code-point order (null last) get the weights in turn. ``share`` (a fraction) of the
    sum of all sizes is dealt out by weight; a target stops at ``cap`` times its source's size and the
    excess goes to the others by weight until none is above. That is the level at which
    ``min(cap * size, level * weight)`` adds up to the budget: sources sorted by ``cap * size /
    weight`` are capped up to the first one that the level so far does not exceed. Works on one row a
    source, with exact whole sums."""
    num, den = share
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("limit", (cap * F.col("source_size")).cast("double"))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    levels = (ranked
              .withColumn("budget", F.sum("source_size").over(everything) * num / den)
              .withColumn("capped", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
              .withColumn("rest", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("rest"))
              .withColumn("free", F.col("limit") >= F.col("level") * F.col("weight")))
    # the first free source in that order fixes the level of all that follow
    level = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (levels.withColumn("final", level)
            .withColumn("target", F.least(F.col("limit"), F.col("final") * F.col("weight")))
            .select("source", "source_size", "target"))


def _bucket(digits: int) -> Column:
    return F.shiftright(F.col("h"), 4 * (HASH_HEX - digits))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the whole repeats and the hash threshold of the last, partial one.

    ``sized`` has ``source, size, h``. Returns ``source, source_size, target, repeats, below``: a row
    is taken ``repeats`` times, and once more if ``h < below``. The hash value in which the budget
    runs out is taken if at least half of its size still fits."""
    goal = (targets
            .withColumn("repeats", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                        .otherwise(0).cast("long"))
            .withColumn("need", F.col("target") - F.col("repeats") * F.col("source_size"))
            .withColumn("prefix", F.lit(0).cast("long")))
    open_rows, done = sized, None
    for digits in range(LEVEL_HEX, HASH_HEX + 1, LEVEL_HEX):
        histogram = (open_rows.withColumn("bucket", _bucket(digits))
                     .groupBy("source", "bucket").agg(F.sum("size").alias("size")))
        running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        cut = (histogram.withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0)))
               .alias("x").join(_small(goal.alias("g")), F.expr("x.source <=> g.source"))
               .where("x.before < g.need and x.before + x.size >= g.need")
               .select("g.source", "g.source_size", "g.target", "g.repeats",
                       (F.col("need") - F.col("before")).alias("need"), F.col("bucket").alias("prefix"),
                       F.col("x.size").alias("inside")))
        goal = written(cut, "mix-cut")
        if digits == HASH_HEX:
            break
        open_rows = written(
            open_rows.withColumn("bucket", _bucket(digits)).alias("r")
            .join(_small(goal.alias("g")), F.expr("r.source <=> g.source and r.bucket = g.prefix"), "left_semi")
            .select("source", "size", "h"), "mix-open")
        if open_rows.where("size > 0").groupBy("source").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a < b").isEmpty():
            last = open_rows.groupBy("source").agg(F.max(F.when(F.col("size") > 0, F.col("h"))).alias("h1"))
            goal = written(goal.alias("g").join(last.alias("l"), F.expr("g.source <=> l.source"))
                           .select("g.*", "h1").withColumn("prefix", F.col("h1")).drop("h1"), "mix-last")
            break
    below = (goal.withColumn("below", F.col("prefix") + F.when(F.col("inside") <= 2 * F.col("need"), 1).otherwise(0))
             .select("source", "below"))
    return (targets.alias("t").join(below.alias("b"), F.expr("t.source <=> b.source"), "left")
            .select("t.source", "source_size", "target",
                    F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                    .otherwise(0).cast("long").alias("repeats"),
                    F.coalesce("below", F.lit(0)).cast("long").alias("below")))


def _small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast one row per source if they are provably few (``limit`` reads no more than that);
    beyond it the join is a shuffle join, whose hot sources AQE splits."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                       hash60(F.col(key)).alias("h"))


def _plan(sized: DataFrame, weights, share, cap) -> DataFrame:
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(totals, weights, share, cap), "mix-targets")
    return written(thresholds(sized.select("source", "size", "h"), targets), "mix-plan")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2), cap: int = 2) -> DataFrame:
    """How often the mix takes each row.

    Returns one row per input row: ``key, size, source_size, target, taken, repeats``. ``size`` is the
    number of words, ``taken = size * repeats``. Null texts have size 0 and take nothing; null sources
    are one source, last in the order; null keys share a hash, and so do repeated keys (they are taken
    together); an empty table gives an empty result. Only the columns named are read, so further
    columns cannot clash. Reruns agree: hashes come from the key."""
    sized = written(_sized(docs, key, text, source), "mix-sized")
    plan = _plan(sized, weights, share, cap)
    repeats = F.col("repeats") + F.when(F.col("h") < F.col("below"), 1).otherwise(0)
    return (sized.alias("d").join(_small(plan.alias("p")), F.expr("d.source <=> p.source"))
            .withColumn("n", F.when(F.col("size") > 0, repeats).otherwise(0).cast("long"))
            .select(F.col("doc_id").alias(key), "size", "source_size", "target",
                    (F.col("size") * F.col("n")).alias("taken"), F.col("n").alias("repeats")))


def take_mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
             weights: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2), cap: int = 2) -> DataFrame:
    """The rows that the mix takes, whole, with ``repeats`` (how often; 1 or more) as the last column,
    in place of one of that name. The rows are as for ``mix``; they are filtered where they lie, and
    only their sizes and hashes were gathered before."""
    plan = _plan(written(_sized(docs, key, text, source), "mix-sized"), weights, share, cap)
    row = docs.select(F.struct("*").alias("row"), F.col(source).alias("source"), hash60(F.col(key)).alias("h"),
                      F.coalesce(F.col(text).rlike(WORD), F.lit(False)).alias("worded"))
    names = [c for c in docs.columns if c != "repeats"]
    return (row.alias("d").join(_small(plan.select("source", "repeats", "below").alias("p")), F.expr("d.source <=> p.source"))
            .withColumn("n", (F.col("repeats") + F.when(F.col("h") < F.col("below"), 1).otherwise(0)).cast("long"))
            .where("worded and n > 0").select(*[F.col("row")[c].alias(c) for c in names], F.col("n").alias("repeats")))
