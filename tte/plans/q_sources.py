"""Registered queries: sources, typing, splitting, selection, summary."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tte.functions.expr import aft_cdf, clip, monotone_survival, sigmoid
from tte.plans.registry import r6, register
from tte.plans.sqltext import COHORT_ORDERS, RISK
from tte.session import ensure_checkpoint_dir
from tte.sources.cohort import (
    CohortSpec, apply_types, dataset_summary, read_cohort, select_features, split_external, split_target,
    subject_filter, write_table,
)
from tte.sources.tables import table
from tte.sources.testdata import cohort_exclusions, cohort_orders, with_standin


@register("S1_read_cohort", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus""")
def s1_read(spark, sf_dir):
    """Parquet read by suffix with a required-column check (NaN mapped to null)."""
    df = read_cohort(spark, os.path.join(sf_dir, "orders.parquet"), required=("o_orderkey", "o_totalprice"))
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("o_totalprice"), 2).alias("total"))


@register("S7_S1_csv_roundtrip", f"""WITH {COHORT_ORDERS}
SELECT c_mktsegment, count(*) AS n, CAST(sum(event) AS BIGINT) AS events, round(sum(time), 1) AS sum_time FROM cohort GROUP BY c_mktsegment""")
def s7_roundtrip(spark, sf_dir):
    """The cohort written as CSV (partitioned by segment) under the checkpoint folder and read back
    through ``read_cohort`` with an explicit schema."""
    co = cohort_orders(spark, sf_dir)
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"cohort-{uuid.uuid4().hex[:10]}.csv")
    write_table(co, path, "csv", partition_by=["c_mktsegment"])
    back = read_cohort(spark, path, fmt="csv",
                       schema="subject_id long, time double, event int, x_price double, x_bal double, o_orderpriority string, c_mktsegment string")
    return back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum("event").cast("bigint").alias("events"),
                                            r6(F.sum("time"), 1).alias("sum_time"))


@register("S7_S1_json_roundtrip", f"""WITH {COHORT_ORDERS}
SELECT o_orderpriority, count(*) AS n, CAST(sum(event) AS BIGINT) AS events FROM cohort GROUP BY o_orderpriority""")
def s7_json(spark, sf_dir):
    co = cohort_orders(spark, sf_dir)
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"cohort-{uuid.uuid4().hex[:10]}.jsonl")
    write_table(co, path, "json")
    back = read_cohort(spark, path, schema=co.schema)
    return back.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("event").cast("bigint").alias("events"))


@register("S2_apply_types", """
WITH t AS (SELECT CAST(l_orderkey AS VARCHAR) AS a, CAST(l_quantity AS VARCHAR) AS b, l_returnflag AS c,
                  CAST(l_discount * 100 AS VARCHAR) AS d FROM lineitem),
x AS (SELECT CASE WHEN TRY_CAST(a AS DOUBLE) = floor(TRY_CAST(a AS DOUBLE)) THEN CAST(TRY_CAST(a AS DOUBLE) AS BIGINT) END AS a,
             TRY_CAST(b AS DOUBLE) AS b,
             CASE WHEN TRY_CAST(c AS DOUBLE) = floor(TRY_CAST(c AS DOUBLE)) THEN CAST(TRY_CAST(c AS DOUBLE) AS BIGINT) END AS c,
             CASE WHEN TRY_CAST(d AS DOUBLE) = floor(TRY_CAST(d AS DOUBLE)) THEN CAST(TRY_CAST(d AS DOUBLE) AS BIGINT) END AS d FROM t)
SELECT count(a) AS n_a, round(sum(b), 2) AS sum_b, count(c) AS n_c, count(d) AS n_d, CAST(sum(d) AS BIGINT) AS sum_d FROM x""")
def s2_types(spark, sf_dir):
    """Text columns typed by metadata: flags are not numbers (all null), discount x 100 is an
    integer only where the product has no fraction."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("a"), F.col("l_quantity").cast("string").alias("b"),
        F.col("l_returnflag").alias("c"), (F.col("l_discount") * 100).cast("string").alias("d"))
    t = apply_types(li, {"a": "int", "b": "float", "c": "int", "d": "int"})
    return t.agg(F.count("a").alias("n_a"), r6(F.sum("b"), 2).alias("sum_b"), F.count("c").alias("n_c"),
                 F.count("d").alias("n_d"), F.sum("d").alias("sum_d"))


@register("S4_split_external", f"""WITH {COHORT_ORDERS}
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'train' ELSE 'external' END AS __split, count(*) AS n
FROM cohort WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1""")
def s4_external(spark, sf_dir):
    s = split_external(cohort_orders(spark, sf_dir), "o_orderpriority", "1-URGENT", "2-HIGH")
    return s.groupBy("__split").agg(F.count(F.lit(1)).alias("n"))


@register("S5_S6_split_select", f"""WITH {COHORT_ORDERS}
SELECT count(*) AS n_target, CAST(sum(event) AS BIGINT) AS events,
       (SELECT count(*) FROM cohort WHERE x_price IS NOT NULL AND x_bal IS NOT NULL AND c_mktsegment IS NOT NULL) AS n_features
FROM cohort""")
def s5_s6(spark, sf_dir):
    spec = CohortSpec(time="time", event="event", id="subject_id", numeric=("x_price", "x_bal"),
                      categorical=("c_mktsegment", "missing_col"), drop=("o_orderpriority",))
    feats, target = split_target(cohort_orders(spark, sf_dir), spec)
    sel = select_features(feats, spec, drop_missing=True)
    t = target.agg(F.count(F.lit(1)).alias("n_target"), F.sum("event").cast("bigint").alias("events"))
    return t.crossJoin(sel.agg(F.count(F.lit(1)).alias("n_features")))


@register("S8_dataset_summary", f"""WITH {COHORT_ORDERS},
p AS (SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN 'external' ELSE 'train' END AS split FROM cohort)
SELECT count(*) AS n_rows, 8 AS n_columns, CAST(sum(event) AS BIGINT) AS n_events, round(avg(event), 6) AS event_rate,
       CAST(0.0 AS DOUBLE) AS missing_pct, CAST(sum(CASE WHEN split = 'external' THEN 1 ELSE 0 END) AS BIGINT) AS n_external FROM p""")
def s8_summary(spark, sf_dir):
    co = cohort_orders(spark, sf_dir).withColumn("split", F.when(F.col("o_orderpriority") == "5-LOW", "external").otherwise("train"))
    s = dataset_summary(co, split_col="split")
    return s.select("n_rows", "n_columns", "n_events", r6("event_rate").alias("event_rate"), r6("missing_pct").alias("missing_pct"),
                    "n_external")


@register("E8_subject_filter", f"""WITH {COHORT_ORDERS}
SELECT subject_id, time, event FROM cohort WHERE subject_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1)""")
def e8_filter(spark, sf_dir):
    ids = table(spark, sf_dir, "lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)) \
        .select(F.col("l_orderkey").alias("subject_id"))
    return subject_filter(cohort_orders(spark, sf_dir), ids, "subject_id").select("subject_id", "time", "event")


@register("E1_E4_expressions", f"""WITH {COHORT_ORDERS}
SELECT subject_id, least(greatest(x_price, 1.0), 3.0) AS price_clipped, round(1.0 / (1.0 + exp(-({RISK}))), 6) AS p,
       round(greatest(exp(-exp({RISK} - 1.5) * 365.0 / 1000.0), 0.5), 6) AS s_floor FROM cohort""")
def e1_e4(spark, sf_dir):
    co = with_standin(cohort_orders(spark, sf_dir))
    return co.select("subject_id", clip(F.col("x_price"), 1.0, 3.0).alias("price_clipped"), r6(sigmoid(F.col("risk"))).alias("p"),
                     r6(clip(F.element_at("surv", 3), 0.5, None)).alias("s_floor"))


@register("E6_monotone_survival", f"""WITH {COHORT_ORDERS}, s AS (SELECT subject_id, x_price AS a, x_bal / 10.0 AS b, CAST(0.3 AS DOUBLE) AS c FROM cohort)
SELECT subject_id, round(greatest(a, b, c), 6) AS s1, round(greatest(b, c), 6) AS s2, round(c, 6) AS s3 FROM s""")
def e6_monotone(spark, sf_dir):
    """Running max from the right over an unordered array (x_price, x_bal / 10, 0.3)."""
    co = cohort_orders(spark, sf_dir).withColumn("arr", F.array(F.col("x_price"), F.col("x_bal") / 10.0, F.lit(0.3)))
    m = co.withColumn("m", monotone_survival(F.col("arr")))
    return m.select("subject_id", *[r6(F.element_at("m", i + 1)).alias(f"s{i + 1}") for i in range(3)])


@register("E5_aft_cdf", f"""WITH {COHORT_ORDERS},
st AS (SELECT avg(x_price) AS m, stddev_pop(x_price) AS s FROM cohort),
z AS (SELECT subject_id, (x_price - m) / s AS z FROM cohort, st)
SELECT subject_id, round(z, 6) AS z,
       round(0.5 + list_sum(list_transform(range(80), lambda n: (CASE WHEN n % 2 = 0 THEN 1.0 ELSE -1.0 END)
             * pow(z / sqrt(2.0), 2 * n + 1) / (gamma(n + 1) * (2 * n + 1)))) / sqrt(pi()), 6) AS normal,
       round(1.0 / (1.0 + exp(-z)), 6) AS logistic, round(1.0 - exp(-exp(z)), 6) AS extreme FROM z""")
def e5_cdf(spark, sf_dir):
    """The three log-time distribution functions at every standardised order price; the SQL side sums
    the power series of the error function."""
    co = cohort_orders(spark, sf_dir)
    st = co.agg(F.avg("x_price").alias("m"), F.stddev_pop("x_price").alias("s"))
    z = co.crossJoin(F.broadcast(st)).select("subject_id", ((F.col("x_price") - F.col("m")) / F.col("s")).alias("z"))
    return z.select("subject_id", r6("z").alias("z"), *[r6(aft_cdf(F.col("z"), d)).alias(d) for d in ("normal", "logistic", "extreme")])


@register("S9_exclusions", """
SELECT count(*) AS n_lines, CAST(sum(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_order,
       CAST(sum(CASE WHEN l_shipdate <= o_orderdate THEN 1 ELSE 0 END) AS BIGINT) AS shipped_before,
       CAST(sum(CASE WHEN l_shipdate <= o_orderdate AND l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned_before
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def s9_exclusions(spark, sf_dir):
    """Lines that the line and order cohorts leave out: those of no order, and those shipped on or before
    the order date (a returned one among them does not count as the order's event)."""
    return cohort_exclusions(spark, sf_dir)
