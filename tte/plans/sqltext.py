"""SQL text shared by the oracle queries: the cohorts of FIXTURES.md and small generators.

Everything here is plain DuckDB SQL over the pre-registered test tables.
"""

from __future__ import annotations

COHORT_ORDERS = """
cohort AS (
  WITH e AS (SELECT max(l_shipdate) AS study_end FROM lineitem),
       f AS (SELECT o_orderkey, min(l_shipdate) AS first_ship
             FROM orders JOIN lineitem
               ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate AND l_returnflag = 'R'
             GROUP BY 1)
  SELECT o.o_orderkey AS subject_id,
         CAST(date_diff('day', o.o_orderdate, coalesce(first_ship, study_end)) AS DOUBLE) AS time,
         CAST(first_ship IS NOT NULL AS INT) AS event,
         o_totalprice / 100000.0 AS x_price, c_acctbal / 1000.0 AS x_bal,
         c_mktsegment, o_orderpriority
  FROM orders o CROSS JOIN e
  LEFT JOIN f USING (o_orderkey)
  LEFT JOIN customer ON c_custkey = o_custkey
)"""

COHORT_LINES = """
cohort AS (
  SELECT l_orderkey AS subject_id, l_linenumber,
         CAST(date_diff('day', o_orderdate, l_shipdate) AS DOUBLE) AS time,
         CAST(l_returnflag = 'R' AS INT) AS event,
         o_totalprice / 100000.0 AS x_price, c_acctbal / 1000.0 AS x_bal, c_mktsegment
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate
  LEFT JOIN customer ON c_custkey = o_custkey
)"""

COHORT_EPISODES = """
cohort AS (
  WITH s AS (
    SELECT event_id, user_id, value, ts,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts
    FROM events WHERE event_type = 'signup'),
  e AS (SELECT max(ts) AS study_end FROM events),
  p AS (
    SELECT s.event_id, min(pu.ts) AS p_ts
    FROM s CROSS JOIN e JOIN events pu
      ON pu.user_id = s.user_id AND pu.event_type = 'purchase' AND pu.ts > s.ts
     AND pu.ts <= coalesce(s.next_ts, e.study_end)
    GROUP BY 1)
  SELECT s.event_id AS subject_id, s.user_id,
         date_diff('second', s.ts, coalesce(p.p_ts, s.next_ts, e.study_end)) / 3600.0 AS time,
         CAST(p.p_ts IS NOT NULL AS INT) AS event,
         s.value AS x1, s.ts AS start_ts
  FROM s CROSS JOIN e LEFT JOIN p USING (event_id)
)"""

# fixed values of the stand-in risk (FIXTURES.md), as SQL
RISK = "(0.4 * x_price - 0.1 * x_bal)"


def surv_at(h: float, risk: str = RISK) -> str:
    return f"exp(-exp({risk} - 1.5) * {float(h)} / 1000.0)"


def horizons_values(hs) -> str:
    return "(VALUES " + ", ".join(f"(CAST({float(h)} AS DOUBLE))" for h in hs) + ") AS hz(horizon)"


def km_ctes(src: str = "cohort", by: str = "", name: str = "km") -> str:
    """CTEs ``{name}_rt`` and ``{name}``: risk table and KM survival / censoring (ties='all')."""
    part = f"PARTITION BY {by}" if by else ""
    bycols = f"{by}, " if by else ""
    return f"""
{name}_rt AS (
  SELECT {bycols}time, CAST(sum(event) AS BIGINT) AS d, CAST(sum(1 - event) AS BIGINT) AS c
  FROM {src} WHERE time IS NOT NULL AND event IS NOT NULL GROUP BY {bycols}time),
{name}_n AS (
  SELECT {bycols}time, d, c,
         CAST(sum(d + c) OVER ({part} ORDER BY time DESC) AS BIGINT) AS n_at_risk
  FROM {name}_rt),
{name} AS (
  SELECT {bycols}time, n_at_risk, d, c,
    CASE WHEN sum(CASE WHEN d >= n_at_risk THEN 1 ELSE 0 END) OVER ({part} ORDER BY time) > 0 THEN 0.0
         ELSE exp(sum(CASE WHEN d < n_at_risk THEN ln(1 - d / n_at_risk) ELSE 0 END) OVER ({part} ORDER BY time)) END AS surv,
    CASE WHEN sum(CASE WHEN c >= n_at_risk THEN 1 ELSE 0 END) OVER ({part} ORDER BY time) > 0 THEN 0.0
         ELSE exp(sum(CASE WHEN c < n_at_risk THEN ln(1 - c / n_at_risk) ELSE 0 END) OVER ({part} ORDER BY time)) END AS cens,
    CASE WHEN sum(CASE WHEN n_at_risk - d > 0 AND c >= n_at_risk - d THEN 1 ELSE 0 END) OVER ({part} ORDER BY time) > 0 THEN 0.0
         ELSE exp(sum(CASE WHEN n_at_risk - d > 0 AND c < n_at_risk - d THEN ln(1 - c / (n_at_risk - d)) ELSE 0 END)
                  OVER ({part} ORDER BY time)) END AS cens_ef
  FROM {name}_n)"""


def step_at(curve: str, value: str, horizon_expr: str, by_match: str = "") -> str:
    """Scalar subquery: step value of ``curve`` at ``horizon_expr`` (1.0 before the first time)."""
    cond = f" AND {by_match}" if by_match else ""
    return (f"coalesce((SELECT {value} FROM {curve} k WHERE k.time <= {horizon_expr}{cond} "
            f"ORDER BY k.time DESC LIMIT 1), 1.0)")


def linear_at(curve: str, value: str, x: str) -> str:
    """Scalar expression: the reference's linear read of ``curve`` at ``x``, clipped to [1e-8, 1]."""
    lo_t = f"(SELECT max(time) FROM {curve} WHERE time <= {x})"
    lo_v = f"(SELECT {value} FROM {curve} WHERE time <= {x} ORDER BY time DESC LIMIT 1)"
    hi_t = f"(SELECT min(time) FROM {curve} WHERE time >= {x})"
    hi_v = f"(SELECT {value} FROM {curve} WHERE time >= {x} ORDER BY time LIMIT 1)"
    v = (f"CASE WHEN {lo_t} IS NULL THEN 1.0 WHEN {hi_t} IS NULL THEN {lo_v} "
         f"WHEN {hi_t} = {lo_t} THEN {lo_v} "
         f"ELSE {lo_v} + ({hi_v} - {lo_v}) * ({x} - {lo_t}) / ({hi_t} - {lo_t}) END")
    return f"least(greatest({v}, 1e-8), 1.0)"

QUALITY_FRAME = """
qf AS (
  SELECT l_orderkey, l_linenumber, l_quantity,
         CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
         l_linestatus,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_discount END AS l_discount
  FROM lineitem)"""

QF_NUMERIC = ("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
QF_TEXT = ("l_returnflag", "l_linestatus")
QF_DTYPES = {"l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_returnflag": "string",
             "l_linestatus": "string", "l_discount": "double"}
QF_COLUMNS = ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_discount")

DRIFT_FRAME = """
df AS (
  SELECT CASE WHEN o_orderdate < TIMESTAMP '1995-06-01' THEN 'base' ELSE 'current' END AS period,
         o_totalprice, c_acctbal, o_orderstatus, o_orderpriority, c_mktsegment
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""


def draws_cte(seed: int, reps: int, cohort: str = "cohort", index: bool = False) -> str:
    """CTE ``draws(subject_id, rep, bw)``: the Poisson weights of ``tte.operators.replicates``, recomputed; ``index``: the
    hashes ``u`` instead."""
    from tte.operators.replicates import CUTS, PRIME, coefficients

    polynomials = ", ".join(f"({r}, {a}, {b}, {c}, {d})" for r, (a, b, c, d) in enumerate(coefficients(seed, reps)))
    return f"""
draws AS (
  SELECT subject_id, rep, {"u" if index else f"CAST(len(list_filter({CUTS}, lambda q: q < u)) AS DOUBLE) AS bw"} FROM (
    SELECT subject_id, rep, (((((a * x + b) % {PRIME}) * x + c) % {PRIME}) * x + d) % {PRIME} AS u FROM (
      SELECT subject_id, CAST('0x' || substr(md5(coalesce(CAST(subject_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {PRIME} AS x FROM {cohort})
    CROSS JOIN (SELECT rep, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, CAST(c AS BIGINT) AS c, CAST(d AS BIGINT) AS d
                FROM (VALUES {polynomials}) t(rep, a, b, c, d))))"""
