"""Driver contract: entry runs, every query key is unique and named by an inventory ID."""

import re

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 15 and set(df.columns) == {"c_mktsegment", "horizon", "surv"}
    assert all(0.0 <= r.surv <= 1.0 for r in rows)


def test_registry_shape():
    q, s = entry.queries(), entry.oracle_sql()
    assert len(q) >= 100 and set(s) <= set(q)
    for name in q:
        assert re.match(r"^([A-Z][0-9]+_|op[0-9]+_|pipeline$)", name), name
