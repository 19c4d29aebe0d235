"""The driver contract: every query has a name from the inventory, the
flagship runs on sf0.001, and every oracle has a query."""

import __spark_entry__ as E


def test_keys():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) > 150
    assert set(o) <= set(q)


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 10 and all(r["count"] > 0 for r in rows)
