"""The driver contract: entry() runs, every query has a name-matched oracle."""

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["period", "n_entries", "n_lots", "n_results"]


def test_queries_have_oracles():
    from tenderlake.plans import catalog

    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and set(catalog.queries()) == set(catalog.oracle_sql())
    assert len(q) >= 40
