import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 4 and set(df.columns) == {"pool", "gini"}


def test_registry_consistent():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q)
