import __spark_entry__ as entry


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs_on_smallest_data(spark):
    df = entry.entry(spark)
    assert df.columns == ["Source", "Target", "Type", "Weight"]
    assert df.count() >= 0
