import __spark_entry__ as entry


def test_entry_and_registry(spark):
    found = entry.entry(spark)
    assert found.columns == ["query", "doc", "score", "rank"] and found.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 60
