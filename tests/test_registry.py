import __spark_entry__ as E


def test_registry_shape():
    qs, sql = E.queries(), E.oracle_sql()
    assert len(qs) >= 70
    assert set(sql) <= set(qs)
    assert all(callable(f) for f in qs.values())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["query_id", "rank", "doc_id", "filepath", "score", "total_hits", "status"]
