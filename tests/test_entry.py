import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "category" in df.columns and "target_median" in df.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


def test_some_queries_run_small(spark):
    q = E.queries()
    for name in ("clean", "spearman", "box_by_group", "split", "prepared", "comparison", "json_records"):
        assert q[name](spark, "/root/testdata/sf0.001").count() > 0, name
