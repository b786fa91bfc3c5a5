import pytest

from finlens.operators import clean as cl
from finlens.operators import split
from finlens.spec import ACCOUNTS

SF_SMALL = "/root/testdata/sf0.001"


def test_dedupe_nulls_equal_and_clean(spark):
    df = spark.createDataFrame([(1, None, -5.0, 10.0), (1, None, -5.0, 10.0), (2, "a", 3.0, 0.0), (3, "b", None, None)],
                               "id long, sector string, eps double, price double")
    spec = ACCOUNTS.with_(clip_cols=("eps",))
    assert cl.drop_duplicates(df).count() == 3
    out = cl.clean(df, spec).collect()
    assert [(r.id, r.eps) for r in out] == [(1, 0.0)]
    rep = cl.clean_report(df, spec).first()
    assert (rep.rows_before, rep.rows_after) == (4, 1)


def test_add_missing_features_idempotent(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "price double, ebitda double, eps double, volume double")
    a = cl.add_missing_features(df, ACCOUNTS)
    assert set(ACCOUNTS.derived) <= set(a.columns)
    assert cl.add_missing_features(a, ACCOUNTS) is a
    with pytest.raises(KeyError):
        cl.add_missing_features(df.drop("volume"), ACCOUNTS)


def test_split_disjoint_complete_and_folds(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    tr, te = split.train_test_split(df, "k")
    a, b = {r.k for r in tr.collect()}, {r.k for r in te.collect()}
    assert not (a & b) and len(a | b) == 5000 and 0.17 < len(b) / 5000 < 0.23
    f = split.with_folds(df, "k").groupBy("fold").count().collect()
    assert sorted(r.fold for r in f) == [0, 1, 2, 3, 4]
    s1 = [r.k for r in split.bounded_sample(df.repartition(3), "k", 50).collect()]
    s2 = [r.k for r in split.bounded_sample(df, "k", 50).collect()]
    assert s1 == s2 and len(s1) == 50


def test_accounts_view_equals_its_sql(spark):
    from finlens.sources.tables import ACCOUNTS_SQL, accounts, load_table

    for t in ("customer", "orders"):
        load_table(spark, SF_SMALL, t).createOrReplaceTempView(t)
    df = accounts(spark, SF_SMALL)
    sql = spark.sql(ACCOUNTS_SQL)
    assert df.count() == sql.count()
    assert df.exceptAll(sql).isEmpty() and sql.exceptAll(df).isEmpty()
