import math

from pyspark.sql import functions as F

from finlens.functions import exprs as X


def test_clip_and_ratio_keep_missing(spark):
    df = spark.createDataFrame([(-2.0, 0.0), (None, 5.0), (3.0, None), (4.0, -1.0)], "a double, b double")
    r = df.select(X.clip_lower("a").alias("c"), X.guarded_ratio("a", "b").alias("r"),
                  X.log_feature("a").alias("l")).collect()
    assert [x.c for x in r] == [0.0, None, 3.0, 4.0]
    assert r[0].r == -2.0 / 1e-6 and r[1].r is None and r[2].r is None and r[3].r == 4.0 / 1e-6
    assert r[0].l == 0.0 and r[1].l is None and math.isclose(r[2].l, math.log1p(3.0))


def test_round_half_away_matches_c_round(spark):
    vals = [263656.035, 0.125, -0.125, 2.5, -2.5, 1.005, 123.4549999]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(X.round_half_away("v", 2)).collect()]
    want = [math.copysign(math.floor(abs(v) * 100 + 0.5), v) / 100 for v in vals]
    # C round on the binary value: 263656.035 is stored as ...03499 -> .03
    assert got[0] == 263656.03 and got[1] == 0.13 and got[2] == -0.13
    assert got == want


def test_pct_error_slug_find(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, 0.0)], "p double, a double")
    assert [r[0] for r in df.select(X.pct_error("p", "a")).collect()] == [10.000000000000002, 0.0] or \
        [round(r[0], 9) for r in df.select(X.pct_error("p", "a")).collect()] == [10.0, 0.0]
    assert X.slug_str("Price/Sales Ratio") == "price_sales_ratio"
    s = spark.createDataFrame([("Price/Book",)], "x string").select(X.slug("x")).first()[0]
    assert s == "price_book"
    cols = ["Model", "R^2 (log CV)", "R^2 (real)", "MAE (real)"]
    assert X.find_column(cols, "r^2", "real") == "R^2 (real)"
    assert X.find_column(["a", "MAE (real)"], "r^2", "real", fallback_needles=("real",)) == "MAE (real)"
    assert X.find_column(["a"], "zzz") is None


def test_hash_bucket_is_key_only(spark):
    df = spark.range(1000).repartition(7)
    a = {r.id: r.b for r in df.select("id", X.hash_bucket("id", "42", 100).alias("b")).collect()}
    b = {r.id: r.b for r in spark.range(1000).select("id", X.hash_bucket("id", "42", 100).alias("b")).collect()}
    assert a == b and all(0 <= v < 100 for v in a.values())
