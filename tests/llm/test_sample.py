from pyspark.sql import functions as F

from finlens.llm.classify import bounded_sample


def test_sample_is_bounded_and_the_same_in_every_order(spark):
    rows = spark.range(20000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), (F.col("id") % 11).alias("v"))
    few = rows.where("k <> 7")
    assert 300 < bounded_sample(few, 500, "k").count() <= 1000 and bounded_sample(few.limit(30), 500, "k").count() == 30
    got = [sorted(map(tuple, bounded_sample(rows.repartition(n, "v"), 500, "k").collect())) for n in (1, 5, 9)]
    assert got[0] == got[1] == got[2] and len(got[0]) <= 1000
    hot = spark.range(5000).select(F.lit(1).alias("k"), (F.col("id") % 11).alias("v"))
    for n in range(20):  # some key of one value is chosen
        a, b = (sorted(map(tuple, bounded_sample(hot.withColumn("k", F.lit(n)).repartition(m, "v"), 100, "k").collect())) for m in (2, 7))
        assert a == b and len(a) <= 200
