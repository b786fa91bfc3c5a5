"""Row numbers by range partitions against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from finlens.operators.positions import number_rows


@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
def test_numbers_within_groups(spark, hot):
    r = random.Random(4)
    rows = [(r.choice(["b", "a", None, ""]) if r.random() >= hot else "hot", r.choice([None, r.randrange(500)]), i) for i in range(1500)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(5)
    out = number_rows(df, ["v", "id"], by=["g"], name="pos", count="n", ordinal="no", parts=7).collect()
    groups = sorted({x[0] for x in rows}, key=lambda g: (g is not None, g or ""))
    want = []
    for k, g in enumerate(groups):
        own = sorted((x for x in rows if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        want += [(*x, p, len(own), k) for p, x in enumerate(own)]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))


def test_numbers_of_a_whole_table(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1009).alias("x"))
    out = number_rows(df, [F.desc("x")], name="pos", count="n", parts=6).orderBy("pos").collect()
    assert [x.pos for x in out] == list(range(1000)) and all(x.n == 1000 for x in out)
    assert [x.x for x in out] == sorted((x.x for x in out), reverse=True)
    assert number_rows(df.where("false"), ["x"]).count() == 0 and number_rows(df.where("false"), ["x"], by=["x"], name="p").count() == 0
