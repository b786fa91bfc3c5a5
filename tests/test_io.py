import os

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from finlens.session import scratch_path
from finlens.sources import files, records, sinks
from finlens.streaming import score as sc

FIELDS = {"price": "double", "sector": "string"}


def test_records_reasons(spark):
    rows = [('{"price": 1.5, "sector": "A"}',), ('{bad',), ('{"price": "abc", "sector": "A"}',), ('{"sector": "A"}',),
            ('{"price": null, "sector": "A"}',), ('{"price": "12.5", "sector": "Unknown"}',), (None,)]
    p = records.parse_records(spark.createDataFrame(rows, "v string"), "v", FIELDS).collect()
    assert [(r.valid, r.reason) for r in p] == [
        (True, None), (False, "malformed"), (False, "type:price"), (False, "missing:price"), (False, "missing:price"),
        (True, None), (False, "malformed")]
    assert p[5].price == 12.5


def test_csv_tokens_bad_values_missing_file(spark):
    path = scratch_path(spark, "test-csv")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "a.csv"), "w") as fh:
        fh.write("id,x,s\n1,1.5,a\n2,NA,N/A\n3,oops,\n4,,null\n")
    sch = StructType([StructField("id", LongType()), StructField("x", DoubleType()), StructField("s", StringType())])
    got = [(r.id, r.x, r.s) for r in files.read_csv(spark, path, sch).orderBy("id").collect()]
    assert got == [(1, 1.5, "a"), (2, None, None), (3, None, None), (4, None, None)]
    bad = {r.column: r.bad_values for r in files.bad_values(files.read_csv_raw(spark, path, sch), sch).collect()}
    assert bad == {"id": 0, "x": 1}
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, path + "-nope", sch)


def test_stream_equals_batch_and_model_roundtrip(spark):
    df = spark.createDataFrame([(i, float(i), "A", float(i) * 0.1 + 1) for i in range(1, 60)],
                               "id long, price double, sector string, y double")
    pm = Pipeline(stages=[VectorAssembler(inputCols=["price"], outputCol="features"),
                          LinearRegression(labelCol="y", solver="normal")]).fit(df)
    req = {"id": "long", **FIELDS}
    recs = records.to_records(df, ["id", "price", "sector"])
    batch = {r.id: r.predicted for r in sc.score(pm, recs, req).select("id", "predicted").collect()}
    src = scratch_path(spark, "test-stream-src")
    recs.write.mode("overwrite").text(src)
    out = sc.score_stream(spark, pm, src, scratch_path(spark, "test-stream-out"), scratch_path(spark, "test-stream-ck"),
                          req, ["id", "predicted"])
    assert {r.id: r.predicted for r in out.collect()} == batch
    base = scratch_path(spark, "test-models")
    sinks.save_model(pm, base, "Linear Regression")
    assert sinks.load_model(base, "linear regression") is not None
    assert sinks.load_model(base, "missing") is None
    with pytest.raises(FileNotFoundError):
        sinks.load_model(base, "missing", required=True)
    one = sc.predict_one(spark, pm, '{"price": 10, "sector": "Technology"}', FIELDS, "lr").first()
    assert one.model == "lr" and one.predicted > 0
