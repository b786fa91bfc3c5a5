"""Shapiro-Wilk, type inference, the missing-value map and value counts on odd input."""

import pandas as pd
import pytest

from finlens.operators import charts, evaluate, prep, profile
from finlens.sources import files


def test_shapiro_wilk_known_values():
    # men's weights from the original paper's example
    w, p = profile.shapiro_wilk([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236])
    assert abs(w - 0.79) < 0.005 and abs(p - 0.0067) < 0.0005
    w, p = profile.shapiro_wilk([i for i in range(1, 21)])
    assert abs(w - 0.9604) < 0.002 and p > 0.5
    w, p = profile.shapiro_wilk([2.0**i for i in range(50)])
    assert w < 0.5 and p < 1e-9
    assert profile.shapiro_wilk([1.0, 2.0]) == profile.shapiro_wilk([4.0] * 30) == (None, None)
    w, p = profile.shapiro_wilk([0.0, 0.0, 1.0])
    assert abs(w - 0.75) < 1e-9 and p < 1e-6


def test_the_number_of_values_picks_the_test(spark):
    df = spark.range(6000).selectExpr("cast(id as double) as a", "case when id < 4999 then cast(id % 97 as double) end as b",
                                      "case when id < 2 then 1.0D end as c", "case when id < 100 then double('NaN') else null end as d")
    got = {r["column"]: r for r in profile.normality(df, ["a", "b", "c", "d"]).collect()}
    assert got["a"].test == "jarque-bera" and got["b"].test == "shapiro-wilk" and got["b"].n == 4999 and not got["b"].normal
    assert got["c"].n == 2 and got["d"].n == 0


@pytest.mark.parametrize("name", ["plain", "missing", "mixed"])
def test_inferred_types_are_those_of_pandas(spark, tmp_path, name):
    rows = {"plain": [("1", "1.5", "x", "True", "007", "1e3", "9223372036854775807"), ("-2", "2", "y", "False", "8", "-.5", "1")],
            "missing": [("1", "NA", "x", "True", "", "nan", "null"), ("", "2", "", "", "8", "inf", "NULL")],
            "mixed": [("1", "a", "1", "True", "1 2", "1.2.3", "12345678901234567890"), ("b", "2", "0x1", "x", "3", "4", "1")]}[name]
    path = tmp_path / "t.csv"
    path.write_text("i,f,s,b,z,e,l\n" + "\n".join(",".join(r) for r in rows) + "\n")
    kinds = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string", "str": "string", "uint64": "double"}
    want = {c: kinds[str(t)] for c, t in pd.read_csv(path).dtypes.items()}
    assert dict(files.read_csv_inferred(spark, str(path)).dtypes) == want
    with pytest.raises(FileNotFoundError):
        files.read_csv_inferred(spark, str(tmp_path / "none.csv"))


def test_map_and_counts_of_odd_tables(spark):
    df = spark.createDataFrame([(i, None if i >= 90 else 1.0, float("nan") if i < 10 else float(i)) for i in range(100)], "id int, a double, b double").repartition(7)
    got = {(r.bucket, r.column): (r.rows, r.missing) for r in charts.missing_map(df, ["id"], ["a", "b"], buckets=10).collect()}
    assert got[9, "a"] == (10, 10) and got[0, "b"] == (10, 10) and sum(m for _, m in got.values()) == 20
    assert charts.missing_map(df.where("false"), ["id"]).count() == 0
    few = charts.missing_map(df.limit(3), ["id"], ["a"], buckets=50).collect()
    assert sum(r.rows for r in few) == 3
    wide = profile.value_counts(df, "b").orderBy("pos").collect()
    assert [r.pos for r in wide] == list(range(1, 91)) and [r.value for r in wide] == [float(i) for i in range(10, 100)]
    assert profile.value_counts(df.where("false"), "b").count() == 0


def test_nan_is_missing_in_fits_and_metrics(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 1.0), (nan, 2.0), (3.0, nan), (2.0, 2.5), (9.0, 9.0)], "y double, p double")
    m = evaluate.regression_metrics(df, "y", "p").first()
    assert m.n == 3 and abs(m.mae - 0.5 / 3) < 1e-12
    model = prep.ExactMedianImputer(inputCols=["y"], outputCols=["y"]).fit(df)
    assert sorted(r.y for r in model.transform(df).collect()) == [1.0, 2.0, 2.5, 3.0, 9.0]
    same = spark.createDataFrame([(2.0, 2.0), (2.0, 2.5)], "y double, p double")
    row = same.agg(*[x.alias(f"q{x._jc.toString().split(' AS ')[-1]}") for x in evaluate.metric_aggs("y", "p")]).first().asDict()
    assert evaluate.regression_metrics(same, "y", "p").first().r2 == 0.0
    assert evaluate._finish({f"t_{k}": row[f"q{k}"] for k in ("n", "sse", "var_y", "mae", "mse")}, "t_")["r2"] == 0.0
