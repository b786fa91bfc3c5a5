"""Input off the happy path: constant and NaN columns, reordered and quoted CSV, wrong JSON types, missing features,
rejected records."""

import math
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from finlens.operators import charts as ch
from finlens.operators import evaluate as ev
from finlens.operators import profile as pf
from finlens.operators import ranks
from finlens.operators.split import test_flag as flag
from finlens.plans import eda
from finlens.sources import files
from finlens.sources.records import parse_records
from finlens.spec import ACCOUNTS
from finlens.streaming.score import rejects


@pytest.fixture(scope="module")
def flat(spark):
    rows = [(i, float(i), 7.0, float(i * i % 11), math.nan if i % 5 == 0 else float(i % 3)) for i in range(40)]
    return spark.createDataFrame(rows, "id long, x double, same double, y double, gaps double")


def test_constant_column_has_no_correlation(flat):
    for fn in (pf.pearson, pf.spearman):
        got = {(r.a, r.b): r.r for r in fn(flat, ["x", "same", "y"]).collect()}
        want = flat.toPandas()[["x", "same", "y"]].corr(method=fn.__name__)
        for (a, b), r in got.items():
            assert (r is None) == math.isnan(want.loc[a, b]) and (r is None or abs(r - want.loc[a, b]) < 1e-9)
    assert {r.feature: r.r for r in pf.feature_check(flat, "same", [("q", "x", "y")]).collect()} == {"q": None}


def test_constant_column_in_charts_and_metrics(flat):
    hist = ch.histogram(flat, ["x", "same"], 5)
    stats = flat.agg(F.count("x").alias("n"), F.stddev("x").alias("sx"), F.stddev("same").alias("ss")).selectExpr(
        "inline(array(struct('x' AS column, n, sx AS std), struct('same' AS column, n, ss AS std)))")
    got = ch.binned_density(hist, stats).collect()
    assert all((r.density is None) == (r.column == "same") for r in got) and any(r.column == "x" for r in got)
    assert ev.regression_metrics(flat, "same", "x").first().r2 == 0.0 and ev.regression_metrics(flat, "same", "same").first().r2 == 1.0


def test_nan_is_missing(flat):
    p = flat.toPandas()["gaps"]
    assert {r.column: r["count"] for r in pf.missing_table(flat).collect()} == {"gaps": int(p.isna().sum())}
    d = {r.column: r for r in pf.describe(flat, ["gaps"]).collect()}["gaps"]
    assert (d["count"], d["mean"], d["q75"]) == (p.count(), p.mean(), p.quantile(0.75))


def test_eda_sections_fail_on_their_own(spark):
    rows = [(i, f"n{i}", "s" + str(i % 2), float(i), 1.0, float(i), 2.0, 3.0, 1.0, 2.0, float(i + 1)) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, name string, sector string, price double, ebitda double, eps double, pe double, volume double, low52 double, high52 double, target double")
    out = eda.profile(df, ACCOUNTS)
    assert {r.section for r in eda.summary(out).collect()} >= {"pearson", "spearman", "value_counts_all", "hist"}
    broken = eda.profile(df.withColumn("price", F.expr("if(id > 3, assert_true(false, 'bad'), null)").cast("string").cast("double")), ACCOUNTS)
    assert broken["errors"].count() > 0


def test_eda_shares_quartiles_and_correlations(spark, monkeypatch):
    r = random.Random(4)
    rows = [(i, f"n{i}", [None, "s0", "s1"][i % 3], *[None if r.random() < 0.1 else round(r.gauss(0, 2), 1) for _ in range(8)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, name string, sector string, price double, ebitda double, eps double, pe double, volume double, low52 double, high52 double, target double")
    num = [*ACCOUNTS.numeric, "target"]
    want = {"describe": pf.describe(df, num), "iqr_outliers": pf.iqr_outliers(df, num), "box_wide": ch.box_stats(df, num),
            "box_by_group": ch.box_stats(df, ["target"], by=("sector",)), "group_profile": pf.group_profile(df, "sector", "target", ACCOUNTS.clip_cols[1]),
            "target_corr": pf.target_corr(pf.pearson(df, num), "target")}
    want = {k: sorted(map(repr, d.collect())) for k, d in want.items()}
    asked, real = [], ranks.exact_quantiles
    monkeypatch.setattr(ranks, "exact_quantiles", lambda *a, **k: asked.append(1) or real(*a, **k))
    out = eda.profile(df, ACCOUNTS)
    assert set(want) <= set(out) and len(asked) == 2  # of all columns, and by category
    assert {k: sorted(map(repr, out[k].collect())) for k in want} == {k: want[k] for k in want}


def test_csv_binds_by_header_and_reads_doubled_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,extra,id,s\n1.5,e,7,"Foo ""Bar"" Inc"\nNaN,e,8,"a,b"\n')
    got = files.read_csv(spark, str(tmp_path / "a.csv"), spark.createDataFrame([], "id long, x double, s string").schema).collect()
    assert [tuple(r) for r in got] == [(7, 1.5, 'Foo "Bar" Inc'), (8, None, "a,b")]
    with pytest.raises(ValueError, match="no column y"):
        files.read_csv(spark, str(tmp_path / "a.csv"), spark.createDataFrame([], "id long, y double").schema)
    files.write_csv(spark.createDataFrame([(1, 'q "x" \\ y')], "id long, s string"), str(tmp_path / "out"))
    assert files.read_csv(spark, str(tmp_path / "out"), spark.createDataFrame([], "s string, id long").schema).first().s == 'q "x" \\ y'


def test_json_string_field_takes_no_number(spark):
    texts = ['{"sector": "IT", "52 Week Low": 1}', '{"sector": 5, "52 Week Low": "2"}', '{"sector": null, "52 Week Low": 1}', "{bad", '{"52 Week Low": "x", "sector": "a"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, value string")
    fields = {"sector": "string", "52 Week Low": "double"}
    got = {r.id: r.reason for r in parse_records(df, "value", fields, keep=["id"]).collect()}
    assert got == {0: None, 1: "type:sector", 2: "missing:sector", 3: "malformed", 4: "type:52 Week Low"}
    bad = {r.id: (r.record, r.reason) for r in rejects(df, fields, keep=["id"]).collect()}
    assert bad == {i: (texts[i], got[i]) for i in (1, 2, 3, 4)}


def test_cross_validation_raises_on_missing_features_and_is_centred(spark):
    rows = [(i, i % 5, 1e8 + (i * 7919 % 100) / 25, float(i * 7919 % 100) + (i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, fold int, x double, y_log double")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression(featuresCol="features", labelCol="y_log")])
    assert ev.cv_metrics(pipe, df)["r2"] > 0.98
    with pytest.raises(ValueError, match="missing feature"):
        ev.cv_metrics(pipe, df.withColumn("x", F.when(F.col("id") > 9, F.col("x"))))


def test_split_share_of_part_percent(spark):
    share = spark.range(40_000).agg(F.avg(flag("id", test_share=0.125).cast("double"))).first()[0]
    assert abs(share - 0.125) < 0.006
