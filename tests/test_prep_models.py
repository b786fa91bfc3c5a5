import itertools
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from finlens.operators import explain as xp
from finlens.operators import models as md
from finlens.operators import prep
from finlens.session import scratch_path
from finlens.spec import Spec

SPEC = Spec(key="id", target="y", category="cat", numeric=("a", "b"), ratios=(("r", "a", "b"),), logs=(("la", "a"),))


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, float(i % 7) if i % 5 else None, float((i * 3) % 11), ["p", "q", "q", "r"][i % 4] if i % 9 else None,
             float(i % 7) * 2 + (i * 3) % 11 * 0.5 + 1.0) for i in range(200)]
    return spark.createDataFrame(rows, "id long, a double, b double, cat string, y double")


def test_imputer_scaler_mode(spark, frame):
    pdf = frame.toPandas()
    m = prep.ExactMedianImputer(inputCols=["a"], outputCols=["a_i"]).fit(frame)
    assert m.getOrDefault("surrogates") == [pdf["a"].median()]
    const = spark.createDataFrame([(1.0,), (1.0,), (3.0,)], "v double")
    s = prep.ExactRobustScaler(inputCols=["v"], outputCols=["s"]).fit(const)
    assert s.getOrDefault("scales") == [1.0]  # zero IQR -> divide by 1
    assert [r.s for r in s.transform(const).collect()] == [0.0, 0.0, 2.0]
    tie = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert prep.ModeImputer(inputCol="c", outputCol="c").fit(tie).getOrDefault("fill") == "a"


def test_pipeline_unknown_category_and_persistence(spark, frame):
    pm = prep.build_prep_pipeline(SPEC).fit(frame)
    out = pm.transform(frame)
    names = prep.feature_names(out, spec=SPEC)
    assert names == ["a", "b", "cat=p", "cat=q", "cat=r"]
    unk = spark.createDataFrame([(999, 1.0, 1.0, "zzz", 0.0)], frame.schema)
    v = pm.transform(unk).select(vector_to_array("features").alias("v")).first().v
    assert v[2:] == [0.0, 0.0, 0.0]
    p = scratch_path(spark, "test-prep-model")
    pm.write().overwrite().save(p)
    again = PipelineModel.load(p).transform(frame).select("features").collect()
    assert again == out.select("features").collect()
    with_derived = prep.build_prep_pipeline(SPEC, use_derived=True).fit(frame)
    assert prep.feature_names(with_derived.transform(frame), spec=SPEC)[:4] == ["a", "b", "r", "la"]


def test_ols_matches_lstsq(spark, frame):
    df = frame.where("a is not null")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                             md.make_regressor("LinearRegression", label_col="y")]).fit(df)
    pdf = df.toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf["a"], pdf["b"]])
    beta = np.linalg.lstsq(X, pdf["y"], rcond=None)[0]
    lr = model.stages[-1]
    assert np.allclose([lr.intercept, *lr.coefficients], beta, atol=1e-8)


def test_voting_is_weighted_mean_and_persists(spark, frame):
    df = frame.where("a is not null")
    asm = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    members = [LinearRegression(labelCol="y", solver="normal"), GBTRegressor(labelCol="y", maxIter=3, seed=1)]
    vote = md.VotingRegressor(members=members, weights=[0.25, 0.75], labelCol="y")
    pm = Pipeline(stages=[asm, vote]).fit(df)
    v = pm.stages[-1]
    p0 = v.members[0].transform(asm.transform(df)).select("__vote0").collect()
    p1 = v.members[1].transform(asm.transform(df)).select("__vote1").collect()
    got = pm.transform(df).select("prediction").collect()
    for a, b, g in zip(p0, p1, got):
        assert abs(g[0] - (0.25 * a[0] + 0.75 * b[0])) < 1e-9
    path = scratch_path(spark, "test-vote")
    pm.write().overwrite().save(path)
    assert PipelineModel.load(path).transform(df).select("prediction").collect() == got


def test_seeded_draws_and_mapping():
    a, b = md.draw_params("XGBoost", 10), md.draw_params("XGBoost", 10)
    assert a == b and len(a) == 10
    for d in a:
        assert 50 <= d["n_estimators"] <= 300 and 0.5 <= d["subsample"] <= 1.0
    assert md.boost_params("LightGBM").num_leaves == 31 and md.boost_params("LightGBM").max_depth < 1
    assert md.boost_params("XGBoost", {"subsample": 0.8}).subsample == 0.8
    assert md.gbt_params("GradientBoosting", {"min_samples_split": 7})["minInstancesPerNode"] == 4
    assert md.draw_params("LinearRegression") == []


def _brute_shap(f, x, B):
    d = len(x)
    phi = np.zeros(d)
    for b in B:
        for i in range(d):
            others = [j for j in range(d) if j != i]
            for k in range(len(others) + 1):
                for S in itertools.combinations(others, k):
                    w = math.factorial(len(S)) * math.factorial(d - len(S) - 1) / math.factorial(d)
                    z1, z0 = b.copy(), b.copy()
                    z1[list(S) + [i]] = x[list(S) + [i]]
                    z0[list(S)] = x[list(S)]
                    phi[i] += w * (f(z1[None])[0] - f(z0[None])[0])
    return phi / len(B)


def test_tree_shap_exact_and_additive(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(rng.normal()), float(rng.normal()), float(rng.integers(0, 2))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    df = df.withColumn("y", F.col("a") * 2 + F.col("b") * F.col("c"))
    pm = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"),
                          GBTRegressor(labelCol="y", maxIter=4, maxDepth=3, seed=1)]).fit(df)
    gbt = pm.stages[-1]
    leaves = [xp._leaves(t) for t in xp._tree_tables(gbt, spark)]
    X = np.array([[r.a, r.b, r.c] for r in df.limit(5).collect()])
    B = np.array([[r.a, r.b, r.c] for r in df.orderBy("id").limit(12).collect()])
    f = lambda Z: xp.tree_predict(Z, leaves, gbt.treeWeights)
    sp = pm.transform(df.limit(5)).select("prediction").collect()
    assert np.allclose(f(X), [r[0] for r in sp], atol=1e-9)
    phi = xp.interventional_shap(X, B, leaves, gbt.treeWeights)
    for i in range(len(X)):
        assert np.allclose(phi[i], _brute_shap(f, X[i], B), atol=1e-9)
        assert abs(phi[i].sum() - (f(X[i:i + 1])[0] - f(B).mean())) < 1e-9
    att = xp.tree_attributions(pm, df, df.limit(20), key="id", background=30)
    s = att.groupBy("id").agg(F.sum("phi").alias("s"), F.first("base").alias("base")).toPandas().set_index("id")
    pred = pm.transform(df.limit(20)).select("id", "prediction").toPandas().set_index("id")["prediction"]
    assert np.allclose(s["s"] + s["base"], pred.loc[s.index], atol=1e-9)


def test_gradient_boosting_runs_on_as_many_partitions_as_its_rows_fill(spark, frame, monkeypatch):
    df = VectorAssembler(inputCols=["b"], outputCol="features").transform(frame).repartition(16, "id")
    seen, real = [], GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, d: seen.append((d.rdd.getNumPartitions(), d.count())) or real(self, d))
    few = {"n_estimators": 3}
    plain = GBTRegressor(seed=42, cacheNodeIds=True, checkpointInterval=10, labelCol="y", **md.gbt_params("GradientBoosting", few)).fit(df)
    want = {r.id: r.prediction for r in plain.transform(df).collect()}
    for rows in (md.FIT_ROWS, 50):
        monkeypatch.setattr(md, "FIT_ROWS", rows)
        model = md.make_regressor("GradientBoosting", few, label_col="y").fit(df)
        assert all(abs(r.prediction - want[r.id]) < 1e-9 for r in model.transform(df).collect())
    (before, _), (one, n), (some, m) = seen
    assert before == 16 and one == 1 and 1 < some <= 4 and n == m == 200


def test_linear_and_sampled_attribution_additivity(spark, frame):
    df = frame.where("a is not null")
    pm = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                          LinearRegression(labelCol="y", solver="normal")]).fit(df)
    att = xp.linear_attributions(pm, df, df, ["a", "b"], key="id")
    s = att.groupBy("id").agg(F.sum("phi").alias("s")).toPandas().set_index("id")["s"]
    pred = pm.transform(df).select("id", "prediction").toPandas().set_index("id")["prediction"]
    assert np.allclose(s + pred.mean(), pred.loc[s.index], atol=1e-8)
    sa = xp.sampled_attributions(pm, df, df.limit(10), ["a", "b"], key="id", background=20, permutations=6)
    g = sa.groupBy("id").agg(F.sum("phi").alias("s"), F.first("base").alias("base")).toPandas().set_index("id")
    assert np.allclose(g["s"] + g["base"], pred.loc[g.index], atol=1e-8)
    # for a linear model every permutation gives the exact value coef * (x - b)
    ins = xp.insights(att, top=1).first()
    assert ins.pos == 1 and ins.line.startswith("- ")


def test_one_pass_linear_cv_equals_refit_loop(spark, frame):
    from pyspark.ml.feature import SQLTransformer

    from finlens.operators import evaluate as ev
    from finlens.operators import split as sp
    df = sp.with_folds(frame.where("a is not null"), "id", k=4)
    fast = ev.cv_metrics(Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                                          LinearRegression(labelCol="y", solver="normal")]), df, "y", k=4)
    slow = ev.cv_metrics(Pipeline(stages=[SQLTransformer(statement="SELECT * FROM __THIS__"),
                                          VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                                          LinearRegression(labelCol="y", solver="normal")]), df, "y", k=4)
    for m in ("r2", "mae", "rmse"):
        assert abs(fast[m] - slow[m]) < 1e-9


def test_tree_attributions_are_of_the_whole_family_model(spark, monkeypatch):
    import __spark_entry__  # noqa: F401 — registers in the order that the modules need
    from finlens.plans import queries_model as qm

    class Asked(Exception):
        pass

    def ask(name, params, *_, **__):
        raise Asked(md.gbt_params(name, params))
    monkeypatch.setattr(qm.md, "train_model", ask)
    with pytest.raises(Asked) as asked:
        qm.q_tree_attrib(spark, "/root/testdata/sf0.001")
    assert asked.value.args[0] == md.gbt_params("GradientBoosting") and asked.value.args[0]["maxIter"] == 100
