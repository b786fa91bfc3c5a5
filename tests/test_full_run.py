"""The run over all five families: a table with real times, the best model from disk, attributions that add up."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from finlens.operators import evaluate as ev
from finlens.operators import models as md
from finlens.operators import prep
from finlens.operators.search import Folds
from finlens.plans import full_run
from finlens.sources import sinks
from finlens.sources.tables import accounts
from finlens.spec import ACCOUNTS

SF = "/root/testdata/sf0.001"
SMALL = {"GradientBoosting": {"n_estimators": 2, "max_depth": 2}, "XGBoost": {"n_estimators": 3, "max_depth": 2},
         "LightGBM": {"n_estimators": 3, "num_leaves": 4}}


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    small = {k: {**v, **SMALL[k]} for k, v in md.DEFAULTS.items()}
    old, md.DEFAULTS = md.DEFAULTS, small  # the vote's members take the defaults
    try:
        out = str(tmp_path_factory.mktemp("run"))
        yield out, full_run.run(accounts(spark, SF), ACCOUNTS, out, tune=False, profile=False)
    finally:
        md.DEFAULTS = old


def test_five_families_with_real_times(result):
    out, res = result
    rows = {r["model"]: r for r in res.comparison.collect()}
    assert set(rows) == set(md.MODEL_NAMES) and [r["row_no"] for r in res.comparison.orderBy("row_no").collect()] == [0, 1, 2, 3, 4]
    assert all(r["train_time"] > 0 for r in rows.values())  # J3: joined to times that were measured
    assert rows["Ensemble"]["train_time"] > max(rows[m]["train_time"] for m in md.MEMBERS)
    assert all(r[x] is not None for r in rows.values() for x in ev.METRIC_COLS)


def test_best_model_is_read_back_and_explained(spark, result):
    out, res = result
    assert res.best == min(res.comparison.collect(), key=lambda r: (-r["r2_real"], r["train_time"], r["model"]))["model"]
    assert sinks.load_model(f"{out}/models", ev.serving_model_name(sinks.read_table(spark, f"{out}/comparison")), required=True) is not None
    mean = res.attributions.groupBy("feature").agg(F.avg(F.abs("phi"))).count()
    assert mean > 0 and res.insights.count() > 0 and res.worst.count() > 0
    assert set(res.report) == {"comparison", "best", "insights"}


def test_vote_is_the_mean_of_its_members(spark, result):
    _, res = result
    rows = accounts(spark, SF).dropDuplicates(["id"]).where("target IS NOT NULL").limit(20)
    got = {n: {r["id"]: r["prediction"] for r in res.models[n].transform(rows).select("id", "prediction").collect()} for n in (*md.MEMBERS, "Ensemble")}
    for key, p in got["Ensemble"].items():
        assert abs(p - sum(got[m][key] for m in md.MEMBERS) / 3) < 1e-9


def test_joint_cross_validation_equals_refitting_every_fold(spark, result):
    tr, _ = full_run.prepare(accounts(spark, SF), ACCOUNTS)
    pp = prep.build_prep_pipeline(ACCOUNTS)
    got = md.cross_validate(Folds(pp, tr), {"LinearRegression": {}})
    for name in got:
        want = ev.cv_metrics(Pipeline(stages=[*pp.getStages(), md.make_regressor(name)]), tr, k=ACCOUNTS.folds)
        assert all(abs(got[name][x] - want[x]) < 1e-6 for x in want), (name, got[name], want)


def test_equal_scores_go_to_the_faster_model(spark):
    one = lambda name, r2: spark.createDataFrame([(name, *[r2] * 9)], "model string, " + ", ".join(f"{x} double" for x in ev.METRIC_COLS))
    times = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 0.1)], "model string, train_time double")
    t = ev.comparison_table([one("a", 0.91231), one("b", 0.91234), one("c", 0.5), one("d", 0.4)], times)
    assert ev.best_model_name(t) == "b" and ev.serving_model_name(t) == "a"  # equal after rounding; serving takes the first row
    assert {r["model"]: r["train_time"] for r in t.collect()} == {"a": 3.0, "b": 1.0, "c": 0.1, "d": 0.0}
