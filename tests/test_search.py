from pyspark.sql import functions as F

from finlens.operators import models as md
from finlens.operators import prep
from finlens.operators import split
from finlens.spec import Spec

SPEC = Spec(key="id", target="y", category="cat", numeric=("a", "b"))
SMALL = {"n_estimators": ("int", 2, 4), "learning_rate": ("float", 0.05, 0.3), "max_depth": ("int", 2, 3),
         "min_samples_split": ("int", 2, 6)}


def test_seeded_search_picks_best_and_is_reproducible(spark):
    rows = [(i, float(i % 13), float((i * 7) % 5), ["p", "q"][i % 2], float(i % 13) * 0.3 + (i * 7) % 5)
            for i in range(240)]
    df = spark.createDataFrame(rows, "id long, a double, b double, cat string, y double")
    df = split.with_folds(df, "id", k=3).withColumn("y_log", F.log1p("y")).cache()
    pp = prep.build_prep_pipeline(SPEC)
    best1, scores1 = md.search("GradientBoosting", pp, df, trials=3, space=SMALL, parallelism=3)
    best2, scores2 = md.search("GradientBoosting", pp, df, trials=3, space=SMALL, parallelism=3)
    draws = md.draw_params("GradientBoosting", 3, space=SMALL)
    assert len(scores1) == 3 and scores1 == scores2 and best1 == best2
    assert best1 == draws[max(range(3), key=lambda i: scores1[i])]
    # a failing search falls back to defaults
    assert md.search("GradientBoosting", pp, df.drop("fold"), trials=2, space=SMALL) == ({}, [])
    # the winner trains with its parameters
    model, secs = md.train_model("GradientBoosting", best1, pp, df)
    assert model.stages[-1].getNumTrees == best1["n_estimators"] and secs > 0
