"""Histogram boosting, the sampler of the search, and the explainers over them, against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from finlens.operators import boosting as B
from finlens.operators import explain as xp
from finlens.operators import models as md
from finlens.operators import prep, search, split
from finlens.spec import Spec


def table(spark, n=400, seed=1, parts=3):
    r = random.Random(seed)
    rows = [(i, float(r.randrange(40)), round(r.gauss(0, 1), 2), float(r.random() < 0.3), i % 4) for i in range(n)]
    rows = [(*x, 0.3 * x[1] - 2 * x[2] * x[3] + math.sin(x[1]) + r.gauss(0, 0.1)) for x in rows]
    return spark.createDataFrame(rows, "id long, a double, b double, d double, fold int, y double").repartition(parts), rows


def plain_fit(rows, b: B.Boost, bins=B.BINS):
    """One tree after another by direct search over all values that are bin edges."""
    x = np.array([r[1:4] for r in rows])
    y = np.array([r[5] for r in rows])
    edges = [B._edges(x[:, f], bins) for f in range(3)]
    base = round(math.fsum(y) / len(y), 12)
    p = np.full(len(y), base)
    leaves_of = []
    for _ in range(b.n_estimators):
        g = p - y

        def best(at):
            out = (1e-12, None, None)
            for f, e in enumerate(edges):
                for v in e:
                    lo = at[x[at, f] <= v]
                    n, m = len(lo), len(at) - len(lo)
                    if min(n, m) < max(b.min_rows, 1):
                        continue
                    gl, gt = g[lo].sum(), g[at].sum()
                    gain = 0.5 * (gl**2 / (n + b.l2) + (gt - gl) ** 2 / (m + b.l2) - gt**2 / (len(at) + b.l2))
                    if gain > out[0] + 1e-9:
                        out = (gain, f, v)
            return out
        leaves = [(np.arange(len(y)), 0)]
        limit = b.num_leaves if b.num_leaves > 0 else 10**9
        while len(leaves) < limit:
            open_ = [(best(at), k) for k, (at, depth) in enumerate(leaves) if b.max_depth < 1 or depth < b.max_depth]
            open_ = [(gain, k, f, v) for (gain, f, v), k in open_ if f is not None]
            if not open_:
                break
            _, k, f, v = max(open_, key=lambda o: o[0])
            at, depth = leaves.pop(k)
            leaves += [(at[x[at, f] <= v], depth + 1), (at[x[at, f] > v], depth + 1)]
        for at, _ in leaves:
            p[at] += -b.learning_rate * g[at].sum() / (len(at) + b.l2)
        leaves_of.append(len(leaves))
    return p, leaves_of


@pytest.mark.parametrize("b", [B.Boost(n_estimators=4, max_depth=3, learning_rate=0.3), B.Boost(n_estimators=3, max_depth=0, num_leaves=9, l2=0.0, min_rows=20),
                               B.Boost(n_estimators=3, max_depth=3, num_leaves=7, l2=0.5, min_rows=5), B.Boost(n_estimators=2, max_depth=0, num_leaves=31, l2=0.0, min_rows=2)],
                         ids=["by level", "by leaf", "by leaf to a depth", "31 leaves"])
def test_trees_equal_a_direct_search(spark, b):
    df, rows = table(spark)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "d"], outputCol="features"), B.HistogramBooster(b, labelCol="y", keyCol="id")])
    model = pipe.fit(df)
    got = {r.id: r.prediction for r in model.transform(df).collect()}
    want, leaves = plain_fit(rows, b)
    assert [sum(f < 0 for f in t.feature) for t in model.stages[-1].ensemble.trees] == leaves
    assert b.num_leaves < 1 or max(leaves) == b.num_leaves or b.max_depth > 0
    assert max(abs(got[r[0]] - w) for r, w in zip(rows, want, strict=True)) < 1e-9


def test_model_does_not_depend_on_partitions_and_saves(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "PART_BYTES", 2000)  # several partitions, so sums go through a shuffle
    monkeypatch.setattr(B, "REFRESH", 2)
    b = B.Boost(n_estimators=5, max_depth=3, subsample=0.7)
    fits = []
    for parts in (1, 7):
        df, _ = table(spark, parts=parts)
        df = VectorAssembler(inputCols=["a", "b", "d"], outputCol="features").transform(df)
        fits.append(B.HistogramBooster(b, labelCol="y", keyCol="id").fit(df))
    monkeypatch.setattr(B, "PART_BYTES", 1 << 20)
    monkeypatch.setattr(B, "REFRESH", 10)
    fits.append(B.HistogramBooster(b, labelCol="y", keyCol="id").fit(df))
    assert len({m.getOrDefault("trees") for m in fits}) == 1 and fits[0].getNumTrees == 5
    pm = PipelineModel(stages=[fits[0]])
    pm.write().overwrite().save(str(tmp_path / "m"))
    a, c = (m.transform(df).select("id", "prediction").orderBy("id").collect() for m in (pm, PipelineModel.load(str(tmp_path / "m"))))
    assert a == c


def test_a_fit_plans_its_rows_once(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    df, _ = table(spark)
    data = B.bin_rows(df.withColumn("z", F.array("a", "b", "d")), ["z"], "y", key=F.col("id"))
    calls, real = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda self, *a, **k: calls.append(1) or real(self, *a, **k))
    fit = B.Fit(B.Boost(n_estimators=12, max_depth=0, num_leaves=6, min_rows=5))
    model = B.boost(data, [fit])[0]
    assert len(model.trees) == 12 and len(calls) == 1  # not once for each batch of nodes
    monkeypatch.setattr(B, "REFRESH", 3)  # predictions checkpointed in between
    assert B.dumps(B.boost(data, [fit])[0]) == B.dumps(model)


def test_fits_together_equal_fits_alone(spark):
    df, _ = table(spark)
    data = B.bin_rows(df.withColumn("z", F.array("a", "b", "d")), ["z"], "y", key=F.col("id"), fold="fold")
    fits = [B.Fit(B.Boost(n_estimators=n, max_depth=d, num_leaves=k, subsample=s), held=h)
            for n, d, k, s, h in ((3, 2, 0, 1.0, 0), (5, 0, 6, 0.5, 1), (2, 3, 0, 1.0, None), (0, 3, 0, 1.0, 2))]
    together = B.boost(data, fits)
    assert [B.dumps(m) for m in together] == [B.dumps(B.boost(data, [f])[0]) for f in fits]
    scores = B.held_out_scores(data, fits, together)
    assert [s["n"] for s in scores] == [100, 100, 0, 100] and scores[0]["r2"] > 0.2 and scores[3]["r2"] <= 0


def test_odd_input(spark):
    schema = "id long, a double, b double, y double"
    b = B.Boost(n_estimators=2, max_depth=2, min_rows=1)

    def fit(rows):
        df = VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="keep").transform(spark.createDataFrame(rows, schema))
        model = B.HistogramBooster(b, labelCol="y", keyCol="id").fit(df)
        return model, [r.prediction for r in model.transform(df).orderBy("id").collect()]
    nan = float("nan")
    model, p = fit([(i, nan if i % 3 == 0 else float(i % 3), 1.0, float(i % 3 == 0)) for i in range(60)] + [(99, 1.0, 1.0, None), (98, 1.0, 1.0, nan)])
    assert p[0] > p[1] == p[2]  # missing values go with the greatest
    assert set(fit([(i, float(i), 2.0, 7.0) for i in range(9)])[1]) == {7.0}       # a constant label
    assert fit([(1, 1.0, 1.0, 3.0)])[1] == [3.0] and fit([(1, 1.0, 1.0, None)])[1] == [0.0]
    assert fit([(1, 1.0, 2.0, 3.0)] * 50)[1] == [3.0] * 50                           # one repeated row
    assert fit([])[1] == []


def test_sampler_beats_random_draws():
    space = {"x": ("float", 0.0, 1.0), "n": ("int", 1, 100), "w": ("float", -5.0, 5.0)}
    f = lambda p: -(p["x"] - 0.73) ** 2 * 9 - ((p["n"] - 31) / 50) ** 2 - abs(p["w"] - 1.5) / 5
    wins, gap = 0, 0.0
    for seed in range(40):
        _, adaptive = search.run_trials(space, lambda asked: [f(p) for p in asked], 40, seed, batch=2)
        sampler = search.ParzenSampler(space, seed + 1000)
        drawn = max(f(sampler.draw()) for _ in range(40))
        wins += max(adaptive) > drawn
        gap += max(adaptive) - drawn
    assert wins >= 28 and gap > 0
    tried, _ = search.run_trials(space, lambda asked: [f(p) for p in asked], 30, 5)
    assert all(0 <= p["x"] <= 1 and 1 <= p["n"] <= 100 and isinstance(p["n"], int) and -5 <= p["w"] <= 5 for p in tried)
    assert tried == search.run_trials(space, lambda asked: [f(p) for p in asked], 30, 5)[0]
    assert search.run_trials({"k": ("int", 3, 3)}, lambda asked: [0.0] * len(asked), 7, 1)[0] == [{"k": 3}] * 7


SPEC = Spec(key="id", target="y", category="cat", numeric=("a", "b"))


@pytest.fixture(scope="module")
def folded(spark):
    rows = [(i, float(i % 13) if i % 17 else None, float((i * 7) % 5), ["p", "q", None][i % 3], float(i % 13) * 0.3 + (i * 7) % 5) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, a double, b double, cat string, y double")
    return split.with_folds(df, "id", k=3).withColumn("y_log", F.log1p("y")).cache()


def test_search_of_boosted_families_shares_prepared_folds(spark, folded, monkeypatch):
    monkeypatch.setattr(md, "DEFAULTS", {k: {**v, "n_estimators": 3} for k, v in md.DEFAULTS.items()})  # the ensemble's members
    pp = prep.build_prep_pipeline(SPEC)
    folds = search.Folds(pp, folded)
    space = {"n_estimators": ("int", 3, 8), "learning_rate": ("float", 0.05, 0.3), "max_depth": ("int", 2, 3), "num_leaves": ("int", 3, 8)}
    best, scores = md.search("LightGBM", pp, folded, trials=6, space=space, folds=folds)
    again = md.search("LightGBM", pp, folded, trials=6, space=space, folds=folds)
    assert folds.fitted == 3  # once for each fold, whatever the trials
    assert (best, scores) == again and len(scores) == 6 and max(scores) == scores[[*scores].index(max(scores))]
    # a trial's score is that of refitting preparation and model for each fold
    slow = []
    for k in range(3):
        pipe = Pipeline(stages=[*pp.getStages(), md.make_regressor("LightGBM", best)])
        held = pipe.fit(folded.where(F.col("fold") != k)).transform(folded.where(F.col("fold") == k))
        slow.append(search.regression_metrics(held, "y_log", "prediction").first()["r2"])
    assert abs(max(scores) - sum(slow) / 3) < 1e-9
    weights, scores = md.search("Ensemble", pp, folded, trials=5, folds=folds)
    assert len(scores) == 5 and set(weights) == {"w0", "w1", "w2"} and folds.fitted == 3


def test_weighted_r2_is_that_of_the_weighted_mean():
    rng = np.random.default_rng(1)
    y, p = rng.normal(size=50), rng.normal(size=(2, 50))
    r = {"n": 50, "s": y.sum(), "q": (y * y).sum(), "y0": (p[0] * y).sum(), "y1": (p[1] * y).sum(),
         "p0_0": (p[0] ** 2).sum(), "p0_1": (p[0] * p[1]).sum(), "p1_1": (p[1] ** 2).sum()}
    mean = (3 * p[0] + p[1]) / 4
    assert abs(search.weighted_r2([r], [0.9, 0.3]) - (1 - ((y - mean) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-12


def exact_shapley(f, x, background):
    d, out = len(x), np.zeros(len(x))
    value = lambda s: np.mean([f([x[j] if s >> j & 1 else b[j] for j in range(d)]) for b in background])
    for j in range(d):
        for s in range(1 << d):
            if not s >> j & 1:
                k = bin(s).count("1")
                out[j] += math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) * (value(s | 1 << j) - value(s))
    return out


def test_kernel_solver_is_exact_by_enumeration():
    rng = np.random.default_rng(3)
    for d in (2, 3, 5, 7):
        f = lambda z: z[0] * z[1] + max(z) - (z[-1] > 0.2) * z[0]
        x, bg = rng.normal(size=d), rng.normal(size=(4, d))
        masks, weights = xp.coalitions(d)
        assert len(masks) == 2**d - 2
        solver = xp.kernel_solver(masks, weights, d)
        v = np.array([np.mean([f([x[j] if m >> j & 1 else b[j] for j in range(d)]) for b in bg]) for m in masks])
        base, gain = np.mean([f(b) for b in bg]), 0.0
        gain = f(x) - base
        last = np.array([m >> (d - 1) & 1 for m in masks])
        phi = solver @ (v - base - last * gain)
        assert np.allclose([*phi, gain - phi.sum()], exact_shapley(f, x, bg))
    masks, weights = xp.coalitions(14, most=600)
    assert len(masks) == len(set(masks)) <= 601 and all(0 < m < (1 << 14) - 1 for m in masks)
    # a linear game is solved exactly whatever sets were drawn
    c = rng.normal(size=14)
    v = np.array([sum(c[j] for j in range(14) if m >> j & 1) for m in masks])
    last = np.array([m >> 13 & 1 for m in masks])
    assert np.allclose(xp.kernel_solver(masks, weights, 14) @ (v - last * c.sum()), c[:-1])


def test_kernel_and_tree_attributions_of_a_booster(spark):
    df, rows = table(spark, n=120)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "d"], outputCol="features"), B.HistogramBooster(B.Boost(n_estimators=6, max_depth=4), labelCol="y", keyCol="id")])
    model = pipe.fit(df)
    bg = [r[1:4] for r in sorted(rows, key=lambda r: hashlib.md5(f"s42|{r[0]}".encode()).hexdigest())[:20]]
    e = model.stages[-1].ensemble

    def f(z):
        out = e.base
        for t in e.trees:
            at = 0
            while t.feature[at] >= 0:
                at = t.left[at] if z[t.feature[at]] <= t.threshold[at] else t.right[at]
            out += t.value[at]
        return out
    few = df.where("id < 6")
    kernel, tree = {}, {}
    for r in xp.kernel_attributions(model, df, few, ["a", "b", "d"], background=20).collect():
        kernel[r.id, r.feature] = r.phi
    for r in xp.tree_attributions(model, df, few, background=20).collect():
        tree[r.id, r.feature] = r.phi
    for i in range(6):
        want = exact_shapley(f, rows[i][1:4], bg)
        for j, name in enumerate("abd"):
            assert abs(kernel[i, name] - want[j]) < 1e-9 and abs(tree[i, name] - want[j]) < 1e-9


def test_a_failing_explainer_gives_way_when_it_runs(spark, monkeypatch):
    df, _ = table(spark, n=80)
    spec = type("S", (), {"key": "id", "features": ("a", "b", "d"), "numeric": ("a", "b", "d"), "derived": (), "category": "none"})()  # no category column
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "d"], outputCol="features"), B.HistogramBooster(B.Boost(n_estimators=3), labelCol="y")]).fit(df)
    few = df.where("id < 5")
    assert xp.additivity_gap(xp.attributions(model, df, few, spec), model.transform(few)) < 1e-9
    real = xp.tree_attributions

    def broken(*a, **k):  # fails in the tasks, not when it is planned
        return real(*a, **k).withColumn("phi", F.raise_error(F.lit("no")).cast("double"))
    monkeypatch.setattr(xp, "tree_attributions", broken)
    out = xp.attributions(model, df, few, spec)
    assert out.count() == 15 and xp.additivity_gap(out, model.transform(few)) < 1e-9
    monkeypatch.setattr(xp, "tree_attributions", lambda *a, **k: real(*a, **k).withColumn("phi", F.col("phi") + 1))
    assert xp.additivity_gap(xp.attributions(model, df, few, spec), model.transform(few)) < 1e-9
