"""The toxicity cut-off: texts without any feature stay, whatever the share of toxic labels; the gradient against finite
differences."""

import random

import numpy as np
import pytest
from corpus_pipeline import run
from pyspark.sql import functions as F

from finlens.llm.toxicity import Model, OrdinalToxicity, _cut

WORDS = [f"w{i}" for i in range(300)]


def corpus(share, n, seed):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = r.random() < share
        words = [r.choice(WORDS) for _ in range(r.randrange(20, 60))]
        if toxic:
            for _ in range(r.randrange(2, 6)):
                words.insert(r.randrange(len(words)), r.choice(["vilething", "nastyword", "hatefulthing"]))
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.mark.parametrize(("share", "n"), [(0.05, 600), (0.5, 300), (0.95, 400), (0.1, 60)])
def test_texts_without_features_are_never_toxic(spark, stored_docs, share, n):
    rows, labels = corpus(share, n, n)
    blank = [(10000, None, None, None, None), (10001, "", None, None, None), (10002, "unseen words only", None, None, None), (10003, "!!", None, None, None)]
    docs = stored_docs(rows + blank)
    engine = OrdinalToxicity()
    model = engine.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert model.cut > model.featureless
    out = {x.doc_id: x for x in engine.predict(docs, model).collect()}
    assert not any(out[i].toxic for i, *_ in blank)
    right = [out[i].toxic == bool(t) for i, _, t in labels]
    assert np.mean(right) > 0.97 or n == 60
    assert np.mean([not out[i].toxic for i, _, t in labels if not t]) > 0.98


def test_labels_of_one_side_or_none_call_nothing_toxic(spark, stored_docs):
    rows, _ = corpus(0.3, 50, 1)
    docs = stored_docs(rows)
    for values in ([], [(i, 0) for i in range(50)], [(i, 1) for i in range(50)]):
        model = OrdinalToxicity().fit(docs, spark.createDataFrame(values, "doc_id long, toxic int"))
        assert OrdinalToxicity().predict(docs, model).where("toxic").count() == 0


def test_cut_has_the_fewest_weighted_errors():
    scores, toxic = np.array([0.01, 0.02, 0.3, 0.6, 0.7, 0.9]), np.array([False, False, False, True, False, True])
    share = 0.2
    cost = lambda c: share * (scores[toxic] < c).mean() + (1 - share) * (scores[~toxic] >= c).mean()
    assert cost(_cut(scores, toxic, share)) == min(cost(k / 20) for k in range(1, 20))
    assert _cut(scores, np.zeros(6, bool), 0.1) == _cut(scores, np.ones(6, bool), 0.1) == 0.5
    assert Model(np.zeros(0), np.zeros(0), np.zeros((2, 0)), np.array([0.0])).featureless == 0.5


def test_ordinal_fit_reaches_a_stationary_point():
    """At the fitted weights finite differences of the penalised weighted likelihood are near 0, and the likelihood is that of
    a plain loop."""
    rng = np.random.default_rng(5)
    n, f = 200, 4
    dense = rng.integers(0, 3, (n, f)).astype(float)
    y = np.clip(np.round(dense @ np.array([0.9, -0.4, 0.5, 0.0]) + rng.normal(0, 0.8, n)), 0, 2).astype(int)
    row, col = np.nonzero(dense)
    engine = OrdinalToxicity(penalty=0.05, rounds=6000)
    weights, cuts = engine._ordinal((row, col, dense[row, col]), f, y)

    def loss(w, c):
        total = 0.0
        for i in range(n):
            z = [-np.inf, *(c - dense[i] @ w), np.inf]
            cdf = [0.0 if v == -np.inf else 1.0 if v == np.inf else 1 / (1 + np.exp(-v)) for v in z]
            weight = ((y > 0).sum() if y[i] == 0 else (y == 0).sum()) / n
            total -= weight * np.log(cdf[y[i] + 1] - cdf[y[i]])
        return total / n + 0.05 / 2 * (w**2).sum()
    w = weights.reshape(-1)
    for k in range(f + len(cuts)):
        step = np.zeros(f + len(cuts))
        step[k] = 1e-4
        slope = (loss(w + step[:f], cuts + step[f:]) - loss(w - step[:f], cuts - step[f:])) / 2e-4
        assert abs(slope) < 5e-3, (k, slope)


def test_pipeline_keeps_rows_on_the_given_tables(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    n = docs.count()
    kept = run(spark, d)
    assert 0.3 * n < kept.count() < n and kept.where(F.col("n_tokens") > 0).count() > 0.3 * n
