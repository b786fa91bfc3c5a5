"""Feature attributions and their reports.

* **linear** (X1): ``coef_j · (z_j − mean_background(z_j))`` — pure column
  arithmetic on the model's feature vector;
* **tree** (X2): interventional Shapley values of a tree ensemble with a
  background set (the published tree-explainer algorithm, Lundberg et al.
  2020).  For a leaf, an explained row ``x`` and a background row ``b`` the
  path's features split into *A* (only ``x`` follows the path), *B* (only ``b``
  does), both, or neither (leaf unreachable).  The leaf adds
  ``v · (|A|-1)!|B|!/(|A|+|B|)!`` to each feature in A and subtracts
  ``v · |A|!(|B|-1)!/(|A|+|B|)!`` from each in B.  Vectorised over pairs of path
  patterns per leaf with numpy inside ``mapInPandas`` — the
  explained rows are partitioned by Spark, the background (≤ ``background``
  rows) and the tree arrays are broadcast, both with a proven bound;
* **sampled** (X3): model-agnostic permutation Shapley as a DataFrame job —
  hybrid rows ``rows × permutations × (d+1)`` are scored by the fitted
  pipeline itself, marginals come from a ``lag`` over each bounded
  ``(row, permutation)`` window and are averaged per feature;
* **kernel** (X3): weighted least squares over coalitions with the Shapley
  kernel, the additivity constraint eliminated; exact by full enumeration for
  up to ten features.
"""

from __future__ import annotations

import itertools
import logging
import math
import os
import random
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlens.functions.exprs import c, inverse_target
from finlens.operators import split
from finlens.operators.boosting import HistogramBoosterModel
from finlens.operators.evaluate import bias_correction
from finlens.operators.prep import feature_names
from finlens.session import scratch_path, ship_library
from finlens.spec import Spec

LOG = logging.getLogger("finlens")


def _final_model(model: PipelineModel):
    return model.stages[-1]


def _features_col(model: PipelineModel) -> str:
    return _final_model(model).getFeaturesCol()


# -- X1 ------------------------------------------------------------------------------------------
def linear_attributions(model: PipelineModel, train: DataFrame, test: DataFrame, names: Sequence[str] | None = None,
                        key: str = "id", spec: Spec | None = None) -> DataFrame:
    """Long ``(key, feature, phi, value)`` for a pipeline ending in a linear model."""
    lr = _final_model(model)
    if not isinstance(lr, LinearRegressionModel):
        raise TypeError("linear attributions need a LinearRegressionModel as the last stage")
    fc = lr.getFeaturesCol()
    mean = model.transform(train).select(Summarizer.mean(F.col(fc)).alias("m")).first()["m"].toArray().tolist()
    coef = lr.coefficients.toArray().tolist()
    scored = model.transform(test)
    names = list(names) if names else feature_names(scored, fc, spec)
    arr = scored.select(c(key), vector_to_array(fc).alias("z"))
    phi = F.zip_with(F.col("z"), F.array(*[F.lit(float(x)) for x in coef]), lambda z, b: b * z)
    phi = F.zip_with(phi, F.array(*[F.lit(float(b * m)) for b, m in zip(coef, mean)]), lambda p, bm: p - bm)
    out = arr.select(c(key), F.posexplode(F.arrays_zip(phi.alias("phi"), F.col("z").alias("value"))).alias("j", "s"))
    name_col = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("j") + 1)
    return out.select(c(key), name_col.alias("feature"), F.col("s.phi").alias("phi"), F.col("s.value").alias("value"))


# -- A18 / T5 / X6 -------------------------------------------------------------------------------
def importance(att: DataFrame) -> DataFrame:
    """Mean |phi| per feature."""
    return att.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs"))


def insights(att: DataFrame, top: int = 5) -> DataFrame:
    """T5 + X6: the ``top`` features by mean |phi| with a report line each.
    The ranking runs over one row per feature (bounded by the feature count)."""
    imp = importance(att)
    ranked = imp.withColumn("pos", F.row_number().over(Window.orderBy(F.col("mean_abs").desc(), F.col("feature"))))
    return ranked.where(F.col("pos") <= top).withColumn(
        "line", F.format_string("- %s: mean impact %.4f", F.col("feature"), F.col("mean_abs")))


# -- T4 / X5 -------------------------------------------------------------------------------------
def worst_errors(model: PipelineModel, train: DataFrame, test: DataFrame, key: str = "id", target: str = "target",
                 k: int = 3, label: str = "y_log") -> DataFrame:
    """T4: the ``k`` largest absolute real-scale errors (bias corrected),
    ``pos`` 1 = smallest of them (emitted smallest first)."""
    factor = bias_correction(model.transform(train), label)
    sc = model.transform(test).withColumn("pred_real", inverse_target("prediction", factor))
    sc = sc.withColumn("abs_err", F.abs(F.col("pred_real") - c(target)))
    top = sc.orderBy(F.col("abs_err").desc(), c(key)).limit(k)
    return top.withColumn("pos", F.row_number().over(Window.orderBy(F.col("abs_err"), c(key))))


def waterfall(att: DataFrame, rows: DataFrame, key: str = "id", max_lines: int = 10) -> DataFrame:
    """Per selected row the ``max_lines - 1`` largest |phi| and the rest
    summed as ``other``.  ``rows`` is a bounded selection (T4), broadcast."""
    a = att.join(F.broadcast(rows.select(key)), key)
    a = a.withColumn("rk", F.row_number().over(Window.partitionBy(key).orderBy(F.abs("phi").desc(), F.col("feature"))))
    feat = F.when(F.col("rk") < max_lines, F.col("feature")).otherwise(F.lit("other"))
    return a.groupBy(key, feat.alias("feature")).agg(F.sum("phi").alias("phi"), F.min("rk").alias("rk"))


# -- X2 ------------------------------------------------------------------------------------------
def _tree_tables(model: GBTRegressionModel, spark) -> list[dict]:
    """Node arrays per tree, read back from the saved model's ``data`` table
    (model-sized: collected like any fitted parameter)."""
    path = scratch_path(spark, f"trees-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(os.path.join(path, "data")).select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        "nodeData.split.featureIndex", "nodeData.split.leftCategoriesOrThreshold",
        "nodeData.split.numCategories").collect()
    trees: dict[int, dict] = {}
    for r in nodes:
        t = trees.setdefault(r["treeID"], {})
        t[r["id"]] = (r["prediction"], r["leftChild"], r["rightChild"], r["featureIndex"],
                      list(r["leftCategoriesOrThreshold"] or []), r["numCategories"])
    return [trees[i] for i in sorted(trees)]


def _leaves(tree: dict) -> list[tuple[float, dict]]:
    """Every leaf with its path constraints ``feature -> list of (kind, arg, go_left)``."""
    out = []

    def walk(nid, cons):
        pred, left, right, feat, arg, ncat = tree[nid]
        if left < 0:
            out.append((pred, cons))
            return
        kind = "cat" if ncat is not None and ncat >= 0 else "num"
        for child, go_left in ((left, True), (right, False)):
            nc = {k: list(v) for k, v in cons.items()}
            nc.setdefault(feat, []).append((kind, arg, go_left))
            walk(child, nc)

    root = [n for n in tree if all(n not in (v[1], v[2]) for v in tree.values())][0]
    walk(root, {})
    return out


def _booster_leaves(tree) -> list[tuple[float, dict]]:
    out, todo = [], [(0, {})]
    while todo:
        at, cons = todo.pop()
        if tree.feature[at] < 0:
            out.append((tree.value[at], cons))
            continue
        for child, go_left in ((tree.left[at], True), (tree.right[at], False)):
            own = {k: list(v) for k, v in cons.items()}
            own.setdefault(tree.feature[at], []).append(("num", [tree.threshold[at]], go_left))
            todo.append((child, own))
    return out


def _forest(final, spark) -> tuple[list, list[float], float]:
    """Leaves per tree, tree weights and the constant of a fitted tree ensemble."""
    if isinstance(final, HistogramBoosterModel):
        e = final.ensemble
        return [_booster_leaves(t) for t in e.trees], [1.0] * len(e.trees), e.base
    return [_leaves(t) for t in _tree_tables(final, spark)], list(final.treeWeights), 0.0


def _satisfies(vals: np.ndarray, conds) -> np.ndarray:
    ok = np.ones(vals.shape[0], dtype=bool)
    for kind, arg, go_left in conds:
        if kind == "num":
            left = vals <= arg[0]
        else:
            left = np.isin(vals, np.asarray(arg, dtype=float))
        ok &= left if go_left else ~left
    return ok


def _codes(vals: np.ndarray, cons: dict) -> np.ndarray:
    """Bit k of a row: it follows the path at the k-th feature."""
    out = np.zeros(len(vals), np.int64)
    for k, j in enumerate(cons):
        out |= _satisfies(vals[:, j], cons[j]).astype(np.int64) << k
    return out


def background_patterns(B: np.ndarray, leaves_per_tree) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """For every leaf the distinct patterns of the background rows and their shares."""
    out = []
    for leaves in leaves_per_tree:
        own = []
        for _, cons in leaves:
            codes, n = np.unique(_codes(B, cons), return_counts=True)
            own.append((codes, n / max(len(B), 1)))
        out.append(own)
    return out


def _weight_tables(p: int) -> tuple[np.ndarray, np.ndarray]:
    """By (|A|, |B|): the weight of a feature in A and of one in B."""
    fact = [math.factorial(i) for i in range(p + 1)]
    wa, wb = np.zeros((p + 1, p + 1)), np.zeros((p + 1, p + 1))
    for a in range(p + 1):
        for b in range(p + 1 - a):
            wa[a, b] = fact[a - 1] * fact[b] / fact[a + b] if a else 0.0
            wb[a, b] = fact[a] * fact[b - 1] / fact[a + b] if b else 0.0
    return wa, wb


def interventional_shap(X: np.ndarray, B: np.ndarray, leaves_per_tree, weights, patterns=None) -> np.ndarray:
    """Exact interventional Shapley values of a weighted tree sum, averaged over the background rows ``B``.

    A leaf with p path features sees a row only through which of them the row follows.  So rows and background rows are grouped by
    that bit pattern first (``patterns``: background_patterns(), which a task computes once), and the sums run over pairs of
    patterns, at most ``min(2^p, rows) x min(2^p, background)`` of them, with weights from a table by (|A|, |B|)."""
    n, d = X.shape
    phi = np.zeros((n, d))
    patterns = patterns if patterns is not None else background_patterns(B, leaves_per_tree)
    tables: dict[int, tuple] = {}
    for w, leaves, own in zip(weights, leaves_per_tree, patterns, strict=True):
        for (v, cons), (ub, share) in zip(leaves, own, strict=True):
            p = len(cons)
            if not p:
                continue
            wa, wb = tables.setdefault(p, _weight_tables(p))
            ux, inverse = np.unique(_codes(X, cons), return_inverse=True)
            a, b = ux[:, None] & ~ub[None, :], ~ux[:, None] & ub[None, :]
            live = ((ux[:, None] | ub[None, :]) == (1 << p) - 1) * share[None, :]
            na, nb = np.bitwise_count(a), np.bitwise_count(b & ((1 << p) - 1))
            up, down = wa[na, nb] * live, wb[na, nb] * live
            for k, j in enumerate(cons):
                part = ((a >> k & 1) * up - (b >> k & 1) * down).sum(1)
                phi[:, j] += w * v * part[inverse]
    return phi


def tree_predict(X: np.ndarray, leaves_per_tree, weights) -> np.ndarray:
    out = np.zeros(X.shape[0])
    for w, leaves in zip(weights, leaves_per_tree):
        for v, cons in leaves:
            ok = np.ones(X.shape[0], dtype=bool)
            for j, cs in cons.items():
                ok &= _satisfies(X[:, j], cs)
            out += w * v * ok
    return out


def tree_attributions(model: PipelineModel, train: DataFrame, test: DataFrame, key: str = "id",
                      background: int = 100, explain_rows: int | None = None, seed: int = 42, spec: Spec | None = None) -> DataFrame:
    """Long ``(key, feature, phi, value, base)`` for a pipeline ending in a
    GBT or histogram booster model.  ``explain_rows`` optionally bounds the explained rows (J6)."""
    spark = train.sparkSession
    ship_library(spark)
    final = _final_model(model)
    fc = final.getFeaturesCol()
    leaves, weights, start = _forest(final, spark)
    bg_rows = split.bounded_sample(model.transform(train), key, background, seed).select(
        vector_to_array(fc).alias("z")).collect()  # <= background rows: bounded
    Bm = np.array([r["z"] for r in bg_rows], dtype=float)
    scored = model.transform(test if explain_rows is None else split.bounded_sample(test, key, explain_rows, seed))
    names = feature_names(scored, fc, spec)
    base = start + (float(tree_predict(Bm, leaves, weights).mean()) if len(Bm) else 0.0)
    bc = spark.sparkContext.broadcast((leaves, weights, Bm, names, base))

    def run(it):
        leaves_, w_, B_, names_, base_ = bc.value
        patterns = background_patterns(B_, leaves_)
        for pdf in it:
            if pdf.empty:
                continue
            X = np.array(pdf["z"].tolist(), dtype=float)
            phi = interventional_shap(X, B_, leaves_, w_, patterns)
            ids = np.repeat(pdf[key].to_numpy(), X.shape[1])
            yield pd.DataFrame({key: ids, "feature": np.tile(np.array(names_, dtype=object), X.shape[0]),
                                "phi": phi.reshape(-1), "value": X.reshape(-1), "base": base_})

    kt = dict(scored.dtypes)[key]
    src = scored.select(c(key), vector_to_array(fc).alias("z"))
    return src.mapInPandas(run, f"`{key}` {kt}, feature string, phi double, value double, base double")


# -- X3 ------------------------------------------------------------------------------------------
def sampled_attributions(model: PipelineModel, train: DataFrame, test: DataFrame, features: Sequence[str],
                         key: str = "id", background: int = 100, permutations: int = 8, seed: int = 42) -> DataFrame:
    """Permutation-sampling Shapley values over the *input* columns, with
    the whole fitted pipeline as the black box.  Returns ``(key, feature, phi,
    base)`` where ``base`` is the mean prediction of the backgrounds used for
    that row (so ``sum(phi) = f(x) - base`` holds exactly)."""
    feats = list(features)
    d = len(feats)
    bg = split.bounded_sample(train, key, background, seed).select(*[c(x) for x in feats])
    bg = bg.withColumn("__bi", F.row_number().over(Window.orderBy(*[c(x) for x in feats])) - 1)
    nbg = bg.count()
    bgs = bg.select("__bi", *[c(x).alias(f"__b{i}") for i, x in enumerate(feats)])
    rows = test.select(c(key), *[c(x).alias(f"__x{i}") for i, x in enumerate(feats)])
    rows = rows.withColumn("__p", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
    h = lambda *parts: F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("__bi", F.pmod(h(F.lit(f"bg{seed}"), c(key).cast("string"), F.col("__p").cast("string")),
                                           F.lit(max(nbg, 1))))
    # permutation: feature indices sorted by a per-(row, p, j) hash
    order = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda j: F.struct(
        h(F.lit(f"perm{seed}"), c(key).cast("string"), F.col("__p").cast("string"), j.cast("string")).alias("h"),
        j.alias("j"))))
    rows = rows.withColumn("__perm", F.transform(order, lambda s: s["j"]))
    j = rows.join(F.broadcast(bgs), "__bi")  # <= background rows: bounded broadcast
    j = j.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(d))))
    # position of feature i in the permutation; feature from x when pos < k
    hyb = {x: F.when(F.array_position(F.col("__perm"), F.lit(i)) - 1 < F.col("__k"), F.col(f"__x{i}"))
           .otherwise(F.col(f"__b{i}")) for i, x in enumerate(feats)}
    z = j.select(c(key), "__p", "__k", "__perm", *[v.alias(x) for x, v in hyb.items()])
    pred = model.transform(z).select(c(key), "__p", "__k", "__perm", "prediction")
    w = Window.partitionBy(key, "__p").orderBy("__k")
    step = pred.withColumn("__step", F.col("prediction") - F.lag("prediction").over(w))
    # the feature switched on at step k; step 0 is the background itself
    moved = F.get("__perm", F.col("__k") - 1)
    out = step.groupBy(key).agg(
        F.avg(F.when(F.col("__k") == 0, F.col("prediction"))).alias("base"),
        *[F.avg(F.when((F.col("__k") > 0) & (moved == i), F.col("__step"))).alias(f"__phi{i}") for i in range(d)])
    return out.select(c(key), F.inline(F.array(*[F.struct(F.lit(x).alias("feature"), F.col(f"__phi{i}").alias("phi"))
                                                 for i, x in enumerate(feats)])), "base")


def coalitions(d: int, most: int = 1022, seed: int = 42) -> tuple[list[int], list[float]]:
    """Bit masks of feature sets, neither empty nor full, and their kernel weights.

    All of them if there are at most ``most`` (ten features).  Beyond that sizes are taken whole from both ends (the
    heaviest) while they fit; the rest of the weight goes to sets drawn from the remaining sizes, each with its complement."""
    if d < 2:
        return [], []
    size_weight = [0.0, *[(d - 1) / (s * (d - s)) for s in range(1, d)]]  # of a whole size; a set has its share
    masks: dict[int, float] = {}
    left = set(range(1, d))
    for s in range(1, d // 2 + 1):
        sizes = {s, d - s}
        n = sum(math.comb(d, x) for x in sizes)
        if len(masks) + n > most:
            break
        for x in sizes:
            for members in itertools.combinations(range(d), x):
                masks[sum(1 << j for j in members)] = size_weight[x] / math.comb(d, x)
        left -= sizes
    rng = random.Random(f"coalitions|{seed}|{d}")
    if left and len(masks) + 1 < most:
        drawn: dict[int, int] = {}
        sizes = sorted(left)
        while len(drawn) + len(masks) + 1 < most:
            s = rng.choices(sizes, [size_weight[x] for x in sizes])[0]
            m = sum(1 << j for j in rng.sample(range(d), s))
            for x in (m, (1 << d) - 1 - m):
                drawn[x] = drawn.get(x, 0) + 1
        total = sum(drawn.values())
        for m, n in drawn.items():
            masks[m] = sum(size_weight[x] for x in left) * n / total
    return list(masks), list(masks.values())


def kernel_solver(masks: Sequence[int], weights: Sequence[float], d: int) -> np.ndarray:
    """(d - 1) x coalitions: what each coalition's value adds to the first d - 1 attributions, from the normal equations with
    the last attribution eliminated through additivity."""
    z = np.array([[m >> j & 1 for j in range(d)] for m in masks], float).reshape(len(masks), d)
    x = z[:, :-1] - z[:, -1:]
    w = np.array(weights)[:, None]
    return np.linalg.solve(x.T @ (x * w), (x * w).T)


def kernel_attributions(model: PipelineModel, train: DataFrame, test: DataFrame, features: Sequence[str], key: str = "id",
                        background: int = 100, most: int = 1022, seed: int = 42) -> DataFrame:
    """Kernel Shapley values over the *input* columns: ``(key, feature, phi, base)``, ``sum(phi) = f(x) - base``.

    A coalition's value is the mean prediction over the background rows with the coalition's features taken from the row.  All rows use
    the same coalitions, so their Gram matrix is one and is solved once; a row's attributions are then weighted sums of
    its hybrid predictions, made in one aggregate by key whose map side already sums a row's hybrids.  Hybrid rows number rows x
    coalitions x background and are never stored."""
    feats = list(features)
    d = len(feats)
    masks, weights = coalitions(d, most, seed)
    solver = kernel_solver(masks, weights, d) if d > 1 else np.zeros((0, 0))
    bg = split.bounded_sample(train, key, background, seed)
    base = model.transform(bg).agg(F.avg("prediction")).first()[0]
    bg = bg.withColumn("__bi", F.row_number().over(Window.orderBy(c(key))) - 1).select("__bi", *[c(x).alias(f"__b{i}") for i, x in enumerate(feats)])
    nbg = bg.count()  # <= background rows: a bounded window and broadcast
    rows = test.select(c(key), *[c(x).alias(f"__x{i}") for i, x in enumerate(feats)])
    # coalition number len(masks) is the row itself, taken once
    n = len(masks)
    rows = rows.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(n))))
    rows = rows.withColumn("__bi", F.explode(F.when(F.col("__s") == n, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(max(nbg, 1) - 1)))))
    rows = rows.join(F.broadcast(bg), "__bi")
    mask = F.element_at(F.array(*[F.lit(m) for m in [*masks, (1 << d) - 1]]), F.col("__s") + 1)
    hybrid = rows.select(c(key), "__s", *[F.when(F.shiftright(mask, i).bitwiseAND(1) == 1, F.col(f"__x{i}")).otherwise(F.col(f"__b{i}")).alias(x)
                                          for i, x in enumerate(feats)])
    pred = model.transform(hybrid).select(c(key), "__s", "prediction")
    share = lambda j: F.element_at(F.array(*[F.lit(float(v)) for v in [*solver[j], 0.0]]), F.col("__s") + 1)
    out = pred.groupBy(key).agg(F.avg(F.when(F.col("__s") == n, F.col("prediction"))).alias("__f"),
                                *[F.sum(share(j) * F.col("prediction")).alias(f"__v{j}") for j in range(d - 1)])
    gain = F.col("__f") - F.lit(base)
    last = np.array([m >> (d - 1) & 1 for m in masks], float)
    phis = [F.col(f"__v{j}") / nbg - F.lit(float(solver[j].sum())) * F.lit(base) - F.lit(float(solver[j] @ last)) * gain for j in range(d - 1)]
    phis.append(gain - sum(phis, F.lit(0.0)))
    return out.select(c(key), F.inline(F.array(*[F.struct(F.lit(x).alias("feature"), p.alias("phi")) for x, p in zip(feats, phis, strict=True)])),
                      F.lit(base).alias("base"))


# -- X4 ------------------------------------------------------------------------------------------
def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def additivity_gap(attr: DataFrame, scored: DataFrame, key: str = "id") -> float:
    """The greatest distance between ``sum(phi) + base`` and the prediction, relative to the prediction where that is above 1."""
    total = attr.groupBy(key).agg((F.sum("phi") + F.max("base")).alias("__t"))
    d = F.abs(F.col("__t") - F.col("prediction")) / F.greatest(F.abs("prediction"), F.lit(1.0))
    return scored.select(c(key), "prediction").join(total, key, "left").agg(F.max(F.coalesce(d, F.lit(float("inf"))))).first()[0] or 0.0


def attributions(model: PipelineModel, train: DataFrame, test: DataFrame, spec: Spec, tolerance: float = 1e-6) -> DataFrame:
    """Attributions by the kind of the final model, computed and stored here; a method that fails, or whose tree attributions do
    not add up to the predictions, gives way, with a log entry, to the sampled one, which takes any model."""
    final = _final_model(model)
    try:
        if isinstance(final, LinearRegressionModel):
            return _kept(linear_attributions(model, train, test, key=spec.key, spec=spec), "attributions")
        if isinstance(final, (GBTRegressionModel, HistogramBoosterModel)):
            out = _kept(tree_attributions(model, train, test, key=spec.key, spec=spec), "attributions")
            gap = additivity_gap(out, model.transform(test), spec.key)
            if gap > tolerance:
                raise ArithmeticError(f"attributions miss the predictions by {gap}")
            return out
    except Exception:  # noqa: BLE001
        LOG.exception("attributions of %s failed; sampling instead", type(final).__name__)
    return _kept(sampled_attributions(model, train, test, list(spec.features), key=spec.key), "attributions")
