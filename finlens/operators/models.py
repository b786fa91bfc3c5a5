"""Regressors, voting, seeded search and training (M1–M8).

The five model families of the surveyed job map to ``pyspark.ml``:

* ``LinearRegression`` — OLS with intercept (normal equations: one
  distributed aggregate of the k x k Gram matrix, solved on the driver);
* ``GradientBoosting`` — ``GBTRegressor``, over as many partitions as its rows fill;
* ``XGBoost`` / ``LightGBM`` — :class:`~finlens.operators.boosting.HistogramBooster`:
  second-order gain with row subsampling by level, and best-first growth to a leaf limit;
* ``Ensemble`` — :class:`VotingRegressor`, a weighted mean of member models.

Tuning (``search``) proposes parameters on the driver (a handful of numbers) and
scores them on the key-hash folds, whose preparation all trials share.
"""

from __future__ import annotations

import itertools
import logging
import math
import time
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.functions.exprs import c
from finlens.operators.boosting import Boost, HistogramBooster, HistogramBoosterModel, dumps
from finlens.operators.evaluate import metric_aggs, metric_cols
from finlens.operators.positions import written
from finlens.operators.search import Folds, ParzenSampler, mean_r2, run_trials, weighted_r2

LOG = logging.getLogger("finlens")

MODEL_NAMES = ("LinearRegression", "GradientBoosting", "XGBoost", "LightGBM", "Ensemble")
MEMBERS = ("GradientBoosting", "XGBoost", "LightGBM")  # of the vote

# Library defaults of the three boosting families and the search
# ranges of the surveyed job (trees 50–300, rate .01–.3, depth 3–10, split
# size 2–20, subsample .5–1, leaves 20–100, ensemble weights .1–1; 10 trials).
DEFAULTS = {
    "GradientBoosting": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "min_samples_split": 2},
    "XGBoost": {"n_estimators": 100, "learning_rate": 0.3, "max_depth": 6, "subsample": 1.0},
    "LightGBM": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": -1, "num_leaves": 31},
}
SEARCH_SPACE = {
    "GradientBoosting": {"n_estimators": ("int", 50, 300), "learning_rate": ("float", 0.01, 0.3),
                         "max_depth": ("int", 3, 10), "min_samples_split": ("int", 2, 20)},
    "XGBoost": {"n_estimators": ("int", 50, 300), "learning_rate": ("float", 0.01, 0.3),
                "max_depth": ("int", 3, 10), "subsample": ("float", 0.5, 1.0)},
    "LightGBM": {"n_estimators": ("int", 50, 300), "learning_rate": ("float", 0.01, 0.3),
                 "max_depth": ("int", 3, 10), "num_leaves": ("int", 20, 100)},
    "Ensemble": {"w0": ("float", 0.1, 1.0), "w1": ("float", 0.1, 1.0), "w2": ("float", 0.1, 1.0)},
}
N_TRIALS = 10
FIT_ROWS = 20_000  # rows in a partition of a boosted fit, about: its hundreds of jobs each run one task for every partition


def gbt_params(family: str = "GradientBoosting", params: dict | None = None) -> dict:
    """The ``GradientBoosting`` family's parameters as ``GBTRegressor`` arguments."""
    p = {**DEFAULTS[family], **(params or {})}
    # split size s -> children of at least ceil(s / 2) rows (approximation)
    return {"maxIter": int(p["n_estimators"]), "stepSize": float(p["learning_rate"]), "maxDepth": int(p["max_depth"]),
            "minInstancesPerNode": max(1, math.ceil(int(p["min_samples_split"]) / 2))}


def boost_params(family: str, params: dict | None = None, seed: int = 42) -> Boost:
    """The other two boosting families' parameters.  Fixed values: an L2 penalty of 1 and leaves of one row (second order), none and
    20 rows (leaf-wise), which are those libraries' defaults."""
    p = {**DEFAULTS[family], **(params or {})}
    shared = {"n_estimators": int(p["n_estimators"]), "learning_rate": float(p["learning_rate"]), "max_depth": int(p["max_depth"]), "seed": seed}
    if family == "XGBoost":
        return Boost(**shared, l2=1.0, min_rows=1, subsample=float(p["subsample"]))
    return Boost(**shared, num_leaves=int(p["num_leaves"]), l2=0.0, min_rows=20)


class CompactGBTRegressor(GBTRegressor):
    """``GBTRegressor`` whose hundreds of jobs do not run a task for every partition of whatever made its rows: the label and features
    are written once, in partitions of about ``FIT_ROWS`` rows at least, and read back without the plan that made them."""

    def _fit(self, df):
        cols = [self.getLabelCol(), self.getFeaturesCol(), *([self.getWeightCol()] if self.isSet(self.weightCol) else [])]
        rows = df.select(*[c(x) for x in dict.fromkeys(cols)]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            few = written(rows.coalesce(max(1, -(-rows.count() // FIT_ROWS))), "fit-rows")
        finally:
            rows.unpersist()
        return super()._fit(few)


def make_regressor(name: str, params: dict | None = None, features_col: str = "features", label_col: str = "y_log",
                   prediction_col: str = "prediction", seed: int = 42, tuned_members: dict | None = None):
    """One estimator per model family (M1–M5)."""
    cols = {"featuresCol": features_col, "labelCol": label_col, "predictionCol": prediction_col}
    if name == "LinearRegression":
        return LinearRegression(solver="normal", regParam=0.0, elasticNetParam=0.0, fitIntercept=True, **cols)
    if name == "GradientBoosting":
        return CompactGBTRegressor(seed=seed, cacheNodeIds=True, checkpointInterval=10, **gbt_params(name, params), **cols)
    if name in DEFAULTS:
        return HistogramBooster(boost_params(name, params, seed), **cols)
    if name == "Ensemble":
        members = [make_regressor(m, (tuned_members or {}).get(m), features_col, label_col, seed=seed)
                   for m in MEMBERS]
        w = None
        if params:
            w = [float(v) for _, v in sorted(params.items())]
        return VotingRegressor(members=members, weights=w, **cols)
    raise KeyError(f"unknown model {name!r}")


# -- M5 ------------------------------------------------------------------------------------------
class _VotingParams(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    weights = Param(Params._dummy(), "weights", "member weights (empty = equal)", typeConverter=TypeConverters.toListFloat)


class VotingRegressor(Estimator, _VotingParams):
    """Weighted mean of member regressors' predictions, ``sum(w·p) / sum(w)``."""

    def __init__(self, members=None, weights=None, featuresCol="features", labelCol="label",
                 predictionCol="prediction"):
        super().__init__()
        self.members = list(members or [])
        self._setDefault(weights=[])
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol)
        if weights:
            self._set(weights=weights)

    def copy(self, extra=None):
        that = super().copy(extra)
        that.members = [m.copy() for m in self.members]
        return that

    def _fit(self, df):
        fitted = []
        for i, m in enumerate(self.members):
            extra = {m.predictionCol: f"__vote{i}"}
            if not m.isSet(m.featuresCol):
                extra[m.featuresCol] = self.getFeaturesCol()
            if not m.isSet(m.labelCol):
                extra[m.labelCol] = self.getLabelCol()
            m = m.copy(extra)
            fitted.append(m.fit(df))
        w = self.getOrDefault("weights") or [1.0] * len(fitted)
        return VotingModel(fitted, w, self.getPredictionCol())


class VotingModel(Model, MLWritable, MLReadable):
    def __init__(self, members=None, weights=None, predictionCol="prediction"):
        super().__init__()
        self.members = list(members or [])
        self.weights = list(weights or [])
        self.predictionCol = predictionCol

    def _transform(self, df):
        out = df
        for m in self.members:
            out = m.transform(out)
        tot = float(sum(self.weights))
        pred = sum((F.col(f"__vote{i}") * F.lit(float(w)) for i, w in enumerate(self.weights)), F.lit(0.0)) / tot
        return out.withColumn(self.predictionCol, pred).drop(*[f"__vote{i}" for i in range(len(self.members))])

    def write(self):
        return _VotingWriter(self)

    @classmethod
    def read(cls):
        return _VotingReader()


class _VotingWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession.sparkContext, extraMetadata={
            "weights": self.instance.weights, "predictionCol": self.instance.predictionCol,
            "members": len(self.instance.members),
            "member_classes": [f"{type(m).__module__}.{type(m).__name__}" for m in self.instance.members]})
        for i, m in enumerate(self.instance.members):
            m.write().overwrite().save(f"{path}/member_{i}")


class _VotingReader(MLReader):
    def load(self, path):
        import importlib
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession.sparkContext)
        members = []
        for i, qual in enumerate(meta["member_classes"]):
            mod, cls = qual.rsplit(".", 1)
            members.append(getattr(importlib.import_module(mod), cls).load(f"{path}/member_{i}"))
        return VotingModel(members, meta["weights"], meta["predictionCol"])


# -- M6 ------------------------------------------------------------------------------------------
def draw_params(name: str, trials: int = N_TRIALS, seed: int = 42, space: dict | None = None) -> list[dict]:
    """Seeded random draws from the family's search space (reproducible); a search starts with these."""
    space = space or SEARCH_SPACE.get(name)
    if not space:
        return []
    sampler = ParzenSampler(space, f"{name}|{seed}")
    return [sampler.draw() for _ in range(trials)]


def search(name: str, prep: Pipeline, train: DataFrame, label_col: str = "y_log", fold_col: str = "fold",
           trials: int = N_TRIALS, seed: int = 42, parallelism: int = 2, space: dict | None = None,
           folds: Folds | None = None) -> tuple[dict, list[float]]:
    """M6: maximise mean k-fold R² over a Parzen-estimator search; returns (best params,
    per-trial scores).  ``folds`` shares prepared folds between families.  A failing search returns ``({}, [])`` (defaults)."""
    space = space or SEARCH_SPACE.get(name)
    if not space:
        return {}, []
    try:
        folds = folds or Folds(prep, train, label_col, fold_col)
        if name in ("XGBoost", "LightGBM"):
            score = lambda asked: [mean_r2(f) for f in folds.boosted([boost_params(name, p, seed) for p in asked])]
        elif name == "Ensemble":
            products = folds.products(make_regressor(name, label_col=label_col, seed=seed).members)
            score = lambda asked: [weighted_r2(products, [v for _, v in sorted(p.items())]) for p in asked]
        else:
            score = lambda asked: [mean_r2(f) for f in folds.estimated(
                [make_regressor(name, p, label_col=label_col, seed=seed) for p in asked], parallelism)]
        tried, scores = run_trials(space, score, trials, f"{name}|{seed}", parallelism)
        return tried[max(range(len(scores)), key=lambda i: scores[i])], scores
    except Exception:  # noqa: BLE001 — parity: a failed search falls back to defaults, and says so
        LOG.exception("search of %s failed; its defaults are used", name)
        return {}, []


# -- M7 / M8 -------------------------------------------------------------------------------------
def train_model(name: str, params: dict, prep: Pipeline, train: DataFrame, label_col: str = "y_log",
                seed: int = 42) -> tuple[PipelineModel, float]:
    """M7: fit ``prep + model`` with the chosen parameters; returns the fitted
    pipeline and the wall-clock training time (pipeline construction included)."""
    t0 = time.time()
    est = make_regressor(name, params, label_col=label_col, seed=seed)
    model = Pipeline(stages=[*prep.getStages(), est]).fit(train)
    return model, time.time() - t0


def _fits(name: str, params: dict | None) -> list[tuple[tuple, float]]:
    """The single models a family consists of, as ``(family, its parameters)``, with their weights in its vote."""
    if name != "Ensemble":
        return [((name, tuple(sorted((params or {}).items()))), 1.0)]
    weights = [float(v) for _, v in sorted((params or {}).items())] or [1.0] * len(MEMBERS)
    return [((m, ()), w) for m, w in zip(MEMBERS, weights, strict=True)]


def train_all(prep: Pipeline, train: DataFrame, names=MODEL_NAMES, label_col: str = "y_log", tune: bool = True,
              trials: int = N_TRIALS, seed: int = 42, folds: Folds | None = None, space: dict | None = None,
              params: dict | None = None) -> tuple[dict, dict, dict]:
    """M8: search + fit every family; models that fail are skipped and logged.  Returns ``(models, params, train_times)``.

    The preparation is fitted once and its rows are kept for all families.  A member of the vote that was already fitted with
    the same parameters is not fitted again; a family's time is that of the preparation and of all the models in it.  ``params`` gives
    parameters of families that are not searched, ``space`` replaces search spaces by family."""
    models, times, fitted = {}, {}, {}
    chosen = {name: dict((params or {}).get(name, {})) for name in names}
    if tune:
        folds = folds or Folds(prep, train, label_col)
        for name in names:
            chosen[name] = search(name, prep, train, label_col, trials=trials, seed=seed, folds=folds, space=(space or {}).get(name))[0]
    t0 = time.time()
    ready = prep.fit(train)
    rows = ready.transform(train).select(label_col, "features").persist(StorageLevel.MEMORY_AND_DISK)
    shared = time.time() - t0
    try:
        for name in names:
            try:
                for key, _ in _fits(name, chosen[name]):
                    if key not in fitted:
                        t0 = time.time()
                        model = make_regressor(key[0], dict(key[1]), label_col=label_col, seed=seed).fit(rows)
                        fitted[key] = (model, time.time() - t0)
                if name == "Ensemble":
                    own = [m.copy({m.predictionCol: f"__vote{i}"}) for i, m in enumerate(fitted[k][0] for k, _ in _fits(name, chosen[name]))]
                    last = VotingModel(own, [w for _, w in _fits(name, chosen[name])])
                else:
                    last = fitted[_fits(name, chosen[name])[0][0]][0]
                models[name] = PipelineModel(stages=[*ready.stages, last])
                times[name] = shared + sum(fitted[k][1] for k, _ in _fits(name, chosen[name]))
            except Exception:  # noqa: BLE001 — a failing family is left out and reported, the others go on
                LOG.exception("training of %s failed; it is left out", name)
    finally:
        rows.unpersist()
    return models, {name: chosen[name] for name in models}, times


# -- M9 over all families ------------------------------------------------------------------------
def cross_validate(folds: Folds, params: dict[str, dict], seed: int = 42, threads: int = 2) -> dict[str, dict]:
    """M9 of several families: ``family -> {r2, mae, rmse}`` (mean R², mean MAE, root of the mean MSE over the folds that hold
    rows).  Every fold is prepared once; the histogram boosters of all families and folds grow in the same jobs; a model that
    several families hold is fitted once for each fold, and the vote is taken of its members' held-out predictions."""
    keys = sorted({k for name, p in params.items() for k, _ in _fits(name, p)}, key=str)
    joint = [k for k in keys if k[0] in ("XGBoost", "LightGBM")]
    grown = iter(folds.grown([boost_params(k[0], dict(k[1]), seed) for k in joint]))
    trees = {k: list(itertools.islice(grown, len(folds.numbers))) for k in joint}

    def one(i):
        fit_rows, held = (x.persist(StorageLevel.MEMORY_AND_DISK) for x in folds.part(i))
        try:
            scored = held
            for j, k in enumerate(keys):
                if k in trees:
                    model = HistogramBoosterModel(featuresCol=folds.features, predictionCol=f"__m{j}", trees=dumps(trees[k][i]), boost="{}")
                else:
                    model = make_regressor(k[0], dict(k[1]), folds.features, folds.label, f"__m{j}", seed).fit(fit_rows)
                scored = model.transform(scored)
            votes = {n: _fits(n, p) for n, p in params.items()}
            mean = lambda v: sum((F.col(f"__m{keys.index(k)}") * F.lit(w) for k, w in v), F.lit(0.0)) / F.lit(sum(w for _, w in v))
            scored = scored.select(folds.label, *[mean(v).alias(f"__p{n}") for n, v in enumerate(votes.values())])
            sums = [F.struct(*[x.alias(a) for x, a in zip(metric_aggs(folds.label, f"__p{n}"), ("n", "sse", "var_y", "mae", "mse"), strict=True)])
                    for n in range(len(votes))]
            return scored.agg(F.array(*sums).alias("f")).select(F.inline("f")).select("n", *metric_cols()).collect()  # one row per family
        finally:
            fit_rows.unpersist()
            held.unpersist()

    with ThreadPool(threads) as pool:
        got = pool.map(one, range(len(folds.numbers)))
    out = {}
    for n, name in enumerate(params):
        rows = [g[n] for g in got if g[n]["n"]]
        mean = lambda x: sum(r[x] for r in rows) / len(rows) if rows else None  # noqa: B023,E731
        out[name] = {"r2": mean("r2"), "mae": mean("mae"), "rmse": math.sqrt(mean("mse")) if rows else None}
    return out
