"""O2 (and M11): the whole job — profile -> prepare -> train -> evaluate ->
select -> explain -> report — as one function over a DataFrame and a Spec.

Every step is a Spark job (or a short sequence of them); the driver only holds
fitted parameters, the comparison table (one row per model) and names.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.operators import clean as cl
from finlens.operators import evaluate as ev
from finlens.operators import explain as xp
from finlens.operators import models as md
from finlens.operators import prep
from finlens.operators import split
from finlens.operators.search import Folds
from finlens.plans import eda
from finlens.sources import sinks
from finlens.spec import Spec

LOG = logging.getLogger("finlens")


@dataclass
class RunResult:
    profile: dict = field(default_factory=dict)
    comparison: DataFrame | None = None
    best: str | None = None
    insights: DataFrame | None = None
    attributions: DataFrame | None = None
    worst: DataFrame | None = None
    models: dict = field(default_factory=dict)
    params: dict = field(default_factory=dict)
    times: dict = field(default_factory=dict)
    report: dict = field(default_factory=dict)


def prepare(df: DataFrame, spec: Spec, label: str = "y_log") -> tuple[DataFrame, DataFrame]:
    """Clean -> target present -> log target -> folds -> split (cached)."""
    d = cl.clean(df, spec).where(F.col(f"`{spec.target}`").isNotNull())
    d = cl.log_target(d, spec.target, label)
    d = split.with_folds(d, spec.key, spec.folds, spec.seed)
    tr, te = split.train_test_split(d, spec.key, spec.seed, spec.test_share)
    return tr.persist(), te.persist()


def evaluate_all(models: dict, times: dict, prep_pipe, tr: DataFrame, te: DataFrame, spec: Spec,
                 params: dict | None = None, cv: bool = True, folds: Folds | None = None) -> DataFrame:
    """M10 over every trained model, with its training time (J3).  Cross-validation prepares each fold once for all families; a
    model whose evaluation fails is logged and left out."""
    cvm = {}
    if cv and models:
        cvm = md.cross_validate(folds or Folds(prep_pipe, tr), {n: (params or {}).get(n) or {} for n in models}, spec.seed)
    rows = []
    for name, model in models.items():
        try:
            rows.append(ev.evaluate_model(name, model, None, tr, te, target=spec.target, unit=spec.unit, cvm=cvm.get(name)))
        except Exception:  # noqa: BLE001 — a failing model is left out and reported, the others go on
            LOG.exception("evaluation of %s failed; it is left out", name)
    spark = tr.sparkSession
    tdf = spark.createDataFrame([(k, float(v)) for k, v in times.items()], "model string, train_time double")
    return ev.comparison_table(rows, tdf)


def run(df: DataFrame, spec: Spec, out_dir: str, names=md.MODEL_NAMES, tune: bool = True, trials: int = md.N_TRIALS,
        cv: bool = True, profile: bool = True, explain: bool = True, params: dict | None = None) -> RunResult:
    """The whole job.  Models, comparison and report are written below ``out_dir``; the best model is read back from there
    before it explains anything.  ``params`` gives parameters of families when ``tune`` is off."""
    res = RunResult()
    if profile:
        res.profile = eda.profile(df, spec)
    tr, te = prepare(df, spec)
    try:
        pp = prep.build_prep_pipeline(spec)
        folds = Folds(pp, tr) if tune or cv else None
        models, res.params, res.times = md.train_all(pp, tr, names, tune=tune, trials=trials, seed=spec.seed, folds=folds, params=params)
        for name, m in models.items():
            sinks.save_model(m, f"{out_dir}/models", name)
        res.models = models
        sinks.write_table(evaluate_all(models, res.times, pp, tr, te, spec, res.params, cv, folds), f"{out_dir}/comparison")
        res.comparison = sinks.read_table(tr.sparkSession, f"{out_dir}/comparison")
        res.best = ev.best_model_name(res.comparison)
        best = sinks.load_model(f"{out_dir}/models", res.best) if res.best else None
        if best is not None and explain:
            xp.attributions(best, tr, te, spec).write.mode("overwrite").parquet(f"{out_dir}/attributions")
            res.attributions = tr.sparkSession.read.parquet(f"{out_dir}/attributions")
            res.insights = xp.insights(res.attributions)
            xp.worst_errors(best, tr, te, key=spec.key, target=spec.target).write.mode("overwrite").parquet(f"{out_dir}/worst")
            res.worst = tr.sparkSession.read.parquet(f"{out_dir}/worst")
        res.report = sinks.write_report(f"{out_dir}/report", res.comparison, res.best, res.insights)
    finally:
        tr.unpersist()
        te.unpersist()
    return res
