"""Evaluation: metrics, cross-validation, real-scale conversion, comparison
table and model selection (A17, F2–F6, J3, M9–M11, T2, T3, U1, C9)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlens.functions.exprs import METRIC_DIGITS, R2_DIGITS, c, find_column, inverse_target, nan_to_null, round_half_away

METRIC_COLS = ("r2_log_cv", "mae_log_cv", "rmse_log_cv", "r2_log", "mae_log", "rmse_log",
               "r2_real", "mae_real", "rmse_real")
# Fixed value: serving falls back to this family when no comparison exists.
SERVING_FALLBACK = "LightGBM"


# -- A17 -----------------------------------------------------------------------------------------
def metric_aggs(label: str, pred: str) -> list[Column]:
    y, p = nan_to_null(c(label).cast("double")), nan_to_null(c(pred).cast("double"))
    e = y - p  # null where either side is missing: such a row is left out
    return [F.count(e).alias("n"), F.sum(e * e).alias("sse"), F.var_pop(F.when(p.isNotNull(), y)).alias("var_y"),
            F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse")]


def metric_cols() -> list[Column]:
    # a constant label: 1 if predicted exactly, else 0
    r2 = (F.when(F.col("var_y") > 0, F.lit(1.0) - F.try_divide(F.col("sse"), F.col("n") * F.col("var_y")))
          .when(F.col("n") > 0, F.when(F.col("sse") == 0, 1.0).otherwise(0.0)))
    return [r2.alias("r2"), F.col("mae"), F.sqrt(F.col("mse")).alias("rmse"), F.col("mse")]


def regression_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """R², MAE, RMSE, MSE in one pass (optionally per group)."""
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(*metric_aggs(label, pred)).select(*by, "n", *metric_cols())


# -- F2 / F3 -------------------------------------------------------------------------------------
def bias_correction(train_scored: DataFrame, label: str = "y_log", pred: str = "prediction") -> float:
    """F2 factor ``exp(mean(y_log_train) - mean(pred_log_train))`` (one row)."""
    r = train_scored.agg(F.avg(c(label)).alias("my"), F.avg(c(pred)).alias("mp")).first()
    if r["my"] is None or r["mp"] is None:
        return 1.0
    return math.exp(r["my"] - r["mp"])


def to_real(scored: DataFrame, pred: str = "prediction", factor: float | None = None,
            out: str = "pred_real") -> DataFrame:
    """F2 (with factor) / F3 (``factor=None``): ``expm1(pred) [* factor]``."""
    return scored.withColumn(out, inverse_target(pred, factor))


# -- M9 ------------------------------------------------------------------------------------------
def cv_metrics(pipeline: Pipeline, train: DataFrame, label: str = "y_log", fold_col: str = "fold",
               k: int = 5, pred: str = "prediction") -> dict:
    """M9: refit the *whole* pipeline on k-1 folds, score the held-out fold;
    mean R², mean MAE, ``sqrt(mean MSE)``.  Each fold is a distributed fit; the
    per-fold metrics come from one aggregate each.  A pipeline that is only an
    assembler + unregularised least squares takes the one-pass path
    (:func:`linear_cv_metrics`)."""
    feats = _plain_linear(pipeline)
    if feats is not None:
        return linear_cv_metrics(train, feats, label, fold_col, k)
    rows = []
    for f in range(k):
        fit_part = train.where(F.col(fold_col) != f)
        held = train.where(F.col(fold_col) == f)
        m = pipeline.fit(fit_part)
        rows.append(regression_metrics(m.transform(held), label, pred).first())
    rows = [r for r in rows if r["n"]]
    if not rows:
        return {"r2": None, "mae": None, "rmse": None}
    return {"r2": sum(r["r2"] for r in rows) / len(rows), "mae": sum(r["mae"] for r in rows) / len(rows),
            "rmse": (sum(r["mse"] for r in rows) / len(rows)) ** 0.5}


def _plain_linear(pipeline: Pipeline):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    st = pipeline.getStages()
    if (len(st) == 2 and isinstance(st[0], VectorAssembler) and isinstance(st[1], LinearRegression)
            and st[1].getRegParam() == 0.0 and st[1].getFitIntercept()
            and st[0].getOutputCol() == st[1].getFeaturesCol() and not st[1].isSet(st[1].weightCol)):
        return list(st[0].getInputCols())
    return None


def linear_cv_metrics(train: DataFrame, feats: Sequence[str], label: str = "y_log", fold_col: str = "fold",
                      k: int = 5) -> dict:
    """M9 for ordinary least squares in two passes, whatever ``k``.

    Pass 1 aggregates, per fold, the Gram sums of ``z = (1, x...)`` and
    ``z·y`` (``k × O(d²)`` numbers).  The fit without fold ``f`` is
    ``total − fold f``, solved on the driver (d+1 unknowns).  Pass 2 scores
    every held-out row with its fold's coefficients and aggregates the fold
    metrics.  A first pass takes the means, so the sums are of centred values
    and the solve is well conditioned.  A missing feature or label is an error,
    as it is for the assembler that this stands for."""
    import numpy as np
    d = len(feats)
    ok = F.lit(True)
    for x in [*feats, label]:
        ok = ok & c(x).isNotNull()
    data = train
    first = train.agg(F.count(F.when(~ok, 1)).alias("bad"), *[F.avg(c(x)).alias(f"m{i}") for i, x in enumerate(feats)]).first()
    if first["bad"]:
        raise ValueError(f"{first['bad']} rows have a missing feature or label")
    centred = [c(x).cast("double") - F.lit(float(first[f"m{i}"] or 0.0)) for i, x in enumerate(feats)]
    z = [F.lit(1.0)] + centred
    y = c(label).cast("double")
    aggs = [F.sum(z[i] * z[j]).alias(f"g{i}_{j}") for i in range(d + 1) for j in range(i, d + 1)]
    aggs += [F.sum(z[i] * y).alias(f"h{i}") for i in range(d + 1)]
    rows = {r[fold_col]: r for r in data.groupBy(fold_col).agg(*aggs).collect()}  # k rows
    if not rows:
        return {"r2": None, "mae": None, "rmse": None}

    def mats(r):
        g = np.zeros((d + 1, d + 1))
        for i in range(d + 1):
            for j in range(i, d + 1):
                g[i, j] = g[j, i] = r[f"g{i}_{j}"]
        return g, np.array([r[f"h{i}"] for i in range(d + 1)])

    parts = {f: mats(r) for f, r in rows.items()}
    gt = sum(p[0] for p in parts.values())
    ht = sum(p[1] for p in parts.values())
    coefs = {}
    for f, (gf, hf) in parts.items():
        g, h = gt - gf, ht - hf
        n, mu, my = g[0, 0], g[0, 1:] / g[0, 0], h[0] / g[0, 0]
        cxx = g[1:, 1:] - n * np.outer(mu, mu)
        cxy = h[1:] - n * mu * my
        b = np.linalg.lstsq(cxx, cxy, rcond=None)[0]
        coefs[f] = (float(my - mu @ b), [float(v) for v in b])
    pred = None
    for f, (b0, b) in coefs.items():
        e = F.lit(b0) + sum((F.lit(bj) * x for bj, x in zip(b, centred)), F.lit(0.0))
        pred = F.when(F.col(fold_col) == f, e) if pred is None else pred.when(F.col(fold_col) == f, e)
    per = regression_metrics(data.withColumn("__p", pred), label, "__p", by=[fold_col]).collect()
    per = [r for r in per if r["n"]]
    return {"r2": sum(r["r2"] for r in per) / len(per), "mae": sum(r["mae"] for r in per) / len(per),
            "rmse": (sum(r["mse"] for r in per) / len(per)) ** 0.5}


# -- M10 / J3 / U1 / F4 / F6 ---------------------------------------------------------------------
def evaluate_model(name: str, model: PipelineModel, pipeline: Pipeline | None, train: DataFrame, test: DataFrame,
                   label: str = "y_log", target: str = "target", fold_col: str = "fold", k: int = 5,
                   unit: float = 1e9, cv: bool = True, cvm: dict | None = None) -> DataFrame:
    """One comparison row: CV-log, test-log and test-real metrics (real scale
    bias-corrected with the training factor, MAE/RMSE in ``unit``).  ``cvm`` gives CV metrics that are known already."""
    spark = train.sparkSession
    cvm = cvm or (cv_metrics(pipeline, train, label, fold_col, k) if (cv and pipeline is not None) else
                  {"r2": None, "mae": None, "rmse": None})
    factor = bias_correction(model.transform(train), label)
    scored = to_real(model.transform(test), factor=factor).withColumn("__y", c(target).cast("double"))
    # log and real metrics in one aggregate pass over the scored test rows
    m = scored.agg(*[x.alias(f"l_{n}") for x, n in zip(metric_aggs(label, "prediction"), _AGG_NAMES)],
                   *[x.alias(f"r_{n}") for x, n in zip(metric_aggs("__y", "pred_real"), _AGG_NAMES)]).first()
    lg, rl = _finish(m, "l_"), _finish(m, "r_")
    return spark.createDataFrame(
        [(name, cvm["r2"], cvm["mae"], cvm["rmse"], lg["r2"], lg["mae"], lg["rmse"], rl["r2"],
          _div(rl["mae"], unit), _div(rl["rmse"], unit))],
        "model string, " + ", ".join(f"{x} double" for x in METRIC_COLS))


_AGG_NAMES = ("n", "sse", "var_y", "mae", "mse")


def _div(x, unit):
    return None if x is None else x / unit


def _finish(row, prefix: str) -> dict:
    n, sse, var_y = row[f"{prefix}n"], row[f"{prefix}sse"], row[f"{prefix}var_y"]
    mse = row[f"{prefix}mse"]
    # a constant label: 1 if predicted exactly, else 0, as in metric_cols()
    r2 = None if not n or var_y is None else 1.0 - sse / (n * var_y) if var_y > 0 else float(sse == 0)
    return {"r2": r2, "mae": row[f"{prefix}mae"], "rmse": None if mse is None else math.sqrt(mse)}


def round_metrics(df: DataFrame) -> DataFrame:
    """R² to 4 digits, the other metrics and the time to 2."""
    out = {}
    for x in df.columns:
        if x.startswith("r2"):
            out[x] = round_half_away(x, R2_DIGITS)
        elif x in METRIC_COLS or x == "train_time":
            out[x] = round_half_away(x, METRIC_DIGITS)
    return df.withColumns(out)


def comparison_table(rows: Sequence[DataFrame], times: DataFrame | None = None) -> DataFrame:
    """U1 union of per-model rows, J3 time attached by a left join
    (default 0.0), F6 rounding.  ``row_no`` keeps the insertion order."""
    if not rows:
        raise ValueError("no model rows")
    out = rows[0].withColumn("row_no", F.lit(0))
    for i, r in enumerate(rows[1:], start=1):
        out = out.unionByName(r.withColumn("row_no", F.lit(i)))
    if times is None:
        times = out.sparkSession.createDataFrame([], "model string, train_time double")
    # one row per model on both sides: a broadcast of the time table is bounded
    out = out.join(F.broadcast(times), "model", "left").withColumn("train_time", F.coalesce("train_time", F.lit(0.0)))
    return round_metrics(out)


def comparison_long(table: DataFrame, metrics: Sequence[str] = ("r2_log_cv", "mae_log_cv", "rmse_log_cv", "r2_real",
                                                                "mae_real", "rmse_real")) -> DataFrame:
    """``(model, metric, value)`` for the comparison bar charts."""
    return table.unpivot(["model"], list(metrics), "metric", "value")


# -- T2 / T3 -------------------------------------------------------------------------------------
def best_model(table: DataFrame) -> DataFrame:
    """Highest rounded real R², ties to the shortest training time (then name)."""
    return table.orderBy(F.col("r2_real").desc_nulls_last(), F.col("train_time").asc(), F.col("model")).limit(1)


def best_model_name(table: DataFrame) -> str | None:
    r = best_model(table).select("model").collect()
    return r[0]["model"] if r else None


def serving_model_name(table: DataFrame | None) -> str:
    """First row holding the maximum real R² (no time tie-break); falls
    back to ``SERVING_FALLBACK`` when there is no table, column or row."""
    if table is None:
        return SERVING_FALLBACK
    col = find_column(table.columns, "r^2", "real", fallback_needles=("real",)) or \
        find_column(table.columns, "r2", "real")
    if col is None:
        return SERVING_FALLBACK
    order = [F.col(col).desc_nulls_last()] + ([F.col("row_no")] if "row_no" in table.columns else [])
    r = table.orderBy(*order).limit(1).collect()
    return str(r[0][0] if "model" not in table.columns else r[0]["model"]) if r else SERVING_FALLBACK
