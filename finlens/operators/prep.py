"""Feature preparation as ``pyspark.ml`` stages.

Fitted statistics are tiny (one number per column, one label list per
category) and are kept as Params, so every stage saves and loads with the
default ML persistence.  Medians and quartiles are exact (distributed rank
table); the built-in ``Imputer`` / ``RobustScaler`` use approximate quantiles.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.functions.exprs import c, nan_to_null, no_nan, safe_name
from finlens.operators import ranks
from finlens.operators.clean import derived_exprs
from finlens.spec import Spec


class _HasSurrogates(Params):
    surrogates = Param(Params._dummy(), "surrogates", "fitted value per input column",
                       typeConverter=TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "fitted scale per input column",
                   typeConverter=TypeConverters.toListFloat)


def _exact(df: DataFrame, cols, probs, names):
    q = ranks.exact_quantiles(no_nan(df, cols), cols, probs, names)
    got = {r["column"]: r for r in q.collect()}  # one row per column: bounded
    return [got.get(x) for x in cols]


# -- E1 ------------------------------------------------------------------------------------------
class ExactMedianImputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fill missing values with the exact training median."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df):
        rows = _exact(df, self.getInputCols(), (0.5,), ("median",))
        med = [float(r["median"]) if r is not None and r["median"] is not None else 0.0 for r in rows]
        return ExactMedianImputerModel(inputCols=self.getInputCols(), outputCols=self.getOutputCols(),
                                       surrogates=med)


class ExactMedianImputerModel(Model, HasInputCols, HasOutputCols, _HasSurrogates, DefaultParamsReadable,
                              DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, surrogates=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        return df.withColumns({o: F.coalesce(nan_to_null(c(i).cast("double")), F.lit(s)) for i, o, s in
                               zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault("surrogates"))})


# -- E2 ------------------------------------------------------------------------------------------
class ExactRobustScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """``(x - median) / (Q3 - Q1)``; a zero IQR scales by 1 (nothing to divide)."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df):
        rows = _exact(df, self.getInputCols(), (0.25, 0.5, 0.75), ("q1", "median", "q3"))
        centers, scales = [], []
        for r in rows:
            if r is None or r["median"] is None:
                centers.append(0.0)
                scales.append(1.0)
                continue
            iqr = float(r["q3"] - r["q1"])
            centers.append(float(r["median"]))
            scales.append(iqr if iqr != 0.0 else 1.0)
        return ExactRobustScalerModel(inputCols=self.getInputCols(), outputCols=self.getOutputCols(),
                                      surrogates=centers, scales=scales)


class ExactRobustScalerModel(Model, HasInputCols, HasOutputCols, _HasSurrogates, DefaultParamsReadable,
                             DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, surrogates=None, scales=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        return df.withColumns({o: (c(i) - F.lit(m)) / F.lit(s) for i, o, m, s in
                               zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault("surrogates"),
                                   self.getOrDefault("scales"))})


# -- E3 ------------------------------------------------------------------------------------------
class ModeImputer(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Most frequent value; ties go to the smallest value.  Computed as a
    partial ``groupBy(value).count`` and a top-1, never a per-group value map."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df):
        col = self.getInputCol()
        top = (no_nan(df, [col]).where(c(col).isNotNull()).groupBy(c(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.col("n").desc(), F.col("v")).limit(1).collect())
        return ModeImputerModel(inputCol=col, outputCol=self.getOutputCol(),
                                fill=str(top[0]["v"]) if top else "")


class ModeImputerModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    fill = Param(Params._dummy(), "fill", "fitted most frequent value", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, fill=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        col = c(self.getInputCol())
        col = nan_to_null(col) if dict(df.dtypes).get(self.getInputCol()) in ("double", "float") else col
        return df.withColumn(self.getOutputCol(), F.coalesce(col, F.lit(self.getOrDefault("fill"))))


# -- D1 ------------------------------------------------------------------------------------------
class DerivedFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """User function stage: ratio and log features as Column expressions
    (idempotent, schema tolerant).  Stored as JSON so it persists with the
    pipeline; no Python UDF is involved."""

    spec_json = Param(Params._dummy(), "spec_json", "ratios and logs as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, spec_json=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @staticmethod
    def from_spec(spec: Spec) -> "DerivedFeatures":
        return DerivedFeatures(spec_json=json.dumps({"ratios": spec.ratios, "logs": spec.logs}))

    def _transform(self, df):
        d = json.loads(self.getOrDefault("spec_json"))
        spec = Spec(key="", target="", category="", numeric=(), ratios=tuple(tuple(r) for r in d["ratios"]),
                    logs=tuple(tuple(x) for x in d["logs"]))
        ex = {k: v for k, v in derived_exprs(spec, df.columns).items() if k not in df.columns}
        return df.withColumns(ex) if ex else df


# -- E4–E6 ---------------------------------------------------------------------------------------
def prep_columns(spec: Spec, use_derived: bool = False) -> list[str]:
    return list(spec.numeric) + (list(spec.derived) if use_derived else [])


def build_prep_pipeline(spec: Spec, use_derived: bool = False, features_col: str = "features") -> Pipeline:
    """Derive -> median impute -> robust scale (numeric) and mode impute ->
    one-hot (category) -> assemble.  ``use_derived=False`` keeps the surveyed
    behaviour where the derived columns are computed but not used."""
    num = prep_columns(spec, use_derived)
    imp = [f"__imp_{safe_name(x)}" for x in num]
    sc = [f"{safe_name(x)}__scaled" for x in num]
    cat = spec.category
    cat_imp, cat_idx, cat_vec = f"__imp_{safe_name(cat)}", f"__idx_{safe_name(cat)}", f"{safe_name(cat)}__onehot"
    stages = [
        DerivedFeatures.from_spec(spec),
        ExactMedianImputer(inputCols=num, outputCols=imp),
        ExactRobustScaler(inputCols=imp, outputCols=sc),
        ModeImputer(inputCol=cat, outputCol=cat_imp),
        StringIndexer(inputCol=cat_imp, outputCol=cat_idx, stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=[cat_idx], outputCols=[cat_vec], dropLast=True),  # unknown index dropped -> zeros
        VectorAssembler(inputCols=[*sc, cat_vec], outputCol=features_col, handleInvalid="keep"),
    ]
    return Pipeline(stages=stages)


def feature_names(df: DataFrame, features_col: str = "features", spec: Spec | None = None) -> list[str]:
    """Names of the vector slots from the ML attribute metadata; numeric
    slots map back to the source column, one-hot slots read ``category=value``.
    Falls back to ``feature_i`` when the metadata is absent."""
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs.extend(group)
    n = meta.get("num_attrs", len(attrs))
    if not attrs:
        return [f"feature_{i}" for i in range(n)]
    names = [f"feature_{i}" for i in range(max(n, max(a["idx"] for a in attrs) + 1))]
    back = {}
    if spec is not None:
        for x in list(spec.numeric) + list(spec.derived):
            back[f"{safe_name(x)}__scaled"] = x
        back_cat = f"{safe_name(spec.category)}__onehot_"
    for a in attrs:
        nm = a.get("name", f"feature_{a['idx']}")
        if spec is not None:
            if nm in back:
                nm = back[nm]
            elif nm.startswith(back_cat):
                nm = f"{spec.category}={nm[len(back_cat):]}"
        names[a["idx"]] = nm
    return names
