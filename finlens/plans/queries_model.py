"""Registered split / preparation / model / evaluation / attribution queries.

The SQL-checked chain is: accounts -> clean -> target present -> md5 split and
folds -> ordinary least squares of ``log1p(target)`` (closed form in SQL) ->
bias-corrected real scale -> metrics, comparison, selection, attribution.
Boosted models, the search and the tree / sampled attributions are checked
by row count (plus properties in ``tests/``).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlens.functions.exprs import pct_error
from finlens.operators import boosting
from finlens.operators import clean as cl
from finlens.operators import evaluate as ev
from finlens.operators import explain as xp
from finlens.operators import models as md
from finlens.operators import prep
from finlens.operators import split
from finlens.plans.queries_profile import CLEAN_SQL
from finlens.plans.registry import ACC_WITH, D_LOG, D_PRED, accounts, load_table, register, rnd
from finlens.spec import ACCOUNTS

UNIT = 1e6  # accounts money is reported in millions
OLS_FEATURES = ("volume", "price")
_H = "(('0x' || SUBSTRING(MD5('{salt}|' || CAST(id AS VARCHAR)), 1, 8))::BIGINT % {m})"

MF_SQL = f"""{ACC_WITH}, c AS ({CLEAN_SQL}),
mf AS (SELECT *, LN(1 + target) AS y_log, {_H.format(salt='42', m=100)} < 20 AS is_test,
              CAST({_H.format(salt='fold42', m=5)} AS INTEGER) AS fold
       FROM c WHERE target IS NOT NULL),
tr AS (SELECT * FROM mf WHERE NOT is_test), te AS (SELECT * FROM mf WHERE is_test)"""


def model_frame(spark, sf_dir) -> DataFrame:
    df = cl.clean(accounts(spark, sf_dir), ACCOUNTS).where(F.col("target").isNotNull())
    df = cl.log_target(df, "target")
    return split.with_folds(split.with_split(df, "id"), "id")


def _split(spark, sf_dir):
    mf = model_frame(spark, sf_dir)
    return mf.where(~F.col("is_test")), mf.where(F.col("is_test"))


def ols_pipeline(features=OLS_FEATURES, label="y_log") -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"),
                            LinearRegression(featuresCol="features", labelCol=label, solver="normal", regParam=0.0)])


# -- SQL builders for the least-squares oracle -------------------------------------------------
def ols_coef_sql(feats, src: str, by: str | None = None) -> str:
    """Closed-form OLS coefficients (1 or 2 features) from population moments."""
    g = f"{by}, " if by else ""
    gb = f" GROUP BY {by}" if by else ""
    if len(feats) == 1:
        (a,) = feats
        return (f"SELECT {g}AVG(y_log) AS my, AVG({a}) AS m1, COVAR_POP({a}, y_log) / VAR_POP({a}) AS b1, "
                f"0.0 AS m2, 0.0 AS b2 FROM {src}{gb}")
    a, b = feats
    return f"""SELECT {g}my, m1, m2, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
       (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM (
  SELECT {g}AVG(y_log) AS my, AVG({a}) AS m1, AVG({b}) AS m2, VAR_POP({a}) AS s11, VAR_POP({b}) AS s22,
         COVAR_POP({a}, {b}) AS s12, COVAR_POP({a}, y_log) AS s1y, COVAR_POP({b}, y_log) AS s2y FROM {src}{gb}) m"""


def ols_pred_sql(feats, co: str = "co", row: str = "t") -> str:
    a = feats[0]
    b = feats[1] if len(feats) > 1 else None
    return f"({co}.my + {co}.b1 * ({row}.{a} - {co}.m1)" + (f" + {co}.b2 * ({row}.{b} - {co}.m2))" if b else ")")


# -- J4 / J5 / J6 / J1 ---------------------------------------------------------------------------
@register("split", f"{MF_SQL} SELECT id, is_test FROM mf")
def q_split(spark, sf_dir):
    return model_frame(spark, sf_dir).select("id", "is_test")


@register("folds", f"{MF_SQL} SELECT id, fold FROM mf")
def q_folds(spark, sf_dir):
    return model_frame(spark, sf_dir).select("id", "fold")


@register("sample", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY MD5('s42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100
""")
def q_sample(spark, sf_dir):
    return split.bounded_sample(load_table(spark, sf_dir, "orders"), "o_orderkey", 100).select("o_orderkey",
                                                                                                "o_totalprice")


@register("test_labels", f"{MF_SQL} SELECT te.id, n.name FROM te JOIN (SELECT DISTINCT id, name FROM accounts) n ON te.id = n.id")
def q_test_labels(spark, sf_dir):
    _, te = _split(spark, sf_dir)
    names = accounts(spark, sf_dir).select("id", "name").dropDuplicates()
    return split.label_lookup(te.select("id"), names, "id")


# -- E1–E8 ---------------------------------------------------------------------------------------
_NUM = ACCOUNTS.numeric


def _impute_sql() -> str:
    med = ", ".join(f"QUANTILE_CONT({x}, 0.5) AS med_{x}" for x in _NUM)
    return f"""md AS (SELECT {med} FROM tr),
mo AS (SELECT sector AS mode_sector FROM tr WHERE sector IS NOT NULL GROUP BY sector ORDER BY COUNT(*) DESC, sector LIMIT 1),
imp AS (SELECT mf.id, {", ".join(f"COALESCE({x}, med_{x}) AS {x}" for x in _NUM)}, COALESCE(sector, mode_sector) AS sector,
               mf.is_test FROM mf, md, mo)"""


@register("impute", f"""{MF_SQL}, {_impute_sql()}
SELECT id, {", ".join(f"ROUND({x}, 6) AS {x}" for x in _NUM)}, sector FROM imp""")
def q_impute(spark, sf_dir):
    tr, _ = _split(spark, sf_dir)
    mf = model_frame(spark, sf_dir)
    imp = prep.ExactMedianImputer(inputCols=list(_NUM), outputCols=list(_NUM)).fit(tr)
    mode = prep.ModeImputer(inputCol="sector", outputCol="sector").fit(tr)
    out = mode.transform(imp.transform(mf)).select("id", *_NUM, "sector")
    return rnd(out, {x: 6 for x in _NUM})


def _scale_sql() -> str:
    q = ", ".join(f"QUANTILE_CONT({x}, 0.25) AS q1_{x}, QUANTILE_CONT({x}, 0.5) AS md_{x}, "
                  f"QUANTILE_CONT({x}, 0.75) AS q3_{x}" for x in _NUM)
    sc = ", ".join(f"({x} - md_{x}) / CASE WHEN q3_{x} - q1_{x} = 0 THEN 1.0 ELSE q3_{x} - q1_{x} END AS {x}"
                   for x in _NUM)
    return f"""qs AS (SELECT {q} FROM imp WHERE NOT is_test),
scl AS (SELECT id, {sc}, sector, is_test FROM imp, qs)"""


@register("robust_scale", f"""{MF_SQL}, {_impute_sql()}, {_scale_sql()}
SELECT id, {", ".join(f"ROUND({x}, 6) AS {x}" for x in _NUM)} FROM scl""")
def q_robust_scale(spark, sf_dir):
    tr, _ = _split(spark, sf_dir)
    mf = model_frame(spark, sf_dir)
    pm = Pipeline(stages=[prep.ExactMedianImputer(inputCols=list(_NUM), outputCols=list(_NUM)),
                          prep.ExactRobustScaler(inputCols=list(_NUM), outputCols=list(_NUM))]).fit(tr)
    return rnd(pm.transform(mf).select("id", *_NUM), {x: 6 for x in _NUM})


def _onehot_sql() -> str:
    return """cats AS (SELECT DISTINCT COALESCE(sector, (SELECT mode_sector FROM mo)) AS cat FROM tr),
oh AS (SELECT imp.id, 'sector=' || cats.cat AS feature, CASE WHEN imp.sector = cats.cat THEN 1.0 ELSE 0.0 END AS value
       FROM imp, cats)"""


@register("one_hot", f"""{MF_SQL}, {_impute_sql()}, {_onehot_sql()}
SELECT id, feature, value FROM oh""")
def q_one_hot(spark, sf_dir):
    out = _prepared_long(spark, sf_dir)
    return out.where(F.col("feature").startswith("sector=")).withColumn("value", F.round("value", 0))


def _prepared_long(spark, sf_dir) -> DataFrame:
    tr, _ = _split(spark, sf_dir)
    mf = model_frame(spark, sf_dir)
    pm = prep.build_prep_pipeline(ACCOUNTS).fit(tr)
    scored = pm.transform(mf)
    names = prep.feature_names(scored, spec=ACCOUNTS)
    arr = scored.select("id", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    name_col = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("slot") + 1)
    return arr.select("id", name_col.alias("feature"), "value")


@register("prepared", f"""{MF_SQL}, {_impute_sql()}, {_scale_sql()}, {_onehot_sql()}
{" UNION ALL ".join(f"SELECT id, '{x}' AS feature, ROUND({x}, 6) AS value FROM scl" for x in _NUM)}
UNION ALL SELECT id, feature, value FROM oh""")
def q_prepared(spark, sf_dir):
    return rnd(_prepared_long(spark, sf_dir), {"value": 6})


# -- M1 / P12 / A17 / M7 -------------------------------------------------------------------------
def _ols_fit(spark, sf_dir, features=OLS_FEATURES):
    tr, te = _split(spark, sf_dir)
    tr = tr.cache()
    model = ols_pipeline(features).fit(tr)
    return model, tr, te


@register("ols_predict", f"""{MF_SQL}, co AS ({ols_coef_sql(OLS_FEATURES, 'tr')})
SELECT t.id, ROUND({ols_pred_sql(OLS_FEATURES)}, {D_PRED}) AS prediction FROM te t, co""")
def q_ols_predict(spark, sf_dir):
    model, _, te = _ols_fit(spark, sf_dir)
    return rnd(model.transform(te).select("id", "prediction"), {"prediction": D_PRED})


@register("ols_metrics", f"""{MF_SQL}, co AS ({ols_coef_sql(OLS_FEATURES, 'tr')}),
p AS (SELECT t.y_log, {ols_pred_sql(OLS_FEATURES)} AS prediction FROM te t, co)
SELECT COUNT(*) AS n, ROUND(1 - SUM((y_log - prediction) * (y_log - prediction)) / (COUNT(*) * VAR_POP(y_log)), {D_LOG}) AS r2,
       ROUND(AVG(ABS(y_log - prediction)), {D_LOG}) AS mae,
       ROUND(SQRT(AVG((y_log - prediction) * (y_log - prediction))), {D_LOG}) AS rmse FROM p""")
def q_ols_metrics(spark, sf_dir):
    model, _, te = _ols_fit(spark, sf_dir)
    m = ev.regression_metrics(model.transform(te), "y_log", "prediction").drop("mse")
    return rnd(m, {"r2": D_LOG, "mae": D_LOG, "rmse": D_LOG})


@register("real_scale", f"""{MF_SQL}, co AS ({ols_coef_sql(OLS_FEATURES, 'tr')}),
bf AS (SELECT EXP(AVG(t.y_log) - AVG({ols_pred_sql(OLS_FEATURES)})) AS f FROM tr t, co)
SELECT t.id, ROUND((EXP({ols_pred_sql(OLS_FEATURES)}) - 1) * bf.f / {UNIT}, 4) AS pred_real,
       ROUND((EXP({ols_pred_sql(OLS_FEATURES)}) - 1) / {UNIT}, 4) AS pred_real_raw,
       ROUND(t.target / {UNIT}, 4) AS actual FROM te t, co, bf""")
def q_real_scale(spark, sf_dir):
    model, tr, te = _ols_fit(spark, sf_dir)
    f = ev.bias_correction(model.transform(tr))
    out = ev.to_real(model.transform(te), factor=f)  # F2
    out = ev.to_real(out, out="pred_real_raw")  # serving path, no correction
    out = out.select("id", (F.col("pred_real") / UNIT).alias("pred_real"),
                     (F.col("pred_real_raw") / UNIT).alias("pred_real_raw"), (F.col("target") / UNIT).alias("actual"))
    return rnd(out, {"pred_real": 4, "pred_real_raw": 4, "actual": 4})


@register("bias_scale", f"""{MF_SQL}, part AS (SELECT * FROM tr WHERE fold <> 0), co AS ({ols_coef_sql(OLS_FEATURES, 'part')}),
bf AS (SELECT EXP(AVG(t.y_log) - AVG({ols_pred_sql(OLS_FEATURES)})) AS f FROM tr t, co)
SELECT t.id, ROUND(bf.f, 8) AS factor, ROUND((EXP({ols_pred_sql(OLS_FEATURES)}) - 1) * bf.f / {UNIT}, 4) AS pred_real FROM te t, co, bf""")
def q_bias_scale(spark, sf_dir):
    """F2 where it matters: a model of four folds is biased on all training rows, so the factor is not 1."""
    tr, te = _split(spark, sf_dir)
    model = ols_pipeline().fit(tr.where("fold <> 0"))
    f = ev.bias_correction(model.transform(tr))
    out = ev.to_real(model.transform(te), factor=f).select("id", F.lit(f).alias("factor"), (F.col("pred_real") / UNIT).alias("pred_real"))
    return rnd(out, {"factor": 8, "pred_real": 4})


# -- M9 ------------------------------------------------------------------------------------------
def _cv_sql(feats, name: str) -> str:
    """Per-fold closed-form fit on the other folds, metrics on the held-out one."""
    return f"""cvf_{name} AS (SELECT f.k, t.* FROM (SELECT DISTINCT fold AS k FROM tr) f JOIN tr t ON t.fold <> f.k),
cvc_{name} AS ({ols_coef_sql(feats, f'cvf_{name}', by='k')}),
cvp_{name} AS (SELECT t.fold, t.y_log, {ols_pred_sql(feats, 'co')} AS p FROM tr t JOIN cvc_{name} co ON co.k = t.fold),
cvm_{name} AS (SELECT fold, 1 - SUM((y_log - p) * (y_log - p)) / (COUNT(*) * VAR_POP(y_log)) AS r2,
                 AVG(ABS(y_log - p)) AS mae, AVG((y_log - p) * (y_log - p)) AS mse FROM cvp_{name} GROUP BY fold),
cv_{name} AS (SELECT AVG(r2) AS r2, AVG(mae) AS mae, SQRT(AVG(mse)) AS rmse FROM cvm_{name})"""


@register("cv_metrics", f"""{MF_SQL}, {_cv_sql(OLS_FEATURES, 'a')}
SELECT ROUND(r2, {D_LOG}) AS r2, ROUND(mae, {D_LOG}) AS mae, ROUND(rmse, {D_LOG}) AS rmse FROM cv_a""")
def q_cv_metrics(spark, sf_dir):
    tr, _ = _split(spark, sf_dir)
    m = ev.cv_metrics(ols_pipeline(), tr.cache(), "y_log", "fold", 5)
    out = spark.createDataFrame([(m["r2"], m["mae"], m["rmse"])], "r2 double, mae double, rmse double")
    return rnd(out, {"r2": D_LOG, "mae": D_LOG, "rmse": D_LOG})


# -- M10 / U1 / J3 / T2 / T3 / C9 ----------------------------------------------------------------
# Fixed values of the registered comparison: three least-squares feature sets.
COMPARE = (("ols_volume_price", ("volume", "price")), ("ols_volume", ("volume",)), ("ols_price_high", ("price", "high52")))


def _cmp_row_sql(name: str, feats, row_no: int) -> str:
    pred = ols_pred_sql(feats, "co")
    return f"""SELECT '{name}' AS model, cv.r2 AS r2_log_cv, cv.mae AS mae_log_cv, cv.rmse AS rmse_log_cv,
  1 - SUM((t.y_log - {pred}) * (t.y_log - {pred})) / (COUNT(*) * VAR_POP(t.y_log)) AS r2_log,
  AVG(ABS(t.y_log - {pred})) AS mae_log, SQRT(AVG((t.y_log - {pred}) * (t.y_log - {pred}))) AS rmse_log,
  1 - SUM((t.target - (EXP({pred}) - 1) * bf.f) * (t.target - (EXP({pred}) - 1) * bf.f)) / (COUNT(*) * VAR_POP(t.target)) AS r2_real,
  AVG(ABS(t.target - (EXP({pred}) - 1) * bf.f)) / {UNIT} AS mae_real,
  SQRT(AVG((t.target - (EXP({pred}) - 1) * bf.f) * (t.target - (EXP({pred}) - 1) * bf.f))) / {UNIT} AS rmse_real,
  {row_no} AS row_no
FROM te t, ({ols_coef_sql(feats, 'tr')}) co, cv_{name} cv,
     (SELECT EXP(AVG(t2.y_log) - AVG({ols_pred_sql(feats, 'c2', 't2')})) AS f FROM tr t2, ({ols_coef_sql(feats, 'tr')}) c2) bf
GROUP BY cv.r2, cv.mae, cv.rmse, bf.f"""


def _cmp_sql() -> str:
    ctes = ", ".join(_cv_sql(f, n) for n, f in COMPARE)
    rows = " UNION ALL ".join(_cmp_row_sql(n, f, i) for i, (n, f) in enumerate(COMPARE))
    r = lambda x, d: f"ROUND({x}, {d}) AS {x}"
    sel = ", ".join([r("r2_log_cv", 4), r("mae_log_cv", 2), r("rmse_log_cv", 2), r("r2_log", 4), r("mae_log", 2),
                     r("rmse_log", 2), r("r2_real", 4), r("mae_real", 2), r("rmse_real", 2)])
    return f"""{MF_SQL}, {ctes}, raw AS ({rows}),
cmp AS (SELECT model, {sel}, 0.0 AS train_time, row_no FROM raw)"""


def comparison(spark, sf_dir, cv: bool = True, save=None) -> DataFrame:
    """The comparison table; ``save(name, model)`` is called for every fitted model."""
    tr, te = _split(spark, sf_dir)
    tr, te = tr.cache(), te.cache()
    rows = []
    for name, feats in COMPARE:
        pipe = ols_pipeline(feats)
        model = pipe.fit(tr)
        if save:
            save(name, model)
        rows.append(ev.evaluate_model(name, model, pipe, tr, te, unit=UNIT, cv=cv))
    return ev.comparison_table(rows)


@register("comparison", f"{_cmp_sql()} SELECT * FROM cmp")
def q_comparison(spark, sf_dir):
    return comparison(spark, sf_dir)


@register("best_model", f"""{_cmp_sql()}
SELECT 'best' AS rule, (SELECT model FROM cmp ORDER BY r2_real DESC, train_time, model LIMIT 1) AS model
UNION ALL
SELECT 'serving' AS rule, (SELECT model FROM cmp ORDER BY r2_real DESC, row_no LIMIT 1) AS model""")
def q_best_model(spark, sf_dir):
    t = comparison(spark, sf_dir).cache()
    return spark.createDataFrame([("best", ev.best_model_name(t)), ("serving", ev.serving_model_name(t))],
                                 "rule string, model string")


@register("comparison_long", f"""{_cmp_sql()}
SELECT model, metric, value FROM cmp
UNPIVOT (value FOR metric IN (r2_log_cv, mae_log_cv, rmse_log_cv, r2_real, mae_real, rmse_real))""")
def q_comparison_long(spark, sf_dir):
    return ev.comparison_long(comparison(spark, sf_dir))


# -- M5 ------------------------------------------------------------------------------------------
# Fixed values of the registered vote: two least-squares members and weights.
ENSEMBLE = ((("volume", "price"), 0.7), (("volume",), 0.3))


@register("ensemble", f"""{MF_SQL}, c1 AS ({ols_coef_sql(ENSEMBLE[0][0], 'tr')}), c2 AS ({ols_coef_sql(ENSEMBLE[1][0], 'tr')})
SELECT t.id, ROUND(({ENSEMBLE[0][1]} * {ols_pred_sql(ENSEMBLE[0][0], 'c1')} + {ENSEMBLE[1][1]} * {ols_pred_sql(ENSEMBLE[1][0], 'c2')})
                   / {ENSEMBLE[0][1] + ENSEMBLE[1][1]}, {D_PRED}) AS prediction FROM te t, c1, c2""")
def q_ensemble(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    asm = [VectorAssembler(inputCols=list(f), outputCol=f"f{i}") for i, (f, _) in enumerate(ENSEMBLE)]
    members = [LinearRegression(featuresCol=f"f{i}", labelCol="y_log", solver="normal", regParam=0.0)
               for i in range(len(ENSEMBLE))]
    vote = md.VotingRegressor(members=members, weights=[w for _, w in ENSEMBLE], labelCol="y_log")
    model = Pipeline(stages=[*asm, vote]).fit(tr)
    return rnd(model.transform(te).select("id", "prediction"), {"prediction": D_PRED})


# -- M2–M4, M6, M8 (rows) ------------------------------------------------------------------------
def _family_predict(spark, sf_dir, family: str, params: dict | None = None) -> DataFrame:
    tr, te = _split(spark, sf_dir)
    model, secs = md.train_model(family, params or {}, prep.build_prep_pipeline(ACCOUNTS), tr.cache())
    return model.transform(te).select("id", "prediction", F.lit(family).alias("model"))


@register("gbt")
def q_gbt(spark, sf_dir):
    return _family_predict(spark, sf_dir, "GradientBoosting")


@register("gbt_subsample")
def q_gbt_subsample(spark, sf_dir):
    return _family_predict(spark, sf_dir, "XGBoost", {"subsample": 0.8})  # every tree sees 80 % of the rows


@register("gbt_leaves")
def q_gbt_leaves(spark, sf_dir):
    return _family_predict(spark, sf_dir, "LightGBM")


# the first tree of a booster over two columns without missing values, by SQL: bin edges, the rows drawn by hash, second-order gains
_ROOT = boosting.Boost(n_estimators=1, learning_rate=0.3, max_depth=1, subsample=0.8)
_LEAF = boosting.Boost(n_estimators=1, learning_rate=0.1, max_depth=0, num_leaves=2, l2=0.0, min_rows=20)


def _root_sql(b: boosting.Boost) -> str:
    odd = (2 * b.seed + 1) * 2654435761 % (1 << 32)
    long = " UNION ALL ".join(f"SELECT {i} AS f, {x} AS x, g, used FROM gr" for i, x in enumerate(OLS_FEATURES))
    names = " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(OLS_FEATURES))
    return f"""{MF_SQL}, b AS (SELECT ROUND(AVG(y_log), 12) AS base FROM tr),
gr AS (SELECT tr.*, base - y_log AS g, (CAST(CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) AS HUGEINT) * {odd}) % 4294967296 < {int(b.subsample * (1 << 32))} AS used FROM tr, b),
lg AS ({long}),
ed AS (SELECT DISTINCT f, x AS e FROM (SELECT f, x, ROW_NUMBER() OVER (PARTITION BY f ORDER BY x) AS rn, COUNT(*) OVER (PARTITION BY f) AS n, MAX(x) OVER (PARTITION BY f) AS mx FROM lg)
       WHERE (rn * {boosting.BINS}) // n > ((rn - 1) * {boosting.BINS}) // n AND x < mx),
sp AS (SELECT ed.f, e, SUM(CASE WHEN x <= e THEN g ELSE 0 END) AS gl, COUNT(*) FILTER (x <= e) AS nl, SUM(g) AS gt, COUNT(*) AS nt FROM ed JOIN lg ON lg.f = ed.f AND used GROUP BY ed.f, e),
ga AS (SELECT *, 0.5 * (gl * gl / (nl + {b.l2}) + (gt - gl) * (gt - gl) / (nt - nl + {b.l2}) - gt * gt / (nt + {b.l2})) AS gain FROM sp WHERE nl >= {b.min_rows} AND nt - nl >= {b.min_rows})
SELECT CASE f {names} END AS feature, ROUND(e, 6) AS threshold, ROUND(-{b.learning_rate} * gl / (nl + {b.l2}), 6) AS left_value,
       ROUND(-{b.learning_rate} * (gt - gl) / (nt - nl + {b.l2}), 6) AS right_value, ROUND(base, 6) AS base FROM ga, b ORDER BY gain DESC, f, e LIMIT 1"""


def _root(spark, sf_dir, b: boosting.Boost) -> DataFrame:
    tr, _ = _split(spark, sf_dir)
    rows = VectorAssembler(inputCols=list(OLS_FEATURES), outputCol="features").transform(tr)
    e = boosting.HistogramBooster(b, labelCol="y_log", keyCol="id").fit(rows).ensemble
    t = e.trees[0]
    row = (OLS_FEATURES[t.feature[0]], t.threshold[0], t.value[t.left[0]], t.value[t.right[0]], e.base)
    out = spark.createDataFrame([row], "feature string, threshold double, left_value double, right_value double, base double")
    return rnd(out, {x: 6 for x in ("threshold", "left_value", "right_value", "base")})


@register("boost_root", _root_sql(_ROOT))
def q_boost_root(spark, sf_dir):
    return _root(spark, sf_dir, _ROOT)


@register("leaf_root", _root_sql(_LEAF))
def q_leaf_root(spark, sf_dir):
    return _root(spark, sf_dir, _LEAF)


# M6 over a family at its whole budget is not registered: ten trials of five folds and up to 300 trees take thousands of jobs.


# -- X1 / X5 / X6 / A18 / T4 / T5 / C10 ----------------------------------------------------------
def _linear_attrib(spark, sf_dir):
    model, tr, te = _ols_fit(spark, sf_dir)
    return xp.linear_attributions(model, tr, te, list(OLS_FEATURES), key="id"), model, tr, te


_ATTR_SQL = f"""{MF_SQL}, co AS ({ols_coef_sql(OLS_FEATURES, 'tr')}),
att AS ({" UNION ALL ".join(f"SELECT t.id, '{x}' AS feature, co.b{i + 1} * (t.{x} - co.m{i + 1}) AS phi, t.{x} AS value FROM te t, co"
                            for i, x in enumerate(OLS_FEATURES))})"""


@register("linear_attrib", f"{_ATTR_SQL} SELECT id, feature, ROUND(phi, 6) AS phi, ROUND(value, 6) AS value FROM att")
def q_linear_attrib(spark, sf_dir):
    att, *_ = _linear_attrib(spark, sf_dir)
    return rnd(att, {"phi": 6, "value": 6})


@register("insights", f"""{_ATTR_SQL}, imp AS (SELECT feature, AVG(ABS(phi)) AS mean_abs FROM att GROUP BY feature)
SELECT feature, ROUND(mean_abs, 4) AS mean_abs, ROW_NUMBER() OVER (ORDER BY mean_abs DESC, feature) AS pos,
       '- ' || feature || ': mean impact ' || printf('%.4f', mean_abs) AS line
FROM imp ORDER BY mean_abs DESC LIMIT 5""")
def q_insights(spark, sf_dir):
    att, *_ = _linear_attrib(spark, sf_dir)
    return rnd(xp.insights(att, top=5), {"mean_abs": 4})


def _worst_sql(k: int = 3) -> str:
    pred = ols_pred_sql(OLS_FEATURES)
    return f"""bf AS (SELECT EXP(AVG(t.y_log) - AVG({pred})) AS f FROM tr t, co),
sc AS (SELECT t.id, t.name, t.target, (EXP({pred}) - 1) * bf.f AS pred_real FROM te t, co, bf),
w AS (SELECT *, ABS(pred_real - target) AS abs_err FROM sc ORDER BY abs_err DESC, id LIMIT {k})"""


@register("worst_errors", f"""{_ATTR_SQL}, {_worst_sql()}
SELECT id, name, ROUND(target / {UNIT}, 4) AS actual, ROUND(pred_real / {UNIT}, 4) AS predicted,
       ROUND(CASE WHEN target <> 0 THEN (pred_real - target) / target * 100 ELSE 0 END, 2) AS pct_error,
       ROW_NUMBER() OVER (ORDER BY abs_err, id) AS pos FROM w""")
def q_worst_errors(spark, sf_dir):
    att, model, tr, te = _linear_attrib(spark, sf_dir)
    w = xp.worst_errors(model, tr, te, key="id", target="target", k=3)
    out = w.select("id", "name", (F.col("target") / UNIT).alias("actual"), (F.col("pred_real") / UNIT).alias("predicted"),
                   pct_error("pred_real", "target").alias("pct_error"), "pos")
    return rnd(out, {"actual": 4, "predicted": 4, "pct_error": 2})


@register("waterfall", f"""{_ATTR_SQL}, {_worst_sql()},
r AS (SELECT a.id, a.feature, a.phi, ROW_NUMBER() OVER (PARTITION BY a.id ORDER BY ABS(a.phi) DESC, a.feature) AS rk
      FROM att a JOIN w ON a.id = w.id)
SELECT id, CASE WHEN rk < 10 THEN feature ELSE 'other' END AS feature, ROUND(SUM(phi), 6) AS phi, MIN(rk) AS rk
FROM r GROUP BY id, CASE WHEN rk < 10 THEN feature ELSE 'other' END""")
def q_waterfall(spark, sf_dir):
    att, model, tr, te = _linear_attrib(spark, sf_dir)
    w = xp.worst_errors(model, tr, te, key="id", target="target", k=3).select("id")
    return rnd(xp.waterfall(att, w, key="id", max_lines=10), {"phi": 6})


@register("tree_attrib")
def q_tree_attrib(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    model, _ = md.train_model("GradientBoosting", {}, prep.build_prep_pipeline(ACCOUNTS), tr.cache())
    return xp.tree_attributions(model, tr, te, key="id", background=100, explain_rows=None)


# a linear model's sampled values are exact: slope times distance from the mean of the backgrounds drawn by hash
_BG_ROWS, _PERMS = 100, 8


# backgrounds are the rows with the least hashes; of a linear model kernel values are exact too
@register("kernel_attrib", f"""{MF_SQL}, co AS ({ols_coef_sql(OLS_FEATURES, 'tr')}),
s AS (SELECT * FROM tr ORDER BY md5('s42|' || CAST(id AS VARCHAR)), id LIMIT {_BG_ROWS}),
m AS (SELECT {', '.join(f'AVG({x}) AS a{i}' for i, x in enumerate(OLS_FEATURES))} FROM s)
{" UNION ALL ".join(f"SELECT id, '{x}' AS feature, ROUND(b{i + 1} * ({x} - a{i}), 6) + 0.0 AS phi, "
                    f"ROUND(my + {' + '.join(f'b{k + 1} * (a{k} - m{k + 1})' for k in range(len(OLS_FEATURES)))}, 6) AS base FROM te, co, m"
                    for i, x in enumerate(OLS_FEATURES))}""")
def q_kernel_attrib(spark, sf_dir):
    model, tr, te = _ols_fit(spark, sf_dir)
    out = xp.kernel_attributions(model, tr, te, list(OLS_FEATURES), key="id", background=_BG_ROWS)
    return rnd(out, {"phi": 6, "base": 6}).withColumn("phi", F.col("phi") + F.lit(0.0))


@register("sampled_attrib", f"""{MF_SQL}, co AS ({ols_coef_sql(OLS_FEATURES, 'tr')}),
s AS (SELECT * FROM tr ORDER BY md5('s42|' || CAST(id AS VARCHAR)), id LIMIT {_BG_ROWS}),
bg AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {', '.join(OLS_FEATURES)}) - 1 AS bi, COUNT(*) OVER () AS nb FROM s),
d AS (SELECT t.id, CAST('0x' || substr(md5('bg42|' || CAST(t.id AS VARCHAR) || '|' || CAST(p AS VARCHAR)), 1, 8) AS BIGINT)
             % (SELECT COUNT(*) FROM s) AS bi FROM te t, range({_PERMS}) r(p)),
m AS (SELECT d.id, {', '.join(f'AVG(bg.{x}) AS a{i}' for i, x in enumerate(OLS_FEATURES))} FROM d JOIN bg ON d.bi = bg.bi GROUP BY d.id),
j AS (SELECT t.*, co.*, {', '.join(f'm.a{i}' for i in range(len(OLS_FEATURES)))} FROM te t JOIN m ON t.id = m.id, co)
{" UNION ALL ".join(f"SELECT id, '{x}' AS feature, ROUND(b{i + 1} * ({x} - a{i}), 6) + 0.0 AS phi, "
                    f"ROUND(my + {' + '.join(f'b{k + 1} * (a{k} - m{k + 1})' for k in range(len(OLS_FEATURES)))}, 6) AS base FROM j"
                    for i, x in enumerate(OLS_FEATURES))}""")
def q_sampled_attrib(spark, sf_dir):
    model, tr, te = _ols_fit(spark, sf_dir)
    out = xp.sampled_attributions(model, tr, te, list(OLS_FEATURES), key="id", background=_BG_ROWS, permutations=_PERMS)
    # rounding may leave a signed zero on either side
    return rnd(out, {"phi": 6, "base": 6}).withColumn("phi", F.col("phi") + F.lit(0.0))
