"""Registered source / sink / scoring / orchestration queries (S1–S7, R1,
R3, O1) with their oracle SQL where one exists."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from finlens.operators import clean as cl
from finlens.operators import evaluate as ev
from finlens.plans import eda
from finlens.plans.queries_model import (COMPARE, MF_SQL, OLS_FEATURES, UNIT, _cmp_sql, _ols_fit, comparison, ols_coef_sql,
                                         ols_pred_sql)
from finlens.plans.registry import ACC_WITH, D_PRED, accounts, load_table, register, rnd
from finlens.session import scratch_path
from finlens.sources import files, records, sinks
from finlens.spec import ACCOUNTS
from finlens.streaming import score as sc

ACC_SCHEMA = StructType([
    StructField("id", LongType()), StructField("name", StringType()), StructField("sector", StringType()),
    *[StructField(x, DoubleType()) for x in ("price", "ebitda", "eps", "pe", "volume", "low52", "high52", "target")]])
# Request fields of a scoring record (all required) and their types.
REQUEST = {"id": "long", **{x: "double" for x in ACCOUNTS.numeric}, "sector": "string"}


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# -- S1 ------------------------------------------------------------------------------------------
@register("csv_roundtrip", f"{ACC_WITH} SELECT * FROM accounts")
def q_csv_roundtrip(spark, sf_dir):
    p = _scratch(spark, "accounts-csv")
    files.write_csv(accounts(spark, sf_dir), p, na="NA")
    return files.read_csv(spark, p, ACC_SCHEMA)


def _inferred(x: str, kind: str) -> str:
    """pandas' type: a column that has a missing value is floating point, and so is one of missing values only."""
    if kind == "text":
        return f"SELECT '{x}' AS column, CASE WHEN COUNT({x}) = 0 THEN 'double' ELSE 'string' END AS type FROM accounts"
    return (f"SELECT '{x}' AS column, CASE WHEN COUNT({x}) = COUNT(*) AND COUNT(*) FILTER (CAST({x} AS VARCHAR) NOT SIMILAR TO '[-+]?[0-9]+') = 0 "
            f"THEN 'bigint' ELSE 'double' END AS type FROM accounts")


@register("csv_inferred", f"""{ACC_WITH}
{" UNION ALL ".join(_inferred(f.name, "text" if f.dataType == StringType() else "number") for f in ACC_SCHEMA.fields)}""")
def q_csv_inferred(spark, sf_dir):
    p = _scratch(spark, "accounts-csv")
    files.write_csv(accounts(spark, sf_dir), p, na="NA")
    got = files.read_csv_inferred(spark, p)
    return spark.createDataFrame(got.dtypes, "column string, type string")


@register("csv_bad_values", f"""{ACC_WITH}
SELECT 'id' AS column, 0 AS bad_values UNION ALL SELECT 'name', COUNT(name) FROM accounts
UNION ALL SELECT 'price', 0 UNION ALL SELECT 'target', 0""")
def q_csv_bad_values(spark, sf_dir):
    p = _scratch(spark, "accounts-csv")
    files.write_csv(accounts(spark, sf_dir).select("id", "name", "price", "target"), p, na="NA")
    # read ``name`` as a number: every present name is a counted bad value
    sch = StructType([StructField("id", LongType()), StructField("name", DoubleType()),
                      StructField("price", DoubleType()), StructField("target", DoubleType())])
    raw = files.read_csv_raw(spark, p, sch)
    return files.bad_values(raw, sch).withColumn("bad_values", F.col("bad_values").cast("long"))


# -- S2 ------------------------------------------------------------------------------------------
def _records(spark, sf_dir):
    acc = cl.drop_duplicates(accounts(spark, sf_dir))
    return records.to_records(acc, list(REQUEST))


_REASON = "NULLIF(CONCAT_WS(',', " + ", ".join(f"CASE WHEN {x} IS NULL THEN 'missing:{x}' END" for x in REQUEST) + "), '')"


@register("json_records", f"""{ACC_WITH}
SELECT id, reason IS NULL AS valid, reason FROM (SELECT id, {_REASON} AS reason FROM (SELECT DISTINCT * FROM accounts) d) r""")
def q_json_records(spark, sf_dir):
    parsed = records.parse_records(_records(spark, sf_dir), "value", REQUEST)
    return parsed.select("id", "valid", "reason")


@register("json_props", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       json_extract_string(props, '$.k') IS NOT NULL AS valid FROM events""")
def q_json_props(spark, sf_dir):
    ev_ = load_table(spark, sf_dir, "events")
    return records.parse_records(ev_, "props", {"k": "double"}, keep=["event_id"]).select("event_id", "k", "valid")


# -- R1 / R3 / F3 --------------------------------------------------------------------------------
SCORE_SQL = f"""{MF_SQL}, co AS ({ols_coef_sql(OLS_FEATURES, 'tr')})
SELECT t.id, ROUND((EXP({ols_pred_sql(OLS_FEATURES)}) - 1) / {UNIT}, 4) AS predicted
FROM (SELECT DISTINCT * FROM accounts) t, co
WHERE {" AND ".join(f"t.{x} IS NOT NULL" for x in REQUEST)}"""


@register("score_batch", SCORE_SQL)
def q_score_batch(spark, sf_dir):
    model, _, _ = _ols_fit(spark, sf_dir)
    out = sc.score(model, _records(spark, sf_dir), REQUEST)
    return rnd(out.select("id", (F.col("predicted") / UNIT).alias("predicted")), {"predicted": 4})


@register("score_stream", SCORE_SQL)
def q_score_stream(spark, sf_dir):
    model, _, _ = _ols_fit(spark, sf_dir)
    src = _scratch(spark, "records-in")
    _records(spark, sf_dir).write.mode("overwrite").text(src)
    out = sc.score_stream(spark, model, src, _scratch(spark, "scored-out"), _scratch(spark, "scored-ckpt"),
                          REQUEST, ["id", "predicted"])
    return rnd(out.select("id", (F.col("predicted") / UNIT).alias("predicted")), {"predicted": 4})


# -- S5 / S6 -------------------------------------------------------------------------------------
@register("model_roundtrip", f"""{MF_SQL}, co AS ({ols_coef_sql(OLS_FEATURES, 'tr')})
SELECT t.id, ROUND({ols_pred_sql(OLS_FEATURES)}, {D_PRED}) AS prediction FROM te t, co""")
def q_model_roundtrip(spark, sf_dir):
    model, _, te = _ols_fit(spark, sf_dir)
    base = _scratch(spark, "models")
    sinks.save_model(model, base, "Linear Regression")
    loaded = sinks.load_model(base, "Linear Regression", required=True)
    assert sinks.load_model(base, "no such model") is None
    return rnd(loaded.transform(te).select("id", "prediction"), {"prediction": D_PRED})


# -- T3 -> S6 -> R1: the stored table names the model that serves -----------------------------------
def _served_sql() -> str:
    need = " AND ".join(f"t.{x} IS NOT NULL" for x in REQUEST)
    rows = " UNION ALL ".join(
        f"""SELECT t.id, sv.model, ROUND((EXP({ols_pred_sql(feats)}) - 1) / {UNIT}, 4) AS predicted, NULL AS reason
FROM (SELECT DISTINCT * FROM accounts) t, ({ols_coef_sql(feats, 'tr')}) co, sv WHERE sv.model = '{name}' AND {need}""" for name, feats in COMPARE)
    return f"""{_cmp_sql()}, sv AS (SELECT model FROM cmp ORDER BY r2_real DESC, row_no LIMIT 1)
{rows}
UNION ALL SELECT id, sv.model, NULL AS predicted, reason FROM (SELECT id, {_REASON} AS reason FROM (SELECT DISTINCT * FROM accounts) d) r, sv
WHERE reason IS NOT NULL"""


@register("served", _served_sql())
def q_served(spark, sf_dir):
    """Every compared model is stored, the stored table selects one, which is read back and scores the records; records that
    it cannot score come with the reason."""
    base = _scratch(spark, "served")
    table = comparison(spark, sf_dir, save=lambda name, model: sinks.save_model(model, f"{base}/models", name))
    sinks.write_table(table, f"{base}/comparison")
    name = ev.serving_model_name(sinks.read_table(spark, f"{base}/comparison"))
    model = sinks.load_model(f"{base}/models", name, required=True)
    recs = _records(spark, sf_dir)
    ok = sc.score(model, recs, REQUEST).select("id", (F.col("predicted") / UNIT).alias("predicted"), F.lit(None).cast("string").alias("reason"))
    bad = sc.rejects(recs, REQUEST).select(F.get_json_object("record", "$.id").cast("long").alias("id"), F.lit(None).cast("double").alias("predicted"), "reason")
    return rnd(ok.unionByName(bad).select("id", F.lit(name).alias("model"), "predicted", "reason"), {"predicted": 4})


# -- S3 / S4 -------------------------------------------------------------------------------------
@register("comparison_roundtrip", f"{_cmp_sql()} SELECT * FROM cmp")
def q_comparison_roundtrip(spark, sf_dir):
    p = _scratch(spark, "comparison")
    sinks.write_table(comparison(spark, sf_dir), p)
    return sinks.read_table(spark, p)


# -- S7 / O1 (rows) ------------------------------------------------------------------------------
@register("report")
def q_report(spark, sf_dir):
    from finlens.operators import explain as xp
    t = comparison(spark, sf_dir)
    model, tr, te = _ols_fit(spark, sf_dir)
    att = xp.linear_attributions(model, tr, te, list(OLS_FEATURES), key="id")
    paths = sinks.write_report(_scratch(spark, "report"), t, ev.best_model_name(t), xp.insights(att))
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(name))
             for name, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table", "rows")


@register("eda")
def q_eda(spark, sf_dir):
    return eda.summary(eda.profile(accounts(spark, sf_dir), ACCOUNTS))
