"""Registered profiling / cleaning queries (P, A, T1) with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from finlens.operators import clean as cl
from finlens.operators import profile as pf
from finlens.plans.registry import (ACC_NUM, ACC_WITH, D_MONEY, D_STAT, LI_NUM, ORACLE, accounts, load_table,
                                    register, rnd)
from finlens.spec import ACCOUNTS

ACC_COLS = ("id", "name", "sector", "price", "ebitda", "eps", "pe", "volume", "low52", "high52", "target")
EV_NUM = ("event_id", "user_id", "value")


def union_sql(parts) -> str:
    return "\nUNION ALL\n".join(parts)


# -- A13 + T1: the flagship ------------------------------------------------------------------------
@register("group_profile", f"""
{ACC_WITH}
SELECT sector AS category, ROUND(AVG(target), 2) AS target_mean, ROUND(STDDEV_SAMP(target), 2) AS target_std,
       COUNT(target) AS target_count, ROUND(AVG(ebitda), 2) AS second_mean,
       ROUND(QUANTILE_CONT(target, 0.5), 2) AS target_median, ROUND(QUANTILE_CONT(ebitda, 0.5), 2) AS second_median,
       ROW_NUMBER() OVER (ORDER BY AVG(target) DESC, sector) AS pos
FROM accounts WHERE sector IS NOT NULL GROUP BY sector
""")
def q_group_profile(spark, sf_dir):
    out = pf.group_profile(accounts(spark, sf_dir), "sector", "target", "ebitda")
    out = out.withColumnRenamed("group", "category")
    return rnd(out, {k: D_MONEY for k in ("target_mean", "target_std", "second_mean", "target_median",
                                          "second_median")})


# -- P1 .. P4, P9 .. P12 -------------------------------------------------------------------------
@register("dedupe", f"{ACC_WITH} SELECT DISTINCT * FROM accounts")
def q_dedupe(spark, sf_dir):
    return cl.drop_duplicates(accounts(spark, sf_dir))


_CLIP = lambda x: f"CASE WHEN {x} < 0 THEN 0.0 ELSE {x} END"
CLEAN_SQL = f"""
SELECT id, name, sector, price, {_CLIP('ebitda')} AS ebitda, {_CLIP('eps')} AS eps, {_CLIP('pe')} AS pe,
       volume, low52, high52, target
FROM (SELECT DISTINCT * FROM accounts) d WHERE price > 0
"""


@register("clean", f"{ACC_WITH} {CLEAN_SQL}")
def q_clean(spark, sf_dir):
    return cl.clean(accounts(spark, sf_dir), ACCOUNTS)


@register("clean_report", f"""
{ACC_WITH}
SELECT (SELECT COUNT(*) FROM accounts) AS rows_before,
       (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM accounts) d WHERE price > 0) AS rows_after,
       {len(ACC_COLS)} AS columns
""")
def q_clean_report(spark, sf_dir):
    return cl.clean_report(accounts(spark, sf_dir), ACCOUNTS)


_GR = lambda a, b: f"{a} / CASE WHEN {b} < 1e-6 THEN 1e-6 ELSE {b} END"
_LG = lambda a: f"LN(1 + CASE WHEN {a} < 0 THEN 0.0 ELSE {a} END)"


@register("derived_features", f"""
{ACC_WITH}, c AS ({CLEAN_SQL})
SELECT id, ROUND({_GR('ebitda', 'price')}, 6) AS ebitda_price_ratio, ROUND({_GR('eps', 'price')}, 6) AS eps_price_ratio,
       ROUND({_LG('price')}, 6) AS price_log, ROUND({_LG('ebitda')}, 6) AS ebitda_log,
       ROUND({_LG('volume')}, 6) AS volume_log,
       ROUND(LN(1 + target), 6) AS y_log
FROM c
""")
def q_derived(spark, sf_dir):
    df = cl.add_missing_features(cl.clean(accounts(spark, sf_dir), ACCOUNTS), ACCOUNTS)
    df = cl.add_missing_features(df, ACCOUNTS)  # idempotent: second call is a no-op
    df = cl.log_target(df, "target")
    cols = list(ACCOUNTS.derived) + ["y_log"]
    return rnd(df.select("id", *cols), {k: 6 for k in cols})


# -- A1 / A3 / P8 --------------------------------------------------------------------------------
@register("shape", f"""
{ACC_WITH}
{union_sql(f"SELECT '{x}' AS column, COUNT({x}) AS non_null, COUNT(*) AS rows FROM accounts" for x in ACC_COLS)}
""")
def q_shape(spark, sf_dir):
    return pf.shape_info(accounts(spark, sf_dir)).drop("dtype")


@register("null_profile", f"""
{ACC_WITH}, m AS (
{union_sql(f"SELECT '{x}' AS column, COUNT(*) - COUNT({x}) AS count, COUNT(*) AS n FROM accounts" for x in ACC_COLS)})
SELECT "column", "count", ROUND(100.0 * "count" / n, 6) AS percent,
       ROW_NUMBER() OVER (ORDER BY "count" DESC, "column") AS pos
FROM m WHERE "count" > 0
""")
def q_null_profile(spark, sf_dir):
    return rnd(pf.missing_table(accounts(spark, sf_dir)), {"percent": 6})


# -- A2 / P6 -------------------------------------------------------------------------------------
@register("describe", union_sql(
    f"""SELECT '{x}' AS column, COUNT({x}) AS count, ROUND(AVG({x}), 6) AS mean, ROUND(STDDEV_SAMP({x}), 6) AS std,
       ROUND(MIN({x}), 6) AS min, ROUND(MAX({x}), 6) AS max, ROUND(QUANTILE_CONT({x}, 0.25), 6) AS q25,
       ROUND(QUANTILE_CONT({x}, 0.5), 6) AS q50, ROUND(QUANTILE_CONT({x}, 0.75), 6) AS q75 FROM lineitem"""
    for x in LI_NUM))
def q_describe(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    cols = cl.numeric_columns(li)
    out = pf.describe(li, cols)
    return rnd(out, {k: 6 for k in ("mean", "std", "min", "max", "q25", "q50", "q75")})


# -- A4 / C5 / A5 --------------------------------------------------------------------------------
@register("value_counts", f"""
{ACC_WITH}
SELECT sector AS value, COUNT(*) AS count, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, sector) AS pos
FROM accounts WHERE sector IS NOT NULL GROUP BY sector
""")
def q_value_counts(spark, sf_dir):
    return pf.value_counts(accounts(spark, sf_dir), "sector")


@register("value_counts_lineitem", """
SELECT l_returnflag AS value, COUNT(*) AS count, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, l_returnflag) AS pos
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag
""")
def q_value_counts_li(spark, sf_dir):
    return pf.value_counts(load_table(spark, sf_dir, "lineitem"), "l_returnflag")


@register("value_counts_wide", """
SELECT l_extendedprice AS value, COUNT(*) AS count, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, l_extendedprice) AS pos
FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_extendedprice
""")
def q_value_counts_wide(spark, sf_dir):
    return pf.value_counts(load_table(spark, sf_dir, "lineitem"), "l_extendedprice")


@register("nunique", f"""
{ACC_WITH}
{union_sql(f"SELECT '{x}' AS column, COUNT(DISTINCT {x}) AS nunique FROM accounts" for x in ACC_COLS)}
""")
def q_nunique(spark, sf_dir):
    return pf.nunique(accounts(spark, sf_dir), ACC_COLS)


# -- A8 ------------------------------------------------------------------------------------------
@register("normality_tests")
def q_normality_tests(spark, sf_dir):
    """Shapiro-Wilk or Jarque-Bera by the number of values; the normal quantiles have no SQL."""
    both = pf.normality(load_table(spark, sf_dir, "lineitem"), list(LI_NUM))
    return both.unionByName(pf.normality(accounts(spark, sf_dir), list(ACC_NUM)))


# -- A6 / A7 / A8 --------------------------------------------------------------------------------
@register("moments", union_sql(
    f"SELECT '{x}' AS column, COUNT({x}) AS n, ROUND(SKEWNESS({x}), 6) AS skew, ROUND(KURTOSIS({x}), 6) AS kurt "
    f"FROM events" for x in EV_NUM))
def q_moments(spark, sf_dir):
    out = pf.moments(load_table(spark, sf_dir, "events"), EV_NUM).select("column", "n", "skew", "kurt")
    return rnd(out, {"skew": 6, "kurt": 6})


def _jb_sql(x: str, table: str) -> str:
    return f"""SELECT '{x}' AS column, n, ROUND(jb, 4) AS jb, ROUND(EXP(-jb / 2.0), 6) AS jb_p, EXP(-jb / 2.0) > 0.05 AS normal
FROM (SELECT n, n / 6.0 * (g1 * g1 + g2 * g2 / 4.0) AS jb FROM (
  SELECT COUNT(*) AS n, AVG(POWER(v - m, 3)) / POWER(AVG(POWER(v - m, 2)), 1.5) AS g1,
         AVG(POWER(v - m, 4)) / POWER(AVG(POWER(v - m, 2)), 2) - 3 AS g2
  FROM (SELECT {x} AS v, AVG({x}) OVER () AS m FROM {table} WHERE {x} IS NOT NULL) t) s) u"""


@register("normality", union_sql(_jb_sql(x, "events") for x in EV_NUM))
def q_normality(spark, sf_dir):
    out = pf.moments(load_table(spark, sf_dir, "events"), EV_NUM).select("column", "n", "jb", "jb_p", "normal")
    return rnd(out, {"jb": 4, "jb_p": 6})


# -- A10 / A11 / A12 / C6 ------------------------------------------------------------------------
_PAIRS = [(a, b) for i, a in enumerate(ACC_NUM) for b in ACC_NUM[i + 1:]]


@register("pearson", f"""
{ACC_WITH}
{union_sql([f"SELECT '{a}' AS a, '{b}' AS b, ROUND(CORR({a}, {b}), 6) AS r, ROUND(ABS(CORR({a}, {b})), 6) AS abs_r FROM accounts"
            for a, b in _PAIRS] + [f"SELECT '{b}' AS a, '{a}' AS b, ROUND(CORR({a}, {b}), 6) AS r, ROUND(ABS(CORR({a}, {b})), 6) AS abs_r FROM accounts"
                                   for a, b in _PAIRS] + [f"SELECT '{a}' AS a, '{a}' AS b, 1.0 AS r, 1.0 AS abs_r" for a in ACC_NUM])}
""")
def q_pearson(spark, sf_dir):
    return rnd(pf.pearson(accounts(spark, sf_dir), ACC_NUM), {"r": 6, "abs_r": 6})


_SP_PAIRS = union_sql(f"SELECT '{a}' AS a, '{b}' AS b, {a} AS va, {b} AS vb FROM accounts "
                      f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a, b in _PAIRS)


@register("spearman", f"""
{ACC_WITH}, p AS ({_SP_PAIRS}),
rk AS (SELECT a, b,
   RANK() OVER (PARTITION BY a, b ORDER BY va) + (COUNT(*) OVER (PARTITION BY a, b, va) - 1) / 2.0 AS ra,
   RANK() OVER (PARTITION BY a, b ORDER BY vb) + (COUNT(*) OVER (PARTITION BY a, b, vb) - 1) / 2.0 AS rb
   FROM p),
s AS (SELECT a, b, CORR(ra, rb) AS r FROM rk GROUP BY a, b)
SELECT a, b, ROUND(r, 6) AS r, ROUND(ABS(r), 6) AS abs_r FROM s
UNION ALL SELECT b AS a, a AS b, ROUND(r, 6) AS r, ROUND(ABS(r), 6) AS abs_r FROM s
UNION ALL {union_sql(f"SELECT '{a}' AS a, '{a}' AS b, 1.0 AS r, 1.0 AS abs_r" for a in ACC_NUM)}
""")
def q_spearman(spark, sf_dir):
    return rnd(pf.spearman(accounts(spark, sf_dir), ACC_NUM), {"r": 6, "abs_r": 6})


@register("target_corr", f"""
{ACC_WITH}, t AS (
{union_sql([f"SELECT '{a}' AS column, CORR({a}, target) AS r FROM accounts" for a in ACC_NUM if a != 'target']
           + ["SELECT 'target' AS column, 1.0 AS r"])})
SELECT "column", ROUND(r, 6) AS r, ROW_NUMBER() OVER (ORDER BY r DESC, "column") AS pos FROM t
""")
def q_target_corr(spark, sf_dir):
    return rnd(pf.target_corr(pf.pearson(accounts(spark, sf_dir), ACC_NUM), "target"), {"r": 6})


@register("spearman_target", f"""
SELECT a AS column, r, ROW_NUMBER() OVER (ORDER BY r DESC, a) AS pos FROM ({ORACLE["spearman"]}) s WHERE b = 'target'
""")
def q_spearman_target(spark, sf_dir):
    return pf.target_corr(q_spearman(spark, sf_dir), "target")


# -- A14 / A15 -----------------------------------------------------------------------------------
@register("outliers_zscore", union_sql(
    [f"""SELECT '{x}' AS column, CAST(SUM(CASE WHEN ABS(({x} - m) / s) > 3 THEN 1 ELSE 0 END) AS BIGINT) AS z_outliers
FROM lineitem, (SELECT AVG({x}) AS m, STDDEV_POP({x}) AS s FROM lineitem) st""" for x in LI_NUM]
    + ["""SELECT 'value' AS column, CAST(SUM(CASE WHEN ABS((value - m) / s) > 3 THEN 1 ELSE 0 END) AS BIGINT) AS z_outliers
FROM events, (SELECT AVG(value) AS m, STDDEV_POP(value) AS s FROM events) st"""]))
def q_outliers_zscore(spark, sf_dir):
    li = pf.zscore_outliers(load_table(spark, sf_dir, "lineitem"), LI_NUM)
    ev = pf.zscore_outliers(load_table(spark, sf_dir, "events"), ("value",))
    return li.unionByName(ev).withColumn("z_outliers", F.col("z_outliers").cast("long"))


def _iqr_sql(x, table):
    return f"""SELECT '{x}' AS column, CAST(SUM(CASE WHEN {x} < q1 - 1.5 * (q3 - q1) OR {x} > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS iqr_outliers
FROM {table}, (SELECT QUANTILE_CONT({x}, 0.25) AS q1, QUANTILE_CONT({x}, 0.75) AS q3 FROM {table}) st"""


@register("outliers_iqr", union_sql([_iqr_sql(x, "lineitem") for x in LI_NUM] + [_iqr_sql("value", "events")]))
def q_outliers_iqr(spark, sf_dir):
    li = pf.iqr_outliers(load_table(spark, sf_dir, "lineitem"), LI_NUM)
    ev = pf.iqr_outliers(load_table(spark, sf_dir, "events"), ("value",))
    return li.unionByName(ev).withColumn("iqr_outliers", F.col("iqr_outliers").cast("long"))


# -- A16 -----------------------------------------------------------------------------------------
@register("feature_check", f"""
{ACC_WITH}
SELECT 'ebitda_price_ratio' AS feature, ROUND(CORR(ebitda / CASE WHEN price < 1e-6 THEN 1e-6 ELSE price END, target), 6) AS r FROM accounts
UNION ALL
SELECT 'eps_price_ratio' AS feature, ROUND(CORR(eps / CASE WHEN price < 1e-6 THEN 1e-6 ELSE price END, target), 6) AS r FROM accounts
""")
def q_feature_check(spark, sf_dir):
    return rnd(pf.feature_check(accounts(spark, sf_dir), "target", ACCOUNTS.ratios), {"r": 6})


_ = ORACLE  # the registry owns the dict
