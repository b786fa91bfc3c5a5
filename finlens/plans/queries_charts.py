"""Registered chart-data queries (C1–C8) with their oracle SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.operators import charts as ch
from finlens.operators import evaluate as ev
from finlens.operators import prep
from finlens.operators import profile as pf
from finlens.plans.registry import ACC_NUM, ACC_WITH, LI_NUM, accounts, load_table, register, rnd
from finlens.spec import ACCOUNTS


def union_sql(parts) -> str:
    return "\nUNION ALL\n".join(parts)


ACC_ALL = ("id", "name", "sector", "price", "ebitda", "eps", "pe", "volume", "low52", "high52", "target")
HIST_BINS = 30
PAIR_BINS = 10


# -- C1 ------------------------------------------------------------------------------------------
@register("null_patterns", f"""
{ACC_WITH}
SELECT CONCAT({", ".join(f"CASE WHEN {x} IS NULL THEN '1' ELSE '0' END" for x in ACC_ALL)}) AS pattern,
       COUNT(*) AS rows
FROM accounts GROUP BY 1
""")
def q_null_patterns(spark, sf_dir):
    return ch.null_patterns(accounts(spark, sf_dir), ACC_ALL)


# -- C2 ------------------------------------------------------------------------------------------
def _hist_sql(x: str, table: str, expr: str | None = None, where: str = "") -> str:
    e = expr or x
    return f"""SELECT '{x}' AS column, bin, ROUND(lo + bin * w, 6) AS lo_edge, ROUND(lo + (bin + 1) * w, 6) AS hi_edge,
       COUNT(*) AS count FROM (
  SELECT CAST(CASE WHEN w = 0 THEN 0 ELSE LEAST(FLOOR((v - lo) / w), {HIST_BINS} - 1) END AS INTEGER) AS bin, lo, w
  FROM (SELECT {e} AS v FROM {table}) t,
       (SELECT MIN({e}) AS lo, (MAX({e}) - MIN({e})) / {HIST_BINS} AS w FROM {table}) b
  WHERE v IS NOT NULL {where}) s GROUP BY bin, lo, w"""


@register("hist", union_sql([_hist_sql(x, "lineitem") for x in LI_NUM] + [_hist_sql("value", "events")]))
def q_hist(spark, sf_dir):
    li = ch.histogram(load_table(spark, sf_dir, "lineitem"), LI_NUM, HIST_BINS)
    ev = ch.histogram(load_table(spark, sf_dir, "events"), ("value",), HIST_BINS)
    return rnd(li.unionByName(ev), {"lo_edge": 6, "hi_edge": 6})


_LOG = "LN(1 + CASE WHEN {x} < 0 THEN 0.0 ELSE {x} END)"


@register("log_hist", union_sql(
    _hist_sql(x, "events", _LOG.format(x=x), where=f"AND (SELECT SKEWNESS({x}) FROM events) > 1")
    for x in ("event_id", "user_id", "value")))
def q_log_hist(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events")
    skewed = pf.skewed_columns(pf.moments(ev, ("event_id", "user_id", "value")), 1.0)
    return rnd(ch.log_histogram(ev, skewed, HIST_BINS), {"lo_edge": 6, "hi_edge": 6})


@register("density", f"""
WITH h AS ({_hist_sql("value", "events")}),
st AS (SELECT COUNT(value) AS n, STDDEV_SAMP(value) AS sd FROM events),
hb AS (SELECT h.*, st.n, st.sd * POWER(CAST(st.n AS DOUBLE), -0.2) AS bw, (lo_edge + hi_edge) / 2.0 AS mid FROM h, st)
SELECT g.column, g.bin, ROUND(g.mid, 6) AS x,
       ROUND(SUM(b.count * EXP(-0.5 * ((g.mid - b.mid) / b.bw) * ((g.mid - b.mid) / b.bw))) / (MAX(b.n) * MAX(b.bw) * SQRT(2 * PI())), 9) AS density
FROM hb g JOIN hb b ON g.column = b.column GROUP BY g.column, g.bin, g.mid
""")
def q_density(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events")
    # bin edges are rounded first so both sides start from the same centres
    hist = rnd(ch.histogram(ev, ("value",), HIST_BINS), {"lo_edge": 6, "hi_edge": 6})
    st = ev.agg(F.count("value").alias("n"), F.stddev_samp("value").alias("std")).withColumn("column", F.lit("value"))
    return rnd(ch.binned_density(hist, st), {"x": 6, "density": 9})


# -- C4 ------------------------------------------------------------------------------------------
def _pair_sql(cols, table_sql):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            def be(x):
                return (f"CAST(CASE WHEN w_{x} = 0 THEN 0 ELSE LEAST(FLOOR(({x} - lo_{x}) / w_{x}), {PAIR_BINS} - 1) END AS INTEGER)")
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {be(a)} AS bin_a, {be(b)} AS bin_b FROM t, bd "
                         f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL")
    bd = ", ".join(f"MIN({x}) AS lo_{x}, (MAX({x}) - MIN({x})) / {PAIR_BINS} AS w_{x}" for x in cols)
    return f"""{table_sql}, bd AS (SELECT {bd} FROM t),
p AS ({union_sql(parts)})
SELECT a, b, bin_a, bin_b, COUNT(*) AS count FROM p GROUP BY a, b, bin_a, bin_b"""


@register("pair_bins", _pair_sql(ACCOUNTS.key_columns, f"{ACC_WITH}, t AS (SELECT * FROM accounts)"))
def q_pair_bins(spark, sf_dir):
    return ch.pair_bins(accounts(spark, sf_dir), ACCOUNTS.key_columns, PAIR_BINS)


# -- C7 / C8 -------------------------------------------------------------------------------------
def _box_sql(long_sql: str, by: str | None) -> str:
    g = f"{by}, " if by else ""
    on = f"q.{by} = l.{by} AND " if by else ""
    return f"""l AS ({long_sql}),
q AS (SELECT {g}"column", COUNT(*) AS n, QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.5) AS median,
             QUANTILE_CONT(value, 0.75) AS q3 FROM l GROUP BY {g}"column")
SELECT {", ".join(f"q.{x}" for x in ([by] if by else []))}{"," if by else ""} q."column", q.n, ROUND(q.q1, 6) AS q1, ROUND(q.median, 6) AS median,
       ROUND(q.q3, 6) AS q3, ROUND(q.q3 - q.q1, 6) AS iqr,
       ROUND(MIN(CASE WHEN l.value >= q.q1 - 1.5 * (q.q3 - q.q1) THEN l.value END), 6) AS whisker_lo,
       ROUND(MAX(CASE WHEN l.value <= q.q3 + 1.5 * (q.q3 - q.q1) THEN l.value END), 6) AS whisker_hi,
       COUNT(CASE WHEN l.value < q.q1 - 1.5 * (q.q3 - q.q1) OR l.value > q.q3 + 1.5 * (q.q3 - q.q1) THEN 1 END) AS n_outliers,
       ROUND(q.median - 1.57 * (q.q3 - q.q1) / SQRT(q.n), 6) AS notch_lo,
       ROUND(q.median + 1.57 * (q.q3 - q.q1) / SQRT(q.n), 6) AS notch_hi
FROM q JOIN l ON {on}q."column" = l."column"
GROUP BY {", ".join(f"q.{x}" for x in ([by] if by else []))}{"," if by else ""} q."column", q.n, q.q1, q.median, q.q3"""


_BOX_COLS = ("target", "pe")
_BOX_ROUND = {k: 6 for k in ("q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi", "notch_lo", "notch_hi")}


@register("box_by_group", f"""{ACC_WITH}, {_box_sql(union_sql(
    f"SELECT sector, '{x}' AS column, {x} AS value FROM accounts WHERE sector IS NOT NULL AND {x} IS NOT NULL"
    for x in _BOX_COLS), "sector")}""")
def q_box_by_group(spark, sf_dir):
    return rnd(ch.box_stats(accounts(spark, sf_dir), _BOX_COLS, by=("sector",)), _BOX_ROUND)


@register("box_wide", f"""WITH {_box_sql(union_sql(
    f"SELECT '{x}' AS column, {x} AS value FROM lineitem WHERE {x} IS NOT NULL" for x in LI_NUM), None)}""")
def q_box_wide(spark, sf_dir):
    return rnd(ch.box_stats(load_table(spark, sf_dir, "lineitem"), LI_NUM), _BOX_ROUND)


@register("outlier_points", f"""{ACC_WITH}, l AS ({union_sql(
    f"SELECT id, '{x}' AS column, {x} AS value FROM accounts WHERE {x} IS NOT NULL" for x in ACC_NUM)}),
q AS (SELECT "column", QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.75) AS q3 FROM l GROUP BY "column")
SELECT l.id, l."column", l.value FROM l JOIN q ON l."column" = q."column"
WHERE l.value < q.q1 - 1.5 * (q.q3 - q.q1) OR l.value > q.q3 + 1.5 * (q.q3 - q.q1)""")
def q_outlier_points(spark, sf_dir):
    return ch.outlier_points(accounts(spark, sf_dir), ACC_NUM, "id")


# -- C1 as a grid ----------------------------------------------------------------------------------
_MAP_COLS = ("sector", "price", "ebitda", "pe", "target")


@register("missing_map", f"""{ACC_WITH},
n AS (SELECT *, ROW_NUMBER() OVER (ORDER BY id) - 1 AS pos, COUNT(*) OVER () AS n FROM accounts),
b AS (SELECT *, CAST(pos * 50 // n AS INTEGER) AS bucket FROM n)
{" UNION ALL ".join(f"SELECT bucket, '{x}' AS column, COUNT(*) AS rows, COUNT(*) - COUNT({x}) AS missing FROM b GROUP BY bucket" for x in _MAP_COLS)}""")
def q_missing_map(spark, sf_dir):
    return ch.missing_map(accounts(spark, sf_dir), ["id"], _MAP_COLS, buckets=50)


# -- NaN is a missing value everywhere -------------------------------------------------------------
_NAN = """WITH v AS (SELECT l_quantity, CASE WHEN l_orderkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END AS tax FROM lineitem),
ok AS (SELECT * FROM v WHERE NOT isnan(tax)), e AS (SELECT MIN(tax) AS lo, MAX(tax) AS hi, MIN(l_quantity) AS qlo, MAX(l_quantity) AS qhi FROM ok),
q AS (SELECT MIN(l_quantity) AS qlo, MAX(l_quantity) AS qhi FROM v)"""


@register("nan_missing", f"""{_NAN}
SELECT 'pattern' AS operator, CASE WHEN isnan(tax) THEN '01' ELSE '00' END AS name, CAST(COUNT(*) AS DOUBLE) AS value FROM v GROUP BY isnan(tax)
UNION ALL SELECT 'hist', CAST(LEAST(FLOOR((tax - lo) / ((hi - lo) / 4)), 3)::INTEGER AS VARCHAR), COUNT(*) FROM ok, e GROUP BY 2
UNION ALL SELECT 'pairs', CAST(LEAST(FLOOR((l_quantity - q.qlo) / ((q.qhi - q.qlo) / 2)), 1)::INTEGER AS VARCHAR) || '-' || CAST(LEAST(FLOOR((tax - lo) / ((hi - lo) / 2)), 1)::INTEGER AS VARCHAR), COUNT(*) FROM ok, e, q GROUP BY 2
UNION ALL SELECT 'box', 'n', COUNT(*) FROM ok UNION ALL SELECT 'box', 'median', ROUND(QUANTILE_CONT(tax, 0.5), 6) FROM ok
UNION ALL SELECT 'nunique', 'tax', COUNT(DISTINCT tax) FROM ok
UNION ALL SELECT 'impute', 'sum', ROUND(SUM(CASE WHEN isnan(tax) THEN m ELSE tax END), 2) FROM v, (SELECT QUANTILE_CONT(tax, 0.5) AS m FROM ok)
UNION ALL SELECT 'metrics', 'n', COUNT(*) FROM ok UNION ALL SELECT 'metrics', 'mae', ROUND(AVG(ABS(tax - l_quantity / 1000)), 6) FROM ok
UNION ALL SELECT 'map', 'missing', COUNT(*) FILTER (isnan(tax)) FROM v""")
def q_nan_missing(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    v = li.select("l_quantity", F.when(F.col("l_orderkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("tax"), (F.col("l_quantity") / 1000).alias("p"), "l_orderkey", "l_linenumber")
    row = lambda df, op, name, value: df.select(F.lit(op).alias("operator"), name.cast("string").alias("name"), value.cast("double").alias("value"))
    box = ch.box_stats(v, ["tax"])
    filled = prep.ExactMedianImputer(inputCols=["tax"], outputCols=["tax"]).fit(v).transform(v)
    fit = ev.regression_metrics(v, "tax", "p")
    parts = [
        row(ch.null_patterns(v, ["l_quantity", "tax"]), "pattern", F.col("pattern"), F.col("rows")),
        row(ch.histogram(v, ["tax"], 4), "hist", F.col("bin"), F.col("count")),
        row(ch.pair_bins(v, ["l_quantity", "tax"], 2), "pairs", F.concat_ws("-", "bin_a", "bin_b"), F.col("count")),
        row(box, "box", F.lit("n"), F.col("n")), row(box, "box", F.lit("median"), F.round("median", 6)),
        row(pf.nunique(v, ["tax"]), "nunique", F.col("column"), F.col("nunique")),
        row(filled.agg(F.round(F.sum("tax"), 2).alias("s")), "impute", F.lit("sum"), F.col("s")),
        row(fit, "metrics", F.lit("n"), F.col("n")), row(fit, "metrics", F.lit("mae"), F.round("mae", 6)),
        row(ch.missing_map(v, ["l_orderkey", "l_linenumber"], ["tax"]).agg(F.sum("missing").alias("m")), "map", F.lit("missing"), F.col("m")),
    ]
    return reduce(DataFrame.unionByName, parts)
