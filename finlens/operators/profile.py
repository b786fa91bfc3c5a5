"""Profiling aggregates (A1–A16, A18) and ranked reports.

Rule of the module: all columns are profiled in **one** aggregate pass; a
statistic that needs a fitted value (z-score, IQR fences) gets it as a bounded
one-row result and applies it in a second pass.  Results are long tables
``(column, ...)`` so they stay schema-stable whatever the input columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlens.functions.exprs import c, correlation, explode_rows, guarded_ratio, no_nan
from finlens.operators import ranks
from finlens.operators.positions import number_rows
from finlens.session import ship_library


def _stack(rows: list[Column]) -> Column:
    return F.inline(F.array(*rows))


def rank_rows(df: DataFrame, *order: Column, name: str = "pos") -> DataFrame:
    """Position column for a *bounded* report table (one row per column or per
    category): gives sorted output an order-insensitive representation."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


# -- A1 ------------------------------------------------------------------------------------------
def shape_info(df: DataFrame) -> DataFrame:
    """A1: ``(column, dtype, non_null, rows)`` in one pass."""
    agg = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(c(x)).alias(f"__nn{i}") for i, x in enumerate(df.columns)])
    dtypes = dict(df.dtypes)
    return agg.select(_stack([
        F.struct(F.lit(x).alias("column"), F.lit(dtypes[x]).alias("dtype"),
                 F.col(f"__nn{i}").alias("non_null"), F.col("__rows").alias("rows"))
        for i, x in enumerate(df.columns)]))


# -- A2 ------------------------------------------------------------------------------------------
def quartiles(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact ``(by..., column, n, q1, median, q3)``, which the functions below take as ``fitted`` to share it."""
    return ranks.exact_quantiles(no_nan(df, cols), cols, (0.25, 0.5, 0.75), ("q1", "median", "q3"), by=by)


def describe(df: DataFrame, cols: Sequence[str], approx_accuracy: int | None = None, fitted: DataFrame | None = None) -> DataFrame:
    """A2: pandas ``describe`` — count, mean, sample std, min, 25/50/75 %, max.
    Moments in one pass; quartiles exact through the distributed rank table."""
    df = no_nan(df, cols)
    m = df.agg(*[e for i, x in enumerate(cols) for e in (
        F.count(c(x)).alias(f"n{i}"), F.avg(c(x)).alias(f"mean{i}"), F.stddev_samp(c(x)).alias(f"std{i}"),
        F.min(c(x)).cast("double").alias(f"min{i}"), F.max(c(x)).cast("double").alias(f"max{i}"))])
    moments = m.select(_stack([
        F.struct(F.lit(x).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"mean{i}").alias("mean"),
                 F.col(f"std{i}").alias("std"), F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"))
        for i, x in enumerate(cols)]))
    if fitted is not None:
        q = fitted.select("column", F.col("q1").alias("q25"), F.col("median").alias("q50"), F.col("q3").alias("q75"))
    else:
        q = ranks.exact_quantiles(df, cols, (0.25, 0.5, 0.75), ("q25", "q50", "q75"), approx_accuracy=approx_accuracy).drop("n")
    return moments.join(q, "column", "left")


# -- A3 / P8 -------------------------------------------------------------------------------------
def missing_table(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """A3: missing (null or NaN) count and percent per column, worst first (``pos``)."""
    df = no_nan(df)
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.sum(F.when(c(x).isNull(), 1).otherwise(0)).alias(f"__m{i}") for i, x in enumerate(df.columns)])
    out = agg.select(_stack([
        F.struct(F.lit(x).alias("column"), F.col(f"__m{i}").cast("long").alias("count"),
                 (F.lit(100.0) * F.col(f"__m{i}") / F.col("__rows")).alias("percent"))
        for i, x in enumerate(df.columns)]))
    if only_missing:
        out = out.where(F.col("count") > 0)
    return rank_rows(out, F.col("count").desc(), F.col("column"))


# -- A4 / A5 -------------------------------------------------------------------------------------
def counts_of(df: DataFrame, col: str) -> DataFrame:
    """``(value, count)`` of the non-missing values, in no order."""
    return no_nan(df, [col]).where(c(col).isNotNull()).groupBy(c(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))


def value_counts(df: DataFrame, col: str, with_pos: bool = True) -> DataFrame:
    """A4: ``(value, count[, pos])`` most frequent first, missing excluded.

    The aggregate is partial (map-side), so a hot value costs one row per task.
    ``pos`` comes from range partitions and their row counts (:func:`number_rows`), so a column may have as many values
    as rows.  ``with_pos=False`` returns a plain ``orderBy`` instead."""
    out = counts_of(df, col)
    if not with_pos:
        return out.orderBy(F.col("count").desc(), F.col("value"))
    return number_rows(out, [F.col("count").desc(), F.col("value")], name="pos").withColumn("pos", F.col("pos") + 1)


def nunique(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """A5: distinct non-missing values per column (exact, or HLL when ``approx``)."""
    df = no_nan(df, cols)
    fn = (lambda x: F.approx_count_distinct(c(x))) if approx else (lambda x: F.count_distinct(c(x)))
    agg = df.agg(*[fn(x).alias(f"__d{i}") for i, x in enumerate(cols)])
    return agg.select(_stack([F.struct(F.lit(x).alias("column"), F.col(f"__d{i}").cast("long").alias("nunique"))
                              for i, x in enumerate(cols)]))


# -- A8, small columns ---------------------------------------------------------------------------
SHAPIRO_LIMIT = 5000  # fixed value: columns with fewer non-missing values are tested by Shapiro-Wilk
# The polynomials of Royston's algorithm (Applied Statistics R94), constant term first.
_C1 = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
_C2 = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
_C3 = (0.5440, -0.39978, 0.025054, -6.714e-4)
_C4 = (1.3822, -0.77857, 0.062767, -0.0020322)
_C5 = (-1.5861, -0.31082, -0.083751, 0.0038915)
_C6 = (-0.4803, -0.082676, 0.0030302)
_G = (-2.273, 0.459)


def shapiro_wilk(values) -> tuple[float | None, float | None]:
    """W and p of 3 to 5000 values; none for fewer or without spread."""
    x = sorted(float(v) for v in values)
    n = len(x)
    if n < 3 or x[0] == x[-1]:
        return None, None
    poly = lambda c, t: sum(k * t**i for i, k in enumerate(c))
    normal = NormalDist()
    m = [normal.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    square, u = sum(v * v for v in m), n**-0.5
    if n == 3:
        a = [-(0.5**0.5), 0.0, 0.5**0.5]
    else:
        last = poly(_C1, u) + m[-1] / square**0.5
        ends = [last]
        if n > 5:
            ends.append(poly(_C2, u) + m[-2] / square**0.5)
        k = len(ends)
        phi = (square - 2 * sum(v * v for v in m[n - k:])) / (1 - 2 * sum(v * v for v in ends))
        a = [v / phi**0.5 for v in m]
        for j, e in enumerate(ends):
            a[n - 1 - j], a[j] = e, -e
    mean = sum(x) / n
    w = min(1.0, sum(p * q for p, q in zip(a, x, strict=True)) ** 2 / sum((v - mean) ** 2 for v in x))
    if n == 3:
        return w, max(0.0, 6 / math.pi * (math.asin(w**0.5) - math.asin(0.75**0.5)))
    if w >= 1.0:
        return w, 1.0
    y = math.log(1 - w)
    if n <= 11:
        gamma = poly(_G, n)
        if y >= gamma:
            return w, 0.0
        y, mu, s = -math.log(gamma - y), poly(_C3, n), math.exp(poly(_C4, n))
    else:
        t = math.log(n)
        mu, s = poly(_C5, t), math.exp(poly(_C6, t))
    return w, 1 - normal.cdf((y - mu) / s)


def normality(df: DataFrame, cols: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """``(column, n, test, statistic, p, normal)``: Shapiro-Wilk for columns of 3 to ``SHAPIRO_LIMIT`` - 1 non-missing values,
    whose values are one bounded group, Jarque-Bera from the moments for the others; ``test`` says which."""
    ship_library(df.sparkSession)
    df = no_nan(df, cols)
    m = moments(df, cols)
    few = [r["column"] for r in m.where((F.col("n") >= 3) & (F.col("n") < SHAPIRO_LIMIT)).select("column").collect()]  # one row per column
    big = m.where(~F.col("column").isin(few)).select("column", "n", F.lit("jarque-bera").alias("test"), F.col("jb").alias("statistic"), F.col("jb_p").alias("p"))
    out = big
    if few:
        values = explode_rows(df, [(c(x).isNotNull(), [F.lit(x).alias("column"), c(x).cast("double").alias("value")]) for x in few])

        def test(pdf):
            w, p = shapiro_wilk(pdf["value"])
            return pd.DataFrame([(pdf["column"].iloc[0], len(pdf), "shapiro-wilk", w, p)], columns=["column", "n", "test", "statistic", "p"])
        out = big.unionByName(values.groupBy("column").applyInPandas(test, "column string, n long, test string, statistic double, p double"))
    return out.withColumn("normal", F.col("p") > alpha)


# -- A6 / A7 / A8 --------------------------------------------------------------------------------
def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A6, A7, A8 in one pass: ``(column, n, skew, kurt, jb, jb_p, normal)``.

    Spark's ``skewness`` / ``kurtosis`` are the population g1 / g2; the pandas
    (and SQL) values are the bias-adjusted G1 / G2.  The normality check is a
    Jarque–Bera test (one pass over moments) with p from chi-square(2).
    """
    df = no_nan(df, cols)
    agg = df.agg(*[e for i, x in enumerate(cols) for e in (
        F.count(c(x)).alias(f"n{i}"), F.skewness(c(x)).alias(f"g1_{i}"), F.kurtosis(c(x)).alias(f"g2_{i}"))])
    rows = []
    for i, x in enumerate(cols):
        n = F.col(f"n{i}").cast("double")
        g1, g2 = F.col(f"g1_{i}"), F.col(f"g2_{i}")
        skew = F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2) * g1)
        kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
        jb = n / 6.0 * (g1 * g1 + g2 * g2 / 4.0)
        rows.append(F.struct(F.lit(x).alias("column"), F.col(f"n{i}").alias("n"), skew.alias("skew"),
                             kurt.alias("kurt"), jb.alias("jb"), F.exp(-jb / 2.0).alias("jb_p")))
    return agg.select(_stack(rows)).withColumn("normal", F.col("jb_p") > 0.05)


# -- A10 / A12 / C6 ------------------------------------------------------------------------------
def pearson(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10: pairwise-complete Pearson matrix, long ``(a, b, r, abs_r)``, one pass.
    Rows where either side is missing are left out of a pair; a column that is constant there has no correlation."""
    df = no_nan(df, cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = df.agg(*[correlation(a, b).alias(f"r{k}") for k, (a, b) in enumerate(pairs)],
                 *[(F.min(c(a)) < F.max(c(a))).alias(f"v{i}") for i, a in enumerate(cols)])
    rows = []
    for k, (a, b) in enumerate(pairs):
        rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{k}").alias("r")))
        rows.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"r{k}").alias("r")))
    diag = [F.struct(F.lit(a).alias("a"), F.lit(a).alias("b"), F.when(F.col(f"v{i}"), 1.0).alias("r")) for i, a in enumerate(cols)]
    return agg.select(_stack(rows + diag)).withColumn("abs_r", F.abs("r"))


def spearman(df: DataFrame, cols: Sequence[str], buckets: int | None = None) -> DataFrame:
    """A11 via W1: pairwise-complete Spearman, long ``(a, b, r, abs_r)``.

    For the pair (a, b) the ranks are taken over rows where both are present.  The ranks are columns of the rows
    (:func:`ranks.rank_columns`), so all pairs come from one aggregate of products of centred ranks; no row is multiplied by
    the number of pairs.  A pair without rows, or with a column that is constant on them, has no correlation (null).
    ``buckets`` is the number of range partitions of the values (default: the session's shuffle partitions).
    """
    rc = ranks.rank_columns(df, cols, buckets)
    d = range(len(cols))
    # a column's spread differs only between the places of its rank array
    spread = {(i, rc.slot[i][j]): rc.centred(i, j) for i in d for j in (*d[:i], *d[i + 1:], i)}
    row = rc.table.agg(F.count(F.lit(1)),
                       *[F.expr(f"SUM({x} * {x}) AS s{i}_{k}") for (i, k), x in spread.items()],
                       *[F.expr(f"SUM({rc.centred(i, j)} * {rc.centred(j, i)}) AS p{i}_{j}") for i in d for j in d[i + 1:]])

    def cell(i, j):
        var = f"s{i}_{rc.slot[i][j]} * s{j}_{rc.slot[j][i]}"
        value = "1D" if i == j else f"p{min(i, j)}_{max(i, j)} / SQRT({var})"
        return f"IF({var} > 0, {value}, NULL)"
    pairs = [(i, j) for i in d for j in d]
    values = row.select(F.posexplode(F.expr(f"array({', '.join(cell(i, j) for i, j in pairs)})")).alias("pos", "r"))
    names = [F.array(*[F.lit(cols[p[k]]) for p in pairs]) for k in (0, 1)]
    return values.select(names[0][F.col("pos")].alias("a"), names[1][F.col("pos")].alias("b"), "r").withColumn("abs_r", F.abs("r"))


def target_corr(corr_long: DataFrame, target: str) -> DataFrame:
    """Correlation of every column with the target, descending (``pos``)."""
    out = corr_long.where(F.col("b") == target).select(F.col("a").alias("column"), "r")
    return rank_rows(out, F.col("r").desc(), F.col("column"))


# -- A13 -----------------------------------------------------------------------------------------
def group_profile(df: DataFrame, group: str, target: str, second: str | None = None, fitted: DataFrame | None = None) -> DataFrame:
    """Per category — target mean / median / sample std / count and the
    second column's mean / median; missing category dropped; sorted by target
    mean descending (``pos``).  Medians are exact (distributed rank table)."""
    base = no_nan(df, [target, *([second] if second else [])]).where(c(group).isNotNull())
    aggs = [F.avg(c(target)).alias("target_mean"), F.stddev_samp(c(target)).alias("target_std"),
            F.count(c(target)).alias("target_count")]
    cols = [target]
    if second:
        aggs.append(F.avg(c(second)).alias("second_mean"))
        cols.append(second)
    stats = base.groupBy(c(group).alias("group")).agg(*aggs)
    if fitted is not None:
        med = fitted.select(c(group).alias("group"), "column", "median").where(F.col("group").isNotNull())
    else:
        med = ranks.exact_quantiles(base.withColumn("group", c(group)), cols, (0.5,), ("median",), by=("group",))
    med_w = med.groupBy("group").pivot("column", cols).agg(F.first("median"))
    med_w = med_w.withColumnRenamed(target, "target_median")
    if second:
        med_w = med_w.withColumnRenamed(second, "second_median")
    out = stats.join(med_w, "group", "left")
    return rank_rows(out, F.col("target_mean").desc(), F.col("group"))


# -- A14 / A15 -----------------------------------------------------------------------------------
def zscore_outliers(df: DataFrame, cols: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """``|x - mean| / std_pop > threshold`` counts per column.
    Pass 1 fits ``(mean, std_pop)`` (2 doubles per column); pass 2 counts."""
    df = no_nan(df, cols)
    st = df.agg(*[e for i, x in enumerate(cols) for e in (F.avg(c(x)).alias(f"m{i}"),
                                                          F.stddev_pop(c(x)).alias(f"s{i}"))]).first()
    counts = []
    for i, x in enumerate(cols):
        m, s = st[f"m{i}"], st[f"s{i}"]
        if m is None or not s:
            counts.append(F.lit(0).cast("long").alias(f"z{i}"))
            continue
        z = F.abs((c(x) - F.lit(m)) / F.lit(s))
        counts.append(F.count(F.when(z > threshold, 1)).alias(f"z{i}"))
    agg = df.agg(*counts)
    return agg.select(_stack([F.struct(F.lit(x).alias("column"), F.col(f"z{i}").alias("z_outliers"))
                              for i, x in enumerate(cols)]))


def iqr_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5, by: Sequence[str] = (), fitted: DataFrame | None = None) -> DataFrame:
    """Exact quartiles + Tukey fences per column (and group)."""
    q = fitted if fitted is not None else quartiles(df, cols, by)
    iqr = F.col("q3") - F.col("q1")
    return q.withColumn("iqr", iqr).withColumn("lo_fence", F.col("q1") - k * iqr).withColumn(
        "hi_fence", F.col("q3") + k * iqr)


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5, fitted: DataFrame | None = None) -> DataFrame:
    """Strict ``x < Q1 - k·IQR or x > Q3 + k·IQR`` counts per column."""
    df = no_nan(df, cols)
    f = {r["column"]: (r["lo_fence"], r["hi_fence"]) for r in iqr_fences(df, cols, k, fitted=fitted).collect()}
    counts = []
    for i, x in enumerate(cols):
        lo, hi = f.get(x, (None, None))
        if lo is None:
            counts.append(F.lit(0).cast("long").alias(f"o{i}"))
        else:
            counts.append(F.count(F.when((c(x) < F.lit(lo)) | (c(x) > F.lit(hi)), 1)).alias(f"o{i}"))
    agg = df.agg(*counts)
    return agg.select(_stack([F.struct(F.lit(x).alias("column"), F.col(f"o{i}").alias("iqr_outliers"))
                              for i, x in enumerate(cols)]))


# -- A16 -----------------------------------------------------------------------------------------
def feature_check(df: DataFrame, target: str, candidates: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Build ``num / clip(den, 1e-6)`` candidates and correlate with the target."""
    df = no_nan(df)
    present = [(n, a, b) for n, a, b in candidates if a in df.columns and b in df.columns]
    agg = df.agg(*[correlation(guarded_ratio(a, b), c(target)).alias(f"r{i}") for i, (_, a, b) in enumerate(present)])
    return agg.select(_stack([F.struct(F.lit(n).alias("feature"), F.col(f"r{i}").alias("r"))
                              for i, (n, _, _) in enumerate(present)]))


# -- A9 ------------------------------------------------------------------------------------------
def skewed_columns(moments_df: DataFrame, threshold: float = 1.0) -> list[str]:
    """Columns whose bias-adjusted skew exceeds ``threshold`` (bounded list)."""
    return [r["column"] for r in moments_df.where(F.col("skew") > threshold).select("column").collect()]


