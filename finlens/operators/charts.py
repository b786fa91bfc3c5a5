"""The tables behind the usual EDA charts.

Rendering is out of scope; each function returns the small aggregate a plot
would be drawn from.  Bounds (min / max / quartiles) are fitted in one pass and
applied as literals, so every chart table costs at most two scans and one
partial aggregate, whatever the input size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlens.functions.exprs import c, explode_rows, log_feature, no_nan
from finlens.operators import ranks
from finlens.operators.positions import number_rows

# Box-plot whisker reach (1.5 IQR) and notch constant (1.57).
WHISKER = 1.5
NOTCH = 1.57


def null_patterns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows per missing-value pattern; ``pattern`` has one 0/1 flag per
    column (1 = missing: null or NaN) in column order."""
    cols = list(cols or df.columns)
    df = no_nan(df, cols)
    flags = [F.when(c(x).isNull(), F.lit("1")).otherwise(F.lit("0")) for x in cols]
    return df.groupBy(F.concat(*flags).alias("pattern")).agg(F.count(F.lit(1)).alias("rows"))


def missing_map(df: DataFrame, order: Sequence[str], cols: Sequence[str] | None = None, buckets: int = 50) -> DataFrame:
    """The missing-value map as a grid ``(bucket, column, rows, missing)``: rows in ``order`` fall into ``buckets`` runs of equal
    length.  ``order`` must tell rows apart up to equal ones; rows are numbered without a one-task window.  An empty
    table has no buckets."""
    cols = list(cols or df.columns)
    flags = [F.when(c(x).isNull(), 1).otherwise(0).alias(f"__m{i}") for i, x in enumerate(cols)]
    keys = [c(x).alias(f"__o{i}") for i, x in enumerate(order)]
    rows = number_rows(no_nan(df, cols).select(*keys, *flags), [f"__o{i}" for i in range(len(order))], name="__pos", count="__n")
    agg = rows.groupBy(F.floor(F.col("__pos") * buckets / F.col("__n")).cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(f"__m{i}").alias(f"__s{i}") for i in range(len(cols))])
    return agg.select("bucket", "rows", F.inline(F.array(*[F.struct(F.lit(x).alias("column"), F.col(f"__s{i}").alias("missing"))
                                                           for i, x in enumerate(cols)]))).select("bucket", "column", "rows", "missing")


def bounds(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    row = df.agg(*[e for i, x in enumerate(cols) for e in (F.min(c(x)).cast("double").alias(f"lo{i}"),
                                                          F.max(c(x)).cast("double").alias(f"hi{i}"))]).first()
    return {x: (row[f"lo{i}"], row[f"hi{i}"]) for i, x in enumerate(cols)}


def bin_expr(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin id in [0, bins): ``least(floor((x - lo) / w), bins - 1)``."""
    w = (hi - lo) / bins
    if not w:
        return F.when(x.isNotNull(), F.lit(0))
    return F.least(F.floor((x - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30, transform=None) -> DataFrame:
    """``(column, bin, lo_edge, hi_edge, count)`` per numeric column.
    ``transform`` maps a column name to the Column to bin (C3 passes a log)."""
    cols = list(cols)
    src = no_nan(df, cols)
    src = src.select(*[(transform(x) if transform else c(x)).cast("double").alias(f"__v{i}") for i, x in enumerate(cols)])
    bd = bounds(src, [f"__v{i}" for i in range(len(cols))])
    entries = []
    for i, x in enumerate(cols):
        lo, hi = bd[f"__v{i}"]
        if lo is None:
            continue
        b = bin_expr(F.col(f"__v{i}"), lo, hi, bins)
        w = (hi - lo) / bins
        entries.append((F.col(f"__v{i}").isNotNull(), [
            F.lit(x).alias("column"), b.alias("bin"),
            (F.lit(lo) + b.cast("double") * F.lit(w)).alias("lo_edge"),
            (F.lit(lo) + (b + 1).cast("double") * F.lit(w)).alias("hi_edge")]))
    if not entries:
        return df.sparkSession.createDataFrame([], "column string, bin int, lo_edge double, hi_edge double, count long")
    long_df = explode_rows(src, entries)
    return long_df.groupBy("column", "bin", "lo_edge", "hi_edge").agg(F.count(F.lit(1)).alias("count"))


def log_histogram(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """Histogram of ``log1p(clip(x, 0))``."""
    return histogram(df, cols, bins, transform=log_feature)


def binned_density(hist: DataFrame, stats: DataFrame) -> DataFrame:
    """Gaussian kernel density at the bin centres from binned counts.

    ``stats``: ``(column, n, std)``.  Bandwidth by Scott's rule
    ``h = std · n^(-1/5)``.  Every bin row is expanded to the bins of its own
    column (a generator over a table of ``#columns × bins`` rows), so the work
    is bounded by ``bins²`` per column and independent of the input size."""
    h = hist.join(stats, "column")
    h = h.withColumn("bw", F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    centers = hist.select("column", F.col("bin").alias("at"),
                          ((F.col("lo_edge") + F.col("hi_edge")) / 2.0).alias("x"))
    grid = centers.groupBy("column").agg(F.collect_list(F.struct("at", "x")).alias("grid"))
    e = h.join(grid, "column").select("column", "count", "n", "bw",
                                      ((F.col("lo_edge") + F.col("hi_edge")) / 2.0).alias("mid"),
                                      F.explode("grid").alias("g"))
    # a constant column has no bandwidth and no density
    z = F.try_divide(F.col("g.x") - F.col("mid"), F.col("bw"))
    k = F.col("count") * F.exp(-0.5 * z * z)
    return e.groupBy("column", F.col("g.at").alias("bin"), F.col("g.x").alias("x")).agg(
        F.try_divide(F.sum(k), F.first("n") * F.first("bw") * F.lit(math.sqrt(2 * math.pi))).alias("density"))


def pair_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """C4: 2-D binned counts for every pair of ``cols`` (the scalable form of a
    pair plot): ``(a, b, bin_a, bin_b, count)`` over rows where both exist."""
    cols = list(cols)
    df = no_nan(df, cols)
    bd = bounds(df, cols)
    ok = [x for x in cols if bd[x][0] is not None]
    bx = {x: bin_expr(c(x).cast("double"), bd[x][0], bd[x][1], bins) for x in ok}
    entries = [(c(a).isNotNull() & c(b).isNotNull(), [
        F.lit(a).alias("a"), F.lit(b).alias("b"), bx[a].alias("bin_a"), bx[b].alias("bin_b")])
        for i, a in enumerate(ok) for b in ok[i + 1:]]
    long_df = explode_rows(df, entries)
    return long_df.groupBy("a", "b", "bin_a", "bin_b").agg(F.count(F.lit(1)).alias("count"))


def _long(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    return explode_rows(df, [(c(x).isNotNull(), [F.lit(x).alias("column"), c(x).cast("double").alias("value")])
                             for x in cols], keep=by)


def box_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), fitted: DataFrame | None = None) -> DataFrame:
    """Quartiles, whiskers (last datum inside 1.5·IQR), notch and the
    number of points beyond the whiskers, per ``(by..., column)``.

    Quartiles come from the distributed rank table; the per-group stats (one row
    per group and column) are joined back to the values — AQE turns that join
    into a broadcast when the stats table is small and splits skewed groups
    otherwise.  ``fitted`` gives quartiles that are known already, maybe of more columns."""
    by = list(by)
    df = no_nan(df, cols)
    q = fitted if fitted is not None else ranks.exact_quantiles(df, cols, (0.25, 0.5, 0.75), ("q1", "median", "q3"), by=by)
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    keep = F.lit(True)
    for b in by:
        keep = keep & c(b).isNotNull()
    lv = _long(df.where(keep), cols, by)
    j = lv.join(q, [*by, "column"])
    lo_f = F.col("q1") - WHISKER * F.col("iqr")
    hi_f = F.col("q3") + WHISKER * F.col("iqr")
    agg = j.groupBy(*by, "column").agg(
        F.first("n").alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"), F.first("iqr").alias("iqr"),
        F.min(F.when(F.col("value") >= lo_f, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(F.col("value") <= hi_f, F.col("value"))).alias("whisker_hi"),
        F.count(F.when((F.col("value") < lo_f) | (F.col("value") > hi_f), 1)).alias("n_outliers"))
    half = NOTCH * F.col("iqr") / F.sqrt(F.col("n").cast("double"))
    return agg.withColumn("notch_lo", F.col("median") - half).withColumn("notch_hi", F.col("median") + half)


def outlier_points(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """C8 outlier markers: ``(key, column, value)`` beyond the whisker fences."""
    df = no_nan(df, cols)
    st = ranks.exact_quantiles(df, cols, (0.25, 0.75), ("q1", "q3")).withColumn("iqr", F.col("q3") - F.col("q1"))
    lv = _long(df, cols, [key])
    j = lv.join(st, "column")
    return j.where((F.col("value") < F.col("q1") - WHISKER * F.col("iqr")) |
                   (F.col("value") > F.col("q3") + WHISKER * F.col("iqr"))).select(key, "column", "value")
