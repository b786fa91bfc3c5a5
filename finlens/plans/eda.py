"""O1: the EDA profile as a dict of DataFrames.

Seven profilers run in order over one (cached) input; each section is written
below the checkpoint folder and read back inside its own ``try``, so it fails on
its own, and the error is reported in the result, never swallowed silently.
Quartiles, moments and correlations that several sections read are computed once.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.operators import charts as ch
from finlens.operators import clean as cl
from finlens.operators import profile as pf
from finlens.session import scratch_path
from finlens.spec import Spec


class SectionError(RuntimeError):
    pass


def profile(df: DataFrame, spec: Spec, bins: int = 30, persist: bool = True) -> dict[str, DataFrame]:
    """Sections: shape, describe, missing, null_patterns (basic info); value
    counts / nunique (categorical); moments, histograms, log histograms, pair
    bins (numerical); pearson, spearman, target correlation; group profile and
    box stats; z / IQR outliers and box stats; the ratio feature check."""
    if persist:
        df = df.persist()
    num = [x for x in (*spec.numeric, spec.target) if x in df.columns]
    cats = [x for x in (*spec.identifiers, spec.category) if x in df.columns and x != spec.key]
    second = spec.clip_cols[1] if len(spec.clip_cols) > 1 else None
    numeric = cl.numeric_columns(df, exclude=(spec.key,))
    out, errors, shared = {}, {}, {}

    def quartiles(*by):
        if by not in shared:  # small local tables; what cannot be made fails in each section that asks for it
            own = list(dict.fromkeys([spec.target, *([second] if second else [])])) if by else num
            shared[by] = pf.quartiles(df, own, by)
        return shared[by]

    def target_corr():
        if "pearson" in out and set(num) <= set(numeric):
            own = out["pearson"].where(F.col("a").isin(num) & F.col("b").isin(num))
        else:
            own = pf.pearson(df, num)
        return pf.target_corr(own, spec.target)
    sections = {
        "shape": lambda: pf.shape_info(df),
        "describe": lambda: pf.describe(df, num, fitted=quartiles()),
        "missing": lambda: pf.missing_table(df),
        "null_patterns": lambda: ch.null_patterns(df),
        "value_counts": lambda: pf.value_counts(df, spec.category),
        "value_counts_all": lambda: reduce(DataFrame.unionByName, [
            pf.counts_of(df, x).select(F.lit(x).alias("column"), F.col("value").cast("string").alias("value"), "count")
            for x in cats]),
        "nunique": lambda: pf.nunique(df, cats),
        "moments": lambda: pf.moments(df, num),
        "hist": lambda: ch.histogram(df, num, bins),
        "log_hist": lambda: ch.log_histogram(df, pf.skewed_columns(out["moments"] if "moments" in out else pf.moments(df, num)), bins),
        "pair_bins": lambda: ch.pair_bins(df, [x for x in spec.key_columns if x in df.columns]),
        "pearson": lambda: pf.pearson(df, numeric),
        "spearman": lambda: pf.spearman(df, numeric),
        "target_corr": target_corr,
        "group_profile": lambda: pf.group_profile(df, spec.category, spec.target, second, quartiles(spec.category)),
        "box_by_group": lambda: ch.box_stats(df, [spec.target], by=(spec.category,), fitted=shared.get((spec.category,))),
        "z_outliers": lambda: pf.zscore_outliers(df, num),
        "iqr_outliers": lambda: pf.iqr_outliers(df, num, fitted=quartiles()),
        "box_wide": lambda: ch.box_stats(df, num, fitted=quartiles()),
        "feature_check": lambda: pf.feature_check(df, spec.target, spec.ratios),
    }
    run = f"eda-{uuid.uuid4().hex[:12]}"
    for name, fn in sections.items():
        try:
            made = fn()
            path = scratch_path(df.sparkSession, f"{run}/{name}")
            made.write.mode("overwrite").parquet(path)
            out[name] = df.sparkSession.read.schema(made.schema).parquet(path)
        except Exception as e:  # noqa: BLE001 — each section fails on its own
            errors[name] = f"{type(e).__name__}: {e}"
    if persist:
        df.unpersist()
    if errors:
        out["errors"] = df.sparkSession.createDataFrame(sorted(errors.items()), "section string, error string")
    return out


def summary(sections: dict[str, DataFrame]) -> DataFrame:
    """``(section, rows)`` — one small count per section table."""
    parts = [d.agg(F.count(F.lit(1)).alias("rows")).withColumn("section", F.lit(n)) for n, d in sections.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("section", "rows")
