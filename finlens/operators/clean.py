"""Cleaning, projection and derived features (P1–P12, D1 expressions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from finlens.functions.exprs import c, clip_lower, guarded_ratio, log_feature
from finlens.spec import Spec


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Full-row duplicates removed (missing equals missing).
    Hash aggregate with map-side combine: repeated rows collapse before the shuffle."""
    return df.dropDuplicates()


def positive_price(df: DataFrame, col: str) -> DataFrame:
    """Keep rows with ``col > 0`` (missing removed)."""
    return df.where(c(col) > 0)


def clip_negatives(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Negatives -> 0 for the present columns; missing stays missing."""
    present = [x for x in cols if x in df.columns]
    return df.withColumns({x: clip_lower(x, 0.0) for x in present}) if present else df


def clean(df: DataFrame, spec: Spec) -> DataFrame:
    """P1 -> P2 -> P3."""
    out = drop_duplicates(df)
    if spec.price and spec.price in df.columns:
        out = positive_price(out, spec.price)
    return clip_negatives(out, spec.clip_cols)


def clean_report(df: DataFrame, spec: Spec) -> DataFrame:
    """Shape before / after cleaning in one pass: the dedupe aggregate keeps each
    distinct row's multiplicity, so both counts come from the same shuffle."""
    g = df.groupBy(*[c(x) for x in df.columns]).agg(F.count(F.lit(1)).alias("__m"))
    keep = c(spec.price) > 0 if spec.price and spec.price in df.columns else F.lit(True)
    return g.agg(
        F.sum("__m").alias("rows_before"),
        F.count(F.when(keep, 1)).alias("rows_after"),
    ).withColumn("columns", F.lit(len(df.columns)))


def split_xy(df: DataFrame, spec: Spec) -> tuple[DataFrame, DataFrame]:
    """P5: X = everything but identifiers and target (the key is kept);
    y = (key, target)."""
    drop = [x for x in (*spec.identifiers, spec.target) if x in df.columns and x != spec.key]
    return df.drop(*drop), df.select(c(spec.key), c(spec.target))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns of the schema."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def derived_exprs(spec: Spec, columns: Sequence[str]) -> dict:
    """P9/P10 expressions for every derivable feature whose sources exist."""
    out = {}
    for name, num, den in spec.ratios:
        if num in columns and den in columns:
            out[name] = guarded_ratio(num, den)
    for name, src in spec.logs:
        if src in columns:
            out[name] = log_feature(src)
    return out


def derive_features(df: DataFrame, spec: Spec) -> DataFrame:
    """P9 + P10: ratio and log features (schema tolerant)."""
    ex = derived_exprs(spec, df.columns)
    return df.withColumns(ex) if ex else df


def add_missing_features(df: DataFrame, spec: Spec) -> DataFrame:
    """Compute only absent derived columns; no-op when all exist;
    a missing source column is an error."""
    missing = [n for n in spec.derived if n not in df.columns]
    if not missing:
        return df
    sources = {n: (num, den) for n, num, den in spec.ratios} | {n: (src,) for n, src in spec.logs}
    for n in missing:
        for s in sources[n]:
            if s not in df.columns:
                raise KeyError(f"source column {s!r} for {n!r} not found")
    ex = derived_exprs(spec, df.columns)
    return df.withColumns({n: ex[n] for n in missing})


def log_target(df: DataFrame, target: str, out: str = "y_log") -> DataFrame:
    """``log1p(target)``."""
    return df.withColumn(out, F.log1p(c(target)))
