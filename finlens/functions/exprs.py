"""Scalar Column builders (all JVM-side, codegen friendly).

Null semantics follow the pandas job being re-expressed: a missing value stays
missing through clip / log / ratio.  ``greatest`` is never used for a clip
because ``greatest(NULL, x)`` is ``x`` in Spark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bound of the guarded denominator, rounding digits of the
# result table (R² 4, other metrics 2).
RATIO_FLOOR = 1e-6
R2_DIGITS = 4
METRIC_DIGITS = 2


def c(name: str) -> Column:
    """Column by name; back-ticks make names with '/' or spaces safe."""
    return F.col(f"`{name}`")


def col_of(x) -> Column:
    return x if isinstance(x, Column) else c(x)


def nan_to_null(x) -> Column:
    x = col_of(x)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def no_nan(df, cols=None):
    """NaN in the float columns (of ``cols``) becomes null: a missing value, as in pandas."""
    kinds = dict(df.dtypes)
    own = [x for x in (cols or df.columns) if kinds.get(x) in ("double", "float")]
    return df.withColumns({x: nan_to_null(x) for x in own}) if own else df


def correlation(a, b) -> Column:
    """Aggregate: Pearson correlation over rows where both sides are present, null if either is constant there
    (the built-in one divides by zero under ANSI rules)."""
    a, b = col_of(a).cast("double"), col_of(b).cast("double")
    both = a.isNotNull() & b.isNotNull()
    spread = F.sqrt(F.var_pop(F.when(both, a)) * F.var_pop(F.when(both, b)))
    return F.when(spread > 0, F.try_divide(F.covar_pop(a, b), spread))


def clip_lower(x, lower: float = 0.0) -> Column:
    """``x.clip(lower=...)``: values below ``lower`` become ``lower``; null stays null."""
    x = col_of(x)
    return F.when(x < F.lit(lower), F.lit(float(lower))).otherwise(x)


def guarded_ratio(num, den, floor: float = RATIO_FLOOR) -> Column:
    """``num / clip(den, lower=floor)`` — cannot divide by zero."""
    return col_of(num) / clip_lower(den, floor)


def log_feature(x) -> Column:
    """``log1p(clip(x, 0))``."""
    return F.log1p(clip_lower(x, 0.0))


def inverse_target(pred, correction: Column | float | None = None) -> Column:
    """``expm1(pred)`` optionally times a bias-correction factor."""
    out = F.expm1(col_of(pred))
    if correction is not None:
        out = out * (correction if isinstance(correction, Column) else F.lit(float(correction)))
    return out


def bias_factor(mean_y_log: Column, mean_pred_log: Column) -> Column:
    """``exp(mean(y_log_train) - mean(pred_log_train))``."""
    return F.exp(mean_y_log - mean_pred_log)


def in_units(x, unit: float = 1e9) -> Column:
    return col_of(x) / F.lit(float(unit))


def pct_error(pred, actual) -> Column:
    """Signed percent error, 0 when the actual value is 0."""
    p, a = col_of(pred), col_of(actual)
    return F.when(a != 0, (p - a) / a * 100.0).otherwise(F.lit(0.0))


def slug(x) -> Column:
    """Lower case with '/' and ' ' replaced by '_' (file-name safe)."""
    return F.translate(F.lower(col_of(x)), "/ ", "__")


def slug_str(s: str) -> str:
    return s.lower().replace("/", "_").replace(" ", "_")


def safe_name(s: str) -> str:
    """A name usable as an ML column name (no back-ticks needed)."""
    out = "".join(ch if ch.isalnum() or ch == "_" else "_" for ch in s)
    return out


def find_column(columns, *needles: str, fallback_needles: tuple[str, ...] = ()) -> str | None:
    """Case-insensitive lookup: first column containing all ``needles``,
    else the first containing all ``fallback_needles``."""
    for cand in columns:
        low = cand.lower()
        if all(n.lower() in low for n in needles):
            return cand
    if fallback_needles:
        for cand in columns:
            low = cand.lower()
            if all(n.lower() in low for n in fallback_needles):
                return cand
    return None


def round_half_away(x, digits: int = 0) -> Column:
    """C-style ``round(x * 10^d) / 10^d`` on the binary double value.

    Spark's ``round`` rounds the shortest decimal string of a double
    (``263656.035`` -> ``.04``), SQL engines that follow C ``round`` round the
    stored binary value (``263656.03499...`` -> ``.03``).  This builds the latter
    from JVM-side functions so a Spark result can be compared value-for-value.
    """
    m = float(10 ** digits)
    v = col_of(x).cast("double") * F.lit(m)
    fl = F.floor(v).cast("double")
    r = F.when(v - fl == 0.5, F.when(v > 0, fl + 1.0).otherwise(fl)).otherwise(F.rint(v))
    return r / F.lit(m)


def explode_rows(df, rows, keep=()):
    """Unpivot: every input row yields one output row per ``(condition,
    fields)`` entry whose condition holds.  ``inline`` of a struct array plus a
    plain ``where`` stays in generated code (a ``filter`` lambda over the array
    is interpreted and several times slower)."""
    arr = F.array(*[F.struct(cond.alias("__keep"), *fields) for cond, fields in rows])
    return df.select(*[col_of(k) for k in keep], F.inline(arr)).where(F.col("__keep")).drop("__keep")


def hash_bucket(key, salt: str, modulo: int) -> Column:
    """Deterministic bucket in [0, modulo) from md5(salt|key).

    The same expression is valid in DuckDB, so a split made here can be checked
    against SQL.  It depends only on the key, never on partitioning.
    """
    h = F.md5(F.concat(F.lit(f"{salt}|"), col_of(key).cast("string")))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(modulo))
