"""Distributed exact ranks and exact quantiles (W1 and its users).

Spark's exact ``percentile`` keeps a value -> count map of a whole group in one
task, and a global ``Window.orderBy`` runs in one partition.  Neither holds at
scale, so ranks are computed in four bounded steps:

1. **cut points** — one ``percentile_approx`` pass gives ``B`` cut values per
   column (driver receives ``B`` doubles per column: a proven bound);
2. **bucket** — ``Bucketizer`` (JVM binary search) gives every value a bucket;
   buckets are monotone in the value, so a rank is
   ``offset(bucket) + running count inside the bucket``;
3. **pre-aggregate** — ``groupBy(key, bucket, value).count`` collapses repeated
   values map-side, so a value holding a third of all rows becomes one row;
4. **prefix sums** — a running sum per ``(key, bucket)`` window (bounded by
   ~rows/B distinct values) plus bucket offsets from a table of ``#keys x B``
   rows.

The result, one row per distinct ``(key, value)``, gives each value the 1-based
rank interval ``[cum - cnt + 1, cum]``; its average (pandas ``rank()``) is
``cum - (cnt - 1) / 2``.

Ranks *attached to rows* (:func:`rank_columns`, Spearman) need no cut points: range partitions over the distinct values,
running counts within a partition and one small table of partition counts, then every row's ranks come back as columns.

Quantiles need only the values at two ranks per target, so they skip the full
rank table: a histogram over a data-independent monotone bucket locates exact
brackets, and only the rows inside them are ranked (:func:`bracket_quantiles`).
Exact linear quantiles read the values at ranks ``floor(h)+1`` and
``ceil(h)+1`` with ``h = (n - 1) p`` — the same definition as pandas
``quantile`` and SQL ``quantile_cont``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from finlens.functions.exprs import c, explode_rows, nan_to_null
from finlens.operators.positions import written
from finlens.session import ensure_checkpoint_dir

DEFAULT_BUCKETS = 64
# upper bound on buckets per column: the driver receives that many cut points
MAX_BUCKETS = 100_000
# sketch accuracy for cut points is capped: its error only moves rows between
# neighbouring buckets, and a larger sketch costs executor memory per task
MAX_CUT_ACCURACY = 1_000_000
# sub-buckets per narrowing round of a quantile bracket
DEFAULT_ACCURACY = 10000
# rows a single (key, target) selection bracket may hold before it is narrowed
MAX_BRACKET = 2_000_000
# log buckets per power of two in the first histogram pass
LOG_STEPS = 16
# targets (#keys x #probs rows, ~100 bytes each) broadcast up to this many rows;
# beyond it the bracket join shuffles on the keys
MAX_BROADCAST_TARGETS = 500_000
_INF = float("inf")
# bucket ids: magnitudes of finite non-zero doubles land in [1, 2 * _LOG_OFFSET]
_LOG_OFFSET = 1100 * LOG_STEPS
_INF_BUCKET = 4 * _LOG_OFFSET
_NAN_BUCKET = 5 * _LOG_OFFSET


def as_value(col) -> Column:
    """Double with signed zero normalised (``-0.0 + 0.0 == 0.0``): Java's
    array search orders -0.0 below 0.0, SQL equality does not."""
    return col.cast("double") + F.lit(0.0)


def _splits(cuts) -> list[float]:
    vals = sorted({float(x) for x in (cuts or []) if x is not None and x == x})
    vals = [v for v in vals if v not in (_INF, -_INF)]
    if not vals:
        vals = [0.0]
    return [-_INF, *vals, _INF]


def session_buckets(spark) -> int:
    """Buckets per column when the caller gives none: the session's shuffle
    partition count (which a cluster sizes to its data), at least
    ``DEFAULT_BUCKETS`` and at most ``MAX_BUCKETS``.  One ``(column, bucket)``
    window then holds about one shuffle partition's worth of values, and the
    rank step runs in as many parallel tasks as the cluster is sized for."""
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions", str(DEFAULT_BUCKETS)))
    except ValueError:  # "auto" on some platforms
        n = DEFAULT_BUCKETS
    return max(DEFAULT_BUCKETS, min(MAX_BUCKETS, n))


def cut_points(df: DataFrame, cols: Sequence[str], buckets: int | None = None,
               accuracy: int | None = None, extra: Sequence[Column] = ()) -> dict[str, list[float]]:
    """Bucket splits per column from one ``percentile_approx`` pass.

    Cut points only balance the buckets (their error moves rows between
    neighbouring buckets, never breaks exactness), so the sketch accuracy is
    kept proportional to the bucket count (capped).  ``extra`` aggregates ride
    along in the same pass; their values are returned under ``"__extra"``."""
    buckets = buckets or session_buckets(df.sparkSession)
    accuracy = accuracy or min(MAX_CUT_ACCURACY, max(1000, 50 * buckets))
    probs = [i / buckets for i in range(1, buckets)]
    row = df.agg(*[F.percentile_approx(as_value(c(col)), probs, accuracy).alias(f"q{i}")
                   for i, col in enumerate(cols)], *extra).first()
    out = {col: _splits(row[f"q{i}"]) for i, col in enumerate(cols)}
    out["__extra"] = row
    return out


def bucketize(df: DataFrame, cols: Sequence[str], splits: dict[str, list[float]],
              prefix: str = "__b_") -> DataFrame:
    """Add ``{prefix}{i}`` bucket ids for ``cols`` (JVM-side binary search)."""
    if not cols:
        return df
    tmp = [f"__v_{i}" for i in range(len(cols))]
    out = [f"{prefix}{i}" for i in range(len(cols))]
    staged = df.select("*", *[as_value(c(col)).alias(t) for col, t in zip(cols, tmp)])
    b = Bucketizer(inputCols=tmp, outputCols=out, splitsArray=[splits[col] for col in cols],
                   handleInvalid="keep")
    return b.transform(staged).drop(*tmp)


def long_values(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
                splits: dict[str, list[float]] | None = None, conds: dict[str, Column] | None = None,
                only: set[tuple[str, str]] | None = None) -> DataFrame:
    """Unpivot to ``(keys..., column, cond, value, bucket)`` without nulls.

    ``conds`` maps a condition name to a boolean Column; for each condition an
    extra copy of every value is emitted where the condition holds (used for
    pairwise-complete ranks).  ``only`` restricts those copies to the listed
    ``(column, condition)`` pairs.  Condition ``""`` (all rows) is always
    present.
    """
    if splits is None:
        splits = cut_points(df, cols)
    bdf = bucketize(df, cols, splits)
    rows = []
    conds = conds or {}
    for i, col in enumerate(cols):
        v = as_value(c(col))
        b = F.col(f"__b_{i}").cast("int")
        rows.append((v.isNotNull(), [F.lit(col).alias("column"), F.lit("").alias("cond"), v.alias("value"),
                                     b.alias("bucket")]))
        for name, cond in conds.items():
            if name == col or (only is not None and (col, name) not in only):
                continue
            rows.append((v.isNotNull() & cond, [F.lit(col).alias("column"), F.lit(name).alias("cond"),
                                                v.alias("value"), b.alias("bucket")]))
    return explode_rows(bdf, rows, keep=keys)


def rank_table(long_df: DataFrame, keys: Sequence[str] = ("column",)) -> DataFrame:
    """Distinct ``(keys..., value)`` with ``cnt``, ``cum`` (rows <= value),
    ``n`` (rows in key) and ``avg_rank``.  Input needs ``value`` and ``bucket``."""
    keys = list(keys)
    d = long_df.groupBy(*keys, "bucket", "value").agg(F.count(F.lit(1)).alias("cnt"))
    per_bucket = d.groupBy(*keys, "bucket").agg(F.sum("cnt").alias("bcnt"))
    wk = Window.partitionBy(*keys).orderBy("bucket")
    offsets = (per_bucket
               .withColumn("offset", F.coalesce(F.sum("bcnt").over(wk.rowsBetween(Window.unboundedPreceding, -1)),
                                                F.lit(0)))
               .withColumn("n", F.sum("bcnt").over(Window.partitionBy(*keys)))
               .select(*keys, "bucket", "offset", "n"))
    wv = Window.partitionBy(*keys, "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding,
                                                                          Window.currentRow)
    ranked = d.withColumn("cum_in", F.sum("cnt").over(wv)).join(offsets, [*keys, "bucket"])
    return ranked.select(
        *keys, "value", "cnt", "n",
        (F.col("offset") + F.col("cum_in")).alias("cum"),
    ).withColumn("avg_rank", F.col("cum") - (F.col("cnt") - 1) / 2.0)


@dataclass
class RankColumns:
    """Rows with their ranks: ``table`` has one row per input row with ``__r{i}``, an array of average ranks of column ``i``;
    ``slot[i][j]`` is the place in it of the rank among the rows where column ``j`` is present too (0: among all rows where
    ``i`` is present), ``size[i][k]`` the number of rows ranked at place ``k``."""

    table: DataFrame
    slot: list[list[int]]
    size: list[list[int]]

    def centred(self, i: int, j: int) -> str:
        """SQL: rank of ``i`` among the rows where ``j`` is present, less the mean rank ``(n + 1) / 2``; null outside them."""
        k = self.slot[i][j]
        return f"IF(__r{j} IS NULL, NULL, __r{i}[{k}] - {(self.size[i][k] + 1) / 2!r}D)"


def rank_columns(df: DataFrame, cols: Sequence[str], parts: int | None = None) -> RankColumns:
    """Average ranks of every column attached to its rows, also pairwise-complete ones.

    1. the columns are written once as doubles, with a row id, so that every later pass reads the same rows;
    2. one aggregate finds the ordered pairs (a, b) with rows where a is present and b missing: only there does the rank of
       a among the rows of b differ from its plain rank;
    3. ``(column, value) -> counts``, one counter for all rows and one for each such b (hot values collapse map-side), range
       partitioned by (column, value); running counts within a partition, and offsets from one row per (partition, column);
    4. the rows' values meet their ranks on (column, value), where AQE splits a hot value's rows, and one grouping by
       the row id makes them columns.

    Every shuffle carries at most ``#cols x rows`` short rows, whatever the number of pairs.  A row without any value gets no
    ranks.  ``parts`` is the number of range partitions (the session's shuffle partitions)."""
    spark, cols = df.sparkSession, list(cols)
    d = range(len(cols))
    parts = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = written(df.select(*[as_value(nan_to_null(c(x).cast("double"))).alias(f"v{i}") for i, x in enumerate(cols)],
                             F.monotonically_increasing_id().alias("rid")), "ranked-rows")
    gaps = base.agg(F.count(F.lit(1)), *[F.expr(f"count_if(v{i} IS NOT NULL AND v{j} IS NULL) AS x{i}_{j}")
                                               for i in d for j in d if i != j]).first()
    need = [[j for j in d if j != i and gaps[f"x{i}_{j}"]] for i in d]
    asked = sorted({j for js in need for j in js})
    slot = [[1 + need[i].index(j) if j in need[i] else 0 for j in d] for i in d]
    present = lambda i: F.col(f"v{i}").isNotNull()
    values = explode_rows(base, [(present(i), [F.lit(i).alias("i"), F.col(f"v{i}").alias("value"),
                                               *[present(j).alias(f"p{j}") for j in asked]]) for i in d])
    kinds = ["all", *[str(j) for j in asked]]
    counts = values.groupBy("i", "value").agg(F.count(F.lit(1)).alias("n_all"), *[F.count_if(F.col(f"p{j}")).alias(f"n_{j}") for j in asked])
    counts = written(counts.repartitionByRange(parts, "i", "value").withColumn("part", F.spark_partition_id()), "ranked-values")
    totals = [[0] * len(kinds) for _ in d]
    before = []
    for r in counts.groupBy("part", "i").agg(*[F.sum(f"n_{k}").alias(f"n_{k}") for k in kinds]).orderBy("i", "part").collect():
        # one row per range partition, and one more per column that begins inside a partition
        before.append((r["part"], r["i"], *totals[r["i"]]))
        totals[r["i"]] = [t + r[f"n_{k}"] for t, k in zip(totals[r["i"]], kinds, strict=True)]
    schema = "part int, i int" + "".join(f", o_{k} long" for k in kinds)
    w = Window.partitionBy("part", "i").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = lambda k: F.col(f"o_{k}") + F.sum(f"n_{k}").over(w) - (F.col(f"n_{k}") - 1) / 2.0
    ranked = counts.join(F.broadcast(spark.createDataFrame(before, schema)), ["part", "i"]).select(
        "i", "value", *[rank(k).alias(f"r_{k}") for k in kinds])
    # the places of a column's array follow its own list of conditions
    own = F.coalesce(*[F.when(F.col("i") == i, F.array(F.col("r_all"), *[F.col(f"r_{j}") for j in need[i]])) for i in d])
    rows = explode_rows(base, [(present(i), [F.lit(i).alias("i"), F.col(f"v{i}").alias("value")]) for i in d], keep=("rid",))
    table = rows.join(ranked.select("i", "value", own.alias("r")), ["i", "value"]).groupBy("rid").agg(
        *[F.max(F.when(F.col("i") == i, F.col("r"))).alias(f"__r{i}") for i in d])
    size = [[totals[i][0], *[totals[i][1 + asked.index(j)] for j in need[i]]] for i in d]
    return RankColumns(table, slot, size)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    names: Sequence[str] | None = None, by: Sequence[str] = (),
                    accuracy: int = DEFAULT_ACCURACY, approx_accuracy: int | None = None,
                    max_bracket: int = MAX_BRACKET) -> DataFrame:
    """Quantiles of ``cols`` (optionally per ``by`` group) in long form:
    ``(by..., column, n, <name per prob>)``.  Missing values are ignored;
    linear interpolation as pandas ``quantile`` / SQL ``quantile_cont``.

    Exact by distributed selection (see :func:`bracket_quantiles`);
    ``accuracy`` is the number of sub-buckets per narrowing round.
    ``approx_accuracy`` switches to plain ``percentile_approx`` (one bounded
    sketch per group, no exact guarantee)."""
    by = list(by)
    names = list(names) if names else [f"q{int(round(p * 100))}" for p in probs]
    long_df = explode_rows(df, [(c(x).isNotNull(), [F.lit(x).alias("column"), as_value(c(x)).alias("value")])
                                for x in cols], keep=by)
    if approx_accuracy:
        agg = long_df.groupBy(*by, "column").agg(
            F.count(F.lit(1)).alias("n"), F.percentile_approx("value", list(probs), approx_accuracy).alias("__q"))
        return agg.select(*by, "column", "n", *[F.col("__q")[i].alias(nm) for i, nm in enumerate(names)])
    return bracket_quantiles(long_df, [*by, "column"], probs, names, accuracy, max_bracket)


def _log_bucket(v: Column) -> Column:
    """Data-independent bucket id that never decreases as ``v`` grows:
    ``LOG_STEPS`` buckets per power of two, mirrored for negatives, 0 for zero,
    the extremes for infinities and NaN (which SQL orders last)."""
    mag = F.floor(F.log2(F.abs(v)) * LOG_STEPS).cast("long") + F.lit(_LOG_OFFSET + 1)
    return (F.when(F.isnan(v), F.lit(_NAN_BUCKET))
            .when(v == F.lit(_INF), F.lit(_INF_BUCKET))
            .when(v == F.lit(-_INF), F.lit(-_INF_BUCKET))
            .when(v > 0, mag)
            .when(v < 0, -mag)
            .otherwise(F.lit(0)).cast("long"))


def _linear_bucket(v: Column, lo: Column, hi: Column, steps: int) -> Column:
    """Equal-width sub-bucket of ``[lo, hi]`` (never decreasing in ``v``)."""
    return F.least(F.floor((v - lo) / (hi - lo) * F.lit(float(steps))).cast("long"), F.lit(steps - 1))


def _band_join(long_df: DataFrame, keys: Sequence[str], brackets: DataFrame) -> DataFrame:
    """Rows of ``long_df`` inside a bracket ``[lo, hi]`` of their key (brackets of a key are disjoint, so a row comes
    once at most): a null-safe equi-join on the keys with the band test evaluated inside the join."""
    tk = brackets.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                         *[x for x in brackets.columns if x not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    on += [F.col("value") >= F.col("lo"), F.col("value") <= F.col("hi")]
    return long_df.join(tk, on).drop(*[f"__k{i}" for i in range(len(keys))])


def _brackets(hist: DataFrame, part: Sequence[str], keys: Sequence[str], bucket: str) -> DataFrame:
    """From ``(part..., bucket, bc, bmin, bmax, below, wanted, n)`` the buckets that hold a wanted rank.

    Every row of an earlier bucket is smaller (the bucket id never decreases with the value), so the running count says which
    ranks a bucket holds, and its ``[min, max]`` is an exact bracket for them.  ``below`` counts the rows under the
    histogram's range."""
    w = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    under = F.sum("bc").over(w) - F.col("bc") + F.col("below")
    out = hist.withColumn("below", under)
    own = F.filter("wanted", lambda r: (r > F.col("below")) & (r <= F.col("below") + F.col("bc")))
    return out.select(*keys, "n", "below", F.col("bc").alias("rows"), F.col("bmin").alias("lo"), F.col("bmax").alias("hi"),
                      own.alias("wanted")).where(F.size("wanted") > 0)


def _held(df: DataFrame) -> tuple[DataFrame, list | None]:
    """A small table fixed where it is: up to MAX_BROADCAST_TARGETS rows as a local relation, whose size the planner knows, and
    its rows; otherwise checkpointed."""
    rows = [r.asDict() for r in df.take(MAX_BROADCAST_TARGETS + 1)]
    if len(rows) <= MAX_BROADCAST_TARGETS:
        return _local(df, rows), rows
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True), None


def _local(like: DataFrame, rows: list) -> DataFrame:
    table = pa.Table.from_pylist(rows, schema=to_arrow_schema(like.schema))  # an Arrow table becomes a local relation
    return F.broadcast(like.sparkSession.createDataFrame(table, like.schema))


def rounds_needed(accuracy: int) -> int:
    """Narrowing rounds after which no bracket can hold two values: a log bucket's doubles lie within two powers of two, so
    at most 2^53 of them, and a round keeps an ``accuracy``-th of the range."""
    return 2 + math.ceil(53 / math.log2(max(2, accuracy)))


def bracket_quantiles(long_df: DataFrame, keys: Sequence[str], probs: Sequence[float], names: Sequence[str],
                      accuracy: int = DEFAULT_ACCURACY, max_bracket: int = MAX_BRACKET) -> DataFrame:
    """Exact quantiles by histogram selection (distributed, sketch-free).

    1. *histogram* — one partial aggregate of ``(key, log bucket) -> count, min, max`` (a few thousand rows per key at
       most, whatever the size); running counts locate the bucket of every wanted rank.  The two ranks around a
       quantile are wanted each for itself, so a bracket never spans a gap between buckets;
    2. *narrow* (only brackets over ``max_bracket`` rows whose ends differ) — the same over ``accuracy`` equal-width
       sub-buckets of the bracket; only its rows pass the join, the rows below it are already counted.  Within one
       log bucket doubles are evenly spaced, so the rounds are bounded (:func:`rounds_needed`) whatever the values;
    3. *select* — running counts over the distinct values of a bracket, at most ``max_bracket`` of them.  A bracket of
       one value needs no rows at all.

    A value holding a third of all rows is one histogram entry and one distinct bracket value; no task ever sorts a
    whole column."""
    keys = list(keys)
    hist = long_df.groupBy(*keys, _log_bucket(F.col("value")).alias("b")).agg(
        F.count(F.lit(1)).alias("bc"), F.min("value").alias("bmin"), F.max("value").alias("bmax"))
    h = [(F.col("n") - 1).cast("double") * F.lit(float(p)) for p in probs]
    ranks = [e for x in h for e in (F.floor(x) + 1, F.ceil(x) + 1)]
    hist = hist.withColumn("n", F.sum("bc").over(Window.partitionBy(*keys))).withColumns(
        {"below": F.lit(0).cast("long"), "wanted": F.array_distinct(F.array(*ranks))})
    targets, rows = _held(_brackets(hist, keys, keys, "b"))
    steps = max(2, int(accuracy))
    wide = (F.col("rows") > max_bracket) & (F.col("lo") < F.col("hi"))

    def parted(test: Column, plain) -> tuple[DataFrame, DataFrame, bool]:
        """The targets that pass a test, the others, and whether any passes; without a job where the rows are at hand."""
        if rows is None:
            return targets.where(test), targets.where(~test), bool(targets.where(test).take(1))
        yes = [r for r in rows if plain(r)]
        return _local(targets, yes), _local(targets, [r for r in rows if not plain(r)]), bool(yes)

    for _ in range(rounds_needed(steps)):
        some, done, any_ = parted(wide, lambda r: r["rows"] > max_bracket and r["lo"] < r["hi"])
        if not any_:
            break
        part = [*keys, "below"]
        sub = _band_join(long_df, keys, some).groupBy(
            *part, _linear_bucket(F.col("value"), F.col("lo"), F.col("hi"), steps).alias("sb")).agg(
            F.count(F.lit(1)).alias("bc"), F.min("value").alias("bmin"), F.max("value").alias("bmax"),
            F.first("n").alias("n"), F.first("wanted").alias("wanted"))
        targets, rows = _held(done.unionByName(_brackets(sub, part, keys, "sb")))
    else:
        if parted(wide, lambda r: r["rows"] > max_bracket and r["lo"] < r["hi"])[2]:
            raise RuntimeError("quantile brackets did not shrink")
    # a bracket of one value (or of NaN) needs no rows; NaN is above all others, so lo < hi fails for it
    some, known, any_ = parted((F.col("lo") < F.col("hi")) & ~F.isnan("hi"), lambda r: r["lo"] < r["hi"])
    found = known.select(*keys, "n", F.explode("wanted").alias("r"), F.col("lo").alias("v"))
    if any_:
        d = _band_join(long_df, keys, some).groupBy(*keys, "below", F.col("value").alias("v")).agg(
            F.count(F.lit(1)).alias("cnt"), F.first("n").alias("n"), F.first("wanted").alias("wanted"))
        w = Window.partitionBy(*keys, "below").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        d = d.withColumn("cum", F.sum("cnt").over(w) + F.col("below"))
        own = F.filter("wanted", lambda r: (r > F.col("cum") - F.col("cnt")) & (r <= F.col("cum")))
        found = found.unionByName(d.select(*keys, "n", F.explode(own).alias("r"), "v"))
    at = lambda rank: F.max(F.when(F.col("r") == rank, F.col("v")))
    got = found.groupBy(*keys, "n").agg(*[e for t, x in enumerate(h) for e in (at(F.floor(x) + 1).alias(f"__lo{t}"), at(F.ceil(x) + 1).alias(f"__hi{t}"))])
    # equal ends are the quantile: infinite ones have no difference
    between = lambda t, x: F.when(F.col(f"__lo{t}") == F.col(f"__hi{t}"), F.col(f"__lo{t}")).otherwise(
        F.col(f"__lo{t}") + (F.col(f"__hi{t}") - F.col(f"__lo{t}")) * (x - F.floor(x)))
    result = got.select(*keys, "n", *[between(t, x).alias(nm) for t, (x, nm) in enumerate(zip(h, names, strict=True))])
    # one row per key: callers join it back to the data on the keys
    return _held(result)[0]
