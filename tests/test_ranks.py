import numpy as np
import pandas as pd

from finlens.operators import ranks


def _frame(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    a = np.round(rng.lognormal(0, 2, n), 1)  # heavy tail + ties
    a[: n // 3] = 7.0  # a hot value holding a third of the rows
    b = rng.integers(0, 5, n).astype(float)  # few distinct values
    g = rng.choice(["x", "y", "z"], n, p=[0.6, 0.3, 0.1])
    pdf = pd.DataFrame({"a": a, "b": b, "g": g})
    pdf.loc[rng.choice(n, 100, replace=False), "a"] = np.nan
    sdf = spark.createDataFrame([(None if np.isnan(r.a) else float(r.a), float(r.b), r.g) for r in pdf.itertuples()],
                                "a double, b double, g string")
    return pdf, sdf


def test_exact_quantiles_match_linear_interpolation(spark):
    pdf, sdf = _frame(spark)
    # small sketch accuracy (wide brackets), and a forced refinement round
    for kw in ({"accuracy": 50}, {"accuracy": 10000}, {"accuracy": 100, "max_bracket": 10}):
        q = ranks.exact_quantiles(sdf, ["a", "b"], (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0),
                                  ("p0", "p10", "q1", "med", "q3", "p99", "p100"), **kw).toPandas().set_index("column")
        for col in ["a", "b"]:
            want = pdf[col].quantile([0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]).to_numpy()
            got = q.loc[col, ["p0", "p10", "q1", "med", "q3", "p99", "p100"]].to_numpy(dtype=float)
            assert np.allclose(got, want, rtol=0, atol=1e-9), (kw, col, got, want)
            assert q.loc[col, "n"] == pdf[col].notna().sum()


def test_grouped_quantiles(spark):
    pdf, sdf = _frame(spark)
    q = ranks.exact_quantiles(sdf, ["a"], (0.5,), ("med",), by=("g",), accuracy=30).toPandas().set_index("g")
    want = pdf.groupby("g")["a"].median()
    for g, v in want.items():
        assert abs(q.loc[g, "med"] - v) < 1e-9


def test_average_ranks_match_pandas(spark):
    pdf, sdf = _frame(spark, n=800)
    splits = ranks.cut_points(sdf, ["a"], 8)
    rt = ranks.rank_table(ranks.long_values(sdf, ["a"], splits=splits), keys=("column", "cond")).toPandas()
    got = dict(zip(rt["value"], rt["avg_rank"]))
    want = pdf["a"].dropna().rank(method="average")
    for v, r in zip(pdf["a"].dropna(), want):
        assert got[v] == r


def test_approx_switch(spark):
    pdf, sdf = _frame(spark)
    q = ranks.exact_quantiles(sdf, ["b"], (0.5,), ("med",), approx_accuracy=10000).first()
    assert q["med"] == pdf["b"].median()


def test_session_buckets_follow_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert ranks.session_buckets(spark) == ranks.DEFAULT_BUCKETS
        spark.conf.set("spark.sql.shuffle.partitions", "4000")
        assert ranks.session_buckets(spark) == 4000
        spark.conf.set("spark.sql.shuffle.partitions", str(10 * ranks.MAX_BUCKETS))
        assert ranks.session_buckets(spark) == ranks.MAX_BUCKETS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_ranks_exact_with_more_buckets_than_values(spark):
    pdf, sdf = _frame(spark, n=400)
    splits = ranks.cut_points(sdf, ["a", "b"], 1000)
    rt = ranks.rank_table(ranks.long_values(sdf, ["a", "b"], splits=splits), keys=("column", "cond")).toPandas()
    for col in ("a", "b"):
        sub = rt[rt["column"] == col]
        got = dict(zip(sub["value"], sub["avg_rank"]))
        want = pdf[col].dropna().rank(method="average")
        for v, r in zip(pdf[col].dropna(), want):
            assert got[v] == r


def test_histogram_selection_edges(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([
        -np.round(rng.lognormal(3, 1, 300), 3),  # negatives
        np.zeros(50), -np.zeros(50),  # signed zeros
        1e6 + rng.integers(0, 400, 500) * 1e-9,  # tight cluster: one log bucket, needs narrowing rounds
        rng.uniform(1e-300, 1e-299, 20),  # tiny magnitudes
    ])
    keys = rng.choice(["p", "q"], len(vals))
    sdf = spark.createDataFrame([(float(v), str(k)) for v, k in zip(vals, keys)], "v double, k string")
    probs = (0.0, 0.05, 0.25, 0.5, 0.6, 0.75, 0.95, 1.0)
    for kw in ({}, {"max_bracket": 5, "accuracy": 4}, {"max_bracket": 1, "accuracy": 2}):
        q = ranks.exact_quantiles(sdf, ["v"], probs, by=("k",), **kw).toPandas().set_index("k")
        for k in ("p", "q"):
            want = np.quantile(vals[keys == k], probs)
            got = q.loc[k, [f"q{int(round(p * 100))}" for p in probs]].to_numpy(dtype=float)
            assert np.allclose(got, want, rtol=1e-15, atol=0), (kw, k, got, want)


def test_null_group_keeps_its_quantiles(spark):
    rows = [(float(v), None if v % 3 == 0 else "a") for v in range(200)]
    sdf = spark.createDataFrame(rows, "v double, g string")
    for kw in ({}, {"max_bracket": 3, "accuracy": 3}):
        q = {r["g"]: r["med"] for r in ranks.exact_quantiles(sdf, ["v"], (0.5,), ("med",), by=("g",), **kw).collect()}
        assert q[None] == np.median([v for v, g in rows if g is None])
        assert q["a"] == np.median([v for v, g in rows if g == "a"])


def test_brackets_end_whatever_the_values(spark, monkeypatch):
    """Passes over the data are counted: one histogram, then joins."""
    inf = float("inf")
    cases = {
        "two clusters": [1 + i * 1e-6 for i in range(500)] + [1e9 + i for i in range(500)],
        "infinite": [-inf] * 3 + [float(i) for i in range(300)] + [inf] * 400,
        "one value": [3.25] * 900,
        "close doubles": [1.0 + i * 2.0**-52 for i in range(700)],
        "tiny": [i * 5e-324 for i in range(600)],
        "signs": [-5.0] * 400 + [5.0] * 400,
        "single": [2.5],
    }
    rows = [(k, v) for k, vs in cases.items() for v in vs]
    sdf = spark.createDataFrame(rows, "k string, v double").repartition(4)
    probs = (0.0, 0.25, 0.5, 0.75, 1.0)
    joins = []
    real = ranks._band_join
    monkeypatch.setattr(ranks, "_band_join", lambda *a: joins.append(1) or real(*a))
    for kw, most in (({}, 1), ({"max_bracket": 10}, ranks.rounds_needed(10000) + 1), ({"max_bracket": 1, "accuracy": 2}, ranks.rounds_needed(2) + 1)):
        joins.clear()
        q = {r["k"]: r for r in ranks.exact_quantiles(sdf, ["v"], probs, by=("k",), **kw).collect()}
        assert len(joins) <= most
        for k, vs in cases.items():
            with np.errstate(invalid="ignore"):
                s = np.sort(vs)
                at = (len(s) - 1) * np.array(probs)
                lo, hi = s[np.floor(at).astype(int)], s[np.ceil(at).astype(int)]
                want = np.where(lo == hi, lo, lo + (hi - lo) * (at - np.floor(at)))
            got = np.array([q[k][f"q{int(100 * p)}"] for p in probs])
            assert np.array_equal(got, want), (k, kw, got, want)
    joins.clear()
    ranks.exact_quantiles(sdf.where("k = 'one value'"), ["v"], probs).collect()
    assert not joins  # a bracket of one value needs no rows
    assert ranks.exact_quantiles(sdf.where("false"), ["v"], probs).count() == 0


def test_spearman_of_columns_with_own_gaps(spark):
    from finlens.operators import profile as pf
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"hot": np.where(rng.random(900) < 0.4, 7.0, rng.integers(0, 40, 900)), "x": rng.normal(size=900),
                        "y": rng.integers(-3, 3, 900) * 0.5, "flat": 2.0, "it's `odd`": rng.random(900)})
    for i, col in enumerate(("hot", "x", "y")):
        pdf.loc[rng.choice(900, 60 * (i + 1), replace=False), col] = np.nan
    pdf["none"] = np.nan
    pdf.loc[pdf["y"] == 0, "y"] = -0.0
    sdf = spark.createDataFrame([tuple(map(float, r)) for r in pdf.itertuples(index=False)],
                                ", ".join(f"`{x.replace('`', '``')}` double" for x in pdf.columns)).withColumnRenamed("it's `odd`", "it's odd")
    pdf = pdf.rename(columns={"it's `odd`": "it's odd"})
    want = pdf.corr(method="spearman")
    for parts in (1, 3, None):
        got = pf.spearman(sdf, list(pdf.columns), parts).collect()
        assert len(got) == len(pdf.columns) ** 2
        for r in got:
            w = want.loc[r.a, r.b]
            assert (r.r is None) == bool(np.isnan(w)) and (r.r is None or abs(r.r - w) < 1e-9), (r, w)
    assert all(r.r is None for r in pf.spearman(sdf.limit(0), ["hot", "x"]).collect())


def test_rank_columns_match_pandas_and_are_not_multiplied_by_pairs(spark):
    pdf, sdf = _frame(spark, n=500)
    rc = ranks.rank_columns(sdf, ["a", "b"], 4)
    assert (rc.slot, rc.size) == ([[0, 0], [1, 0]], [[400], [500, 400]])  # b's ranks differ where a is missing
    assert rc.table.count() == 500
    got = rc.table.selectExpr("__r0[0] AS a", "__r1[0] AS b", "__r1[1] AS ba").toPandas()
    both = pdf[pdf["a"].notna()]
    for x, w in (("a", pdf["a"].dropna().rank()), ("b", pdf["b"].rank()), ("ba", both["b"].rank())):
        assert sorted(got[x].dropna() if x != "ba" else got.loc[got["a"].notna(), "ba"]) == sorted(w)
