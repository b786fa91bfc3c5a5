import numpy as np
import pandas as pd
import pytest

from finlens.operators import charts as ch
from finlens.operators import profile as pf


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    n = 400
    x = rng.lognormal(0, 1, n)
    y = 2 * x + rng.normal(0, 1, n)
    z = np.round(rng.normal(0, 1, n), 1)
    pdf = pd.DataFrame({"x": x, "y": y, "z": z, "cat": rng.choice(["a", "b", "c", None], n)})
    pdf.loc[::11, "y"] = np.nan
    pdf.loc[::17, "z"] = np.nan
    rows = [tuple(None if (isinstance(v, float) and np.isnan(v)) else v for v in r) for r in pdf.itertuples(index=False)]
    sdf = spark.createDataFrame(rows, "x double, y double, z double, cat string")
    return pdf, sdf


def test_moments_match_pandas(data):
    pdf, sdf = data
    m = pf.moments(sdf, ["x", "y", "z"]).toPandas().set_index("column")
    for c in "xyz":
        assert abs(m.loc[c, "skew"] - pdf[c].skew()) < 1e-9
        assert abs(m.loc[c, "kurt"] - pdf[c].kurt()) < 1e-9
    assert not m.loc["x", "normal"]  # log-normal is not normal


def test_pearson_spearman_pairwise_complete(data):
    pdf, sdf = data
    p = pf.pearson(sdf, ["x", "y", "z"]).toPandas().set_index(["a", "b"])["r"]
    s = pf.spearman(sdf, ["x", "y", "z"], buckets=8).toPandas().set_index(["a", "b"])["r"]
    wp = pdf[["x", "y", "z"]].corr("pearson")
    ws = pdf[["x", "y", "z"]].corr("spearman")
    for a in "xyz":
        for b in "xyz":
            assert abs(p[(a, b)] - wp.loc[a, b]) < 1e-9
            assert abs(s[(a, b)] - ws.loc[a, b]) < 1e-9


def test_describe_and_missing(data):
    pdf, sdf = data
    d = pf.describe(sdf, ["x", "y"]).toPandas().set_index("column")
    w = pdf[["x", "y"]].describe()
    for c in "xy":
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"),
                             ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert abs(d.loc[c, ours] - w.loc[theirs, c]) < 1e-9
    m = pf.missing_table(sdf).toPandas().set_index("column")
    assert m.loc["y", "count"] == pdf["y"].isna().sum() and "x" not in m.index
    assert list(m.sort_values("pos").index)[0] == pdf.isna().sum().sort_values(ascending=False).index[0]


def test_value_counts_ties_and_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), ("c",)], "v string")
    r = [(x.value, x["count"], x.pos) for x in pf.value_counts(df, "v").orderBy("pos").collect()]
    assert r == [("a", 2, 1), ("b", 2, 2), ("c", 1, 3)]


def test_outliers_match_pandas(data):
    pdf, sdf = data
    z = pf.zscore_outliers(sdf, ["x"]).first()["z_outliers"]
    xs = pdf["x"].dropna()
    assert z == int((np.abs((xs - xs.mean()) / xs.std(ddof=0)) > 3).sum())
    o = pf.iqr_outliers(sdf, ["x", "y"]).toPandas().set_index("column")
    for c in "xy":
        q1, q3 = pdf[c].quantile(0.25), pdf[c].quantile(0.75)
        want = int(((pdf[c] < q1 - 1.5 * (q3 - q1)) | (pdf[c] > q3 + 1.5 * (q3 - q1))).sum())
        assert o.loc[c, "iqr_outliers"] == want


def test_group_profile_drops_missing_group(data):
    pdf, sdf = data
    g = pf.group_profile(sdf, "cat", "y", "x").toPandas().set_index("group")
    w = pdf.dropna(subset=["cat"]).groupby("cat").agg(m=("y", "mean"), md=("y", "median"), c=("y", "count"),
                                                      xm=("x", "median"))
    assert set(g.index) == set(w.index)
    for k in w.index:
        assert abs(g.loc[k, "target_mean"] - w.loc[k, "m"]) < 1e-9
        assert abs(g.loc[k, "target_median"] - w.loc[k, "md"]) < 1e-9
        assert abs(g.loc[k, "second_median"] - w.loc[k, "xm"]) < 1e-9
        assert g.loc[k, "target_count"] == w.loc[k, "c"]
    assert list(g.sort_values("pos").index) == list(w.sort_values("m", ascending=False).index)


def test_box_stats_whiskers(data):
    pdf, sdf = data
    b = ch.box_stats(sdf, ["x"]).first()
    xs = pdf["x"]
    q1, q3 = xs.quantile(0.25), xs.quantile(0.75)
    assert b["whisker_hi"] == xs[xs <= q3 + 1.5 * (q3 - q1)].max()
    assert b["whisker_lo"] == xs[xs >= q1 - 1.5 * (q3 - q1)].min()
    assert abs(b["notch_hi"] - (xs.median() + 1.57 * (q3 - q1) / np.sqrt(len(xs)))) < 1e-9


def test_histogram_counts_sum(data):
    pdf, sdf = data
    h = ch.histogram(sdf, ["x", "y"], 10).toPandas()
    assert h.groupby("column")["count"].sum().to_dict() == {"x": 400, "y": int(pdf["y"].notna().sum())}
    assert h["bin"].between(0, 9).all()


def test_spearman_columns_missing_together(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    n = 400
    x = np.round(rng.normal(size=n), 1)
    y = np.round(x + rng.normal(size=n), 1)
    z = np.round(rng.normal(size=n), 1)
    gone = rng.random(n) < 0.2  # x and y missing together
    x[gone], y[gone] = np.nan, np.nan
    z[rng.random(n) < 0.1] = np.nan  # z missing on its own
    pdf = pd.DataFrame({"x": x, "y": y, "z": z})
    sdf = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in pdf.itertuples(index=False)],
                                "x double, y double, z double")
    got = pf.spearman(sdf, ["x", "y", "z"], buckets=8).toPandas().set_index(["a", "b"])["r"]
    want = pdf.corr(method="spearman")
    for a in "xyz":
        for b in "xyz":
            assert abs(got[(a, b)] - want.loc[a, b]) < 1e-12, (a, b)
