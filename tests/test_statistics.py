"""Order statistics, profiles and correlations against pandas, also on many small buckets."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from conftest import by_key, rows_of
from pyspark.sql import functions as F

from tenura.operators import correlation, ordered, profile

random.seed(7)
N = 500
# a third of the rows share one value, some are missing
VALUES = [
    5.0 if i % 3 == 0 else None if i % 17 == 0 else round(random.gauss(0, 10), 1) for i in range(N)
]
GROUPS = ["a" if i % 5 else "b" for i in range(N)]
OTHER = [float(random.randint(0, 4)) for _ in range(N)]
FRAME = pd.DataFrame({"g": GROUPS, "v": pd.Series(VALUES, dtype=float), "w": OTHER, "i": range(N)})
FRAME["u"] = FRAME["v"].fillna(0) * 2 + FRAME["w"]


@pytest.fixture(scope="module")
def table(spark):
    rows = list(zip(GROUPS, VALUES, OTHER, range(N), FRAME["u"].tolist()))
    return spark.createDataFrame(rows, "g string, v double, w double, i int, u double").cache()


@pytest.mark.parametrize("per_bucket", [10, 1_000_000])
def test_average_ranks(table, per_bucket):
    counts = ordered.ordered_counts(table, "v", ["g"], rows_per_bucket=per_bucket)
    got = {
        (r["g"], r["v"]): r["rank"]
        for r in counts.select("g", "v", ordered.average_rank().alias("rank")).collect()
    }
    want = FRAME.dropna().assign(rank=FRAME.dropna().groupby("g")["v"].rank())
    assert got == {(r.g, r.v): r["rank"] for _, r in want.iterrows()}


@pytest.mark.parametrize("per_bucket", [10, 1_000_000])
def test_quantiles(table, per_bucket):
    probs = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.999, "f": 1.0}
    got = ordered.quantiles(table, "v", probs, ["g"], rows_per_bucket=per_bucket)
    for row in got.collect():
        want = FRAME[FRAME.g == row["g"]]["v"].quantile(list(probs.values())).tolist()
        assert [row[n] for n in probs] == pytest.approx(want)


@pytest.mark.parametrize("per_bucket", [25, 1_000_000])
def test_roc_auc_by_brute_force(spark, per_bucket):
    scores = [round(random.random(), 2) for _ in range(300)]
    labels = [int(random.random() < s) for s in scores]
    df = spark.createDataFrame(list(zip(scores, labels)), "p double, y int")
    pairs = [
        (1.0 if a > b else 0.5 if a == b else 0.0)
        for a, y in zip(scores, labels) if y == 1
        for b, z in zip(scores, labels) if z == 0
    ]
    got = ordered.roc_auc(df, "p", "y", rows_per_bucket=per_bucket).first()["roc_auc"]
    assert got == pytest.approx(sum(pairs) / len(pairs))


def test_roc_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "p double, y int")
    assert ordered.roc_auc(df, "p", "y").first()["roc_auc"] is None


def test_infinite_values_are_ordered(spark):
    values = [math.inf, -math.inf, 1.0, 2.0, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for per_bucket in (1, 1000):
        counts = ordered.ordered_counts(df, "v", rows_per_bucket=per_bucket)
        assert by_key(counts, "v", "before") == {-math.inf: 0, 1.0: 1, 2.0: 2, math.inf: 3}


def test_describe(table):
    got = {r["column_name"]: r for r in profile.describe(table, ["v", "u"]).collect()}
    want = FRAME[["v", "u"]].describe()
    for column in ("v", "u"):
        names = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
        assert [got[column][n] for n in names] == pytest.approx(want[column].tolist())


def test_sketched_statistics_are_close(table):
    exact = profile.describe(table, ["u"]).drop("column_name").first()
    near = profile.describe(table, ["u"], accuracy=10_000).drop("column_name").first()
    assert near.asDict() == pytest.approx(exact.asDict(), rel=0.05, abs=0.5)
    box, rough = (
        profile.box_stats(table, ["u"], ["g"], accuracy=a).orderBy("g").collect() for a in (None, 10_000)
    )
    for a, b in zip(box, rough):
        assert (a["g"], a["count"]) == (b["g"], b["count"])
        assert b["median"] == pytest.approx(a["median"], abs=0.5)


def test_shape(table, spark):
    got = {r["column_name"]: r for r in profile.shape(table, ["v", "u"]).collect()}
    for column in ("v", "u"):
        assert got[column]["skewness"] == pytest.approx(FRAME[column].skew())
        assert got[column]["kurtosis"] == pytest.approx(FRAME[column].kurt())
    flat = spark.createDataFrame([(1.0, 1.0)] * 5, "v double, u double")
    assert tuple(profile.shape(flat, ["v"]).first())[1:] == (0.0, 0.0)
    short = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    assert tuple(profile.shape(short, ["v"]).first())[1:] == (None, None)


def test_box_and_outliers(table):
    row = profile.box_stats(table, ["v"]).first()
    v = FRAME["v"].dropna()
    q1, q3 = v.quantile(0.25), v.quantile(0.75)
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = v[(v >= low) & (v <= high)]
    assert (row["q1"], row["q3"]) == pytest.approx((q1, q3))
    assert (row["whisker_low"], row["whisker_high"]) == (inside.min(), inside.max())
    assert row["outliers"] == len(v) - len(inside) and row["count"] == len(v)
    assert profile.outlier_rows(table, "v").count() == len(v) - len(inside)


@pytest.mark.parametrize("bins", [10, 7])
def test_histogram_matches_numpy(table, bins):
    got = profile.histogram(table, ["v"], bins).orderBy("bin").collect()
    counts, edges = np.histogram(FRAME["v"].dropna(), bins=bins)
    assert [r["count"] for r in got] == counts.tolist()
    assert [r["bin_start"] for r in got] == pytest.approx(edges[:-1].tolist())


def test_automatic_bins_match_numpy(table):
    got = profile.histogram(table, ["v", "u"], "auto")
    for column in ("v", "u"):
        counts, _ = np.histogram(FRAME[column].dropna(), bins="auto")
        mine = got.filter(F.col("column_name") == column).orderBy("bin").collect()
        assert [r["count"] for r in mine] == counts.tolist()


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "v double")
    counts, _ = np.histogram([3.0] * 4, bins=5)
    got = profile.histogram(df, ["v"], 5).orderBy("bin").collect()
    assert [r["count"] for r in got] == counts.tolist()


def test_histogram_by_group_keeps_empty_bins(table):
    got = profile.histogram(table, ["w"], 10, by="g")
    assert got.count() == 20
    assert got.agg(F.sum("count")).first()[0] == N


def test_density_by_brute_force(table):
    got = profile.kernel_density(table, "v", "g", grid=20).collect()
    for g in ("a", "b"):
        v = FRAME[FRAME.g == g]["v"].dropna().to_numpy()
        bw = len(v) ** -0.2 * v.std(ddof=1)
        xs = np.linspace(v.min() - 3 * bw, v.max() + 3 * bw, 20)
        want = [np.exp(-0.5 * ((x - v) / bw) ** 2).sum() / (len(v) * bw * math.sqrt(2 * math.pi)) for x in xs]
        mine = sorted((r["point"], r["x"], r["density"]) for r in got if r["group"] == g)
        assert [m[1] for m in mine] == pytest.approx(xs.tolist())
        assert [m[2] for m in mine] == pytest.approx(want)


def test_density_skips_constant_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 2.0)], "g string, v double")
    assert {r["group"] for r in profile.kernel_density(df, "v", "g").collect()} == {"b"}


COLUMNS = ["v", "w", "i", "u"]


def _pairs(df):
    return {(r["col_a"], r["col_b"]): r["corr"] for r in df.collect()}


def test_pearson_skips_missing_pairs(table):
    want = FRAME[COLUMNS].corr()
    for (a, b), r in _pairs(correlation.pearson(table, COLUMNS)).items():
        assert r == pytest.approx(want.loc[a, b])


@pytest.mark.parametrize("per_bucket", [1_000_000, 50])
def test_spearman_ranks_complete_pairs(table, per_bucket):
    """The second case ranks over many buckets and joins ranks by shuffle with hot values."""
    want = FRAME[COLUMNS].corr(method="spearman")
    got = correlation.spearman(
        table, COLUMNS, rows_per_bucket=per_bucket
    )
    for (a, b), r in _pairs(got).items():
        assert r == pytest.approx(want.loc[a, b])


def test_spearman_of_many_columns(spark):
    frame = pd.DataFrame(np.random.default_rng(1).integers(0, 50, (200, 12)), columns=[f"c{i}" for i in range(12)])
    frame["c11"] = 1
    df = spark.createDataFrame(frame)
    want = frame.corr(method="spearman")
    for (a, b), r in _pairs(correlation.spearman(df, list(frame.columns))).items():
        if "c11" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[a, b])


def test_many_columns_with_gaps(spark):
    """Flags, ties, constants and gaps in most of 26 columns; ranks are taken among the rows that both have."""
    rng = np.random.default_rng(4)
    n = 300
    frame = pd.DataFrame({f"c{i}": rng.integers(0, 2, n).astype(float) if i % 2 else rng.normal(size=n).round(i % 3) for i in range(24)})
    frame["constant"], frame["same"] = 7.25, frame["c0"]
    for i in range(0, 24, 3):
        frame.loc[rng.random(n) < 0.2, f"c{i}"] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in frame.itertuples(index=False)],
                               ", ".join(f"{c} double" for c in frame.columns)).repartition(4)
    for method, make in (("pearson", correlation.pearson), ("spearman", correlation.spearman)):
        want = frame.corr(method=method)
        got = _pairs(make(df, list(frame.columns)))
        assert len(got) == 26 * 25 // 2
        for (a, b), r in got.items():
            assert (r is None) if np.isnan(want.loc[a, b]) else r == pytest.approx(want.loc[a, b], abs=1e-9)


def test_infinite_values(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, float("inf")), (3.0, 2.0)], "a double, b double")
    assert _pairs(correlation.pearson(df, ["a", "b"])) == {("a", "b"): None}
    assert _pairs(correlation.spearman(df, ["a", "b"])) == {("a", "b"): pytest.approx(0.5)}


def test_all_null_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    assert _pairs(correlation.spearman(df, ["a", "b"])) == {("a", "b"): None}


def test_correlated_features_and_target(spark):
    frame = pd.DataFrame({"a": range(40), "b": [x * 2.0 for x in range(40)], "c": [(x * 7) % 11 for x in range(40)]})
    frame["Churn"] = [int(x > 20) for x in range(40)]
    df = spark.createDataFrame(frame)
    assert by_key(correlation.correlated_with_earlier(df, ["a", "b", "c"]), "feature", "max_abs_corr") == {"b": pytest.approx(1.0)}
    kept = correlation.drop_correlated(df, ["a", "b", "c"], "computed")
    assert kept[1] == ["a", "c"] and "b" not in kept[0].columns
    want = frame.corr(method="spearman")["Churn"]
    assert by_key(correlation.with_target(df, ["a", "b", "c"]), "feature", "corr") == pytest.approx(
        {c: want[c] for c in "abc"}
    )
    assert correlation.select_features(df, ["a", "b", "c"], "computed", k=3)[:2] == ["a", "b"]
    top = rows_of(correlation.top_by_target(df, ["a", "b", "c"], 2))
    assert top[0] == ("Churn", 1.0) and len(top) == 2


def test_square_matrix(table):
    square = correlation.full_matrix(correlation.pearson(table, ["w", "i"]), ["w", "i"])
    rows = {r["col_a"]: r for r in square.collect()}
    assert rows["w"]["w"] == 1.0 and rows["w"]["i"] == rows["i"]["w"]


def test_density_of_shared_cells(spark):
    """Within the stated bound of the exact curve."""
    df = spark.range(3000).select((F.rand(3) * 50 + F.randn(4) * 5).alias("x"))
    df = spark.createDataFrame(df.collect(), "x double")
    exact = {r["point"]: r["density"] for r in profile.kernel_density(df, "x").withColumn("point", F.round("x", 6)).collect()}
    for cells in (50, 1000):
        got = {r["point"]: r["density"] for r in profile.kernel_density(df, "x", cells=cells).withColumn("point", F.round("x", 6)).collect()}
        assert set(got) == set(exact)
        span, spread = df.agg(F.max("x") - F.min("x"), F.stddev("x")).first()
        bandwidth = spread * 3000 ** -0.2
        bound = (span / cells / bandwidth) ** 2 / 8 / (bandwidth * 2.5066282746310002)
        assert max(abs(got[k] - exact[k]) for k in exact) <= bound
