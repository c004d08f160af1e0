"""Several results of one pass: counts by group, counts of a write, mergeable distinct counts."""

import math

import pytest
from conftest import ACCOUNTS, account, rows_of, to_table
from pyspark.sql import functions as F

from tenura import config
from tenura.functions.tables import q
from tenura.operators import cleaning, quality, rates
from tenura.plans import eda
from tenura.sources import accounts


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def normal(df):
    return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()], key=str)


def test_views_cut_from_one_pass_are_those_of_their_own_scans(spark):
    """With unusual, missing and undeclared values among the accounts."""
    odd = [account("X-1", InternetService="Satellite", PaymentMethod=None, tenure=None), account("X-2", gender=None, Churn="perhaps"),
           account("X-3", Contract="Ten years", MonthlyCharges=500.0), account("X-4", StreamingTV="?", MonthlyCharges=None)]
    cleaned = cleaning.clean(to_table(spark, ACCOUNTS + odd)).cache()
    views = eda.counted_views(eda.exploration_cells(cleaned).cache())
    assert len(views) == 14
    for name, view in views.items():
        want = getattr(eda, name)(cleaned)
        assert view.columns == want.columns, name
        if name in ("streaming_matrix", "contract_internet_churn", "payment_contract_churn", "tenure_charge_churn"):
            assert dict(view.dtypes) == dict(want.dtypes), name
        assert normal(view) == normal(want), name


def test_one_scan_and_one_shuffle(cleaned):
    plan = eda.exploration_cells(cleaned)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 2  # printed before and after adaptive planning
    with pytest.raises(ValueError):
        rates.grouped_at_once(cleaned, {"three": ["gender", "Partner", "Contract"]})


def test_equal_groupings_and_nulls(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 0), (None, "x", None)], "k string, l string, Churn int")
    got = rates.grouped_at_once(df, {"one": ["k"], "again": ["k"], "kl": ["k", "l"], "lk": ["l", "k"]}).collect()
    rows = {(r["grouping"], r["key"], r["second"]): tuple(r)[3:] for r in got}
    assert rows["one", "a", None] == rows["again", "a", None] == (2, 1, 1) and rows["one", None, None] == (1, 0, 0)
    assert rows["kl", "a", "x"] == rows["lk", "x", "a"] == (1, 0, 1) and rows["kl", "a", None] == (1, 1, 0)
    assert len(got) == 2 + 2 + 3 + 3


def test_undeclared_labels_have_a_cell(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "z", 1), ("a", None, 0), ("b", "y", 0)], "k string, l string, Churn int")
    assert sorted(rows_of(rates.rate_matrix(df, "k", "l", ["x", "y"], other="other"))) == [("a", 100.0, None, 50.0), ("b", None, 0.0, None)]
    assert sorted(rows_of(rates.count_matrix(df, "k", "l", ["x", "y"], fill=0, other="other"))) == [("a", 1, 0, 2), ("b", 0, 1, 0)]
    assert sorted(rows_of(rates.count_matrix(df, "k", "l", ["x", "y"]))) == [("a", 1, None), ("b", None, 1)]


def test_publish_replaces_only_a_faultless_table(spark, cleaned, tmp_path):
    path = str(tmp_path / "table")
    faults = {"no tenure": F.count_if(q("tenure").isNull()), "negative": F.count_if(q("MonthlyCharges") < 0)}
    assert accounts.publish(cleaned, path, faults) == {"rows": len(ACCOUNTS), "no tenure": 0, "negative": 0}
    with pytest.raises(ValueError, match="no tenure: 2, negative: 12"):
        accounts.publish(cleaned.withColumns({"tenure": F.when(q("tenure") > 2, q("tenure")), "MonthlyCharges": -q("MonthlyCharges")}),
                         path, faults)
    assert accounts.read_table(spark, path).filter("tenure IS NULL").count() == 0
    half = cleaned.filter("tenure > 24")
    assert accounts.publish(half, path, faults)["rows"] == half.count() == accounts.read_table(spark, path).count()
    assert [p.name for p in tmp_path.iterdir()] == ["table"]
    assert accounts.publish(cleaned.limit(0), str(tmp_path / "empty"), faults) == {"rows": 0, "no tenure": 0, "negative": 0}


def test_publish_scans_once(spark, cleaned, tmp_path, monkeypatch):
    """The counts come from the job that writes."""
    source = str(tmp_path / "source")
    cleaned.write.parquet(source)
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.read.parquet(source)
    accounts.publish(df.mapInArrow(count, df.schema), str(tmp_path / "t"), {"none": F.count_if(q("tenure").isNull())})
    assert reads.value == len(ACCOUNTS)


def test_merged_sketches(spark):
    """Loads that overlap, an empty load, a column of nulls; the error stays near the stated one."""
    whole = spark.range(50_000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("d"), F.lit(None).cast("string").alias("n"))
    parts = [whole.filter("k < 30000"), whole.filter("k >= 20000"), whole.filter("k < 0")]
    sketches = [quality.distinct_sketches(p, ["k", "d", "n"]) for p in parts]
    stacked = sketches[0].unionByName(sketches[1]).unionByName(sketches[2])
    got = {r["column_name"]: r for r in quality.distinct_estimates(quality.merged_sketches(stacked)).collect()}
    assert math.isclose(got["k"]["distinct_values"], 50_000, rel_tol=0.04) and got["k"]["rows"] == 60_000
    assert got["d"]["distinct_values"] == 7 and (got["n"]["distinct_values"], got["n"]["rows"]) == (0, 0)
