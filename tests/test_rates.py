import pytest
from conftest import account, by_key, rows_of, to_table

from tenura import config
from tenura.operators import cleaning, rates, segments
from tenura.plans import dashboard, eda


def test_value_counts_skip_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    assert rows_of(rates.value_counts(df, "k")) == [
        ("a", 2, 50.0), ("b", 1, 25.0),
    ]
    many = rows_of(rates.value_counts_many(df, ["k"]).orderBy("value"))
    assert many == [("k", "a", 2, 50.0), ("k", "b", 1, 25.0)]


def test_rates_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 0), ("a", None), ("b", 0), (None, 1)], "k string, Churn int"
    )
    got = {r["k"]: r for r in rates.rate_by(df, ["k"]).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["total"], got["a"]["churned"], got["a"]["stayed"]) == (3, 1, 1)
    assert got["a"]["rate"] == 50.0 and got["b"]["rate"] == 0.0


def test_matrices(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 0), ("b", "x", 0)], "r string, c string, Churn int")
    matrix = {r["r"]: (r["x"], r["y"]) for r in rates.rate_matrix(df, "r", "c", ["x", "y"]).collect()}
    assert matrix == {"a": (100.0, 0.0), "b": (0.0, None)}
    filled = {r["r"]: r["y"] for r in rates.rate_matrix(df, "r", "c", ["x", "y"], fill=0.0).collect()}
    assert filled["b"] == 0.0
    counts = {r["r"]: (r["x"], r["y"]) for r in rates.count_matrix(df, "r", "c", ["x", "y"]).collect()}
    assert counts == {"a": (1, 1), "b": (1, None)}
    assert rates.count_matrix(df, "r", "c", ["x", "y"], fill=0).filter("r = 'b'").first()["y"] == 0


def test_domain_keeps_unobserved_labels(spark):
    df = spark.createDataFrame([("b", 5)], "k string, n int")
    assert rows_of(rates.in_domain_order(df, "k", ["b", "a"])) == [("b", 0, 5), ("a", 1, None)]


def test_weights_and_ratio(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "Churn int")
    assert by_key(rates.balanced_weights(df), "Churn", "weight") == {0: pytest.approx(4 / 6), 1: 2.0}
    assert rates.class_ratio(df).first()["ratio"] == 3.0
    assert rates.class_ratio(df.filter("Churn = 0")).first()["ratio"] is None


def test_headline_numbers(cleaned):
    row = rates.kpis(cleaned).first()
    assert (row["customers"], row["churned"]) == (12, 4)
    assert row["churn_pct"] == pytest.approx(100 / 3)


def test_tenure_groups_in_order(cleaned):
    got = rows_of(eda.tenure_churn(cleaned))
    assert [r[0] for r in got] == config.TENURE_GROUPS
    assert [r[2] for r in got] == [4, 2, 6]


def test_band_matrix_keeps_all_bands(spark):
    df = cleaning.clean(to_table(spark, [account("A", tenure=0), account("B", tenure=5)]))
    got = rows_of(eda.tenure_charge_churn(df))
    assert [r[0] for r in got] == config.TENURE_LABELS
    assert got[1][2:] == (None,) * 4


@pytest.mark.parametrize(
    "given,score,risk",
    [
        ({"Contract": "Month-to-month", "tenure": 12, "OnlineSecurity": 0, "InternetService_Fiber optic": 1,
          "PaymentMethod_Electronic check": 1}, 11, "High Risk"),
        ({"Contract": "Two year", "tenure": 13, "OnlineSecurity": 1, "InternetService_Fiber optic": 0,
          "PaymentMethod_Electronic check": 0}, 0, "Low Risk"),
        ({"Contract": "Month-to-month", "tenure": 40, "OnlineSecurity": 0, "InternetService_Fiber optic": 0,
          "PaymentMethod_Electronic check": 0}, 4, "Medium Risk"),
        ({"Contract": None, "tenure": None, "OnlineSecurity": None, "InternetService_Fiber optic": None,
          "PaymentMethod_Electronic check": None}, 0, "Low Risk"),
    ],
)
def test_risk_points(spark, given, score, risk):
    schema = "`Contract` string, tenure int, OnlineSecurity int, `InternetService_Fiber optic` int, `PaymentMethod_Electronic check` int"
    row = segments.with_risk(spark.createDataFrame([tuple(given.values())], schema)).first()
    assert (row["risk_score"], row["risk"]) == (score, risk)


def test_numeric_contract_scores_by_whole_part(spark):
    df = spark.createDataFrame([("0.55", 40), ("1.0", 40)], "Contract string, tenure int")
    assert [r["risk_score"] for r in segments.with_risk(df).collect()] == [3, 0]


def test_segments_agree_both_ways(featured):
    risky = segments.with_risk(featured)
    one = by_key(segments.segment_table(risky), "segment", "churn_rate")
    assert one == by_key(segments.segment_lookup(risky), "segment", "churn_rate")
    money = segments.revenue_at_risk(risky).first()
    rows = risky.collect()
    assert money["high_customers"] == sum(r["risk"] == "High Risk" for r in rows)
    assert money["total_at_risk"] == pytest.approx(
        sum(r["MonthlyCharges"] for r in rows if r["risk"] != "Low Risk")
    )


def test_dashboard_tables(featured):
    df = dashboard.load(featured).cache()
    assert dashboard.overview(df).first()["customers_text"] == "12"
    assert by_key(dashboard.churn_split(df), "status", "count") == {"Retained": 8, "Churned": 4}
    assert {r["tenure_band"] for r in dashboard.tenure_band_churn(df).collect()} <= set(config.TENURE_LABELS_LONG)
    assert dashboard.charge_histogram(df).count() == 80
    assert [r["label"] for r in dashboard.feature_churn(df, config.AUTO_PAY).collect()] == ["Manual Payment", "AutoPay"]
    assert dashboard.feature_churn(df.drop(config.LOYALTY), config.LOYALTY) is None
    assert dashboard.addon_count_churn(df.drop(config.ADDON_TOTAL)) is None
    assert dashboard.revenue_at_risk(df).first()["total_text"].startswith("$")
    assert dashboard.churn_correlations(df).count() == 6
    assert dashboard.group_rates(df).count() >= 8
