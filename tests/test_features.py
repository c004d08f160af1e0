import math

import pytest
from conftest import account, by_key, rows_of, to_table
from pyspark.sql import functions as F

from tenura import config
from tenura.functions import columns as C
from tenura.functions.tables import q
from tenura.operators import cleaning, features, quality


def test_gender_codes(encoded, cleaned):
    codes, texts = by_key(encoded, "customerID", "gender"), by_key(cleaned, "customerID", "gender")
    assert all(codes[k] == int(texts[k] == "Male") for k in texts)


def test_three_valued_columns_collapse(encoded):
    for column in config.TERNARY:
        assert {r[0] for r in encoded.select(column).distinct().collect()} <= {0, 1}


def test_first_category_has_no_indicator(encoded):
    assert "InternetService_DSL" not in encoded.columns
    assert "PaymentMethod_Bank transfer (automatic)" not in encoded.columns
    assert encoded.columns[-5:] == [
        config.FIBER, config.NO_INTERNET, config.CREDIT_CARD, config.ELECTRONIC_CHECK,
        config.MAILED_CHECK,
    ]


def test_key_stays_out_of_the_features(encoded):
    from tenura.plans.churn import feature_columns

    assert "customerID" in encoded.columns
    assert "customerID" not in feature_columns(encoded)
    assert "Churn" not in feature_columns(encoded)


def test_nothing_is_null_after_encoding(encoded, featured):
    assert quality.require_no_nulls(encoded).first()["nulls"] == 0
    assert quality.require_no_nulls(featured).first()["nulls"] == 0


def test_strict_encoding_refuses_unknown_values(spark):
    bad = cleaning.clean(to_table(spark, [account("X", gender="Other")]))
    with pytest.raises(Exception, match="unmapped value in gender"):
        features.encode(bad).collect()
    assert features.encode(bad, strict=False).first()["gender"] is None
    assert by_key(features.encode_rejects(bad), "column_name", "rejected")["gender"] == 1


def test_null_category_has_zero_indicators(spark):
    df = cleaning.clean(to_table(spark, [account("X", InternetService=None, PaymentMethod=None)]))
    row = features.encode(df).first()
    assert all(row[c] == 0 for c in (config.FIBER, config.NO_INTERNET, config.ELECTRONIC_CHECK))


def test_feature_formulas(featured):
    rows = [r.asDict() for r in featured.collect()]
    tenure_mean = sum(r["tenure"] for r in rows) / len(rows)
    bill_mean = sum(r["MonthlyCharges"] for r in rows) / len(rows)
    for r in rows:
        addons = sum(r[c] for c in config.ADDONS)
        services = r["PhoneService"] + 1 - r[config.NO_INTERNET] + addons
        assert r[config.ADDON_TOTAL] == addons
        assert r[config.COST_PER_SERVICE] == pytest.approx(r["MonthlyCharges"] / services)
        bank = not (r[config.CREDIT_CARD] or r[config.ELECTRONIC_CHECK] or r[config.MAILED_CHECK])
        assert r[config.AUTO_PAY] == int(bool(r[config.CREDIT_CARD]) or bank)
        assert r[config.LOYALTY] == int(r["tenure"] > tenure_mean and r["MonthlyCharges"] < bill_mean)
        assert r[config.HIGH_FRICTION] == int(r["PaperlessBilling"] and r[config.ELECTRONIC_CHECK])
        assert r[config.HOUSEHOLD] == r["Partner"] + r["Dependents"]


def test_fitted_means_replace_global_ones(encoded):
    df = features.add_engineered_features(encoded, {"tenure": 1000.0, "MonthlyCharges": 0.0})
    assert df.agg(F.sum(config.LOYALTY)).first()[0] == 0


def test_no_services_gives_infinite_or_null_cost(spark):
    df = features.encode(
        cleaning.clean(to_table(spark, [account("X", PhoneService="No", InternetService="No")]))
    )
    assert math.isinf(features.add_engineered_features(df).first()[config.COST_PER_SERVICE])
    assert features.add_engineered_features(df, on_zero="null").first()[config.COST_PER_SERVICE] is None


@pytest.mark.parametrize(
    "num,den,out", [(4.0, 2.0, 2.0), (4.0, 0.0, math.inf), (-4.0, 0.0, -math.inf), (None, 0.0, None), (1.0, None, None)]
)
def test_ratio(spark, num, den, out):
    df = spark.createDataFrame([(num, den)], "a double, b double")
    assert df.select(C.ratio(q("a"), q("b"))).first()[0] == out


def test_zero_over_zero_is_nan(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "a double, b double")
    assert math.isnan(df.select(C.ratio(q("a"), q("b"))).first()[0])


def test_bands_are_right_closed(spark):
    values = [0.0, 0.1, 12.0, 12.1, 72.0, 72.1, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(C.band(q("v"), config.TENURE_EDGES, config.TENURE_LABELS)).collect()]
    a, b, d = config.TENURE_LABELS[0], config.TENURE_LABELS[1], config.TENURE_LABELS[3]
    assert got == [None, a, a, b, d, None, None, None]


def test_missing_tenure_falls_in_last_group(spark):
    df = spark.createDataFrame([(12,), (24,), (25,), (None,)], "t int")
    got = [r[0] for r in df.select(C.tenure_group(q("t"))).collect()]
    assert got == [config.TENURE_GROUPS[0], config.TENURE_GROUPS[1], config.TENURE_GROUPS[2], config.TENURE_GROUPS[2]]


def test_labels(spark):
    df = spark.createDataFrame([("One year", 1, 0), ("0.55", 0, 1), (None, 0, 0)], "c string, f int, n int")
    got = rows_of(
        df.select(
            C.label_or_self(q("c"), config.CONTRACT_LABELS), C.internet_label(q("f"), q("n"))
        )
    )
    assert got == [("One Year", "Fiber Optic"), ("0.55", "No Internet"), (None, "DSL")]


def test_display_columns_skip_what_is_absent(featured):
    partial = features.with_display_columns(featured.select("tenure", "Churn"))
    assert partial.columns == ["tenure", "Churn", "tenure_band"]


def test_texts(spark):
    df = spark.createDataFrame([(12.345, 1234567.8, "x" * 300)], "p double, m double, t string")
    row = df.select(C.percent_text(q("p")), C.money_text(q("m")), C.clip_text(q("t"))).first()
    assert row[0] == "12.3%" and row[1] == "$1,234,568" and len(row[2]) == 250


def test_encoding_is_repeatable(cleaned):
    first, second = (rows_of(features.encode(cleaned).orderBy("customerID")) for _ in range(2))
    assert first == second


def test_unknown_nominal_values(spark, cleaned):
    odd = cleaned.withColumn("PaymentMethod", F.when(F.col("customerID") == "A-01", "Crypto").otherwise(F.col("PaymentMethod")))
    odd = odd.withColumn("InternetService", F.when(F.col("customerID") != "A-02", F.col("InternetService")))
    rejected = {r["column_name"]: r["rejected"] for r in features.encode_rejects(odd).collect()}
    assert rejected["PaymentMethod"] == 1 and rejected["InternetService"] == 0 and len(rejected) == 12
    with pytest.raises(Exception, match="unmapped value in PaymentMethod: Crypto"):
        features.encode(odd).collect()
    lenient = {r["customerID"]: r for r in features.encode(odd, strict=False).collect()}
    assert lenient["A-01"]["PaymentMethod_Mailed check"] == 0
    assert lenient["A-02"]["InternetService_No"] == 0
