"""Shared session and small hand-made account tables."""

from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tenura import config  # noqa: E402
from tenura.operators import cleaning, features  # noqa: E402

NO_NET = "No internet service"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tenura-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def account(key, **given):
    """One raw account; anything not given gets a plain valid value."""
    internet = given.get("InternetService", "DSL")
    phone = given.get("PhoneService", "Yes")
    base = {
        "customerID": key, "gender": "Female", "SeniorCitizen": 0, "Partner": "No",
        "Dependents": "No", "tenure": 10, "PhoneService": phone,
        "MultipleLines": "No" if phone == "Yes" else "No phone service",
        "InternetService": internet, "Contract": "Month-to-month", "PaperlessBilling": "No",
        "PaymentMethod": "Mailed check", "MonthlyCharges": 50.0, "TotalCharges": "500",
        "Churn": "No",
    }
    base |= {c: NO_NET if internet == "No" else "No" for c in config.ADDONS}
    return {**base, **given}


ACCOUNTS = [
    account("A-01", gender="Male", tenure=2, MonthlyCharges=91.5, TotalCharges="183",
            InternetService="Fiber optic", PaymentMethod="Electronic check",
            PaperlessBilling="Yes", Churn="Yes"),
    account("A-02", Partner="Yes", Dependents="Yes", tenure=70, MonthlyCharges=21.0,
            TotalCharges="1470", InternetService="No", Contract="Two year"),
    account("A-03", gender="Male", tenure=0, MonthlyCharges=45.25, TotalCharges=" ",
            OnlineSecurity="Yes", OnlineBackup="Yes"),
    account("A-04", SeniorCitizen=1, tenure=13, MonthlyCharges=102.4, TotalCharges="1331.2",
            InternetService="Fiber optic", StreamingTV="Yes", StreamingMovies="Yes",
            PaymentMethod="Electronic check", Churn="Yes"),
    account("A-05", Partner="Yes", tenure=25, MonthlyCharges=64.9, TotalCharges="1622.5",
            Contract="One year", PaymentMethod="Bank transfer (automatic)", TechSupport="Yes"),
    account("A-06", gender="Male", tenure=49, MonthlyCharges=35.0, TotalCharges="1715",
            PhoneService="No", Contract="One year", PaymentMethod="Credit card (automatic)",
            OnlineSecurity="Yes"),
    account("A-07", tenure=5, MonthlyCharges=74.6, TotalCharges="373", PaperlessBilling="Yes",
            InternetService="Fiber optic", PaymentMethod="Electronic check", Churn="Yes"),
    account("A-08", Partner="Yes", Dependents="Yes", gender="Male", tenure=72,
            MonthlyCharges=118.75, TotalCharges="8550", InternetService="Fiber optic",
            Contract="Two year", MultipleLines="Yes", PaymentMethod="Bank transfer (automatic)",
            **{c: "Yes" for c in config.ADDONS}),
    account("A-09", SeniorCitizen=1, tenure=24, MonthlyCharges=55.0, TotalCharges="1320",
            Churn="Yes"),
    account("A-10", Dependents="Yes", tenure=33, MonthlyCharges=20.05, TotalCharges="661.65",
            InternetService="No", Contract="One year", PaymentMethod="Credit card (automatic)"),
    account("A-11", gender="Male", tenure=12, MonthlyCharges=80.0, TotalCharges="960",
            InternetService="Fiber optic", DeviceProtection="Yes", PaperlessBilling="Yes"),
    account("A-12", tenure=61, MonthlyCharges=66.1, TotalCharges="4032.1", Contract="Two year",
            OnlineSecurity="Yes", TechSupport="Yes", PaymentMethod="Credit card (automatic)"),
]


def to_table(spark, accounts):
    names = config.RAW_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(a[n] for n in names) for a in accounts], config.RAW_SCHEMA)


@pytest.fixture(scope="session")
def raw(spark):
    return to_table(spark, ACCOUNTS).cache()


@pytest.fixture(scope="session")
def cleaned(raw):
    return cleaning.clean(raw).cache()


@pytest.fixture(scope="session")
def encoded(cleaned):
    return features.encode(cleaned).cache()


@pytest.fixture(scope="session")
def featured(encoded):
    return features.add_engineered_features(encoded).cache()


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def by_key(df, key, value):
    return {r[key]: r[value] for r in df.collect()}
