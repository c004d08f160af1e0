"""Column groups, code maps, category domains, thresholds and grids."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "customerID"
LABEL = "Churn"

SEED = 42
TEST_SHARE = 0.2
FOLDS = 5
DECISION_THRESHOLD = 0.55
CORRELATION_LIMIT = 0.85
STRONG_IMPORTANCE = 0.01
LIFETIME_MONTHS = 12

NUMERIC = ["tenure", "MonthlyCharges", "TotalCharges"]
ADDONS = [
    "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies",
]
TERNARY = ["MultipleLines", *ADDONS]
TEXT_COLUMNS = [
    "customerID", "gender", "MultipleLines", "InternetService", *ADDONS,
    "Contract", "PaymentMethod", "PhoneService", "PaperlessBilling",
]
CRITICAL = ["customerID", "gender", "tenure", "MonthlyCharges", "Churn"]

YES_NO = {"Yes": 1, "No": 0}
GENDER_CODES = {"Male": 1, "Female": 0}
TERNARY_CODES = {"Yes": 1, "No": 0, "No internet service": 0, "No phone service": 0}

# Declared category domains, in alphabetical order.
DOMAINS = {
    "gender": ["Female", "Male"],
    "SeniorCitizen": [0, 1],
    "Partner": ["No", "Yes"],
    "Dependents": ["No", "Yes"],
    "PhoneService": ["No", "Yes"],
    "MultipleLines": ["No", "No phone service", "Yes"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaperlessBilling": ["No", "Yes"],
    "Churn": ["No", "Yes"],
    **{c: ["No", "No internet service", "Yes"] for c in ADDONS},
}
PAYMENT_METHODS = [
    "Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check",
]
ONE_HOT = {"InternetService": DOMAINS["InternetService"], "PaymentMethod": PAYMENT_METHODS}

FIBER = "InternetService_Fiber optic"
NO_INTERNET = "InternetService_No"
CREDIT_CARD = "PaymentMethod_Credit card (automatic)"
ELECTRONIC_CHECK = "PaymentMethod_Electronic check"
MAILED_CHECK = "PaymentMethod_Mailed check"

ADDON_TOTAL = "_Total_AddOns-Services"
COST_PER_SERVICE = "_Cost_Per_Service"
AUTO_PAY = "_Is_AutoPay"
LOYALTY = "_LoyaltyScore"
HIGH_FRICTION = "_HighFriction_Payment"
HOUSEHOLD = "_Household_Stability"

ID_PATTERN = "^[0-9A-Za-z-]+$"

# Right-closed band edges and their labels.
TENURE_EDGES = [0, 12, 24, 48, 72]
CHARGE_EDGES = [0, 35, 65, 90, 120]
TENURE_LABELS = ["0–12m", "13–24m", "25–48m", "49–72m"]
CHARGE_LABELS = ["Low", "Mid", "High", "Premium"]
TENURE_LABELS_LONG = ["0-12 mo", "13-24 mo", "25-48 mo", "49-72 mo"]
TENURE_GROUPS = ["Under 1 year", "Between 1 and 2 years", "2 or more years"]

CONTRACT_LABELS = {
    "Month-to-month": "Month-to-Month",
    "One year": "One Year",
    "Two year": "Two Year",
}

# Features dropped and kept by name, whatever the computed correlations say.
DROPPED_FEATURES = ["TotalCharges", "_Household_Stability"]
SELECTED_FEATURES = [
    "Contract", "tenure", "InternetService_Fiber optic", "_HighFriction_Payment",
    "_Cost_Per_Service", "InternetService_No", "_LoyaltyScore", "_Is_AutoPay",
]

# Hyper-parameter grids; the boosted-tree grids are the Spark GBT counterparts.
LOGISTIC_GRID = {"C": [0.01, 0.1, 1, 10]}
TREE_GRID = {"max_depth": [3, 5, 7, 10], "min_split": [2, 5, 10]}
FOREST_GRID = {"trees": [200, 300], "max_depth": [8, 10, 15], "min_split": [2, 5]}
BOOST_GRID = {
    "trees": [200, 300], "max_depth": [3, 4, 5], "learning_rate": [0.01, 0.05, 0.1],
    "subsample": [0.8, 1.0], "column_share": [0.8, 1.0],
}
LEAF_BOOST_GRID = {
    "trees": [200, 300], "learning_rate": [0.01, 0.05], "leaves": [31, 50],
    "max_depth": [-1, 10, 15],
}

RAW_SCHEMA = T.StructType(
    [
        T.StructField("customerID", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("SeniorCitizen", T.IntegerType()),
        T.StructField("Partner", T.StringType()),
        T.StructField("Dependents", T.StringType()),
        T.StructField("tenure", T.IntegerType()),
        T.StructField("PhoneService", T.StringType()),
        T.StructField("MultipleLines", T.StringType()),
        T.StructField("InternetService", T.StringType()),
        T.StructField("OnlineSecurity", T.StringType()),
        T.StructField("OnlineBackup", T.StringType()),
        T.StructField("DeviceProtection", T.StringType()),
        T.StructField("TechSupport", T.StringType()),
        T.StructField("StreamingTV", T.StringType()),
        T.StructField("StreamingMovies", T.StringType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("PaperlessBilling", T.StringType()),
        T.StructField("PaymentMethod", T.StringType()),
        T.StructField("MonthlyCharges", T.DoubleType()),
        T.StructField("TotalCharges", T.StringType()),
        T.StructField("Churn", T.StringType()),
    ]
)
