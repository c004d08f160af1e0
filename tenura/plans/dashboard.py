"""The tables behind the dashboard pages, over one enriched table.

``load`` adds the label and band columns; callers persist its result once and
then ask for tables. Tables about an absent feature column come back as None.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura import config
from tenura.functions import columns as C
from tenura.functions.tables import q
from tenura.operators import correlation, features, profile, rates, segments

RETAINED = {0: "Retained", 1: "Churned"}
CORRELATED = [
    "tenure", "MonthlyCharges", "TotalCharges", "Churn",
    "SeniorCitizen", "PaperlessBilling", "OnlineSecurity",
]
INTERNET = ["DSL", "Fiber Optic", "No Internet"]
CHECK = ["Elec. Check", "Other"]
FEATURE_LABELS = {
    config.AUTO_PAY: {0: "Manual Payment", 1: "AutoPay"},
    config.LOYALTY: {0: "Not Loyal", 1: "Loyal"},
    config.HOUSEHOLD: {0: "Alone", 1: "Partner or Dependents", 2: "Full Family"},
    config.HIGH_FRICTION: {0: "Low Friction", 1: "High Friction"},
    "SeniorCitizen": {0: "Not Senior", 1: "Senior"},
}


def load(df: DataFrame) -> DataFrame:
    enriched = features.with_display_columns(df)
    return enriched.withColumn("status", C.map_codes(q(config.LABEL), RETAINED))


def overview(df: DataFrame) -> DataFrame:
    """The five headline numbers with their display texts."""
    return rates.kpis(df).select(
        "*",
        F.format_string("$%.2fM", F.col("total_revenue") / 1_000_000).alias("revenue_text"),
        F.format_number("customers", 0).alias("customers_text"),
        F.format_number("churned", 0).alias("churned_text"),
        C.percent_text(F.col("churn_pct")).alias("churn_text"),
        F.format_string("$%.0f", F.col("avg_bill")).alias("bill_text"),
    )


def churn_split(df: DataFrame) -> DataFrame:
    return rates.value_counts(df, "status")


def tenure_band_churn(df: DataFrame) -> DataFrame:
    """Observed bands only, with rate, count of known outcomes and text."""
    known = (F.col("churned") + F.col("stayed")).alias("total")
    text = C.percent_text(F.col("rate")).alias("rate_text")
    grouped = rates.rate_by(df, ["tenure_band"])
    return grouped.select("tenure_band", "rate", known, text).orderBy("tenure_band")


def charge_histogram(df: DataFrame, bins: int = 40) -> DataFrame:
    return profile.histogram(df, ["MonthlyCharges"], bins, by="status")


def churn_boxes(df: DataFrame) -> DataFrame:
    return profile.box_stats(df, ["tenure", "TotalCharges"], ["status"])


def contract_churn(df: DataFrame) -> DataFrame:
    return rates.rate_by(df, ["Contract_label"]).orderBy(F.desc("rate"), "Contract_label")


def contract_internet(df: DataFrame) -> DataFrame:
    return rates.rate_matrix(df, "Contract_label", "inet_type", INTERNET, fill=0.0)


def contract_check(df: DataFrame) -> DataFrame:
    return rates.rate_matrix(df, "Contract_label", "elec_check", CHECK, fill=0.0)


def group_rates(df: DataFrame) -> DataFrame:
    """Rates of every labelled group on the internet, security and payment tabs, in one pass."""
    return rates.rates_for(df, ["elec_check", "inet_type", "sec_label", "SeniorCitizen"])


def internet_boxes(df: DataFrame) -> DataFrame:
    return profile.box_stats(df, ["MonthlyCharges"], ["inet_type"])


def addon_count_churn(df: DataFrame) -> DataFrame | None:
    if config.ADDON_TOTAL not in df.columns:
        return None
    return rates.rate_by(df, [config.ADDON_TOTAL]).orderBy(q(config.ADDON_TOTAL))


def feature_churn(df: DataFrame, feature: str) -> DataFrame | None:
    """Rate per labelled value of one derived flag."""
    if feature not in df.columns:
        return None
    table = rates.rate_by(df, [feature])
    return table.withColumn("label", C.map_codes(q(feature), FEATURE_LABELS[feature])).orderBy(
        q(feature)
    )


def correlations(df: DataFrame) -> DataFrame:
    """Square Spearman matrix of the numeric columns that are present."""
    present = [c for c in CORRELATED if c in df.columns]
    return correlation.full_matrix(correlation.spearman(df, present), present)


def churn_correlations(df: DataFrame) -> DataFrame:
    """Correlation of each column with churn, lowest first."""
    present = [c for c in CORRELATED if c in df.columns]
    return correlation.with_target(df, present).orderBy("corr", "feature")


def risk_segments(df: DataFrame) -> DataFrame:
    return segments.segment_table(segments.with_risk(df)).select(
        "segment", "count", "churn_rate", C.percent_text(F.col("churn_rate")).alias("rate_text")
    )


def revenue_at_risk(df: DataFrame) -> DataFrame:
    table = segments.revenue_at_risk(segments.with_risk(df))
    return table.select(
        "*",
        C.money_text(F.col("high_revenue")).alias("high_text"),
        C.money_text(F.col("medium_revenue")).alias("medium_text"),
        C.money_text(F.col("total_at_risk")).alias("total_text"),
    )
