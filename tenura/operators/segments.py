"""Rule-based risk segments and the revenue they put at risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura import config
from tenura.functions import columns as C
from tenura.functions.tables import q

# Fixed points per rule and the scores that open a segment.
CONTRACT_POINTS, CHECK_POINTS, NEW_POINTS, SECURITY_POINTS, FIBER_POINTS = 3, 2, 3, 1, 2
NEW_CUSTOMER_MONTHS = 12
HIGH_SCORE, MEDIUM_SCORE = 7, 4


def _whole(col: Column) -> Column:
    """Integer part of a number given as text or number; null when it is neither."""
    return C.to_number(col).cast("double").try_cast("long")


def risk_score(df: DataFrame) -> Column:
    """Points of the rules that hold; rules whose column is absent score nothing."""
    have = set(df.columns)
    rules = []
    if "Contract" in have:
        number = C.to_number(q("Contract"))
        monthly = F.when(number.isNotNull(), _whole(q("Contract")) == 0).otherwise(
            q("Contract").cast("string").contains("Month")
        )
        rules.append((monthly, CONTRACT_POINTS))
    if config.ELECTRONIC_CHECK in have:
        rules.append((_whole(q(config.ELECTRONIC_CHECK)) == 1, CHECK_POINTS))
    if "tenure" in have:
        rules.append((q("tenure") <= NEW_CUSTOMER_MONTHS, NEW_POINTS))
    if "OnlineSecurity" in have:
        rules.append((_whole(q("OnlineSecurity")) == 0, SECURITY_POINTS))
    if config.FIBER in have:
        rules.append((_whole(q(config.FIBER)) == 1, FIBER_POINTS))
    return C.score_points(rules)


def with_risk(df: DataFrame) -> DataFrame:
    """Add ``risk_score`` and the ``risk`` segment."""
    scored = df.withColumn("risk_score", risk_score(df))
    score = F.col("risk_score")
    return scored.withColumn(
        "risk",
        F.when(score >= HIGH_SCORE, "High Risk")
        .when(score >= MEDIUM_SCORE, "Medium Risk")
        .otherwise("Low Risk"),
    )


def segment_table(df: DataFrame) -> DataFrame:
    """Customers, share and churn rate per segment, largest first, from one grouping."""
    grouped = df.groupBy(F.col("risk").alias("segment")).agg(
        F.count(F.lit(1)).alias("count"), (F.avg(config.LABEL) * 100).alias("churn_rate")
    )
    share = F.col("count") / F.sum("count").over(Window.partitionBy()) * 100
    return grouped.withColumn("share", share).orderBy(F.desc("count"), "segment")


def segment_lookup(df: DataFrame) -> DataFrame:
    """Counts with the rate of each segment, from one grouping of the rows."""
    grouped = df.groupBy(F.col("risk").alias("segment")).agg(
        F.count(F.lit(1)).alias("count"), (F.avg(config.LABEL) * 100).alias("churn_rate")
    )
    return grouped.select("segment", "count", "churn_rate")


def revenue_at_risk(df: DataFrame) -> DataFrame:
    """Head counts and monthly revenue of the two risky segments, in one pass."""
    high, medium = F.col("risk") == "High Risk", F.col("risk") == "Medium Risk"

    def revenue(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, q("MonthlyCharges"))), F.lit(0.0))

    totals = df.agg(
        F.count_if(high).alias("high_customers"),
        F.count_if(medium).alias("medium_customers"),
        revenue(high).alias("high_revenue"),
        revenue(medium).alias("medium_revenue"),
    )
    both = F.col("high_revenue") + F.col("medium_revenue")
    return totals.select("*", both.alias("total_at_risk"))
