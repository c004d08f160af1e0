"""Input tables of the registered queries: the account stages, a dirtied variant, rule scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura import config
from tenura.functions.tables import q
from tenura.operators import cleaning, features, segments
from tenura.sources.mart import raw_accounts


def raw(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return raw_accounts(spark, sf_dir, columns)


def cleaned(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return cleaning.clean(raw_accounts(spark, sf_dir, columns))


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.encode(cleaned(spark, sf_dir))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_engineered_features(encoded(spark, sf_dir))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw accounts with faults planted by rule, so that every quality check finds something."""
    df = raw_accounts(spark, sf_dir)
    net, tenure, bill = q("InternetService"), q("tenure"), q("MonthlyCharges")
    planted = {
        "customerID": F.when(tenure == 60, "C 60").when(tenure != 61, q("customerID")),
        "gender": F.when(tenure <= 70, q("gender")),
        "Partner": F.when(bill > 100, "Maybe").otherwise(q("Partner")),
        "MultipleLines": F.when(
            ~((q("PhoneService") == "No") & (tenure > 65)), q("MultipleLines")
        ),
        "OnlineSecurity": F.when((net == "No") & (q("SeniorCitizen") == 1), "Yes")
        .when((net == "DSL") & (tenure == 55), "No internet service")
        .otherwise(q("OnlineSecurity")),
        "InternetService": F.when(tenure == 41, "Satellite").when(tenure != 42, net),
        "PaymentMethod": F.when(tenure == 40, "Crypto").otherwise(q("PaymentMethod")),
        "MonthlyCharges": F.when(bill > 110, -bill).otherwise(bill),
        "TotalCharges": F.when(bill < 30, "n/a")
        .when(tenure == 50, "12d")
        .when(tenure == 51, " 7.5 ")
        .when(tenure == 52, "-3")
        .otherwise(q("TotalCharges")),
    }
    return df.select(*[planted.get(c, q(c)).alias(c) for c in df.columns])


DIRTY_SQL = """
dirty AS (
  SELECT * REPLACE (
    CASE WHEN tenure = 60 THEN 'C 60' WHEN tenure <> 61 THEN "customerID" END AS "customerID",
    CASE WHEN tenure <= 70 THEN gender END AS gender,
    CASE WHEN "MonthlyCharges" > 100 THEN 'Maybe' ELSE "Partner" END AS "Partner",
    CASE WHEN NOT ("PhoneService" = 'No' AND tenure > 65) THEN "MultipleLines" END AS "MultipleLines",
    CASE WHEN "InternetService" = 'No' AND "SeniorCitizen" = 1 THEN 'Yes'
         WHEN "InternetService" = 'DSL' AND tenure = 55 THEN 'No internet service'
         ELSE "OnlineSecurity" END AS "OnlineSecurity",
    CASE WHEN tenure = 41 THEN 'Satellite' WHEN tenure <> 42 THEN "InternetService" END AS "InternetService",
    CASE WHEN tenure = 40 THEN 'Crypto' ELSE "PaymentMethod" END AS "PaymentMethod",
    CASE WHEN "MonthlyCharges" > 110 THEN -"MonthlyCharges" ELSE "MonthlyCharges" END AS "MonthlyCharges",
    CASE WHEN "MonthlyCharges" < 30 THEN 'n/a' WHEN tenure = 50 THEN '12d' WHEN tenure = 51 THEN ' 7.5 '
         WHEN tenure = 52 THEN '-3' ELSE "TotalCharges" END AS "TotalCharges")
  FROM raw
),
checked AS (
  SELECT *, CASE WHEN regexp_matches(trim("TotalCharges"), '^[+-]?[0-9]+([.][0-9]*)?$')
                 THEN TRY_CAST(trim("TotalCharges") AS DOUBLE) END AS total
  FROM dirty
)"""


def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty accounts, with some of them a second and a third time."""
    df = dirty(spark, sf_dir)
    again = df.filter((q("tenure") < 20) | q("gender").isNull())
    return df.unionByName(again).unionByName(again.filter(q("tenure") < 10))


REPEATED_SQL = """
again AS (SELECT * FROM dirty WHERE tenure < 20 OR gender IS NULL),
repeated AS (SELECT * FROM dirty UNION ALL SELECT * FROM again UNION ALL SELECT * FROM again WHERE tenure < 10)"""


def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts scored by three fixed rules, shaped like classifier output."""
    df = segments.with_risk(featured(spark, sf_dir))
    early = 1 - q("tenure") / 72.0
    rules = {
        "risk points": F.col("risk_score") / 11.0,
        "short tenure": early,
        "points and tenure": F.col("risk_score") / 11.0 * 0.75 + early * 0.25,
    }
    models = [F.struct(F.lit(n).alias("Model"), p.alias("probability")) for n, p in rules.items()]
    return (
        df.withColumn("__m", F.explode(F.array(*models)))
        .select(
            q(config.KEY),
            q("Churn").alias("label"),
            q("MonthlyCharges"),
            F.col("__m.Model").alias("Model"),
            F.col("__m.probability").alias("probability"),
        )
        .withColumn("prediction", F.when(F.col("probability") >= 0.5, 1).otherwise(0))
    )


RISK_SQL = """
scored AS (
  SELECT *, CASE WHEN contains("Contract", 'Month') THEN 3 ELSE 0 END
     + CASE WHEN "PaymentMethod_Electronic check" = 1 THEN 2 ELSE 0 END
     + CASE WHEN tenure <= 12 THEN 3 ELSE 0 END
     + CASE WHEN "OnlineSecurity" = 0 THEN 1 ELSE 0 END
     + CASE WHEN "InternetService_Fiber optic" = 1 THEN 2 ELSE 0 END AS risk_score
  FROM featured
),
segmented AS (
  SELECT *, CASE WHEN risk_score >= 7 THEN 'High Risk' WHEN risk_score >= 4 THEN 'Medium Risk'
                 ELSE 'Low Risk' END AS risk
  FROM scored
)"""

RULES_SQL = (
    RISK_SQL
    + """,
rule_rows AS (
  SELECT "customerID", "Churn" AS label, "MonthlyCharges", m.name AS "Model",
    CASE m.name WHEN 'risk points' THEN risk_score / 11.0::DOUBLE
                WHEN 'short tenure' THEN 1 - tenure / 72.0::DOUBLE
                ELSE risk_score / 11.0::DOUBLE * 0.75::DOUBLE
                     + (1 - tenure / 72.0::DOUBLE) * 0.25::DOUBLE END AS probability
  FROM segmented, (VALUES ('risk points'), ('short tenure'), ('points and tenure')) AS m(name)
),
rules AS (SELECT *, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction FROM rule_rows)"""
)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, so that summation order does not show."""
    return df.select(
        *[
            F.round(q(f.name), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else q(f.name)
            for f in df.schema.fields
        ]
    )
