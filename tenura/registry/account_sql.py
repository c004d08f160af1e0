"""DuckDB text of the account tables: the raw mart and each derived stage."""

from __future__ import annotations

ADDONS = [
    "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies",
]

RAW = """
per_order AS (
  SELECT l_orderkey,
         count(*) FILTER (WHERE l_returnflag = 'R') AS r,
         count(*) FILTER (WHERE l_returnflag = 'A') AS a,
         count(*) FILTER (WHERE l_discount >= 0.08) AS dsc,
         count(*) FILTER (WHERE l_tax >= 0.06) AS tx,
         sum(CAST(l_quantity AS BIGINT)) AS qty,
         count(*) FILTER (WHERE l_linestatus = 'O') AS ls,
         count(*) AS c
  FROM lineitem GROUP BY l_orderkey
),
per_customer AS (
  SELECT o_custkey, count(*) AS n,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) AS cents,
         date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) AS span,
         max(o_orderdate) AS last_order,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS f,
         count(*) FILTER (WHERE o_orderstatus = 'P') AS p,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent,
         coalesce(sum(r), 0) AS r, coalesce(sum(a), 0) AS a, coalesce(sum(dsc), 0) AS dsc,
         coalesce(sum(tx), 0) AS tx, coalesce(sum(qty), 0) AS qty, coalesce(sum(ls), 0) AS ls,
         coalesce(sum(c), 0) AS c
  FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey
  GROUP BY o_custkey
),
facts AS (
  SELECT *, r_name = 'AFRICA' AS afr,
         CAST(floor(cents / (n * 3800) + 0.5) AS BIGINT) AS bill,
         CAST(floor(cents / 3800 + 0.5) AS BIGINT) AS total,
         date_diff('day', CAST(last_order AS DATE),
                   (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS rec
  FROM customer JOIN per_customer ON c_custkey = o_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
raw AS (
  SELECT 'C-' || c_custkey AS "customerID",
         CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
         CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS "SeniorCitizen",
         CASE WHEN n >= 10 THEN 'Yes' ELSE 'No' END AS "Partner",
         CASE WHEN f >= 4 THEN 'Yes' ELSE 'No' END AS "Dependents",
         CAST(span // 33 AS INTEGER) AS tenure,
         CASE WHEN p >= 1 THEN 'Yes' ELSE 'No' END AS "PhoneService",
         CASE WHEN p = 0 THEN 'No phone service' WHEN p >= 4 THEN 'Yes' ELSE 'No' END AS "MultipleLines",
         CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN 'Fiber optic' WHEN afr THEN 'No' ELSE 'DSL' END AS "InternetService",
         CASE WHEN afr THEN 'No internet service' WHEN r >= 13 THEN 'Yes' ELSE 'No' END AS "OnlineSecurity",
         CASE WHEN afr THEN 'No internet service' WHEN a >= 13 THEN 'Yes' ELSE 'No' END AS "OnlineBackup",
         CASE WHEN afr THEN 'No internet service' WHEN tx >= 10 THEN 'Yes' ELSE 'No' END AS "DeviceProtection",
         CASE WHEN afr THEN 'No internet service' WHEN dsc >= 10 THEN 'Yes' ELSE 'No' END AS "TechSupport",
         CASE WHEN afr THEN 'No internet service' WHEN qty >= c * 25.5 THEN 'Yes' ELSE 'No' END AS "StreamingTV",
         CASE WHEN afr THEN 'No internet service' WHEN ls * 2 >= c THEN 'Yes' ELSE 'No' END AS "StreamingMovies",
         CASE WHEN n < 8 THEN 'Month-to-month' WHEN n < 12 THEN 'One year' ELSE 'Two year' END AS "Contract",
         CASE WHEN urgent >= 1 THEN 'Yes' ELSE 'No' END AS "PaperlessBilling",
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Electronic check' WHEN 'AUTOMOBILE' THEN 'Mailed check'
              WHEN 'MACHINERY' THEN 'Credit card (automatic)' ELSE 'Bank transfer (automatic)' END AS "PaymentMethod",
         bill / 100.0 AS "MonthlyCharges",
         CASE WHEN span = 0 THEN ' '
              ELSE (total // 100) || '.' || lpad(CAST(total % 100 AS VARCHAR), 2, '0') END AS "TotalCharges",
         CASE WHEN rec > 300 THEN 'Yes' ELSE 'No' END AS "Churn"
  FROM facts
)"""

COERCED = """
coerced AS (
  SELECT * REPLACE (TRY_CAST(trim("TotalCharges") AS DOUBLE) AS "TotalCharges") FROM raw
)"""

CLEANED = """
cleaned AS (
  SELECT * REPLACE (
    coalesce(TRY_CAST(trim("TotalCharges") AS DOUBLE), 0) AS "TotalCharges",
    CASE trim("Partner") WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS "Partner",
    CASE trim("Dependents") WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS "Dependents",
    CASE trim("Churn") WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS "Churn")
  FROM raw
)"""

_FLAGS = ",\n    ".join(
    f"""CASE "{c}" WHEN 'Yes' THEN 1 ELSE 0 END AS "{c}" """ for c in ["MultipleLines", *ADDONS]
)

ENCODED = f"""
encoded AS (
  SELECT * EXCLUDE ("InternetService", "PaymentMethod") REPLACE (
    CASE gender WHEN 'Male' THEN 1 ELSE 0 END AS gender,
    CASE "PhoneService" WHEN 'Yes' THEN 1 ELSE 0 END AS "PhoneService",
    CASE "PaperlessBilling" WHEN 'Yes' THEN 1 ELSE 0 END AS "PaperlessBilling",
    {_FLAGS}),
    CASE WHEN "InternetService" = 'Fiber optic' THEN 1 ELSE 0 END AS "InternetService_Fiber optic",
    CASE WHEN "InternetService" = 'No' THEN 1 ELSE 0 END AS "InternetService_No",
    CASE WHEN "PaymentMethod" = 'Credit card (automatic)' THEN 1 ELSE 0 END AS "PaymentMethod_Credit card (automatic)",
    CASE WHEN "PaymentMethod" = 'Electronic check' THEN 1 ELSE 0 END AS "PaymentMethod_Electronic check",
    CASE WHEN "PaymentMethod" = 'Mailed check' THEN 1 ELSE 0 END AS "PaymentMethod_Mailed check"
  FROM cleaned
)"""

_ADDON_SUM = " + ".join(f'"{c}"' for c in ADDONS)

FEATURED = f"""
counted AS (SELECT *, {_ADDON_SUM} AS addon_total FROM encoded),
featured AS (
  SELECT * EXCLUDE (addon_total),
    addon_total AS "_Total_AddOns-Services",
    CASE WHEN "PhoneService" + 1 - "InternetService_No" + addon_total = 0 THEN
           CASE WHEN "MonthlyCharges" > 0 THEN 'inf'::DOUBLE ELSE 'nan'::DOUBLE END
         ELSE "MonthlyCharges" / ("PhoneService" + 1 - "InternetService_No" + addon_total)
    END AS "_Cost_Per_Service",
    CASE WHEN "PaymentMethod_Credit card (automatic)" = 1
           OR ("PaymentMethod_Electronic check" = 0 AND "PaymentMethod_Mailed check" = 0
               AND "PaymentMethod_Credit card (automatic)" = 0) THEN 1 ELSE 0 END AS "_Is_AutoPay",
    CASE WHEN tenure > (SELECT avg(tenure) FROM counted)
          AND "MonthlyCharges" < (SELECT avg("MonthlyCharges") FROM counted) THEN 1 ELSE 0 END AS "_LoyaltyScore",
    CASE WHEN "PaperlessBilling" = 1 AND "PaymentMethod_Electronic check" = 1 THEN 1 ELSE 0 END AS "_HighFriction_Payment",
    "Partner" + "Dependents" AS "_Household_Stability"
  FROM counted
)"""

STAGES = {
    "raw": [RAW],
    "coerced": [RAW, COERCED],
    "cleaned": [RAW, CLEANED],
    "encoded": [RAW, CLEANED, ENCODED],
    "featured": [RAW, CLEANED, ENCODED, FEATURED],
}


def with_stage(stage: str, body: str, *extra: str) -> str:
    """A query over one stage; ``extra`` adds further common table expressions."""
    return "WITH " + ",".join([*STAGES[stage], *extra]) + "\n" + body
