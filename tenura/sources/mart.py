"""Account table derived from the sales tables (customer, orders, lineitem, nation, region).

Gives the analytics something to run on at any scale factor. Line items are
reduced to one row per order before they meet the orders, and orders to one row
per customer before they meet the customers, so no join ever sees a repeated key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.config import RAW_SCHEMA

# Declared, so that opening a table costs no job.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

LINE_COLUMNS = {
    "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies",
}
REGION_COLUMNS = LINE_COLUMNS | {"InternetService"}

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


LINE_FACTS = {
    "r": "count_if(l_returnflag = 'R')",
    "a": "count_if(l_returnflag = 'A')",
    "dsc": "count_if(l_discount >= 0.08D)",
    "tx": "count_if(l_tax >= 0.06D)",
    "qty": "sum(cast(l_quantity AS bigint))",
    "ls": "count_if(l_linestatus = 'O')",
    "c": "count(*)",
}
ORDER_FACTS = {
    "n": "count(*)",
    "cents": "sum(cast(round(o_totalprice * 100) AS bigint))",
    "span": "datediff(max(o_orderdate), min(o_orderdate))",
    "last_order": "max(o_orderdate)",
    "f": "count_if(o_orderstatus = 'F')",
    "p": "count_if(o_orderstatus = 'P')",
    "urgent": "count_if(o_orderpriority = '1-URGENT')",
}


def _yes_no(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'Yes' ELSE 'No' END"


def _addon(condition: str) -> str:
    return (
        "CASE WHEN r_name = 'AFRICA' THEN 'No internet service' "
        f"WHEN {condition} THEN 'Yes' ELSE 'No' END"
    )


BILL_CENTS = "floor(cents / (n * 3800) + 0.5D)"
TOTAL_CENTS = "floor(cents / 3800 + 0.5D)"
RULES = {
    "customerID": "concat('C-', c_custkey)",
    "gender": "CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END",
    "SeniorCitizen": "cast(c_acctbal < 0 AS int)",
    "Partner": _yes_no("n >= 10"),
    "Dependents": _yes_no("f >= 4"),
    "tenure": "cast(floor(span / 33) AS int)",
    "PhoneService": _yes_no("p >= 1"),
    "MultipleLines": "CASE WHEN p = 0 THEN 'No phone service' WHEN p >= 4 THEN 'Yes' ELSE 'No' END",
    "InternetService": "CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN 'Fiber optic' "
    "WHEN r_name = 'AFRICA' THEN 'No' ELSE 'DSL' END",
    "OnlineSecurity": _addon("r >= 13"),
    "OnlineBackup": _addon("a >= 13"),
    "DeviceProtection": _addon("tx >= 10"),
    "TechSupport": _addon("dsc >= 10"),
    "StreamingTV": _addon("qty >= c * 25.5D"),
    "StreamingMovies": _addon("ls * 2 >= c"),
    "Contract": "CASE WHEN n < 8 THEN 'Month-to-month' WHEN n < 12 THEN 'One year' "
    "ELSE 'Two year' END",
    "PaperlessBilling": _yes_no("urgent >= 1"),
    "PaymentMethod": "CASE c_mktsegment WHEN 'BUILDING' THEN 'Electronic check' "
    "WHEN 'AUTOMOBILE' THEN 'Mailed check' WHEN 'MACHINERY' THEN 'Credit card (automatic)' "
    "ELSE 'Bank transfer (automatic)' END",
    "MonthlyCharges": f"{BILL_CENTS} / 100D",
    "TotalCharges": "CASE WHEN span = 0 THEN ' ' ELSE "
    f"concat({TOTAL_CENTS} div 100, '.', lpad({TOTAL_CENTS} % 100, 2, '0')) END",
    "Churn": _yes_no("datediff(newest, last_order) > 300"),
}


def _aliased(exprs: dict[str, str]) -> list:
    return [F.expr(f"{sql} AS `{name}`") for name, sql in exprs.items()]


def _order_facts(spark: SparkSession, sf_dir: str, with_lines: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    facts = dict(ORDER_FACTS)
    if with_lines:
        lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*_aliased(LINE_FACTS))
        orders = orders.join(lines, F.expr("o_orderkey = l_orderkey"), "left")
        facts |= {name: f"coalesce(sum({name}), 0)" for name in LINE_FACTS}
    return orders.groupBy("o_custkey").agg(*_aliased(facts))


def raw_accounts(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The raw account table, one row per customer with at least one order.

    ``columns`` restricts the output; tables that feed none of them are not read.
    """
    wanted = list(columns) if columns else RAW_SCHEMA.fieldNames()
    facts = _order_facts(spark, sf_dir, bool(LINE_COLUMNS & set(wanted)))
    df = table(spark, sf_dir, "customer").join(facts, F.expr("c_custkey = o_custkey"))
    if REGION_COLUMNS & set(wanted):
        nation, region = (table(spark, sf_dir, t) for t in ("nation", "region"))
        places = nation.join(region, F.expr("n_regionkey = r_regionkey"))
        df = df.join(places, F.expr("c_nationkey = n_nationkey"))
    if "Churn" in wanted:
        newest = table(spark, sf_dir, "orders").select(F.max("o_orderdate"))
        df = df.withColumn("newest", newest.scalar())
    return df.select(*_aliased({c: RULES[c] for c in wanted}))
