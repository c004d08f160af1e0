"""Cleaning: numeric coercion, null fill, text casts and yes/no codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura import config
from tenura.functions import columns as C
from tenura.functions.tables import q


def coerce_total(df: DataFrame, column: str = "TotalCharges") -> DataFrame:
    return df.withColumn(column, C.to_number(q(column)))


def clean(df: DataFrame) -> DataFrame:
    """Raw accounts to cleaned accounts, in one projection and without touching the input."""
    out = {}
    for name in df.columns:
        if name == "TotalCharges":
            out[name] = C.fill_zero(C.to_number(q(name)))
        elif name in ("Partner", "Dependents", "Churn"):
            out[name] = C.trimmed_yes_no(q(name).cast("string"))
        elif name in config.TEXT_COLUMNS:
            out[name] = q(name).cast("string")
        else:
            out[name] = q(name)
    return df.select(*[c.alias(n) for n, c in out.items()])


def cleaning_summary(df: DataFrame) -> DataFrame:
    """Rows, distinct rows, repeated rows and distinct keys after cleaning."""
    keyed = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return (
        keyed.groupBy(config.KEY)
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"))
        .agg(
            F.sum("n").alias("row_count"),
            (F.sum("n") - F.sum("d")).alias("duplicate_rows"),
            F.count(config.KEY).alias("distinct_keys"),
        )
    )
