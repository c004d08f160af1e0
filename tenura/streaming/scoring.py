"""The row-level chain on a stream of raw accounts.

Cleaning, encoding and features are projections, so they run on a stream unchanged once
the loyalty thresholds and the contract shares are fixed numbers from a fitted batch.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura import config
from tenura.functions import columns as C
from tenura.functions.tables import q
from tenura.operators import models
from tenura.plans.churn import featured_accounts


def stream_accounts(spark: SparkSession, path: str) -> DataFrame:
    """CSV files as they arrive; one whose header is not in the declared order is an error."""
    reader = spark.readStream.schema(config.RAW_SCHEMA).option("header", True)
    return reader.option("enforceSchema", False).csv(path)


def score_stream(
    raw: DataFrame, means: Mapping[str, float], contract_shares: Mapping[str, float], chain
) -> DataFrame:
    """Score raw accounts with a fitted chain; one output row per account."""
    featured = featured_accounts(raw, means, on_zero="null")
    share = C.map_codes(q("Contract"), contract_shares)
    ready = featured.withColumn("Contract", F.coalesce(share, F.lit(0.0))).withColumn(
        config.COST_PER_SERVICE, F.coalesce(q(config.COST_PER_SERVICE), F.lit(0.0))
    )
    scored = models.score(chain, ready, config.DECISION_THRESHOLD)
    return scored.select(config.KEY, "probability", "prediction")
