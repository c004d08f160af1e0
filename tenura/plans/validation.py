"""Every check of the raw accounts as one tidy table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura import config
from tenura.functions.tables import q
from tenura.operators import cleaning, correlation, profile, quality


def _tidy(table: DataFrame, check: str, subject: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(check, subject, measure, value) rows of a small result table."""
    parts = [q(c) for c in subject] or [F.lit("all")]
    wide = table.select(F.concat_ws(" / ", *parts).alias("subject"), *[q(v).cast("double").alias(v) for v in values])
    long = wide.unpivot(["subject"], [q(v) for v in values], "measure", "value")
    return long.select(F.lit(check).alias("check"), "subject", "measure", "value")


def report(raw: DataFrame) -> DataFrame:
    """Accuracy, consistency and completeness rules, critical columns, repeats, outliers, distributions and
    relationships: (check, subject, measure, value)."""
    numbers = cleaning.coerce_total(raw)
    critical = quality.count_rules(raw, quality.completeness_rules(raw, config.CRITICAL))
    parts = [
        _tidy(quality.check_accuracy(raw), "accuracy", ["rule"], ["bad_rows"]),
        _tidy(quality.check_consistency(raw), "consistency", ["rule"], ["bad_rows"]),
        _tidy(quality.check_completeness(raw), "completeness", ["rule"], ["bad_rows"]),
        _tidy(critical, "critical", ["rule"], ["bad_rows"]),
        _tidy(quality.duplicate_rows(raw), "duplicates", [], ["duplicate_rows"]),
        _tidy(quality.duplicate_keys(raw), "duplicates", [], ["duplicate_keys"]),
        _tidy(
            profile.iqr_outliers(numbers), "outliers", ["column_name"],
            ["q1", "q3", "iqr", "lower_bound", "upper_bound", "outliers"],
        ),
        _tidy(
            profile.describe(numbers), "distribution", ["column_name"],
            ["count", "mean", "std", "min", "p25", "p50", "p75", "max"],
        ),
        _tidy(profile.shape(numbers), "distribution", ["column_name"], ["skewness", "kurtosis"]),
        _tidy(correlation.pearson(numbers, config.NUMERIC), "pearson", ["col_a", "col_b"], ["corr"]),
        _tidy(correlation.spearman(numbers, config.NUMERIC), "spearman", ["col_a", "col_b"], ["corr"]),
    ]
    return reduce(DataFrame.unionByName, parts)
