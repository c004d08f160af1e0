"""Classifier quality and business value, as grouped aggregates over scored rows.

Scored rows hold ``label``, ``prediction``, ``probability`` and ``MonthlyCharges``; the
grouping columns (model, fold, feature, repeat …) are free.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura import config
from tenura.functions.tables import q
from tenura.operators.ordered import (
    ROWS_PER_BUCKET, area_from_sums, ordered_counts, rank_sums,
)

STANDARD = ["Accuracy", "Precision", "Recall", "F1", "ROC-AUC"]
BUSINESS = ["Revenue_Saved", "Revenue_Leakage"]


def at_threshold(probability: Column, threshold: float = config.DECISION_THRESHOLD) -> Column:
    return F.when(probability >= threshold, 1).otherwise(0)


def positive_probability(vector: str = "probability") -> Column:
    return vector_to_array(q(vector))[1]


def _share(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def confusion_counts(label: Column, prediction: Column) -> dict[str, Column]:
    return {
        "tn": F.count_if((label == 0) & (prediction == 0)),
        "fp": F.count_if((label == 0) & (prediction == 1)),
        "fn": F.count_if((label == 1) & (prediction == 0)),
        "tp": F.count_if((label == 1) & (prediction == 1)),
    }


def confusion(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    cells = confusion_counts(q("label"), q("prediction"))
    return df.groupBy(*[q(k) for k in keys]).agg(*[c.alias(n) for n, c in cells.items()])


def quality_columns() -> list[Column]:
    """Accuracy, precision, recall and F1 of class 1 from tn, fp, fn, tp; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    return [
        _share(tp + tn, tp + tn + fp + fn).alias("Accuracy"),
        _share(tp, tp + fp).alias("Precision"),
        _share(tp, tp + fn).alias("Recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("F1"),
    ]


def from_confusion(table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return table.select(*[q(k) for k in keys], *quality_columns())


def business_value(
    df: DataFrame, keys: Sequence[str] = (), months: int = config.LIFETIME_MONTHS
) -> DataFrame:
    """Revenue kept by caught churners and lost with missed ones; 0 when there are none."""

    def value(hit: Column) -> Column:
        mean = F.coalesce(F.avg(F.when(hit, q("MonthlyCharges"))), F.lit(0.0))
        return F.bround(F.count_if(hit) * mean * months, 2)

    caught = (q("label") == 1) & (q("prediction") == 1)
    missed = (q("label") == 1) & (q("prediction") == 0)
    return df.groupBy(*[q(k) for k in keys]).agg(
        value(caught).alias("Revenue_Saved"), value(missed).alias("Revenue_Leakage")
    )


def scoreboard(
    df: DataFrame, keys: Sequence[str] = ("Model",), rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """The five standard and, where charges are known, the two business metrics per group.

    One pass over the scored rows: counts and charges are tallied per distinct probability.
    Rows without a label are left out; those without a prediction are in no cell of the
    confusion matrix but count for the area.
    """
    keys = list(keys)
    part = [q(k) for k in keys]
    df = df.filter(q("label").isNotNull())
    label = q("label") == 1
    hit, miss = q("prediction") == 1, q("prediction") == 0

    def tally(cond: Column) -> Column:
        return F.coalesce(cond, F.lit(False)).cast("long")

    tallies = {
        "pos": label.cast("long"),
        "tp": tally(label & hit),
        "fp": tally(~label & hit),
        "fn": tally(label & miss),
        "tn": tally(~label & miss),
    }
    charged = "MonthlyCharges" in df.columns
    if charged:
        charge = F.coalesce(q("MonthlyCharges"), F.lit(0.0))
        known = q("MonthlyCharges").isNotNull()
        tallies |= {
            "tp_money": F.when(label & hit, charge).otherwise(0.0),
            "fn_money": F.when(label & miss, charge).otherwise(0.0),
            "tp_known": tally(label & hit & known),
            "fn_known": tally(label & miss & known),
        }
    counts = ordered_counts(df, "probability", keys, tallies, rows_per_bucket)
    sums = counts.groupBy(*part).agg(
        *rank_sums(), *[F.sum(t).alias(f"{t}_") for t in tallies if t != "pos"]
    )
    cells = sums.withColumns({c: F.col(f"{c}_") for c in ("tp", "fp", "fn", "tn")})
    area = area_from_sums().alias("ROC-AUC")
    extra = []
    if charged:
        for name, rows in (("tp", "Revenue_Saved"), ("fn", "Revenue_Leakage")):
            mean = _share(F.col(f"{name}_money_"), F.col(f"{name}_known_"))
            extra.append(F.bround(F.col(name) * mean * config.LIFETIME_MONTHS, 2).alias(rows))
    return cells.select(*part, *quality_columns(), area, *extra)


def metrics_long(board: DataFrame, keys: Sequence[str] = ("Model",)) -> DataFrame:
    """Wide scoreboard to (key…, metric, value) rows."""
    measures = [c for c in [*STANDARD, *BUSINESS] if c in board.columns]
    return board.unpivot([q(k) for k in keys], [q(c) for c in measures], "metric", "value")


def metrics_wide(long: DataFrame, keys: Sequence[str] = ("Model",)) -> DataFrame:
    return (
        long.groupBy(*[q(k) for k in keys])
        .pivot("metric", [*STANDARD, *BUSINESS])
        .agg(F.first("value", ignorenulls=True))
    )


def mean_and_spread(df: DataFrame, measures: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation of each measure, over folds or repeats."""
    aggs = []
    for m in measures:
        aggs += [F.avg(q(m)).alias(f"{m}_mean"), F.stddev_pop(q(m)).alias(f"{m}_std")]
    return df.groupBy(*[q(k) for k in keys]).agg(*aggs)


def best_model(board: DataFrame, metric: str = "ROC-AUC") -> DataFrame:
    """The row with the highest metric; the first name wins a tie."""
    return board.orderBy(F.desc(metric), "Model").limit(1)


def scorecard(board: DataFrame, sort_by: str = "ROC-AUC") -> DataFrame:
    """Models sorted by a metric, with a best-of flag and a text per metric.

    The window spans the scoreboard, which has one row per model.
    """
    measures = [c for c in STANDARD if c in board.columns]
    every = Window.partitionBy()
    flags = [(q(m) == F.max(q(m)).over(every)).alias(f"best_{m}") for m in measures]
    texts = [F.format_string("%.4f", q(m)).alias(f"text_{m}") for m in measures]
    return board.select("Model", *[q(m) for m in measures], *flags, *texts).orderBy(
        F.desc(sort_by), "Model"
    )
