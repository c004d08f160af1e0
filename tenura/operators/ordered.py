"""Order statistics over distinct values: running counts, quantiles, average ranks, AUC.

Everything here works on (key, distinct value, count) rows, so a value that fills a
third of the table is one row after the map-side combine. The running count is a
two-level prefix sum: values fall into ordered buckets holding a bounded number of
distinct values, each bucket is summed on its own, and the bucket totals give the
offsets. The bucket borders are plain numbers in the plan, so a recomputed task lands
on the same buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions.tables import materialize, q

ROWS_PER_BUCKET = 1_000_000
SKETCH_ACCURACY = 20_000


def bucket_borders(counts: DataFrame, value: str, rows_per_bucket: int) -> list[float]:
    """Interior borders that leave about ``rows_per_bucket`` distinct rows in each bucket."""
    buckets = -(-counts.count() // rows_per_bucket)
    if buckets <= 1:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    at = counts.agg(F.percentile_approx(q(value).cast("double"), probs, SKETCH_ACCURACY)).first()
    return sorted({p for p in at[0] if p not in (float("inf"), float("-inf"))})


def value_counts_of(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    tallies: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rows ``n`` per key and distinct value, checkpointed so the input is evaluated once.

    Rows with a null key, or a null or NaN value, are left out.
    """
    present = q(value).isNotNull()
    for key in keys:
        present = present & q(key).isNotNull()
    if dict(df.dtypes)[value] in ("double", "float"):
        present = present & ~F.isnan(q(value))
    sums = [F.sum(c).alias(name) for name, c in (tallies or {}).items()]
    return materialize(
        df.filter(present)
        .groupBy(*[q(k) for k in keys], q(value))
        .agg(F.count(F.lit(1)).alias("n"), *sums)
    )


def ordered_counts(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    tallies: Mapping[str, Column] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Per key and distinct value: ``n`` rows, ``before`` rows with a smaller value and the
    key's ``total``. Everything after the grouping reads its checkpoint.
    """
    keys = list(keys)
    counts = value_counts_of(df, value, keys, tallies)
    return with_running(counts, value, keys, rows_per_bucket)


def with_running(
    counts: DataFrame, value: str, keys: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Add ``before`` and ``total`` to materialised value counts."""
    keys = list(keys)
    borders = bucket_borders(counts, value, rows_per_bucket)
    part = [q(k) for k in keys]
    earlier = (Window.unboundedPreceding, -1)
    if not borders:
        # the whole table fits one bucket, so a window per key is bounded
        running = Window.partitionBy(*part).orderBy(q(value)).rowsBetween(*earlier)
        return counts.withColumns(
            {
                "before": F.coalesce(F.sum("n").over(running), F.lit(0)),
                "total": F.sum("n").over(Window.partitionBy(*part)),
            }
        )
    splits = [float("-inf"), *borders, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="__x", outputCol="__bucket").transform(
        counts.withColumn("__x", q(value).cast("double"))
    )
    per_bucket = Window.partitionBy(*part).orderBy("__bucket").rowsBetween(*earlier)
    offsets = (
        bucketed.groupBy(*part, "__bucket")
        .agg(F.sum("n").alias("__rows"))
        .select(
            *part,
            "__bucket",
            F.coalesce(F.sum("__rows").over(per_bucket), F.lit(0)).alias("__base"),
            F.sum("__rows").over(Window.partitionBy(*part)).alias("total"),
        )
    )
    inside = Window.partitionBy(*part, "__bucket").orderBy(q(value)).rowsBetween(*earlier)
    return (
        bucketed.withColumn("__in", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(offsets, [*keys, "__bucket"])
        .withColumn("before", F.col("__base") + F.col("__in"))
        .select(*[q(c) for c in counts.columns], "before", "total")
    )


def average_rank() -> Column:
    """Average-tie rank, from the columns of ``ordered_counts``."""
    return F.col("before") + (F.col("n") + 1) / 2


def quantile_columns(value: str, probs: Mapping[str, float]) -> tuple[list[Column], list[Column]]:
    """Aggregates and final projections for linearly interpolated quantiles."""
    aggs, finals = [], []
    x = q(value).cast("double")
    for name, p in probs.items():
        pos = (F.col("total") - 1) * F.lit(float(p))
        for tag, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (F.col("before") <= at) & (at < F.col("before") + F.col("n"))
            aggs.append(F.max(F.when(hit, x)).alias(f"__{tag}_{name}"))
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        frac = pos - F.floor(pos)
        finals.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * frac).alias(name))
    aggs.append(F.max("total").alias("total"))
    return aggs, finals


def quantiles_of(counts: DataFrame, value: str, keys: Sequence[str], probs: Mapping) -> DataFrame:
    aggs, finals = quantile_columns(value, probs)
    part = [q(k) for k in keys]
    return counts.groupBy(*part).agg(*aggs).select(*part, *finals)


def quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    keys: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per key."""
    counts = ordered_counts(df, value, keys, rows_per_bucket=rows_per_bucket)
    return quantiles_of(counts, value, keys, probs)


def roc_auc(
    df: DataFrame,
    score: str,
    label: str,
    keys: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Area under the ROC curve by rank sum; null when only one class occurs."""
    rows = df.filter(q(label).isNotNull())
    counts = ordered_counts(
        rows, score, keys, {"pos": q(label).cast("long")}, rows_per_bucket=rows_per_bucket
    )
    part = [q(k) for k in keys]
    return counts.groupBy(*part).agg(*rank_sums()).select(
        *part, area_from_sums().alias("roc_auc")
    )


def rank_sums() -> list[Column]:
    """Aggregates over ``ordered_counts`` with a ``pos`` tally that the area needs."""
    return [
        F.sum(F.col("pos") * average_rank()).alias("__ranks"),
        F.sum("pos").alias("__pos"),
        F.max("total").alias("__total"),
    ]


def area_from_sums() -> Column:
    pos = F.col("__pos").cast("double")
    return F.try_divide(
        F.col("__ranks") - pos * (pos + 1) / 2, pos * (F.col("__total") - pos)
    )
