"""Pearson and Spearman correlation in long form, and what is read off them."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura import config
from tenura.functions.columns import nan_to_null
from tenura.functions.tables import literal_table, materialize, q
from tenura.operators.ordered import ROWS_PER_BUCKET, average_rank, with_running

# executors run the task function below without having the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def _correlate(
    df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[str, str]], centers: Sequence[float],
    slots: Mapping[str, int] | None = None,
) -> DataFrame:
    """Correlation of pairs of columns over the rows that have both, from six sums for each pair.

    ``x`` holds a row's values one column after the other, null where missing; with ``slots``, as many values for each column as
    there are slots, of which a pair takes the one of its other column. Tasks add up the sums, ``centers`` taken off first;
    the plan does not depend on the number of columns or of gaps.
    """
    slots = slots or {}
    at = {c: i for i, c in enumerate(columns)}
    width = max(slots.values(), default=0) + 1
    places = [(at[a], slots.get(b, 0), at[b], slots.get(a, 0)) for a, b in pairs]
    taken = np.asarray(centers, np.float64)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SUMS), len(places)))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = x.reshape(batch.num_rows, len(taken), width) - taken[None, :, None]
            for k, (i, s, j, t) in enumerate(places):
                u, v = x[:, i, s], x[:, j, t]
                both = ~(np.isnan(u) | np.isnan(v))
                if not both.all():
                    u, v = u[both], v[both]
                total[:, k] += len(u), u.sum(), v.sum(), u @ u, v @ v, u @ v
        yield pa.RecordBatch.from_arrays([pa.array(range(len(places)), pa.int32()), *map(pa.array, total)], ["pair", *SUMS])

    parts = df.select("x").mapInArrow(add, "pair int, " + ", ".join(f"{c} double" for c in SUMS))
    sums = parts.groupBy("pair").agg(*[F.sum(c).alias(c) for c in SUMS])
    n, sx, sy, sxx, syy, sxy = (F.col(c) for c in SUMS)
    of_x, of_y = n * sxx - sx * sx, n * syy - sy * sy
    # what rounding leaves of a constant is no spread
    some = (of_x > 1e-12 * n * sxx) & (of_y > 1e-12 * n * syy)
    corr = (n * sxy - sx * sy) / F.sqrt(of_x) / F.sqrt(of_y)
    corr = F.when(some & ~F.isnan(corr), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), corr)))
    names = literal_table(df.sparkSession, [(i, a, b) for i, (a, b) in enumerate(pairs)], ["pair", "col_a", "col_b"])
    return F.broadcast(names).join(sums, "pair", "left").select("col_a", "col_b", corr.alias("corr"))


def _wide(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[nan_to_null(q(c).cast("double")).alias(c) for c in columns])


def pearson(
    df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[str, str]] | None = None
) -> DataFrame:
    """Pearson correlation per pair of columns, over the rows where both are present."""
    pairs = list(pairs or combinations(columns, 2))
    wide = _wide(df, columns)
    means = wide.agg(*[F.avg(q(c)).alias(c) for c in columns]).first()
    centers = [means[c] if means[c] is not None and abs(means[c]) < float("inf") else 0.0 for c in columns]
    return _correlate(wide.select(F.array(*[q(c) for c in columns]).alias("x")), columns, pairs, centers)


def spearman(
    df: DataFrame,
    columns: Sequence[str],
    pairs: Sequence[tuple[str, str]] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Spearman correlation per pair: average ranks among the rows where both are present.

    A column of zeros and ones needs no ranks, as these are the same straight line of its values among any rows. All
    others are ranked together as (row, column, value): the ranks of the distinct values are joined to the values, and one
    grouping puts the rows together again. So values move twice, whatever the number of columns and of distinct
    values. Where columns have gaps, distinct values are counted by the pattern of gaps, and a value has one rank for each
    column with gaps, among the rows that have that column.
    """
    pairs = list(pairs or combinations(columns, 2))
    wide = _wide(df, columns)
    facts = wide.agg(
        F.count(F.lit(1)).alias("|rows"), *[F.count(q(c)).alias(f"n:{c}") for c in columns],
        *[F.count_if(~q(c).isin(0.0, 1.0)).alias(f"o:{c}") for c in columns]).first()
    holey = [c for c in columns if facts[f"n:{c}"] < facts["|rows"]]
    flags = [c for c in columns if facts[f"o:{c}"] == 0]
    slots = {c: i + 1 for i, c in enumerate(holey)}
    rows = _ranked(wide, columns, flags, slots, rows_per_bucket)
    middle = (facts["|rows"] + 1) / 2
    return _correlate(rows, columns, pairs, [0.5 if c in flags else middle for c in columns], slots)


def _ranked(
    wide: DataFrame, columns: Sequence[str], flags: Sequence[str], slots: Mapping[str, int], rows_per_bucket: int
) -> DataFrame:
    """``x`` of every row: for each column its ranks by slot (0: among all rows that have a value), or its flag."""
    width = len(slots) + 1
    ranked = [c for c in columns if c not in flags]

    def repeated(c: str) -> Column:
        return F.array_repeat(q(c), width)

    if not ranked:
        return wide.select(F.flatten(F.array(*[repeated(c) for c in columns])).alias("x"))
    pattern = F.array(F.lit(0), *[F.when(q(c).isNotNull(), F.lit(s)) for c, s in slots.items()])
    numbered = wide.select(
        F.monotonically_increasing_id().alias("row"), F.array_compact(pattern).alias("pattern"),
        F.array(*[q(c) for c in flags]).cast("array<double>").alias("flags"), *[q(c) for c in ranked])
    none = F.lit(None)
    cells = [F.struct(F.lit(i).alias("place"), q(c).alias("value"), none.cast("array<double>").alias("flags"))
             for i, c in enumerate(ranked)]
    cells.append(F.struct(F.lit(-1).alias("place"), none.cast("double").alias("value"), F.col("flags").alias("flags")))
    long = numbered.select("row", "pattern", F.inline(F.array(*cells))).where("value IS NOT NULL OR place = -1")
    counts = materialize(long.where("place >= 0").groupBy("place", "value", "pattern").agg(F.count(F.lit(1)).alias("n")))
    by_slot = counts.select("place", "value", F.explode("pattern").alias("slot"), "n")
    by_slot = materialize(by_slot.groupBy("place", "slot", "value").agg(F.sum("n").alias("n"))) if slots else by_slot
    placed = with_running(by_slot, "value", ["place", "slot"], rows_per_bucket).withColumn("rank", average_rank())
    ranks = placed.groupBy("place", "value").agg(
        F.array(*[F.max(F.when(F.col("slot") == s, F.col("rank"))) for s in range(width)]).alias("ranks"))
    joined = long.drop("pattern").join(ranks, ["place", "value"], "left")
    found = [F.first(F.when(F.col("place") == i, F.col("ranks")), ignorenulls=True).alias(f"r{i}") for i in range(len(ranked))]
    rows = joined.groupBy("row").agg(F.first("flags", ignorenulls=True).alias("flags"), *found)
    empty = F.array_repeat(none.cast("double"), width)
    of = {c: F.coalesce(f"r{i}", empty) for i, c in enumerate(ranked)}
    of |= {c: F.array_repeat(F.col("flags")[i], width) for i, c in enumerate(flags)}
    return rows.select(F.flatten(F.array(*[of[c] for c in columns])).alias("x"))


def full_matrix(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pair rows to a square table, one row and one column per feature."""
    spark = pairs.sparkSession
    flipped = pairs.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    diagonal = literal_table(spark, [(c, c, 1.0) for c in columns], ["col_a", "col_b", "corr"])
    return (
        pairs.unionByName(flipped)
        .unionByName(diagonal)
        .groupBy("col_a")
        .pivot("col_b", list(columns))
        .agg(F.first("corr"))
    )


def with_target(df: DataFrame, columns: Sequence[str], target: str = config.LABEL) -> DataFrame:
    """Spearman correlation of each column with the target, highest first."""
    others = [c for c in columns if c != target]
    rho = spearman(df, [*others, target], [(c, target) for c in others])
    return rho.select(F.col("col_a").alias("feature"), "corr").orderBy(F.desc("corr"), "feature")


def correlated_with_earlier(
    df: DataFrame, columns: Sequence[str], limit: float = config.CORRELATION_LIMIT
) -> DataFrame:
    """Columns whose Spearman correlation with an earlier column passes the limit."""
    rho = spearman(df, columns)
    return (
        rho.filter(F.abs("corr") > limit)
        .groupBy(F.col("col_b").alias("feature"))
        .agg(F.max(F.abs("corr")).alias("max_abs_corr"))
    )


def drop_correlated(
    df: DataFrame, columns: Sequence[str], mode: str = "fixed"
) -> tuple[DataFrame, list[str]]:
    """Drop correlated features: the fixed list, or the computed candidates."""
    if mode == "fixed":
        gone = [c for c in config.DROPPED_FEATURES if c in columns]
    elif mode == "computed":
        gone = [r["feature"] for r in correlated_with_earlier(df, columns).collect()]
    else:
        raise ValueError("mode must be 'fixed' or 'computed'")
    return df.drop(*gone), [c for c in columns if c not in gone]


def top_by_target(df: DataFrame, columns: Sequence[str], k: int = 11) -> DataFrame:
    """The k entries with the largest absolute correlation, the target itself included."""
    ranked = with_target(df, columns)
    itself = literal_table(df.sparkSession, [(config.LABEL, 1.0)], ["feature", "corr"])
    return ranked.unionByName(itself).orderBy(F.desc(F.abs("corr")), "feature").limit(k)


def select_features(df: DataFrame, columns: Sequence[str], mode: str = "fixed", k: int = 11):
    """Feature names: the fixed list, or the computed top k without the target."""
    if mode == "fixed":
        return list(config.SELECTED_FEATURES)
    if mode != "computed":
        raise ValueError("mode must be 'fixed' or 'computed'")
    rows = top_by_target(df, columns, k).collect()
    return [r["feature"] for r in rows if r["feature"] != config.LABEL]
