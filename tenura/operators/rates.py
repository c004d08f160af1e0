"""Counts, shares and rates by one or two keys, with optional fixed label order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura import config
from tenura.functions.tables import literal_table, q


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first (ties by value), and percent of all rows."""
    grouped = df.groupBy(q(column)).agg(F.count(F.lit(1)).alias("count"))
    share = F.col("count") / grouped.select(F.sum("count")).scalar() * 100
    counted = grouped.filter(q(column).isNotNull()).withColumn("share", share)
    return counted.orderBy(F.desc("count"), q(column))


def grouped_at_once(df: DataFrame, groupings: Mapping[str, Sequence[str]], target: str = config.LABEL) -> DataFrame:
    """Many groupings by one or two columns in one pass: ``grouping``, ``key``, ``second`` (text; null also if there is
    none), ``total``, ``churned``, ``stayed``.

    Rows are counted by grouping sets, which add up on the map side. Null is a group of its own.
    """
    if any(not 1 <= len(columns) <= 2 for columns in groupings.values()):
        raise ValueError("a grouping has one or two columns")
    names = list(dict.fromkeys(c for columns in groupings.values() for c in columns))
    at = {c: f"k{i}" for i, c in enumerate(names)}
    wide = df.select(*[q(c).cast("string").alias(k) for c, k in at.items()], q(target).alias("target"))
    asked: dict[frozenset, list[str]] = {}
    for name, columns in groupings.items():
        asked.setdefault(frozenset(at[c] for c in columns), []).append(name)
    keys = list(at.values())
    counted = wide.groupingSets([[F.col(k) for k in sorted(s)] for s in asked], *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("at"), F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("target") == 1).alias("churned"), F.count_if(F.col("target") == 0).alias("stayed"))
    # a grouping set is told by the columns that it leaves out
    rows = {}
    for columns, wanted in asked.items():
        left_out = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in columns)
        rows[left_out] = F.array(*[
            F.struct(F.lit(n).alias("grouping"), *[
                (F.col(at[groupings[n][i]]) if i < len(groupings[n]) else F.lit(None).cast("string")).alias(alias)
                for i, alias in enumerate(("key", "second"))])
            for n in wanted])
    found = F.coalesce(*[F.when(F.col("at") == i, made) for i, made in rows.items()])
    return counted.select(F.inline(found), "total", "churned", "stayed")


def value_counts_many(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per non-null value and percent of all rows, for many columns in one pass."""
    wide = df.select(*[q(c).cast("string").alias(c) for c in columns])
    grouped = (
        wide.unpivot([], [q(c) for c in columns], "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    # one row per listed column, so the broadcast is bounded by the argument
    totals = F.broadcast(grouped.groupBy("column_name").agg(F.sum("count").alias("whole")))
    counted = grouped.filter(F.col("value").isNotNull()).join(totals, "column_name")
    return counted.select(
        "column_name", "value", "count", (F.col("count") / F.col("whole") * 100).alias("share")
    )


def rate_by(df: DataFrame, keys: Sequence[str], target: str = config.LABEL) -> DataFrame:
    """Per key: rows, positives, negatives and the mean of the target in percent."""
    rows = df
    for key in keys:
        rows = rows.filter(q(key).isNotNull())
    return rows.groupBy(*[q(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(q(target) == 1).alias("churned"),
        F.count_if(q(target) == 0).alias("stayed"),
        (F.avg(q(target)) * 100).alias("rate"),
    )


def rates_for(df: DataFrame, columns: Sequence[str], target: str = config.LABEL) -> DataFrame:
    """The rate per value of many columns, in one pass."""
    wide = df.select(q(target).alias("__y"), *[q(c).cast("string").alias(c) for c in columns])
    return (
        wide.unpivot(["__y"], [q(c) for c in columns], "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("total"), (F.avg("__y") * 100).alias("rate"))
    )


def in_domain_order(table: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """Keep every label of the domain, in its given order; unobserved ones have nulls."""
    domain = literal_table(
        table.sparkSession, [(label, i) for i, label in enumerate(labels)], [key, "position"]
    )
    return domain.join(table, key, "left").orderBy("position")


def _conditions(column: str, labels: Sequence, other: str | None) -> list[Column]:
    declared = [q(column) == F.lit(v) for v in labels]
    return declared if other is None else [*declared, ~F.coalesce(q(column).isin(list(labels)), F.lit(False))]


def _names(names: Sequence, other: str | None) -> list:
    return [*names] if other is None else [*names, other]


def rate_matrix(
    df: DataFrame,
    row: str,
    column: str,
    labels: Sequence,
    target: str = config.LABEL,
    names: Sequence[str] | None = None,
    fill: float | None = None,
    other: str | None = None,
) -> DataFrame:
    """Mean of the target in percent, rows by columns; the column labels are declared.

    One conditional aggregate per label, so the table is grouped by the row key only. ``other`` names a column for
    the rows whose value is null or not declared; without it they are in no cell.
    """
    rows = df.filter(q(row).isNotNull())
    conditions = _conditions(column, labels, other)
    cells = [F.avg(F.when(c, q(target))) * 100 for c in conditions]
    shown = [c if fill is None else F.coalesce(c, F.lit(fill)) for c in cells]
    labelled = [c.alias(str(n)) for c, n in zip(shown, _names(names or labels, other))]
    return rows.groupBy(q(row)).agg(*labelled)


def count_matrix(
    df: DataFrame,
    row: str,
    column: str,
    labels: Sequence,
    names: Sequence[str] | None = None,
    fill: int | None = None,
    other: str | None = None,
) -> DataFrame:
    """Row counts, rows by columns; empty cells are null unless filled. ``other`` as in ``rate_matrix``."""
    rows = df.filter(q(row).isNotNull())
    cells = [F.count_if(c) for c in _conditions(column, labels, other)]
    shown = [F.when(c > 0, c) if fill is None else c for c in cells]
    labelled = [c.alias(str(n)) for c, n in zip(shown, _names(names or labels, other))]
    return rows.groupBy(q(row)).agg(*labelled)


def kpis(df: DataFrame) -> DataFrame:
    """Customers, churners, churn percent, mean bill and total revenue."""
    return df.agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(config.LABEL).alias("churned"),
        (F.try_divide(F.sum(config.LABEL), F.count(F.lit(1))) * 100).alias("churn_pct"),
        F.avg("MonthlyCharges").alias("avg_bill"),
        F.sum("TotalCharges").alias("total_revenue"),
    )


def class_ratio(df: DataFrame, label: str = config.LABEL) -> DataFrame:
    """Negatives per positive."""
    neg, pos = F.count_if(q(label) == 0), F.count_if(q(label) == 1)
    return df.agg(
        neg.alias("negatives"), pos.alias("positives"), F.try_divide(neg, pos).alias("ratio")
    )


def balanced_weights(df: DataFrame, label: str = config.LABEL) -> DataFrame:
    """Per class n / (classes * n_class)."""
    sizes = df.filter(q(label).isNotNull()).groupBy(q(label)).agg(F.count(F.lit(1)).alias("n"))
    # the window spans one row per class
    every = Window.partitionBy()
    weight = F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))
    return sizes.withColumn("weight", weight)
