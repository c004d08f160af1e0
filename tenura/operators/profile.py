"""Column profiles: summary statistics, shape, outliers, histograms, boxes, densities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura import config
from tenura.functions.columns import nan_to_null
from tenura.functions.tables import q
from tenura.operators.ordered import (
    ordered_counts, quantile_columns, quantiles, quantiles_of, value_counts_of, with_running,
)

BIN_BLOCK = 4096
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def to_long(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids…, column_name, value) rows with values as double and NaN as null."""
    wide = df.select(*[q(c) for c in ids], *[nan_to_null(q(c).cast("double")).alias(c) for c in columns])
    return wide.unpivot([q(c) for c in ids], [q(c) for c in columns], "column_name", "value")


def skewness(x: Column) -> Column:
    """Bias-adjusted skewness; null below three values, 0 for a constant."""
    n = F.count(x).cast("double")
    adjusted = F.sqrt(n * (n - 1)) / (n - 2) * F.skewness(x)
    return F.when((n > 2) & (F.var_pop(x) == 0), F.lit(0.0)).when(n > 2, adjusted)


def kurtosis(x: Column) -> Column:
    """Bias-adjusted excess kurtosis; null below four values, 0 for a constant."""
    n = F.count(x).cast("double")
    adjusted = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6)
    return F.when((n > 3) & (F.var_pop(x) == 0), F.lit(0.0)).when(n > 3, adjusted)


def _per_column(df: DataFrame, columns: Sequence[str], measures: dict) -> DataFrame:
    """Several measures of several columns in one aggregate, one output row per column."""
    wide = df.select(*[nan_to_null(q(c).cast("double")).alias(c) for c in columns])
    one_row = wide.agg(
        *[f(q(c)).alias(f"{c}|{m}") for c in columns for m, f in measures.items()]
    )
    structs = [
        F.struct(F.lit(c).alias("column_name"), *[q(f"{c}|{m}").alias(m) for m in measures])
        for c in columns
    ]
    return one_row.select(F.inline(F.array(*structs)))


def describe(
    df: DataFrame, columns: Sequence[str] = config.NUMERIC, accuracy: int | None = None
) -> DataFrame:
    """count, mean, std, min, quartiles and max per column.

    Exact by default, from the distinct values. With an ``accuracy`` the quartiles come from
    a mergeable sketch of relative rank error 1/accuracy, in one pass without moving values.
    """
    if accuracy is not None:
        return _describe_sketched(df, columns, accuracy)
    measures = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    basic = _per_column(df, columns, measures)  # combined on the map side; no values are moved
    counts = ordered_counts(to_long(df, columns), "value", ["column_name"])
    aggs, finals = quantile_columns("value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    quartiles = counts.groupBy("column_name").agg(*aggs).select(
        "column_name", F.col("total").alias("count"), *finals
    )
    # one row per listed column, so the broadcast is bounded by the argument
    return quartiles.join(F.broadcast(basic), "column_name").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def _describe_sketched(df: DataFrame, columns: Sequence[str], accuracy: int) -> DataFrame:
    at = F.col("__at")
    return (
        to_long(df, columns)
        .groupBy("column_name")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy).alias("__at"),
            F.max("value").alias("max"),
        )
        .select(
            "column_name", "count", "mean", "std", "min",
            at[0].alias("p25"), at[1].alias("p50"), at[2].alias("p75"), "max",
        )
    )


def shape(df: DataFrame, columns: Sequence[str] = config.NUMERIC) -> DataFrame:
    """Bias-adjusted skewness and excess kurtosis per column."""
    return _per_column(df, columns, {"skewness": skewness, "kurtosis": kurtosis})


def iqr_outliers(df: DataFrame, column: str = "TotalCharges", reach: float = 1.5) -> DataFrame:
    """Quartiles, fences and the number of values outside them."""
    return box_stats(df, [column], reach=reach).select(
        "column_name", "q1", "q3", "iqr", "lower_bound", "upper_bound", "outliers"
    )


def outlier_rows(df: DataFrame, column: str = "TotalCharges", reach: float = 1.5) -> DataFrame:
    """The rows outside the fences."""
    quartiles = quantiles(to_long(df, [column]), "value", QUARTILES)
    iqr = F.col("q3") - F.col("q1")
    low = quartiles.select(F.col("q1") - reach * iqr).scalar()
    high = quartiles.select(F.col("q3") + reach * iqr).scalar()
    x = q(column).cast("double")
    return df.filter((x < low) | (x > high))


def box_stats(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    reach: float = 1.5,
    accuracy: int | None = None,
) -> DataFrame:
    """Quartiles, whiskers at the last value inside the fences, and outlier counts.

    Exact by default. With an ``accuracy`` the quartiles come from a sketch, and two passes over
    the rows replace the grouping of values; whiskers and counts are exact for those fences.
    """
    keys = ["column_name", *by]
    long = to_long(df, columns, by)
    if accuracy is None:
        counts = ordered_counts(long, "value", keys)
        mids = quantiles_of(counts, "value", keys, QUARTILES)
    else:
        present = long.filter(F.col("value").isNotNull())
        counts = present.withColumn("n", F.lit(1))
        at = F.percentile_approx("value", list(QUARTILES.values()), accuracy)
        mids = present.groupBy(*[q(k) for k in keys]).agg(at.alias("__at")).select(
            *[q(k) for k in keys],
            *[F.col("__at")[i].alias(name) for i, name in enumerate(QUARTILES)],
        )
    iqr = F.col("q3") - F.col("q1")
    fenced = mids.select(
        "*",
        iqr.alias("iqr"),
        (F.col("q1") - reach * iqr).alias("lower_bound"),
        (F.col("q3") + reach * iqr).alias("upper_bound"),
    )
    inside = (F.col("value") >= F.col("lower_bound")) & (F.col("value") <= F.col("upper_bound"))
    stats = ["q1", "median", "q3", "iqr", "lower_bound", "upper_bound"]
    return (
        counts.join(fenced, keys)
        .groupBy(*[q(k) for k in keys], *stats)
        .agg(
            F.sum("n").alias("count"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
    )


def histogram(
    df: DataFrame, columns: Sequence[str], bins: int | str = 10, by: str | None = None
) -> DataFrame:
    """Equal-width histogram, closed on the right in the last bin; empty bins are kept.

    ``bins="auto"`` takes the narrower of the Sturges and Freedman–Diaconis widths.
    Bins span the whole column, also when counting per group.
    """
    ids = [by] if by else []
    finite = to_long(df, columns, ids).filter(F.abs("value") != float("inf"))
    if by:
        finite = finite.filter(q(by).isNotNull())
    if bins == "auto":
        counts = value_counts_of(finite, "value", ["column_name", *ids])
    else:
        # two passes that combine on the map side; no value is moved
        counts = finite.withColumn("n", F.lit(1))
    span = counts.groupBy("column_name").agg(
        F.min("value").alias("__min"), F.max("value").alias("__max"), F.sum("n").alias("__n")
    )
    if bins == "auto":
        merged = counts.groupBy("column_name", "value").agg(F.sum("n").alias("n")) if by else counts
        ordered = with_running(merged, "value", ["column_name"])
        mids = quantiles_of(ordered, "value", ["column_name"], QUARTILES)
        width = F.col("__max") - F.col("__min")
        n = F.col("__n").cast("double")
        fd = 2 * (F.col("q3") - F.col("q1")) / F.pow(n, F.lit(1 / 3))
        sturges = width / (F.log2(n) + 1)
        best = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
        bin_count = F.when(best > 0, F.ceil(F.try_divide(width, best))).otherwise(1)
        span = span.join(mids, "column_name").withColumn("__bins", bin_count.cast("int"))
    else:
        span = span.withColumn("__bins", F.lit(int(bins)))
    flat = F.col("__min") == F.col("__max")
    span = span.select(
        "column_name",
        "__bins",
        F.when(flat, F.col("__min") - 0.5).otherwise(F.col("__min")).alias("__lo"),
        F.when(flat, F.col("__max") + 0.5).otherwise(F.col("__max")).alias("__hi"),
    ).withColumn("__w", (F.col("__hi") - F.col("__lo")) / F.col("__bins"))
    # one row per listed column, so the broadcast is bounded by the argument
    placed = counts.join(F.broadcast(span), "column_name")
    guess = F.least(
        F.floor((F.col("value") - F.col("__lo")) / F.col("__w")), F.col("__bins") - 1
    ).cast("int")
    down = F.col("value") < F.col("__lo") + F.col("__i") * F.col("__w")
    up = (F.col("value") >= F.col("__lo") + (F.col("__i") + 1) * F.col("__w")) & (
        F.col("__i") < F.col("__bins") - 1
    )
    filled = (
        placed.withColumn("__i", guess)
        .withColumn("bin", F.col("__i") - F.when(down, 1).otherwise(0) + F.when(up, 1).otherwise(0))
        .groupBy("column_name", *[q(c) for c in ids], "bin")
        .agg(F.sum("n").alias("__count"))
    )
    # one far value can make very many bins, so they are listed block by block
    last = F.col("__bins") - 1
    blocks = span.select("*", F.explode(F.sequence(F.lit(0), F.floor(last / BIN_BLOCK).cast("int"))).alias("__block"))
    first = F.col("__block") * BIN_BLOCK
    each = F.explode(F.sequence(first, F.least(first + BIN_BLOCK - 1, last))).alias("bin")
    every_bin = blocks.select("*", each).drop("__block")
    if by:
        groups = filled.select("column_name", q(by)).distinct()
        every_bin = every_bin.join(groups, "column_name")
    return every_bin.join(filled, ["column_name", *ids, "bin"], "left").select(
        "column_name",
        *[q(c) for c in ids],
        "bin",
        (F.col("__lo") + F.col("bin") * F.col("__w")).alias("bin_start"),
        (F.col("__lo") + (F.col("bin") + 1) * F.col("__w")).alias("bin_end"),
        F.coalesce("__count", F.lit(0)).alias("count"),
    )


def kernel_density(
    df: DataFrame,
    column: str,
    by: str | None = None,
    grid: int = 200,
    cut: float = 3.0,
    common_norm: bool = False,
    cells: int | None = None,
) -> DataFrame:
    """Gaussian density with Scott bandwidth on an even grid, per group.

    Equal values are merged first, then each distinct value adds its weight to the
    fixed grid; those sums combine on the map side. For a column of very many distinct
    values ``cells`` first shares each value between the two nearest of that many even
    steps from the smallest to the largest one, so at most ``cells`` + 1 rows of a group meet
    the grid. The density is then off by at most (step / bandwidth)^2 / 8 of a kernel's peak.
    """
    key = F.lit("all") if by is None else q(by).cast("string")
    rows = df.select(key.alias("group"), q(column).cast("double").alias("value"))
    counts = value_counts_of(rows.filter(F.abs("value") != float("inf")), "value", ["group"])
    v, n = F.col("value"), F.col("n")
    basic = counts.groupBy("group").agg(
        F.sum(n).alias("m"),
        (F.sum(v * n) / F.sum(n)).alias("mean"),
        F.min(v).alias("lo"),
        F.max(v).alias("hi"),
    )
    squares = counts.join(basic, "group").groupBy("group", "m", "lo", "hi").agg(
        F.sum(n * F.pow(v - F.col("mean"), F.lit(2.0))).alias("ss")
    )
    sd = F.sqrt(F.try_divide(F.col("ss"), F.col("m") - 1.0))
    bw = F.pow(F.col("m").cast("double"), F.lit(-0.2)) * sd
    stats = (
        squares.filter(F.col("ss") > 0)
        .select("group", "m", bw.alias("bw"), "lo", "hi")
        .withColumn("start", F.col("lo") - cut * F.col("bw"))
        .withColumn("step", (F.col("hi") + cut * F.col("bw") - F.col("start")) / (grid - 1))
    )
    placed = counts.join(stats, "group")
    if cells is not None:
        width = (F.col("hi") - F.col("lo")) / cells
        cell = F.least(F.floor((v - F.col("lo")) / width), F.lit(cells - 1))
        over = (v - F.col("lo")) / width - cell
        shares = F.array(
            F.struct(cell.alias("cell"), (n * (1 - over)).alias("n")),
            F.struct((cell + 1).alias("cell"), (n * over).alias("n")),
        )
        facts = ["group", "m", "bw", "lo", "hi", "start", "step"]
        placed = (
            placed.select(*facts, F.inline(shares))
            .groupBy(*facts, "cell")
            .agg(F.sum("n").alias("n"))
            .withColumn("value", F.col("lo") + F.col("cell") * width)
        )
    points = placed.withColumn(
        "point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))
    )
    at = F.col("start") + F.col("point") * F.col("step")
    z = (at - v) / F.col("bw")
    weight = F.col("m") if not common_norm else counts.select(F.sum("n")).scalar()
    scale = weight * F.col("bw") * F.sqrt(2 * F.pi())
    return points.groupBy("group", "point").agg(
        F.max(at).alias("x"),
        F.sum(n * F.exp(-0.5 * z * z) / scale).alias("density"),
    )
