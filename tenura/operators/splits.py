"""Reproducible stratified splits and folds by hashing the key, and train-fitted encodings."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura import config
from tenura.functions.tables import materialize, q

HASH_BITS = 60


def key_hash(key: str, seed: int) -> Column:
    """The first 60 bits of md5(seed|key), as a number."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), q(key).cast("string")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def _fractions(shares: Sequence[float | Fraction]) -> list[Fraction]:
    """The running shares, as exact ratios; a float counts as the simple ratio it is nearest to."""
    exact = [Fraction(s).limit_denominator(1_000_000_000) for s in shares]
    ends = [sum(exact[: i + 1], Fraction(0)) for i in range(len(exact))]
    return [e / ends[-1] for e in ends[:-1]]


def assign_parts(
    df: DataFrame,
    names: Sequence,
    shares: Sequence[float | Fraction],
    out: str,
    key: str = config.KEY,
    stratum: str | None = config.LABEL,
    seed: int = config.SEED,
    mode: str = "approx",
) -> DataFrame:
    """Add a column naming the part each row falls in, by the hash of its key.

    ``approx`` cuts the hash range by the shares: a pure projection. ``exact`` finds, per
    stratum, the hash that gives the wanted row count; the table of cuts has a row per
    stratum, a null stratum included, and is joined to the rows.
    Rows with equal hashes, so also rows with equal keys, always share a part.
    """
    h = key_hash(key, seed)
    ends = _fractions(shares)

    def part_of(ranges: Sequence[Column]) -> Column:
        part = F.lit(names[-1])
        for name, inside in reversed(list(zip(names, ranges))):
            part = F.when(inside, F.lit(name)).otherwise(part)
        return part

    if mode == "approx":
        limits = [int(end * (1 << HASH_BITS)) for end in ends]
        return df.withColumn(out, part_of([h < limit for limit in limits]))
    if mode != "exact":
        raise ValueError("mode must be 'approx' or 'exact'")
    level = q(stratum) if stratum else F.lit("all")
    cuts = _exact_cuts(df.select(level.alias("s"), h.alias("h")), ends)
    hashed = df.select("*", level.alias("__s"), h.alias("__h"))
    joined = hashed.join(cuts, F.col("__s").eqNullSafe(F.col("s")), "left")
    ranges = [F.col("__h") <= F.col(f"cut{i}") for i in range(len(ends))]
    return joined.select(*[q(c) for c in df.columns], part_of(ranges).alias(out))


def _wanted_rows(sizes: DataFrame, ends: Sequence[Fraction]) -> DataFrame:
    """Rows up to each cut per stratum (s, rows, cut, goal): proportional in whole numbers, with
    the largest remainders topped up to the rounded-up total (ties by stratum)."""
    each = F.array(
        *[
            F.struct(
                F.lit(i).alias("cut"), F.lit(e.numerator).alias("num"), F.lit(e.denominator).alias("den")
            )
            for i, e in enumerate(ends)
        ]
    )
    wide = "decimal(38,0)"
    rows = sizes.crossJoin(sizes.agg(F.sum("n").alias("whole"))).select("s", "n", "whole", F.inline(each))
    rows = rows.withColumn("wanted", F.expr(f"(cast(whole as {wide}) * num + den - 1) div den"))
    rows = rows.withColumns(
        {
            "base": F.expr(f"(cast(n as {wide}) * wanted) div whole"),
            "rest": F.expr(f"(cast(n as {wide}) * wanted) % whole"),
        }
    )
    # one row per stratum and cut
    by_rest = Window.partitionBy("cut").orderBy(F.desc("rest"), F.col("s").cast("string"))
    missing = F.col("wanted") - F.sum("base").over(Window.partitionBy("cut"))
    top_up = F.when(F.row_number().over(by_rest) <= missing, 1).otherwise(0)
    return rows.select("s", F.col("n").alias("rows"), "cut", (F.col("base") + top_up).cast("long").alias("goal"))


def _exact_cuts(hashed: DataFrame, ends: Sequence[Fraction], spread: float = 8.0) -> DataFrame:
    """Per stratum ``s`` the hash (``cut0``, ``cut1``, ...) at which each running share of its rows is reached.

    Hashes are uniform, so a cut lies within a few standard deviations (``spread``) of its expected place. One pass counts
    the rows below that bracket and the different hashes inside it, some sixteen times the square root of the rows; where a cut
    turns out to lie outside, the bracket is widened and the pass repeated. The input is evaluated once.
    """
    hashed = materialize(hashed)
    sizes = hashed.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    goals = materialize(_wanted_rows(sizes, ends).filter(F.col("goal") > 0))
    found, whole = None, float(1 << HASH_BITS)
    while True:
        share = F.col("goal") / F.col("rows")
        half = F.lit(spread) * (F.sqrt(share * (1 - share) / F.col("rows")) + 1 / F.col("rows"))
        brackets = goals.select(
            F.col("s").alias("s0"), "cut", "goal",
            F.floor(F.greatest(F.lit(0.0), share - half) * whole).alias("low"),
            F.ceil(F.least(F.lit(1.0), share + half) * whole).alias("high"),
        )
        at = hashed.join(brackets, F.col("s").eqNullSafe(F.col("s0"))).filter(F.col("h") <= F.col("high"))
        place = F.when(F.col("h") >= F.col("low"), F.col("h")).otherwise(F.lit(-1))
        counts = at.groupBy("s0", "cut", "goal", place.alias("place")).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("s0", "cut").orderBy("place"))
        reached = counts.withColumn("upto", upto).filter(
            (F.col("upto") >= F.col("goal")) & (F.col("upto") - F.col("n") < F.col("goal")))
        hits = reached.select("s0", F.col("cut").alias("cut0"), "place")
        same = F.col("s").eqNullSafe(F.col("s0")) & (F.col("cut") == F.col("cut0"))
        looked = materialize(goals.join(hits, same, "left").select("s", "cut", "goal", "rows", "place"))
        inside = looked.filter(F.col("place") >= 0)  # -1: below the bracket, null: above it
        found = inside if found is None else found.unionByName(inside)
        goals = looked.filter(F.coalesce(F.col("place"), F.lit(-1)) < 0).drop("place")
        if goals.isEmpty():
            break
        spread *= 16
    cuts = [F.max(F.when(F.col("cut") == i, F.col("place"))).alias(f"cut{i}") for i in range(len(ends))]
    return found.groupBy("s").agg(*cuts)


def train_test_split(
    df: DataFrame,
    test_share: float = config.TEST_SHARE,
    key: str = config.KEY,
    stratum: str | None = config.LABEL,
    seed: int = config.SEED,
    mode: str = "approx",
) -> DataFrame:
    """Add ``split``: 'test' for the given share of each stratum, else 'train'."""
    shares = [test_share, 1 - test_share]
    return assign_parts(df, ["test", "train"], shares, "split", key, stratum, seed, mode)


def assign_folds(
    df: DataFrame,
    folds: int = config.FOLDS,
    key: str = config.KEY,
    stratum: str | None = config.LABEL,
    seed: int = config.SEED + 1,
    mode: str = "approx",
) -> DataFrame:
    """Add ``fold`` 0 … folds-1, independent of the train/test hash."""
    return assign_parts(
        df, list(range(folds)), [Fraction(1, folds)] * folds, "fold", key, stratum, seed, mode
    )


def overlap(left: DataFrame, right: DataFrame, key: str = config.KEY) -> DataFrame:
    """Keys of the left table that occur in the right one."""
    return left.join(right.select(q(key)), key, "left_semi")


def uncovered(whole: DataFrame, parts: DataFrame, key: str = config.KEY) -> DataFrame:
    """Keys of the whole table that no part holds."""
    return whole.join(parts.select(q(key)), key, "left_anti")


def category_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of each category among non-null rows."""
    counted = df.filter(q(column).isNotNull()).groupBy(q(column)).agg(
        F.count(F.lit(1)).alias("n")
    )
    whole = counted.select(F.sum("n")).scalar()
    return counted.select(q(column), "n", (F.col("n") / whole).alias("share"))


def frequency_encode(
    df: DataFrame, column: str = "Contract", split: str = "split", train: str = "train"
) -> DataFrame:
    """Replace a category by its share among the training rows; unseen ones become null."""
    shares = category_shares(df.filter(q(split) == train), column)
    return apply_shares(df, shares, column)


def apply_shares(df: DataFrame, shares: DataFrame, column: str) -> DataFrame:
    """Left join of fitted shares, in place of the category; the join is left to the planner."""
    fitted = shares.select(q(column).alias("__category"), F.col("share").alias("__share"))
    joined = df.join(fitted, q(column) == F.col("__category"), "left")
    return joined.select(
        *[F.col("__share").alias(column) if c == column else q(c) for c in df.columns]
    )
