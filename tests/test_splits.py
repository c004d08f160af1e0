import random
from fractions import Fraction

import pytest
from conftest import by_key
from pyspark.sql import functions as F

from tenura.functions.tables import q
from tenura.operators import splits


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(5000).select(
        F.concat(F.lit("C-"), F.col("id")).alias("customerID"),
        (F.col("id") % 4 == 0).cast("int").alias("Churn"),
        F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("Contract"),
    ).cache()


@pytest.mark.parametrize("mode", ["approx", "exact"])
def test_split_is_disjoint_complete_and_repeatable(people, mode):
    parts = splits.train_test_split(people, 0.3, mode=mode).cache()
    train, test = (parts.filter(q("split") == s) for s in ("train", "test"))
    assert splits.overlap(train, test).count() == 0
    assert splits.uncovered(people, parts).count() == 0
    assert parts.count() == people.count() == train.count() + test.count()
    again = splits.train_test_split(people, 0.3, mode=mode)
    assert by_key(again, "customerID", "split") == by_key(parts, "customerID", "split")
    assert train.columns == test.columns


def test_exact_split_sizes(people):
    parts = splits.train_test_split(people, 0.2, mode="exact")
    sizes = {(r["Churn"], r["split"]): r["count"] for r in parts.groupBy("Churn", "split").count().collect()}
    assert sizes == {(0, "test"): 750, (1, "test"): 250, (0, "train"): 3000, (1, "train"): 1000}


def test_exact_sizes_follow_the_largest_remainder(spark):
    sizes = spark.createDataFrame([("0", 5174), ("1", 1869)], "s string, n bigint")
    wanted = splits._wanted_rows(sizes, [Fraction(1, 5)])
    assert by_key(wanted, "s", "goal") == {"0": 1035, "1": 374}


@pytest.mark.parametrize("mode,slack", [("approx", 120), ("exact", 1)])
def test_folds_are_balanced(people, mode, slack):
    folds = splits.assign_folds(people, mode=mode)
    sizes = by_key(folds.groupBy("fold").count(), "fold", "count")
    assert set(sizes) == set(range(5)) and sum(sizes.values()) == 5000
    assert all(abs(n - 1000) <= slack for n in sizes.values())


def test_folds_are_independent_of_the_split(people):
    both = splits.assign_folds(splits.train_test_split(people))
    sizes = by_key(both.filter("split = 'test'").groupBy("fold").count(), "fold", "count")
    assert len(sizes) == 5 and min(sizes.values()) > 140


def test_exact_mode_matches_a_sort(people):
    rows = people.select("customerID", "Churn", splits.key_hash("customerID", 42).alias("h")).collect()
    want = set()
    for label, size in ((0, 750), (1, 250)):
        ordered = sorted((r["h"], r["customerID"]) for r in rows if r["Churn"] == label)
        want |= {k for _, k in ordered[:size]}
    parts = splits.train_test_split(people, 0.2, mode="exact")
    assert {r["customerID"] for r in parts.filter("split = 'test'").collect()} == want


def test_empty_and_null_strata(spark):
    empty = spark.createDataFrame([], "customerID string, Churn int")
    assert splits.train_test_split(empty, mode="exact").count() == 0
    odd = spark.createDataFrame([(str(i), None) for i in range(10)], "customerID string, Churn int")
    assert splits.train_test_split(odd, mode="exact").filter("split = 'test'").count() == 2


def test_equal_keys_share_a_part(spark):
    df = spark.createDataFrame([("A", 0), ("A", 0), ("B", 0), ("B", 0)], "customerID string, Churn int")
    parts = splits.assign_folds(df, mode="exact")
    assert parts.groupBy("customerID").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0


def test_frequencies_come_from_train_only(people):
    parts = splits.train_test_split(people)
    train = parts.filter("split = 'train'")
    share = train.filter("Contract = 'rare'").count() / train.count()
    encoded = splits.frequency_encode(parts)
    got = {round(r[0], 9) for r in encoded.filter("split = 'test'").select("Contract").distinct().collect()}
    assert got == {round(share, 9), round(1 - share, 9)}


def test_unseen_category_is_null(spark):
    df = spark.createDataFrame([("a", "train"), ("b", "test"), (None, "test")], "Contract string, split string")
    got = [r["Contract"] for r in splits.frequency_encode(df).collect()]
    assert sorted(got, key=str) == [1.0, None, None]


def test_exact_shares_are_ratios(spark):
    df = spark.range(3_000_000).select(F.col("id").cast("string").alias("customerID"), F.lit(1).alias("Churn"))
    parts = splits.assign_parts(df, ["a", "b", "c"], [1 / 3] * 3, "part", mode="exact")
    assert {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()} == {"a": 1_000_000, "b": 1_000_000, "c": 1_000_000}


def test_missing_and_empty_strata_are_two(spark):
    rows = [(f"K{i}", None if i < 10 else "" if i < 20 else "x") for i in range(60)]
    df = spark.createDataFrame(rows, "customerID string, Churn string")
    parts = splits.train_test_split(df, 0.2, mode="exact")
    found = {r["Churn"]: r["n"] for r in parts.filter("split = 'test'").groupBy("Churn").agg(F.count("*").alias("n")).collect()}
    assert found == {None: 2, "": 2, "x": 8}
    assert parts.count() == 60 and splits.train_test_split(df.limit(0), mode="exact").count() == 0


@pytest.mark.parametrize("spread", [0.0, 0.001, 8.0])
def test_cuts_outside_their_bracket(spark, spread):
    """Narrow brackets miss the cuts, below and above; wider ones find the same."""
    rows = [(s, h << 50) for s, n in (("a", 301), ("b", 7), (None, 40), ("c", 1)) for h in random.Random(n).sample(range(1000), n)]
    rows += [("skewed", 5 + i) for i in range(50)]  # far from uniform
    df = spark.createDataFrame(rows, "s string, h bigint")
    ends = [Fraction(1, 5), Fraction(1, 2), Fraction(9, 10)]
    goals = {(r["s"], r["cut"]): r["goal"] for r in splits._wanted_rows(df.groupBy("s").agg(F.count("*").alias("n")), ends).collect()}
    for r in splits._exact_cuts(df, ends, max(spread, 1e-9)).collect():
        mine = sorted(h for s, h in rows if s == r["s"])
        for i in range(3):
            goal = goals[r["s"], i]
            assert r[f"cut{i}"] == (mine[goal - 1] if goal else None)
