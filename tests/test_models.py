import math

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tenura import config
from tenura.functions.tables import q
from tenura.operators import metrics, models, selection
from tenura.plans import churn
from tenura.registry import inputs
from tenura.sources import runs

SF = "/root/testdata/sf0.001"
SMALL = {
    "Logistic Regression": {"C": [0.1, 1]},
    "Decision Tree": {"max_depth": [2], "min_split": [2]},
    "Random Forest": {"trees": [5], "max_depth": [3], "min_split": [2]},
    "Boosted Trees": {"trees": [3], "max_depth": [2], "learning_rate": [0.1], "subsample": [1.0], "column_share": [1.0]},
    "Leaf-Limited Boosted Trees": {"trees": [3], "learning_rate": [0.1], "leaves": [4], "max_depth": [-1]},
}


@pytest.fixture(scope="module")
def table(spark):
    return churn.model_table(inputs.featured(spark, SF), mode="exact").cache()


@pytest.fixture(scope="module")
def ready(table):
    return models.prepare(table, config.SELECTED_FEATURES, ["MonthlyCharges"]).cache()


def test_features_are_numeric_and_complete(table):
    types = dict(table.dtypes)
    names = churn.feature_columns(table)
    assert all(types[c] in ("int", "tinyint", "double", "bigint") for c in names)
    bad = table.select([F.count_if(q(c).isNull() | F.isnan(q(c).cast("double"))).alias(c) for c in names])
    assert set(bad.first()) == {0}


def test_raw_to_predictions(ready):
    train, test = ready.filter("split = 'train'"), ready.filter("split = 'test'")
    scored = models.score(models.fit(train, "Logistic Regression", {"C": 1}), test).collect()
    assert scored and all(r["prediction"] in (0, 1) and 0 <= r["probability"] <= 1 for r in scored)


def test_logistic_penalty_scale(spark):
    """At C the gradient of the weighted loss plus half the squared norm over C vanishes."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2)) * [1.0, 5.0]
    y = (x[:, 0] + 0.2 * x[:, 1] + rng.normal(size=200) > 0.5).astype(int)
    df = spark.createDataFrame([(int(b), float(a[0]), float(a[1])) for a, b in zip(x, y)], "label int, x0 double, x1 double")
    ready = models.assemble(["x0", "x1"]).transform(df)
    model = models.fit(ready, "Logistic Regression", {"C": 0.1})
    w, b = model.coefficients.toArray(), model.intercept
    weight = np.where(y == 1, 200 / (2 * y.sum()), 200 / (2 * (200 - y.sum())))
    p = 1 / (1 + np.exp(-(x @ w + b)))
    gradient = x.T @ (weight * (p - y)) + w / 0.1
    assert np.abs(gradient).max() < 0.05


def test_grids_have_the_declared_sizes():
    sizes = [len(models.combinations_of(grid)) for _, grid in models.FAMILIES.values()]
    assert sizes == [4, 12, 12, 72, 24]


def test_search_evaluate_and_cross_validate(spark, ready):
    train, test = ready.filter("split = 'train'"), ready.filter("split = 'test'")
    best, results = models.grid_search_all(train, SMALL, folds=5)
    assert list(best) == list(SMALL) and len(results) == 6
    assert all(0 <= r["F1_mean"] <= 1 for r in results)
    lr = [r for r in results if r["model"] == "Logistic Regression"]
    assert best["Logistic Regression"]["C"] == [0.1, 1][max((0, 1), key=lambda i: (lr[i]["F1_mean"], -i))]
    board, fitted = models.evaluate_models(train, test, best)
    rows = {r["Model"]: r for r in board.collect()}
    assert set(rows) == set(SMALL) == set(fitted)
    for r in rows.values():
        assert all(math.isfinite(r[m]) for m in metrics.BUSINESS)
    assert models.params_table(spark, best).count() == sum(len(p) for p in best.values())
    assert models.search_table(spark, results).count() == 6
    cv = models.cross_validate_best(train, "Decision Tree", best["Decision Tree"]).first()
    assert 0 <= cv["F1_mean"] <= 1 and cv["ROC-AUC_std"] >= 0


def test_equal_settings_are_fitted_once(ready, monkeypatch):
    train = ready.filter("split = 'train'")
    grown = []
    whole = models.trees.grow
    monkeypatch.setattr(models.trees, "grow", lambda t, c, settings, *a: grown.extend(settings) or whole(t, c, settings, *a))
    grid = {"trees": [1, 2], "learning_rate": [0.1], "leaves": [4], "max_depth": [-1, 5, 1]}
    _, results = models.grid_search(train, "Leaf-Limited Boosted Trees", grid)
    # four leaves reach a depth of 3, so 5 is no limit; one round is the first of two
    assert len(grown) == 2 * config.FOLDS and len(results) == 6
    assert results[0]["F1_mean"] == results[1]["F1_mean"] and results[3]["F1_mean"] == results[4]["F1_mean"]
    grown.clear()
    _, results = models.grid_search(train, "Random Forest", {"trees": [2, 3], "max_depth": [2, 4], "min_split": [2, 9]})
    assert len(grown) == config.FOLDS and len(results) == 8


def test_fold_weights_by_hand(spark):
    rows = [(0, 0), (0, 0), (0, 1), (1, 0), (1, 1), (1, 1), (2, 0), (2, None)]
    df = spark.createDataFrame(rows, "fold int, label int")
    assert models.fold_weights(df, 3) == [{0: 4 / 4, 1: 4 / 4}, {0: 4 / 6, 1: 4 / 2}, {0: 6 / 6, 1: 6 / 6}]


def test_cross_validation_by_hand(ready):
    """Fold scores equal those of separate fits on each fold's complement."""
    train = ready.filter("split = 'train'").cache()
    params = {"C": 0.1}
    jobs = [("t", lambda total: models.logistic(params, total))]
    got = {r["fold"]: r["Accuracy"] for r in models.cross_validate(train, jobs).collect()}
    for fold in (0, 3):
        model = models.fit(train.filter(q("fold") != fold), "Logistic Regression", params)
        rows = models.score(model, train.filter(q("fold") == fold)).collect()
        assert got[fold] == pytest.approx(sum(r["label"] == r["prediction"] for r in rows) / len(rows))


@pytest.mark.parametrize("threshold", [None, 0.3])
def test_grown_cross_validation_by_hand(ready, threshold):
    """The same for grown trees: each fold's own model scores the rows that it has not seen."""
    train = ready.filter("split = 'train'").cache()
    params = {"max_depth": 2, "min_split": 2}
    got = {r["fold"]: r for r in models.cross_validate_params(train, "Decision Tree", params, threshold=threshold).collect()}
    rows = models.bin_rows(train)
    for fold in (0, 3):
        model = models.trees.grow(rows.table, rows.cuts, [rows.setting("Decision Tree", params, fold)])[0]
        held = models.score(model, train.filter(q("fold") == fold), threshold).collect()
        assert got[fold]["Accuracy"] == pytest.approx(sum(r["label"] == r["prediction"] for r in held) / len(held))
        by_rule = [r["probability"] >= threshold if threshold else r["probability"] > 0.5 for r in held]
        assert by_rule == [r["prediction"] == 1 for r in held]


def test_class_weights_of_the_families(ready):
    """Balanced weights of a fold's complement; the class ratio of all training rows for the depth-limited boosting."""
    train = ready.filter("split = 'train'").cache()
    rows = models.bin_rows(train)
    labels = [r["label"] for r in train.collect()]
    assert rows.ratio == pytest.approx(labels.count(0) / labels.count(1))
    boost = rows.setting("Boosted Trees", models.combinations_of(models.FAMILIES["Boosted Trees"][1])[0], 1)
    assert boost.weights == (1.0, rows.ratio) and boost.left_out == 1 and boost.l2 == 1.0
    leaf = rows.setting("Leaf-Limited Boosted Trees", {"trees": 3, "leaves": 31, "max_depth": -1, "learning_rate": 0.1}, 1)
    assert leaf.weights == (rows.by_fold[1][0], rows.by_fold[1][1]) and (leaf.leaves, leaf.min_leaf) == (31, 20)


def test_partial_rescoring_is_full_rescoring(spark, ready):
    """Shuffled columns scored through the kept votes, against scoring every changed row anew."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    train, test = ready.filter("split = 'train'"), ready.filter("split = 'test'")
    for family, params in (("Random Forest", {"trees": 9, "max_depth": 6}),
                           ("Boosted Trees", {"trees": 4, "max_depth": 3, "learning_rate": 0.3, "subsample": 1.0, "column_share": 1.0})):
        model = models.fit(train, family, params)
        rows = test.select(config.KEY, "label", vector_to_array("features").alias("own"))
        shuffled = selection.shuffled(rows, "own", 2).withColumn("id", F.monotonically_increasing_id()).cache()
        got = {(r["id"], r["slot"]): r["probability"]
               for r in models.trees.rescored(shuffled.select("id", "own", "donor"), model, ["id"]).collect()}
        copies = shuffled.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(len(config.SELECTED_FEATURES) - 1))))
        swapped = copies.select("id", "slot", array_to_vector(F.transform(
            "own", lambda x, i: F.when(i == F.col("slot"), F.col("donor")[i]).otherwise(x))).alias("features"))
        want = {(r["id"], r["slot"]): r["probability"] for r in models.score(model, swapped).collect()}
        assert got == want


def test_components(table, spark):
    features = ["tenure", "MonthlyCharges", "Contract", config.ADDON_TOTAL]
    _, rotation, scaled = selection.fit_components(table, features)
    x = np.array([[float(v) for v in r] for r in table.select(*[q(c) for c in features]).collect()])
    want = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1] / len(features) * 100
    variance = selection.explained_variance(spark, rotation)
    assert [r["variance_pct"] for r in variance.orderBy("component").collect()] == pytest.approx(want.tolist())
    cumulative = np.cumsum(want)
    needed = selection.components_for(variance, 80.0).first()["components"]
    assert needed == int(np.argmax(cumulative >= 80) + 1)
    points = selection.projection(scaled, rotation)
    assert points.count() == table.count() and points.columns[-2:] == ["pc1", "pc2"]
    assert points.agg(F.var_samp("pc1")).first()[0] == pytest.approx(want[0] * len(features) / 100)
    assert selection.loadings(spark, rotation, features, 2).count() == 8


def test_permutation_keeps_every_value_and_ranks_the_signal(spark):
    rows = [(f"K{i}", i % 2, float(i % 2), float((i * 7) % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "customerID string, Churn int, signal double, noise double")
    ready = models.prepare(df, ["signal", "noise"]).cache()
    model = models.fit(ready, "Decision Tree", {"max_depth": 3, "min_split": 2})
    for per_cycle in (200_000, 50):
        got = {
            r["feature"]: r
            for r in selection.permutation_importance(model, ready, ["signal", "noise"], 5, rows_per_cycle=per_cycle).collect()
        }
        assert got["signal"]["importance"] > 0.3 and got["signal"]["tier"] == "strong"
        assert got["noise"]["importance"] == 0.0 and got["noise"]["tier"] == "weak"


def test_tiers_and_kept_features(spark):
    df = spark.createDataFrame([("a", 0.01), ("b", 0.005), ("c", 0.0), ("d", -0.1), ("e", 0.2)], "feature string, importance double")
    tiered = df.withColumn("tier", selection.tier(q("importance")))
    assert dict(rows_of(tiered.select("feature", "tier"))) == {
        "a": "strong", "b": "moderate", "c": "weak", "d": "weak", "e": "strong",
    }
    assert selection.kept_features(tiered) == ["e", "a", "b"]


def test_subset_comparison(table):
    train = table.filter("split = 'train'")
    params = {"trees": 5, "max_depth": 3}
    got = selection.compare_subsets(train, {"one": ["tenure"], "two": ["tenure", "Contract"]}, params=params)
    assert {r["candidate"] for r in got.collect()} == {"one", "two"}


def test_whole_run_is_saved(spark, tmp_path):
    raw = inputs.raw(spark, SF).cache()
    result = churn.run(raw, {"Decision Tree": SMALL["Decision Tree"]}, {"trees": 5, "max_depth": 3}, repeats=2, mode="exact")
    churn.save(result, str(tmp_path / "out"), "run-1")
    assert result.validation.filter("check = 'critical'").count() == len(config.CRITICAL)
    assert result.validation.select("check").distinct().count() == 9
    assert result.views["tenure_churn"].count() == 3 and len(result.views) == 35
    assert set(result.correlated) <= set(churn.feature_columns(result.featured)) and result.spearman_features
    assert result.variance.count() == 26 and result.loadings.count() % 26 == 0
    assert {r["candidate"] for r in result.subsets.collect()} == {"spearman", "permutation"}
    from tenura.sources import accounts

    assert accounts.read_table(spark, str(tmp_path / "out/processed")).count() == raw.count()
    back = accounts.read_results(spark, str(tmp_path / "out/model_results"))
    assert back.columns == ["Model", *metrics.STANDARD, *metrics.BUSINESS]
    log = runs.read_runs(spark, str(tmp_path / "out/runs"))
    assert log.filter("kind = 'metric'").count() == 7
    assert {r["kind"] for r in log.select("kind").distinct().collect()} == {"metric", "param", "tag"}
    again = runs.load_model(models.trees.Model, str(tmp_path / "out/models/Decision_Tree"))
    assert again.nodes["depth"].max() <= 2 and again.setting.max_depth == 2
    logged = {r["key"] for r in log.filter("kind = 'param'").collect()}
    assert {"max_depth", "min_split", "l2", "weights", "seed"} <= logged


def test_queries_search_the_declared_settings_each_time(spark, monkeypatch):
    """All 124 settings with their declared rounds; what one query has found is not taken over by another."""
    from tenura.registry import learned

    declared = [p for _, grid in models.FAMILIES.values() for p in models.combinations_of(grid)]
    assert [p for grid in learned.GRIDS.values() for p in models.combinations_of(grid)] == declared and len(declared) == 124
    assert {p["trees"] for p in declared if "learning_rate" in p} == {200, 300}
    fits, search = [], models.search_cells
    monkeypatch.setattr(models, "search_cells", lambda *given: fits.append(list(given[1])) or search(*given))
    monkeypatch.setitem(learned.GRIDS, "Random Forest", {"trees": [2, 3], "max_depth": [3], "min_split": [2]})
    found = [learned.forest_grid_search(spark, SF).collect() for _ in range(2)]
    assert fits == [["Random Forest"]] * 2 and found[0] == found[1]
