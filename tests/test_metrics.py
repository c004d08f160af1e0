import pytest
from pyspark.sql import functions as F
from conftest import rows_of

from tenura.operators import metrics

# (true positives, false positives, false negatives, true negatives) of four published models
PUBLISHED = {
    (293, 277, 81, 758): (0.7459, 0.5140, 0.7834, 0.6208),
    (286, 255, 88, 780): (0.7566, 0.5287, 0.7647, 0.6251),
    (295, 280, 79, 755): (0.7452, 0.5130, 0.7888, 0.6217),
    (292, 258, 82, 777): (0.7587, 0.5309, 0.7807, 0.6320),
}


def scored(spark, labels, predictions, charges, probabilities=None):
    rows = list(zip(labels, predictions, charges, probabilities or [float(p) for p in predictions]))
    return spark.createDataFrame(
        rows, "label int, prediction int, MonthlyCharges double, probability double"
    )


@pytest.mark.parametrize("cells,want", PUBLISHED.items())
def test_published_quality(spark, cells, want):
    df = spark.createDataFrame([cells], "tp int, fp int, fn int, tn int")
    got = metrics.from_confusion(df).first()
    assert [round(x, 4) for x in got] == list(want)


def test_revenue_of_a_known_case(spark):
    df = scored(spark, [1, 1, 0, 0, 1], [1, 0, 0, 1, 1], [80.0, 60.0, 40.0, 50.0, 100.0])
    assert rows_of(metrics.business_value(df)) == [(2160.0, 720.0)]
    assert rows_of(metrics.confusion(df)) == [(1, 1, 1, 2)]


def test_no_caught_churner_saves_nothing(spark):
    df = scored(spark, [0, 0, 1], [0, 0, 0], [50.0, 60.0, 70.0])
    assert metrics.business_value(df).first()["Revenue_Saved"] == 0.0


def test_single_class_has_zeros(spark):
    df = scored(spark, [0, 0], [0, 0], [1.0, 1.0])
    assert tuple(metrics.from_confusion(metrics.confusion(df)).first()) == (1.0, 0.0, 0.0, 0.0)


def test_scoreboard_agrees_with_its_parts(spark):
    import random

    random.seed(3)
    rows = [
        (m, int(random.random() < 0.4), int(random.random() < 0.5), random.choice([10.5, 20.0, None]), round(random.random(), 1))
        for m in "ab" for _ in range(200)
    ]
    df = spark.createDataFrame(rows, "Model string, label int, prediction int, MonthlyCharges double, probability double").cache()
    from tenura.operators.ordered import roc_auc

    board = {r["Model"]: r for r in metrics.scoreboard(df).collect()}
    small = {r["Model"]: r for r in metrics.scoreboard(df, rows_per_bucket=3).collect()}
    quality = {r["Model"]: r for r in metrics.from_confusion(metrics.confusion(df, ["Model"]), ["Model"]).collect()}
    money = {r["Model"]: r for r in metrics.business_value(df, ["Model"]).collect()}
    area = {r["Model"]: r["roc_auc"] for r in roc_auc(df, "probability", "label", ["Model"]).collect()}
    for m in "ab":
        assert board[m] == small[m]
        for c in ("Accuracy", "Precision", "Recall", "F1"):
            assert board[m][c] == pytest.approx(quality[m][c])
        for c in metrics.BUSINESS:
            assert board[m][c] == pytest.approx(money[m][c])
        assert board[m]["ROC-AUC"] == pytest.approx(area[m])


def test_threshold_is_inclusive(spark):
    from tenura.functions.tables import q

    df = spark.createDataFrame([(0.55,), (0.5499,)], "p double")
    assert [r[0] for r in df.select(metrics.at_threshold(q("p"))).collect()] == [1, 0]


def test_long_and_wide_forms(spark):
    df = spark.createDataFrame(
        [("x", 0.1, 0.2, 0.3, 0.4, 0.5, 6.0, 7.0)],
        "Model string, Accuracy double, Precision double, Recall double, F1 double, `ROC-AUC` double, Revenue_Saved double, Revenue_Leakage double",
    )
    long = metrics.metrics_long(df)
    assert long.count() == 7
    assert rows_of(metrics.metrics_wide(long)) == rows_of(df)


def test_scorecard_and_best(spark):
    df = spark.createDataFrame(
        [("b", 0.9, 0.7), ("a", 0.8, 0.7), ("c", 0.9, 0.6)], "Model string, F1 double, `ROC-AUC` double"
    )
    card = metrics.scorecard(df).collect()
    assert [r["Model"] for r in card] == ["a", "b", "c"]
    assert [r["best_F1"] for r in card] == [False, True, True]
    assert card[0]["text_F1"] == "0.8000"
    assert metrics.best_model(df).first()["Model"] == "a"
    assert [r["Model"] for r in metrics.scorecard(df, "F1").collect()] == ["b", "c", "a"]


def test_spread_is_over_the_population(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "F1 double")
    assert rows_of(metrics.mean_and_spread(df, ["F1"])) == [(2.0, 1.0)]


def test_missing_labels_and_predictions(spark):
    rows = [(None, 1, 0.9, 10.0), (0, 1, 0.8, 10.0), (1, 1, 0.7, 20.0), (1, None, 0.6, 30.0), (0, 0, 0.1, 5.0)]
    df = spark.createDataFrame(rows, "label int, prediction int, probability double, MonthlyCharges double")
    df = df.withColumn("Model", F.lit("m"))
    board = metrics.scoreboard(df).first()
    cells = metrics.from_confusion(metrics.confusion(df)).first()
    for name in ("Accuracy", "Precision", "Recall", "F1"):
        assert board[name] == pytest.approx(cells[name])
    assert board["Accuracy"] == pytest.approx(2 / 3) and board["Revenue_Leakage"] == 0.0
    assert board["ROC-AUC"] == pytest.approx(0.5)
