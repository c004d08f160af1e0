import pytest
from conftest import ACCOUNTS, rows_of

from tenura import config
from tenura.operators import models
from tenura.plans import churn
from tenura.sources import accounts, runs
from tenura.streaming import scoring


def test_csv_folder_round_trip(spark, raw, tmp_path):
    path = str(tmp_path / "csv")
    accounts.write_table(raw, path, "csv")
    back = accounts.read_accounts(spark, path)
    assert back.schema == config.RAW_SCHEMA
    assert sorted(rows_of(back)) == sorted(rows_of(raw))


def test_bad_csv_is_refused(spark, tmp_path):
    (tmp_path / "bad.csv").write_text(
        ",".join(config.RAW_SCHEMA.fieldNames()) + "\n" + ",".join(["x"] * 21) + "\n"
    )
    with pytest.raises(Exception):
        accounts.read_accounts(spark, str(tmp_path)).collect()


def test_missing_tables_are_a_clear_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        accounts.read_table(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        accounts.read_results(spark, str(tmp_path / "none"))


def test_results_round_trip(spark, tmp_path):
    path = str(tmp_path / "results")
    board = spark.createDataFrame([("m", 0.5, 0.25)], "Model string, F1 double, `ROC-AUC` double")
    accounts.write_results(board, path)
    assert rows_of(accounts.read_results(spark, path)) == rows_of(board)


def test_processed_table_keeps_names(spark, featured, tmp_path):
    path = str(tmp_path / "processed")
    accounts.write_table(featured, path)
    assert accounts.read_table(spark, path).columns == featured.columns
    accounts.write_table(featured, path + "-csv", "csv")
    assert accounts.read_table(spark, path + "-csv", "csv").columns == featured.columns


def test_preview_and_types(raw):
    assert accounts.preview(raw).count() == 5
    assert [r["customerID"] for r in accounts.first_by_key(raw, 2).collect()] == ["A-01", "A-02"]
    types = accounts.column_types(raw).collect()
    assert len(types) == 21 and types[2]["type"] == "int"


def test_table_from_columns(spark):
    data = {n: [a[n] for a in ACCOUNTS] for n in config.RAW_SCHEMA.fieldNames()}
    assert accounts.from_columns(spark, data, config.RAW_SCHEMA).count() == len(ACCOUNTS)


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    board = spark.createDataFrame([("m", 0.5)], "Model string, F1 double")
    for run in ("one", "two"):
        runs.append_runs(runs.run_rows(board, {"m": {"note": "x" * 400}}, run), path)
    log = runs.read_runs(spark, path)
    assert log.count() == 6 and log.select("run_id").distinct().count() == 2
    assert max(len(r["value"]) for r in log.collect()) == 250


def test_run_logged_again_is_one_run(spark, tmp_path):
    path = str(tmp_path / "runs")
    for score, run in ((0.5, "one"), (0.6, "two"), (0.7, "one")):
        board = spark.createDataFrame([("m", score)], "Model string, F1 double")
        runs.append_runs(runs.run_rows(board, {"m": {"a": 1}}, run), path)
    log = runs.read_runs(spark, path)
    assert log.columns == ["experiment", "run_id", "model", "kind", "key", "value"]
    assert {(r["run_id"], r["value"]) for r in log.filter("kind = 'metric'").collect()} == {("one", "0.7"), ("two", "0.6")}
    assert log.count() == 6
    with pytest.raises(ValueError, match="already logged: two"):
        runs.append_runs(runs.run_rows(board, {"m": {}}, "two"), path, replace=False)
    runs.append_runs(runs.run_rows(board, {"m": {}}, "3"), path, replace=False)
    assert {r["run_id"] for r in runs.read_runs(spark, path).collect()} == {"one", "two", "3"}


def test_stream_scores_like_a_batch(spark, raw, encoded, tmp_path):
    from pyspark.sql import functions as F

    from tenura.operators import features, splits

    means = features.loyalty_means(encoded)
    shares = {r["Contract"]: r["share"] for r in splits.category_shares(raw, "Contract").collect()}
    table = splits.apply_shares(
        features.add_engineered_features(encoded, means), splits.category_shares(raw, "Contract"), "Contract"
    ).withColumn("label", F.col("Churn"))
    weighted = models.add_weights(table)
    chain = models.churn_chain(config.SELECTED_FEATURES, "Logistic Regression", {"C": 1}, 12.0).fit(weighted)
    want = {r["customerID"]: r["probability"] for r in models.score(chain, table).collect()}

    folder = str(tmp_path / "in")
    accounts.write_table(raw, folder, "csv")
    stream = scoring.score_stream(scoring.stream_accounts(spark, folder), means, shares, chain)
    query = stream.writeStream.format("memory").queryName("scores").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    got = {r["customerID"]: r["probability"] for r in spark.table("scores").collect()}
    assert got == pytest.approx(want)
    assert churn.risk_view(features.add_engineered_features(encoded)).count() >= 1


def test_csv_columns_go_by_name(spark, raw, tmp_path):
    """A file whose header is in another order loads the same; a second, differing header is an error."""
    names = list(reversed(raw.columns))
    raw.select(names).coalesce(1).write.option("header", True).csv(str(tmp_path / "turned"))
    got = accounts.read_accounts(spark, str(tmp_path / "turned"))
    assert got.schema == config.RAW_SCHEMA or got.columns == raw.columns
    assert got.filter("customerID = 'A-02'").first()["Partner"] == "Yes"
    assert got.filter("customerID = 'A-02'").first()["Dependents"] == "Yes"
    assert got.select("customerID", "Partner", "Dependents", "MonthlyCharges").exceptAll(
        raw.select("customerID", "Partner", "Dependents", "MonthlyCharges")).count() == 0
    raw.coalesce(1).write.option("header", True).csv(str(tmp_path / "other"))
    folder = tmp_path / "mixed"
    folder.mkdir()
    for i, name in enumerate(("turned", "other")):
        part = next((tmp_path / name).glob("*.csv"))
        (folder / f"{i}.csv").write_text(part.read_text())
    with pytest.raises(Exception, match="(?i)header|column"):
        accounts.read_accounts(spark, str(folder)).collect()
    with pytest.raises(ValueError, match="no column Churn"):
        raw.drop("Churn").coalesce(1).write.option("header", True).csv(str(tmp_path / "short"))
        accounts.read_accounts(spark, str(tmp_path / "short"))
