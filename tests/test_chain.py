"""The chain from raw accounts to scores: against the steps one by one, saved, and loaded by another process."""

import json
import os
import subprocess
import sys
import textwrap

import pytest
from conftest import ACCOUNTS, account, to_table
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tenura import config
from tenura.functions.tables import q
from tenura.operators import chain, cleaning, features, models, splits
from tenura.sources import accounts, runs

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def fitted(raw):
    return chain.raw_chain(config.SELECTED_FEATURES, {"C": 1}, len(ACCOUNTS)).fit(raw)


def scores(df):
    return {r[config.KEY]: (r["probability"], r["prediction"]) for r in df.collect()}


def test_equals_the_steps_one_by_one(raw, fitted):
    encoded = features.encode(cleaning.clean(raw))
    built = features.add_engineered_features(encoded, features.loyalty_means(encoded), on_zero="null").withColumn(
        config.COST_PER_SERVICE, F.coalesce(q(config.COST_PER_SERVICE), F.lit(0.0)))
    table = splits.apply_shares(built, splits.category_shares(raw, "Contract"), "Contract").withColumn("label", q("Churn"))
    model = models.churn_chain(config.SELECTED_FEATURES, "Logistic Regression", {"C": 1}, float(len(ACCOUNTS))).fit(
        models.add_weights(table))
    want = {r[config.KEY]: r["probability"] for r in models.score(model, table).collect()}
    got = scores(chain.score_raw(fitted, raw))
    assert {k: p for k, (p, _) in got.items()} == pytest.approx(want)
    assert all(c == (p >= config.DECISION_THRESHOLD) for p, c in got.values())


def test_another_process_scores_csv_files_alike(spark, raw, fitted, tmp_path):
    """Saved here, loaded by a new Python process with its own session."""
    runs.save_model(fitted, str(tmp_path / "chain"))
    accounts.write_table(raw, str(tmp_path / "csv"), "csv")
    script = textwrap.dedent(f"""
        import json, sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.ml import PipelineModel
        from pyspark.sql import SparkSession
        from tenura.operators import chain
        from tenura.sources import accounts
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        loaded = PipelineModel.load({str(tmp_path / "chain")!r})
        rows = chain.score_raw(loaded, accounts.read_accounts(spark, {str(tmp_path / "csv")!r})).collect()
        print("SCORES" + json.dumps({{r["customerID"]: [r["probability"], r["prediction"]] for r in rows}}))
    """)
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300, cwd=str(tmp_path))
    got = json.loads(out.stdout.split("SCORES")[1])
    assert got == {k: list(v) for k, v in scores(chain.score_raw(fitted, raw)).items()}
    for a, b in zip(PipelineModel.load(str(tmp_path / "chain")).stages, fitted.stages):
        assert type(a) is type(b) and {p.name: v for p, v in a.extractParamMap().items()} == {
            p.name: v for p, v in b.extractParamMap().items()}


def test_learns_from_the_rows_it_is_fitted_on(raw, fitted):
    steps = {type(s).__name__: s for s in fitted.stages}
    shares = dict(zip(steps["ShareEncoderModel"].getOrDefault("categories"), steps["ShareEncoderModel"].getOrDefault("shares")))
    contracts = [a["Contract"] for a in ACCOUNTS]
    assert shares == {c: pytest.approx(contracts.count(c) / len(contracts)) for c in set(contracts)}
    builder = steps["FeatureBuilderModel"]
    assert builder.getOrDefault("tenureMean") == pytest.approx(sum(a["tenure"] for a in ACCOUNTS) / len(ACCOUNTS))
    churners = [a["Churn"] for a in ACCOUNTS].count("Yes")
    assert steps["ClassWeightsModel"].getOrDefault("one") == pytest.approx(len(ACCOUNTS) / 2 / churners)


def test_scores_without_a_label_and_with_unseen_values(spark, raw, fitted):
    """No label column; values outside the domains, missing values, a contract that training did not have."""
    odd = [account("N-1", Contract="Ten years"), account("N-2", Contract=None), account("N-3", gender="?", PhoneService=None),
           account("N-4", InternetService="Satellite", PaymentMethod="Crypto"), account("N-5", tenure=None, MonthlyCharges=None),
           account("N-6", Partner="maybe", OnlineSecurity="x", TotalCharges="n/a", SeniorCitizen=None), account("N-7")]
    got = chain.score_raw(fitted, to_table(spark, odd).drop("Churn"))
    assert got.columns == [config.KEY, "probability", "prediction"]
    found = scores(got)
    assert set(found) == {a["customerID"] for a in odd} and all(0 <= p <= 1 for p, _ in found.values())
    assert found["N-1"] == found["N-2"] != found["N-7"]
    strict = chain.raw_chain(config.SELECTED_FEATURES, {"C": 1}, len(ACCOUNTS), strict=True).fit(raw)
    with pytest.raises(Exception, match="unmapped value in PhoneService"):
        chain.score_raw(strict, to_table(spark, odd[2:3])).collect()
    assert scores(chain.score_raw(strict, raw)) == scores(chain.score_raw(fitted, raw))


def test_scoring_is_a_projection(raw, fitted):
    plan = chain.score_raw(fitted, raw)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_too_many_categories(raw):
    with pytest.raises(ValueError, match="more than 2 categories"):
        chain.ShareEncoder(column="Contract", mostCategories=2).fit(raw)
