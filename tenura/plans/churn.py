"""The whole run, raw accounts to saved results, as a sequence of table operators."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura import config
from tenura.functions.tables import q
from tenura.operators import (
    cleaning, correlation, features, models, quality, segments, selection, splits,
)
from tenura.plans import eda, validation
from tenura.sources import accounts, runs


def featured_accounts(
    raw: DataFrame, means: Mapping[str, float] | None = None, on_zero: str = "inf"
) -> DataFrame:
    return features.add_engineered_features(
        features.encode(cleaning.clean(raw)), means, on_zero
    )


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (config.KEY, config.LABEL, "split", "fold")]


def model_table(
    featured: DataFrame, mode: str = "approx", test_share: float = config.TEST_SHARE
) -> DataFrame:
    """Split, fold and frequency-encoded contract, ready for models.

    Accounts without any service have no cost per service; models get 0 there.
    """
    cost = q(config.COST_PER_SERVICE)
    finite = F.when(F.abs(cost) != float("inf"), F.nanvl(cost, F.lit(0.0))).otherwise(F.lit(0.0))
    table = splits.train_test_split(
        featured.withColumn(config.COST_PER_SERVICE, F.coalesce(finite, F.lit(0.0))),
        test_share, mode=mode,
    )
    table = splits.assign_folds(table, mode=mode)
    encoded = splits.frequency_encode(table, "Contract")
    return encoded.withColumn("Contract", F.coalesce(q("Contract"), F.lit(0.0)))


@dataclass
class ChurnRun:
    """What a run leaves behind; tables are lazy unless the run had to fit something."""

    quality: DataFrame
    featured: DataFrame
    validation: DataFrame | None = None
    views: dict[str, DataFrame] = field(default_factory=dict)
    correlated: list[str] = field(default_factory=list)
    spearman_features: list[str] = field(default_factory=list)
    variance: DataFrame | None = None
    loadings: DataFrame | None = None
    subsets: DataFrame | None = None
    features: list[str] = field(default_factory=list)
    importance: DataFrame | None = None
    best: dict = field(default_factory=dict)
    scoreboard: DataFrame | None = None
    models: dict = field(default_factory=dict)
    threshold_cv: DataFrame | None = None


def run(
    raw: DataFrame,
    grids: Mapping[str, Mapping] | None = None,
    importance_params: Mapping | None = None,
    repeats: int = 30,
    mode: str = "approx",
    threads: int = 4,
) -> ChurnRun:
    """Validate, explore, clean, engineer, split, select, search, evaluate and cross-validate."""
    featured = featured_accounts(raw)
    result = ChurnRun(quality.dq_report(raw), featured, validation.report(raw))
    result.views = eda.run_full(cleaning.clean(raw), featured)
    held = [model_table(featured, mode).persist()]
    try:
        return _select_and_fit(result, held, grids, importance_params, repeats, threads)
    finally:
        for df in held:
            df.unpersist()


def _select_and_fit(
    result: ChurnRun, held: list[DataFrame], grids, importance_params, repeats: int, threads: int
) -> ChurnRun:
    table = held[0]
    spark = table.sparkSession
    names = feature_columns(table)
    both = table.filter(q("split") == "train")
    # the computed lists are reported beside the fixed ones that the run goes on with
    computed = correlation.drop_correlated(both, names, "computed")[1]
    result.correlated = [c for c in names if c not in computed]
    result.spearman_features = correlation.select_features(both, names, "computed")
    kept, names = correlation.drop_correlated(table, names)
    train = kept.filter(q("split") == "train")
    _, rotation, _ = selection.fit_components(train, names)
    result.variance = selection.explained_variance(spark, rotation)
    needed = selection.components_for(result.variance).first()["components"]
    result.loadings = selection.loadings(spark, rotation, names, needed)

    params = importance_params or {"trees": 300, "max_depth": 10}
    ready = models.prepare(kept, names).persist()
    held.append(ready)
    chooser = models.fit(ready.filter(q("split") == "train"), "Random Forest", params)
    result.importance = selection.permutation_importance(
        chooser, ready.filter(q("split") == "test"), names, repeats
    )
    result.features = selection.kept_features(result.importance) or names
    subsets = {"spearman": config.SELECTED_FEATURES, "permutation": result.features}
    result.subsets = selection.compare_subsets(train, subsets, params=params, threads=threads)

    # charges are carried beside the features, even when they are not selected
    chosen = models.prepare(kept, result.features, ["MonthlyCharges"]).persist()
    held.append(chosen)
    train_ready, test_ready = (chosen.filter(q("split") == s) for s in ("train", "test"))
    result.best, _ = models.grid_search_all(train_ready, grids, threads=threads)
    result.scoreboard, result.models = models.evaluate_models(
        train_ready, test_ready, result.best, threads
    )
    last = list(result.best)[-1]
    result.threshold_cv = models.cross_validate_best(
        train_ready, last, result.best[last], threads=threads
    )
    return result


def save(result: ChurnRun, folder: str, run_id: str) -> None:
    """Processed table, scoreboard, run log and fitted models."""
    accounts.write_table(result.featured, f"{folder}/processed")
    accounts.write_results(result.scoreboard, f"{folder}/model_results")
    params = {name: models.full_params(name, chosen) for name, chosen in result.best.items()}
    runs.append_runs(runs.run_rows(result.scoreboard, params, run_id), f"{folder}/runs")
    for name, model in result.models.items():
        runs.save_model(model, f"{folder}/models/{name.replace(' ', '_')}")


def risk_view(featured: DataFrame) -> DataFrame:
    return segments.segment_table(segments.with_risk(featured))
