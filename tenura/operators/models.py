"""Classifier families, grid search over hashed folds, evaluation on the test split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce
from itertools import product
from math import isqrt
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura import config
from tenura.functions.tables import literal_table, materialize, q, release
from tenura.operators import metrics, trees
from tenura.operators.rates import balanced_weights

LABEL, WEIGHT, FEATURES = "label", "weight", "features"
SCORED_TOGETHER = 40


def _with_weights(df: DataFrame, fitted: Mapping[int, float], label: str) -> DataFrame:
    if set(fitted) - {0, 1}:
        raise ValueError("the label must be 0 or 1")
    weight = F.when(q(label) == 1, F.lit(fitted.get(1, 0.0))).otherwise(F.lit(fitted.get(0, 0.0)))
    return df.withColumn(WEIGHT, weight)


def class_weights(df: DataFrame, label: str = LABEL) -> dict[int, float]:
    """Balanced class weights of the rows with a label."""
    return {r[label]: r["weight"] for r in balanced_weights(df.filter(q(label).isNotNull()), label).limit(3).collect()}


def add_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced class weights as a column; the two-row weight table is fitted first."""
    return _with_weights(df, class_weights(df, label), label)


def fold_weights(train: DataFrame, folds: int) -> list[dict[int, float]]:
    """The balanced class weights of every fold's complement, from one count by fold and class."""
    sizes = train.filter(q(LABEL).isNotNull()).groupBy("fold", LABEL).count().collect()
    out = []
    for i in range(folds):
        rows: dict[int, int] = {}
        for r in sizes:
            if r["fold"] != i:
                rows[r[LABEL]] = rows.get(r[LABEL], 0) + r["count"]
        whole = sum(rows.values())
        out.append({c: whole / (len(rows) * n) for c, n in rows.items()})
    return out


def assemble(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error")


def logistic(params: Mapping, total_weight: float):
    """Ridge-penalised logistic regression; C counts against the summed loss."""
    return LogisticRegression(
        featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, maxIter=1000,
        regParam=1.0 / (params["C"] * total_weight), elasticNetParam=0.0, standardization=False,
    )


def tree(params: Mapping, weights: Mapping[int, float], ratio: float, columns: int) -> trees.Setting:
    return trees.Setting(max_depth=params["max_depth"], min_split=params.get("min_split", 2), weights=_pair(weights))


def forest(params: Mapping, weights: Mapping[int, float], ratio: float, columns: int) -> trees.Setting:
    """Bootstrapped rows, the square root of the columns at each node."""
    return trees.Setting(
        trees=params["trees"], max_depth=params["max_depth"], min_split=params.get("min_split", 2), bootstrap=True,
        node_columns=max(1, isqrt(columns)), weights=_pair(weights),
    )


def boosted(params: Mapping, weights: Mapping[int, float], ratio: float, columns: int) -> trees.Setting:
    """Second-order boosting level by level; class 1 weighs the class ratio."""
    return trees.Setting(
        boosted=True, trees=params["trees"], max_depth=params["max_depth"], rate=params["learning_rate"],
        row_share=params["subsample"], column_share=params["column_share"], l2=1.0, min_weight=1.0, weights=(1.0, ratio),
    )


def leaf_boosted(params: Mapping, weights: Mapping[int, float], ratio: float, columns: int) -> trees.Setting:
    """Second-order boosting leaf by leaf; so many leaves reach one level less at most."""
    deepest = params["leaves"] - 1
    depth = min(params["max_depth"], deepest) if params["max_depth"] > 0 else deepest
    return trees.Setting(
        boosted=True, trees=params["trees"], leaves=params["leaves"], max_depth=depth, rate=params["learning_rate"],
        min_leaf=20, min_weight=1e-3, weights=_pair(weights),
    )


def _pair(weights: Mapping[int, float]) -> tuple[float, float]:
    return weights.get(0, 0.0), weights.get(1, 0.0)


FAMILIES = {
    "Logistic Regression": (logistic, config.LOGISTIC_GRID),
    "Decision Tree": (tree, config.TREE_GRID),
    "Random Forest": (forest, config.FOREST_GRID),
    "Boosted Trees": (boosted, config.BOOST_GRID),
    "Leaf-Limited Boosted Trees": (leaf_boosted, config.LEAF_BOOST_GRID),
}


#: Families that ``trees`` grows, all settings and folds side by side.
GROWN = ("Decision Tree", "Random Forest", "Boosted Trees", "Leaf-Limited Boosted Trees")


def combinations_of(grid: Mapping[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def _in_threads(work, items: Sequence, threads: int) -> list:
    """Run driver-side fits side by side; each fit is itself a set of Spark jobs."""
    if threads <= 1:
        return [work(i) for i in items]
    with ThreadPool(min(threads, len(items))) as pool:
        return pool.map(inheritable_thread_target(work), items)


def score(model, df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Add the class-1 probability and the 0/1 prediction (0.5 rule unless a threshold is given)."""
    keep = [c for c in df.columns if c != FEATURES]
    if isinstance(model, trees.Model):
        chance = trees.scored(df, {"": model}, FEATURES, keep).withColumn("probability", F.col("probabilities")[0])
        return chance.drop("probabilities").withColumn("prediction", _hit(threshold))
    out = model.transform(df).withColumn("__p", metrics.positive_probability())
    hit = (
        metrics.at_threshold(F.col("__p"), threshold)
        if threshold is not None
        else F.col("prediction").cast("int")
    )
    return out.select(
        *[q(c) for c in keep], F.col("__p").alias("probability"), hit.alias("prediction")
    )


def _hit(threshold: float | None, probability: str = "probability") -> Column:
    """1 above a half, or from the threshold on if one is given."""
    if threshold is not None:
        return metrics.at_threshold(F.col(probability), threshold)
    return F.when(F.col(probability) > 0.5, 1).otherwise(0)


def prepare(df: DataFrame, features: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Label, feature vector and the columns needed later; nothing else is kept."""
    kept = [c for c in dict.fromkeys([config.KEY, "split", "fold", *extra]) if c in df.columns]
    wide = df.select(
        q(config.LABEL).cast("int").alias(LABEL),
        *[q(c).alias(f"keep:{c}") for c in kept],
        *[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
    )
    out = assemble([f"x{i}" for i in range(len(features))]).transform(wide)
    return out.select(LABEL, *[q(f"keep:{c}").alias(c) for c in kept], FEATURES)


def cross_validate(
    train: DataFrame,
    jobs: Sequence[tuple],
    folds: int = config.FOLDS,
    threads: int = 4,
    threshold: float | None = None,
    with_auc: bool = True,
) -> DataFrame:
    """Per candidate and fold: accuracy, precision, recall, F1 (and AUC).

    ``jobs`` pairs a candidate with a function from the total weight to an estimator. Each
    is fitted on every fold's complement; the held-out scores of up to ``SCORED_TOGETHER``
    fits are measured in one grouped job. Only the metric rows reach the driver. The rows are
    assembled once and kept while the folds are fitted; the weights come from one count.
    """
    keys = ["candidate", "fold"]
    train = train.persist()
    try:
        return _cross_validated(train, jobs, folds, threads, threshold, with_auc, keys)
    finally:
        train.unpersist()


def _cross_validated(train, jobs, folds, threads, threshold, with_auc, keys) -> DataFrame:
    fitted = fold_weights(train, folds)
    weighted = [
        _with_weights(train.filter((F.col("fold") != i) & q(LABEL).isNotNull()), fitted[i], LABEL)
        for i in range(folds)
    ]
    # the balanced weights of a set add up to its number of rows
    counts = dict(train.filter(q(LABEL).isNotNull()).groupBy("fold").count().collect())
    totals = [float(sum(n for k, n in counts.items() if k != i)) for i in range(folds)]

    def one(item):
        (name, make), i = item
        model = make(totals[i]).fit(weighted[i])
        held_out = train.filter(F.col("fold") == i).select(LABEL, "fold", FEATURES)
        return score(model, held_out, threshold).withColumn("candidate", F.lit(name))

    items = [(job, i) for job in jobs for i in range(folds)]
    rows = []
    for at in range(0, len(items), SCORED_TOGETHER):
        parts = _in_threads(one, items[at : at + SCORED_TOGETHER], threads)
        scored = reduce(DataFrame.unionByName, parts)
        board = (
            metrics.scoreboard(scored, keys)
            if with_auc
            else metrics.from_confusion(metrics.confusion(scored, keys), keys)
        )
        names = board.columns
        rows += [tuple(r) for r in board.collect()]
    return literal_table(train.sparkSession, rows, names)


def params_text(params: Mapping) -> dict[str, str]:
    return {k: str(v)[:250] for k, v in params.items()}


def full_params(family: str, params: Mapping, total_weight: float = 1.0) -> dict[str, str]:
    """All parameters of a family's model, not only those of its grid."""
    if family in GROWN:
        return params_text(asdict(FAMILIES[family][0](params, {0: 1.0, 1: 1.0}, 1.0, 1)) | dict(params))
    made = FAMILIES[family][0](params, total_weight)
    return params_text({p.name: v for p, v in made.extractParamMap().items()} | dict(params))


@dataclass
class Binned:
    """Training rows ready for growing trees, with the class weights of every fold's complement and of all rows."""

    table: DataFrame
    cuts: list[list[float]]
    by_fold: list[dict[int, float]]
    whole: dict[int, float]
    ratio: float

    def weights(self, fold: int) -> dict[int, float]:
        return self.by_fold[fold] if fold >= 0 else self.whole

    def setting(self, family: str, params: Mapping, fold: int) -> trees.Setting:
        made = FAMILIES[family][0](params, self.weights(fold), self.ratio, len(self.cuts))
        return replace(made, left_out=fold, seed=config.SEED)


def bin_rows(train: DataFrame, folds: int = config.FOLDS, bins: int = trees.BINS) -> Binned:
    """Cut points over all training rows, binned rows, class weights; rows without a label are left out."""
    rows = train.filter(q(LABEL).isNotNull())
    width = len(rows.select(vector_to_array(FEATURES)).first()[0])
    cuts = trees.cut_points(rows.select(vector_to_array(FEATURES).alias("x")), width, bins)
    whole = class_weights(rows)
    # balanced weights are inverse to the class sizes, so their quotient is the class ratio
    ratio = whole[1] / whole[0] if {0, 1} <= set(whole) else 1.0
    by_fold = fold_weights(train, folds) if "fold" in train.columns else []
    return Binned(trees.binned(rows, cuts, FEATURES, LABEL), cuts, by_fold, whole, ratio)


def _fits(rows: Binned, family: str, combos: Sequence[Mapping], fold: int) -> list[tuple[trees.Setting, trees.Variant]]:
    """For each combination the setting to grow and the part of the grown model that it is.

    Fewer rounds or trees are the first ones of more. Without boosting a smaller depth or a larger split minimum is the same
    tree cut back, so one forest serves all combinations.
    """
    made = [rows.setting(family, p, fold) for p in combos]
    out = []
    for s in made:
        same = [o for o in made if _shared(o) == _shared(s)]
        whole = replace(s, trees=max(o.trees for o in same))
        variant = trees.Variant(0, 0, s.trees)
        if not s.boosted:
            whole = replace(whole, max_depth=max(o.max_depth for o in same), min_split=min(o.min_split for o in same))
            variant = replace(variant, depth=s.max_depth, min_split=s.min_split)
        out.append((whole, variant))
    return out


def _shared(s: trees.Setting) -> trees.Setting:
    s = replace(s, trees=0)
    return s if s.boosted else replace(s, max_depth=0, min_split=0)


def search_cells(rows: Binned, grids: Mapping[str, Mapping], folds: int = config.FOLDS) -> tuple[DataFrame, list[tuple]]:
    """``candidate``, ``fold`` and the four cells of all combinations of several families over the rows each fit has not
    seen, and the (family, number) of each candidate. The grown models do not come to the driver as a whole."""
    settings: dict[trees.Setting, int] = {}
    variants, names = [], []
    for family, grid in grids.items():
        combos = combinations_of(grid)
        for fold in range(folds):
            for i, (whole, variant) in enumerate(_fits(rows, family, combos, fold)):
                model = settings.setdefault(whole, len(settings))
                variants.append(replace(variant, candidate=len(names) + i, model=model))
        names += [(family, i) for i in range(len(combos))]
    cells = trees.grow(rows.table, rows.cuts, list(settings), (), variants)
    found = literal_table(rows.table.sparkSession, cells, ["candidate", "fold", "tn", "fp", "fn", "tp"])
    return found.withColumns({c: F.col(c).cast("int") for c in ("candidate", "fold")}), names


def search_grown(rows: Binned, grids: Mapping[str, Mapping], folds: int = config.FOLDS) -> DataFrame:
    """``model``, ``candidate``, ``fold`` and F1 of all combinations."""
    cells, names = search_cells(rows, grids, folds)
    found = metrics.from_confusion(cells, ["candidate", "fold"]).select("candidate", "fold", "F1")
    known = literal_table(rows.table.sparkSession, [(n, *k) for n, k in enumerate(names)], ["candidate", "model", "number"])
    return found.join(F.broadcast(known), "candidate").select("model", F.col("number").alias("candidate"), "fold", "F1")


def _results(family: str, combos: Sequence[Mapping], fitted: Mapping[int, Mapping]) -> list[dict]:
    return [
        {"model": family, "candidate": i, "params": params_text(p),
         "F1_mean": fitted[i]["F1_mean"], "F1_std": fitted[i]["F1_std"]}
        for i, p in enumerate(combos)
    ]


def best_of(combos: Sequence[Mapping], results: Sequence[Mapping]) -> dict:
    """The parameters with the best mean F1, the first ones on ties."""
    return combos[max(range(len(combos)), key=lambda i: (results[i]["F1_mean"], -i))]


def grid_search(
    train: DataFrame,
    family: str,
    grid: Mapping[str, Sequence] | None = None,
    folds: int = config.FOLDS,
    threads: int = 4,
) -> tuple[dict, list[dict]]:
    """The parameters with the best mean F1 over the folds (first one on ties), and all results."""
    best, results = grid_search_all(train, {family: grid or FAMILIES[family][1]}, folds, threads)
    return best[family], results


def grid_search_all(
    train: DataFrame,
    grids: Mapping[str, Mapping] | None = None,
    folds: int = config.FOLDS,
    threads: int = 4,
    rows: Binned | None = None,
) -> tuple[dict[str, dict], list[dict]]:
    """Best parameters per family, over the declared grids unless others are passed, and all results.

    The tree families are grown together. Combinations that make the same model are fitted once and reported for each.
    ``rows`` are the binned training rows if they are at hand.
    """
    grids = grids or {name: grid for name, (_, grid) in FAMILIES.items()}
    grown = {f: g for f, g in grids.items() if f in GROWN}

    def search(family: str | None) -> list:
        if family is None:
            per_fold = search_grown(rows or bin_rows(train, folds), grown, folds)
        else:
            make = FAMILIES[family][0]
            jobs = [(i, lambda total, p=p: make(p, total)) for i, p in enumerate(combinations_of(grids[family]))]
            per_fold = cross_validate(train, jobs, folds, threads, with_auc=False).withColumn("model", F.lit(family))
        return metrics.mean_and_spread(per_fold, ["F1"], ["model", "candidate"]).collect()

    fitted: dict[str, dict] = {}
    # one after the other, as each fills the machine and the driver would need the memory of both
    for part in [f for f in grids if f not in GROWN] + ([None] if grown else []):
        for r in search(part):
            fitted.setdefault(r["model"], {})[r["candidate"]] = r
        release(train.sparkSession)
    best, results = {}, []
    for family, grid in grids.items():
        combos = combinations_of(grid)
        rows = _results(family, combos, fitted[family])
        best[family] = best_of(combos, rows)
        results += rows
    return best, results


def params_table(spark, best: Mapping[str, Mapping]) -> DataFrame:
    """(model, param, value) rows of the chosen parameters."""
    rows = [(m, k, v) for m, p in best.items() for k, v in params_text(p).items()]
    return literal_table(spark, rows, ["model", "param", "value"])


def search_table(spark, results: Sequence[Mapping]) -> DataFrame:
    """One row per tried combination with its fold mean and spread."""
    rows = [
        (r["model"], r["candidate"], ", ".join(f"{k}={v}" for k, v in r["params"].items()),
         r["F1_mean"], r["F1_std"])
        for r in results
    ]
    return literal_table(spark, rows, ["model", "candidate", "params", "F1_mean", "F1_std"])


def fit_all(train: DataFrame, best: Mapping[str, Mapping], threads: int = 4, rows: Binned | None = None) -> dict:
    """One model for each family on all rows; the tree families are grown together. ``rows`` are the binned ones if at hand."""
    grown = [f for f in best if f in GROWN]

    def fitted(family: str | None) -> dict:
        if family is None:
            binned = rows or bin_rows(train)
            return dict(zip(grown, trees.grow(binned.table, binned.cuts, [binned.setting(f, best[f], -1) for f in grown])))
        weighted = add_weights(train)
        total = weighted.agg(F.sum(WEIGHT)).first()[0]
        return {family: FAMILIES[family][0](best[family], total).fit(weighted)}

    side_by_side = ([None] if grown else []) + [f for f in best if f not in GROWN]
    models = {f: m for part in _in_threads(fitted, side_by_side, threads) for f, m in part.items()}
    return {f: models[f] for f in best}


def fit(train: DataFrame, family: str, params: Mapping):
    return fit_all(train, {family: params})[family]


def evaluate_models(
    train: DataFrame, test: DataFrame, best: Mapping[str, Mapping], threads: int = 4, rows: Binned | None = None
) -> tuple[DataFrame, dict]:
    """Refit each family once on the training rows and score the test rows.

    ``test`` carries MonthlyCharges, ``rows`` are the binned training rows if at hand. Returns the scoreboard and the fitted models.
    """
    names = list(best)
    models = fit_all(train, best, threads, rows)
    scored = [
        score(models[n], test.select(LABEL, "MonthlyCharges", FEATURES)).withColumn(
            "Model", F.lit(n)
        )
        for n in names
    ]
    return metrics.scoreboard(reduce(DataFrame.unionByName, scored)), models


def score_all(train: DataFrame, test: DataFrame, best: Mapping[str, Mapping], threads: int = 4, rows: Binned | None = None) -> DataFrame:
    """The test rows scored by each family's model on the training rows, as ``Model``; written, so that no model is kept."""
    fitted = fit_all(train, best, threads, rows)
    parts = [score(m, test.select(LABEL, "MonthlyCharges", FEATURES)).withColumn("Model", F.lit(n)) for n, m in fitted.items()]
    scored = materialize(reduce(DataFrame.unionByName, parts))
    del fitted
    release(train.sparkSession)
    return scored


def cross_validate_best(
    train: DataFrame,
    family: str,
    params: Mapping,
    threshold: float = config.DECISION_THRESHOLD,
    folds: int = config.FOLDS,
    threads: int = 4,
) -> DataFrame:
    """Mean and population std of F1 and AUC over the folds, at a probability threshold."""
    per_fold = cross_validate_params(train, family, params, folds, threads, threshold)
    return metrics.mean_and_spread(per_fold, ["F1", "ROC-AUC"])


def cross_validate_params(
    train: DataFrame, family: str, params: Mapping, folds: int = config.FOLDS, threads: int = 4,
    threshold: float | None = None, candidate: str | None = None,
) -> DataFrame:
    """Per fold: accuracy, precision, recall, F1 and AUC of one combination, named ``candidate``."""
    name = candidate or family
    if family not in GROWN:
        return cross_validate(train, [(name, lambda total: FAMILIES[family][0](params, total))], folds, threads, threshold)
    rows = bin_rows(train, folds)
    grown = trees.grow(rows.table, rows.cuts, [rows.setting(family, params, i) for i in range(folds)])
    chance = trees.held_out(rows.table, grown).withColumn("prediction", _hit(threshold))
    return metrics.scoreboard(chance.withColumn("candidate", F.lit(name)), ["candidate", "fold"])


def churn_chain(features: Sequence[str], family: str, params: Mapping, total_weight: float):
    """Assembler and logistic classifier as one savable chain."""
    return Pipeline(stages=[assemble(features), FAMILIES[family][0](params, total_weight)])
