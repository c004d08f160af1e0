"""Queries that fit something: components, importance, grid search, evaluation, saved models.

Fitted models have no SQL counterpart, so most of these are checked by tests instead.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura import config
from tenura.functions.tables import literal_table, materialize, q
from tenura.operators import chain, metrics, models, selection, splits, trees
from tenura.plans import churn
from tenura.registry import inputs
from tenura.registry.account_sql import with_stage
from tenura.registry.book import query
from tenura.registry.rows import FOLDS_SQL, SPLIT_SQL, scratch
from tenura.sources import accounts, runs

#: All settings of the five families, as declared.
GRIDS = {family: grid for family, (_, grid) in models.FAMILIES.items()}


def table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model table, computed once because every fit passes over it many times."""
    return materialize(churn.model_table(inputs.featured(spark, sf_dir)))


def searched(
    spark: SparkSession, sf_dir: str, families: list[str], df: DataFrame | None = None, binned: models.Binned | None = None
) -> tuple[dict, list]:
    """The best parameters of each family and all results, in five folds over all settings.

    Every call searches. ``df`` is the model table and ``binned`` its training rows in bins if they are at hand.
    """
    df = table(spark, sf_dir) if df is None else df
    train, _ = train_and_test(df, names_of(df))
    return models.grid_search_all(train, {f: GRIDS[f] for f in families}, threads=8, rows=binned)


def best_of_all(
    spark: SparkSession, sf_dir: str, df: DataFrame | None = None, binned: models.Binned | None = None
) -> dict[str, dict]:
    return searched(spark, sf_dir, list(GRIDS), df, binned)[0]


def search_results(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    return models.search_table(spark, searched(spark, sf_dir, [family])[1])


def names_of(df: DataFrame) -> list[str]:
    return [c for c in churn.feature_columns(df) if c not in config.DROPPED_FEATURES]


def train_and_test(df: DataFrame, features: list[str]) -> tuple[DataFrame, DataFrame]:
    ready = models.prepare(df, features, ["MonthlyCharges"])
    return ready.filter(q("split") == "train"), ready.filter(q("split") == "test")


@query("component_variance")
def component_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir).filter(q("split") == "train")
    _, rotation, _ = selection.fit_components(df, names_of(df))
    return selection.explained_variance(spark, rotation)


@query("components_for_95_percent")
def components_for_95_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.components_for(component_variance(spark, sf_dir))


@query(
    "two_column_variance",
    with_stage(
        "cleaned",
        """SELECT component, round(variance_pct, 6) AS variance_pct, round(cumulative_pct, 6) AS cumulative_pct FROM (
             SELECT 1 AS component, 50 * (1 + abs(corr(tenure, "MonthlyCharges"))) AS variance_pct,
                    50 * (1 + abs(corr(tenure, "MonthlyCharges"))) AS cumulative_pct FROM cleaned
             UNION ALL
             SELECT 2, 50 * (1 - abs(corr(tenure, "MonthlyCharges"))), 100 FROM cleaned) AS t""",
    ),
)
def two_column_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With two standardised columns the shares follow from their correlation alone."""
    df = inputs.cleaned(spark, sf_dir, "tenure", "MonthlyCharges")
    _, rotation, _ = selection.fit_components(df, ["tenure", "MonthlyCharges"])
    return selection.explained_variance(spark, rotation)


@query("component_projection")
def component_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir).filter(q("split") == "train")
    _, rotation, scaled = selection.fit_components(df, names_of(df))
    return selection.projection(scaled, rotation)


@query(
    "component_totals",
    with_stage(
        "featured",
        """SELECT 26 AS components, 100.0 AS total, true AS falling, true AS reached, count(*) AS rows, 0.0 AS mean_1, 0.0 AS mean_2,
             true AS spread_1, true AS spread_2 FROM parted WHERE split = 'train'""",
        SPLIT_SQL,
    ),
)
def component_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for any components: the shares add up to 100 and fall, the first that reach 95 percent do and one less does
    not, and the training rows' coordinates have a mean of 0 and the variance that the share says."""
    df = table(spark, sf_dir).filter(q("split") == "train")
    features = names_of(df)
    _, rotation, scaled = selection.fit_components(df, features)
    variance = materialize(selection.explained_variance(spark, rotation))
    shares = [r["variance_pct"] for r in variance.orderBy("component").collect()]
    needed = selection.components_for(variance).first()["components"]
    reached = sum(shares[:needed]) >= 95 - 1e-9 > sum(shares[: needed - 1])
    points = selection.projection(scaled, rotation)
    near = [F.abs(F.var_samp(f"pc{i + 1}") * 100 / len(features) - shares[i]) < 1e-6 for i in range(2)]
    return points.agg(
        F.lit(len(shares)).alias("components"), F.lit(round(sum(shares), 6)).alias("total"),
        F.lit(shares == sorted(shares, reverse=True)).alias("falling"), F.lit(reached).alias("reached"),
        F.count(F.lit(1)).alias("rows"), *[F.abs(F.round(F.avg(f"pc{i}"), 6)).alias(f"mean_{i}") for i in (1, 2)],
        *[near[i].alias(f"spread_{i + 1}") for i in range(2)])


@query(
    "subset_fold_counts",
    with_stage(
        "featured",
        """SELECT c.candidate, f.fold, count(*) AS rows, true AS valid
           FROM folded AS f, (VALUES ('charges'), ('spearman')) AS c(candidate) WHERE split = 'train' GROUP BY 1, 2""",
        SPLIT_SQL,
        FOLDS_SQL,
    ),
)
def subset_fold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subsets of features compared: every fold of every subset is scored, with an area between 0 and 1."""
    train = table(spark, sf_dir).filter(q("split") == "train")
    subsets = {"spearman": config.SELECTED_FEATURES, "charges": ["tenure", "MonthlyCharges"]}
    boards = [models.cross_validate_params(models.prepare(train, f), "Decision Tree", {"max_depth": 3}, candidate=n)
              for n, f in subsets.items()]
    sizes = train.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))
    board = boards[0].unionByName(boards[1]).join(sizes, "fold")
    return board.select("candidate", "fold", "rows", q("ROC-AUC").between(0, 1).alias("valid"))


@query("component_loadings")
def component_loadings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loadings of the first components that reach 95 percent of the variance."""
    df = table(spark, sf_dir).filter(q("split") == "train")
    features = names_of(df)
    _, rotation, _ = selection.fit_components(df, features)
    needed = selection.components_for(selection.explained_variance(spark, rotation)).first()
    return selection.loadings(spark, rotation, features, needed["components"])


@query(
    "loading_products",
    """SELECT 'PC' || a AS one, 'PC' || b AS other, CASE WHEN a = b THEN 1.0 ELSE 0.0 END AS product
       FROM generate_series(1, 26) AS x(a), generate_series(1, 26) AS y(b)""",
)
def loading_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The components are orthogonal and of length 1."""
    df = table(spark, sf_dir).filter(q("split") == "train")
    features = names_of(df)
    _, rotation, _ = selection.fit_components(df, features)
    rows = selection.loadings(spark, rotation, features)
    left = rows.select(F.col("component").alias("one"), "feature", F.col("loading").alias("x"))
    right = rows.select(F.col("component").alias("other"), "feature", F.col("loading").alias("y"))
    product = F.abs(F.round(F.sum(F.col("x") * F.col("y")), 6))
    return left.join(right, "feature").groupBy("one", "other").agg(product.alias("product"))


@query("permutation_importance")
def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir)
    features = names_of(df)
    train, test = train_and_test(df, features)
    model = models.fit(train, "Random Forest", {"trees": 300, "max_depth": 10})
    return selection.permutation_importance(model, test, features)


@query(
    "shuffled_column_totals",
    with_stage(
        "cleaned",
        """SELECT repeat, count(*) AS rows, CAST(sum(tenure) AS BIGINT) AS total, CAST(sum(tenure * tenure) AS BIGINT) AS squares,
             count(DISTINCT tenure) AS distinct_values, count(DISTINCT "customerID") AS donors, true AS moved
           FROM cleaned, (SELECT unnest([0, 1, 2]) AS repeat) AS r GROUP BY 1""",
    ),
)
def shuffled_column_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shuffled column keeps its values but not their places: the totals of the donors are those of the
    column, every account gives once, and hardly any to itself."""
    df = inputs.cleaned(spark, sf_dir, config.KEY, "tenure")
    donor = F.col("donor")
    return selection.shuffled(df, "tenure", 3, rows_per_cycle=400).groupBy("repeat").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(donor).alias("total"),
        F.sum(donor * donor).alias("squares"),
        F.count_distinct(donor).alias("distinct_values"),
        F.count_distinct("donor_key").alias("donors"),
        # an account may draw itself, but hardly any do
        (F.count_if(F.col("donor_key") == q(config.KEY)) * 20 < F.count(F.lit(1))).alias("moved"),
    )


@query("logistic_grid_search")
def logistic_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_results(spark, sf_dir, "Logistic Regression")


@query("tree_grid_search")
def tree_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_results(spark, sf_dir, "Decision Tree")


@query("forest_grid_search")
def forest_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_results(spark, sf_dir, "Random Forest")


@query("boosted_grid_search")
def boosted_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_results(spark, sf_dir, "Boosted Trees")


@query("leaf_boosted_grid_search")
def leaf_boosted_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_results(spark, sf_dir, "Leaf-Limited Boosted Trees")


@query("best_parameters")
def best_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.params_table(spark, best_of_all(spark, sf_dir))


@query(
    "search_fold_totals",
    with_stage(
        "featured",
        """SELECT c.candidate, f.fold, count(*) FILTER (WHERE "Churn" = 1) AS churners, count(*) FILTER (WHERE "Churn" = 0) AS others
           FROM folded AS f, (SELECT unnest(generate_series(0, 11)) AS candidate) AS c
           WHERE split = 'train' GROUP BY 1, 2""",
        SPLIT_SQL,
        FOLDS_SQL,
    ),
)
def search_fold_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for any fit: the four cells of every setting of the decision tree add up to the fold it has not seen."""
    df = table(spark, sf_dir)
    train, _ = train_and_test(df, names_of(df))
    rows = models.bin_rows(train)
    cells = models.search_cells(rows, {"Decision Tree": GRIDS["Decision Tree"]})[0]
    return cells.select("candidate", "fold", (F.col("tp") + F.col("fn")).alias("churners"), (F.col("tn") + F.col("fp")).alias("others"))


#: Columns whose first split SQL recomputes, in the order that decides ties.
SPLIT_FEATURES = ["tenure", "MonthlyCharges", "SeniorCitizen", "PaperlessBilling", "_Is_AutoPay", "_LoyaltyScore"]


def first_split_sql(gradient: str, weight: str, l2: float, least_weight: float, least_rows: int, rate: float) -> str:
    """The best first split over value parts as the grower makes them, with sums in whole 2^-20."""
    long = " UNION ALL ".join(
        f"SELECT {i} AS feature, '{c}' AS name, CAST(\"{c}\" AS DOUBLE) AS value, \"Churn\" AS y FROM parted WHERE split = 'train'"
        for i, c in enumerate(SPLIT_FEATURES))

    def worth(g: str, h: str) -> str:
        return f"pow({g} / 1048576.0, 2) / ({h} / 1048576.0 + {l2})"

    return with_stage(
        "featured",
        f"""SELECT name AS feature, cut, round(gain, 6) AS gain, nl AS rows_left, nt - nl AS rows_right,
              round({rate} * (gl / 1048576.0) / (hl / 1048576.0 + {l2}), 6) AS value_left,
              round({rate} * ((gt - gl) / 1048576.0) / ((ht - hl) / 1048576.0 + {l2}), 6) AS value_right
            FROM gains WHERE gain > 0 ORDER BY gains.gain DESC, gains.feature, cut LIMIT 1""",
        SPLIT_SQL,
        f"""
long AS ({long}),
sizes AS (SELECT count(*) FILTER (WHERE y = 0)::DOUBLE AS n0, count(*) FILTER (WHERE y = 1)::DOUBLE AS n1 FROM long WHERE feature = 0),
vals AS (
  SELECT feature, name, value, count(*) AS n, sum(CAST(round(({gradient}) * 1048576) AS BIGINT)) AS g,
         sum(CAST(round(({weight}) * 1048576) AS BIGINT)) AS h
  FROM long, sizes GROUP BY 1, 2, 3
),
placed AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(n) OVER (PARTITION BY feature) AS total, count(*) OVER (PARTITION BY feature) AS d FROM vals
),
parts AS (
  SELECT feature, name, CASE WHEN d <= 128 THEN value ELSE floor(before * 128 / total) END AS part, max(value) AS cut,
         sum(n) AS n, sum(g) AS g, sum(h) AS h FROM placed GROUP BY 1, 2, 3
),
running AS (
  SELECT feature, name, cut, sum(n) OVER w AS nl, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER a AS nt,
         sum(g) OVER a AS gt, sum(h) OVER a AS ht
  FROM parts WINDOW w AS (PARTITION BY feature ORDER BY cut), a AS (PARTITION BY feature)
),
gains AS (
  SELECT *, {worth("gl", "hl")} + {worth("(gt - gl)", "(ht - hl)")} - {worth("gt", "ht")} AS gain FROM running
  WHERE nl < nt AND nl >= {least_rows} AND nt - nl >= {least_rows}
    AND hl >= {least_weight} * 1048576 AND ht - hl >= {least_weight} * 1048576
)""",
    )


BALANCED = "(CASE WHEN y = 1 THEN (n0 + n1) / (2 * n1) ELSE (n0 + n1) / (2 * n0) END)"
RATIO = "(CASE WHEN y = 1 THEN n0 / n1 ELSE 1.0 END)"


def first_split(spark: SparkSession, sf_dir: str, family: str, params: dict) -> DataFrame:
    """The first split of a family's first tree on the training rows, with the values of a tree of that split alone."""
    df = table(spark, sf_dir)
    train, _ = train_and_test(df, SPLIT_FEATURES)
    rows = models.bin_rows(train)
    model = trees.grow(rows.table, rows.cuts, [rows.setting(family, params, -1)], SPLIT_FEATURES)[0]
    v = model.nodes
    sides = [int(v["left"][0]), int(v["right"][0])]
    feature, cut = int(v["feature"][0]), int(v["cut"][0])
    row = [SPLIT_FEATURES[feature], float(model.cuts[feature][cut]), float(v["gain"][0])]
    row += [int(v["n"][i]) for i in sides] + [float(v["value"][i]) for i in sides]
    return literal_table(spark, [row], ["feature", "cut", "gain", "rows_left", "rows_right", "value_left", "value_right"])


@query("tree_first_split", first_split_sql(f"y * {BALANCED}", BALANCED, 0, 0, 1, 1))
def tree_first_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decision tree's first split: the largest fall of the weighted impurity, and the shares of class 1."""
    return first_split(spark, sf_dir, "Decision Tree", {"max_depth": 1, "min_split": 2})


@query("boosted_first_split", first_split_sql(f"(y - 0.5) * {RATIO}", f"0.25 * {RATIO}", 1, 1, 1, 0.1))
def boosted_first_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first round's split gain and leaf values, from first and second derivatives."""
    return first_split(spark, sf_dir, "Boosted Trees", {
        "trees": 1, "max_depth": 1, "learning_rate": 0.1, "subsample": 1.0, "column_share": 1.0})


@query("leaf_boosted_first_split", first_split_sql(f"(y - 0.5) * {BALANCED}", f"0.25 * {BALANCED}", 0, 0.001, 20, 0.05))
def leaf_boosted_first_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the leaf-limited family, at two leaves."""
    return first_split(spark, sf_dir, "Leaf-Limited Boosted Trees", {
        "trees": 1, "leaves": 2, "max_depth": -1, "learning_rate": 0.05})


def evaluated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    """Search, best, refit, score: the scoreboard of the test rows and the parameters."""
    df = table(spark, sf_dir)
    train, test = train_and_test(df, names_of(df))
    binned = models.bin_rows(train)  # once, for the search and the last fits
    best = best_of_all(spark, sf_dir, df, binned)
    return metrics.scoreboard(models.score_all(train, test, best, rows=binned)), best


@query("model_scoreboard")
def model_scoreboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluated(spark, sf_dir)[0]


@query(
    "model_test_totals",
    with_stage(
        "featured",
        """SELECT m.name AS "Model", count(*) FILTER (WHERE "Churn" = 1) AS churners,
             count(*) FILTER (WHERE "Churn" = 0) AS others,
             round(sum("MonthlyCharges") FILTER (WHERE "Churn" = 1) * 12, 1) AS revenue
           FROM parted, (VALUES ('Logistic Regression'), ('Decision Tree'), ('Random Forest'), ('Boosted Trees'),
                ('Leaf-Limited Boosted Trees')) AS m(name)
           WHERE split = 'test' GROUP BY 1""",
        SPLIT_SQL,
    ),
)
def model_test_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for any fitted model: its cells add up to the test rows of each class, and
    the revenue it saves and loses to that of the churners."""
    df = table(spark, sf_dir)
    train, test = train_and_test(df, names_of(df))
    binned = models.bin_rows(train)
    scored = models.score_all(train, test, best_of_all(spark, sf_dir, df, binned), rows=binned)
    cells = metrics.confusion(scored, ["Model"])
    money = metrics.business_value(scored, ["Model"])
    return cells.join(money, "Model").select(
        "Model",
        (F.col("tp") + F.col("fn")).alias("churners"),
        (F.col("tn") + F.col("fp")).alias("others"),
        F.round(F.col("Revenue_Saved") + F.col("Revenue_Leakage"), 1).alias("revenue"),
    )


@query("threshold_cross_validation")
def threshold_cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last family at its best parameters, at the decision threshold."""
    df = table(spark, sf_dir)
    train, _ = train_and_test(df, names_of(df))
    name = list(GRIDS)[-1]
    return models.cross_validate_best(train, name, searched(spark, sf_dir, [name])[0][name])


@query("subset_comparison")
def subset_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features chosen by correlation against those that permutation keeps."""
    df = table(spark, sf_dir)
    features = names_of(df)
    train, test = train_and_test(df, features)
    model = models.fit(train, "Random Forest", {"trees": 300, "max_depth": 10})
    important = selection.kept_features(selection.permutation_importance(model, test, features))
    subsets = {"spearman": config.SELECTED_FEATURES, "permutation": important}
    return selection.compare_subsets(df.filter(q("split") == "train"), subsets)


@query("run_log")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and all parameters of the five models, logged to the run table twice and read back once."""
    board, chosen = evaluated(spark, sf_dir)
    path = scratch(spark) + "/runs"
    rows = materialize(runs.run_rows(board, {m: models.full_params(m, p) for m, p in chosen.items()}, "run-1"))
    for _ in range(2):
        runs.append_runs(rows, path)
    return runs.read_runs(spark, path)


@query(
    "run_log_keys",
    """SELECT run_id, model, kind, key, count(*) AS entries FROM (
         SELECT r.run_id, m.model, k.kind, k.key
         FROM (VALUES ('run-1'), ('run-2')) AS r(run_id), (VALUES ('Two rules'), ('Tenure rule')) AS m(model),
              (VALUES ('tag', 'model_name'), ('param', 'rule'), ('param', 'threshold'), ('metric', 'accuracy'), ('metric', 'precision'),
                      ('metric', 'recall'), ('metric', 'f1'), ('metric', 'roc_auc'), ('metric', 'revenue_saved'),
                      ('metric', 'revenue_leakage')) AS k(kind, key)) AS every GROUP BY ALL""",
)
def run_log_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, the first one logged twice: each key of each model stands there once."""
    df = inputs.cleaned(spark, sf_dir, config.KEY, "tenure", "Contract", "MonthlyCharges", "Churn")
    parts = [("Two rules", (q("tenure") < 12) & (q("Contract") == "Month-to-month")), ("Tenure rule", q("tenure") < 12)]
    scored = [df.select(F.lit(m).alias("Model"), q("Churn").alias("label"), "MonthlyCharges", c.cast("int").alias("prediction"),
                        c.cast("double").alias("probability")) for m, c in parts]
    board = materialize(metrics.scoreboard(scored[0].unionByName(scored[1])))
    path = scratch(spark) + "/runs"
    params = {m: {"rule": "by hand", "threshold": 12} for m, _ in parts}
    for run in ("run-1", "run-2", "run-1"):
        runs.append_runs(runs.run_rows(board, params, run), path)
    return runs.read_runs(spark, path).groupBy("run_id", "model", "kind", "key").agg(F.count(F.lit(1)).alias("entries"))


def raw_chain(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, PipelineModel]:
    """Raw accounts with their part, and the chain fitted on the training part, saved and loaded again."""
    raw = inputs.raw(spark, sf_dir)
    parts = materialize(splits.train_test_split(raw))
    train = parts.filter(q("split") == "train")
    fitted = chain.raw_chain(config.SELECTED_FEATURES, {"C": 1}, train.count()).fit(train)
    path = scratch(spark) + "/chain"
    runs.save_model(fitted, path)
    return parts, runs.load_model(PipelineModel, path)


@query(
    "raw_chain_scores",
    with_stage(
        "featured",
        'SELECT "customerID", CAST("Churn" AS DOUBLE) AS label, true AS valid FROM parted WHERE split = \'test\'',
        SPLIT_SQL,
    ),
)
def raw_chain_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw test accounts, written as CSV files, read and scored by the loaded chain: every key and label once,
    with a probability and the class that follows from it."""
    parts, loaded = raw_chain(spark, sf_dir)
    path = scratch(spark) + "/csv"
    accounts.write_table(parts.filter(q("split") == "test").drop("split"), path, "csv")
    scored = chain.score_raw(loaded, accounts.read_accounts(spark, path))
    by_rule = F.when(q("probability") >= config.DECISION_THRESHOLD, 1).otherwise(0)
    valid = q("probability").between(0, 1) & (q("prediction") == by_rule)
    return scored.select(config.KEY, "label", valid.alias("valid"))


@query(
    "raw_chain_values",
    with_stage(
        "featured",
        """SELECT 'mean' AS kind, 'tenure' AS key, round(avg(tenure), 6) AS value FROM parted WHERE split = 'train'
           UNION ALL SELECT 'mean', 'MonthlyCharges', round(avg("MonthlyCharges"), 6) FROM parted WHERE split = 'train'
           UNION ALL SELECT 'share', "Contract", round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) FROM parted WHERE split = 'train' GROUP BY 2
           UNION ALL SELECT 'weight', CAST("Churn" AS VARCHAR), round(sum(count(*)) OVER ()::DOUBLE / (2 * count(*)), 6)
             FROM parted WHERE split = 'train' GROUP BY 2""",
        SPLIT_SQL,
    ),
)
def raw_chain_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the loaded chain has learned from the training part: loyalty thresholds, contract shares, class weights."""
    _, loaded = raw_chain(spark, sf_dir)
    steps = {type(s).__name__: s for s in loaded.stages}
    means, shares, weights = (steps[n] for n in ("FeatureBuilderModel", "ShareEncoderModel", "ClassWeightsModel"))
    rows = [("mean", "tenure", means.getOrDefault("tenureMean")), ("mean", "MonthlyCharges", means.getOrDefault("chargeMean"))]
    rows += [("share", c, s) for c, s in zip(shares.getOrDefault("categories"), shares.getOrDefault("shares"))]
    rows += [("weight", "0", weights.getOrDefault("zero")), ("weight", "1", weights.getOrDefault("one"))]
    return spark.createDataFrame(rows, "kind string, key string, value double")


@query("saved_model_scores")
def saved_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw accounts to scored accounts through a chain that was saved and loaded again."""
    df = table(spark, sf_dir).withColumn(models.LABEL, q(config.LABEL))
    train = models.add_weights(df.filter(q("split") == "train"))
    total = train.agg(F.sum(models.WEIGHT)).first()[0]
    chain = models.churn_chain(config.SELECTED_FEATURES, "Logistic Regression", {"C": 1}, total)
    path = scratch(spark) + "/model"
    runs.save_model(chain.fit(train), path)
    loaded = runs.load_model(PipelineModel, path)
    scored = models.score(loaded, df.filter(q("split") == "test"), config.DECISION_THRESHOLD)
    return scored.select(config.KEY, models.LABEL, "probability", "prediction")
