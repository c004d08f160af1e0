"""Row-level queries: scans, cleaning, encoding, features, labels, splits."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura import config
from tenura.functions import columns as C
from tenura.functions.tables import q
from tenura.operators import cleaning, features, quality, segments, splits
from tenura.plans import dashboard, eda
from tenura.registry import inputs
from tenura.registry.account_sql import with_stage
from tenura.registry.book import query, register
from tenura.sources import accounts

KEY = config.KEY


def scratch(spark: SparkSession) -> str:
    """A fresh folder below the cluster's checkpoint folder; a local one only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        stamp = spark.sql("SELECT uuid()").first()[0]
        return f"{base.rstrip('/')}/tables-{stamp}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="tenura-tables-")


register("raw_accounts", inputs.raw, with_stage("raw", "SELECT * FROM raw"))
register("cleaned_accounts", inputs.cleaned, with_stage("cleaned", "SELECT * FROM cleaned"))
register("encoded_accounts", inputs.encoded, with_stage("encoded", "SELECT * FROM encoded"))
register(
    "featured_accounts",
    inputs.featured,
    with_stage(
        "featured",
        'SELECT * REPLACE (round("_Cost_Per_Service", 6) AS "_Cost_Per_Service") FROM featured',
    ),
)


@query("account_preview", with_stage("raw", 'SELECT * FROM raw ORDER BY "customerID" LIMIT 5'))
def account_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts.first_by_key(inputs.raw(spark, sf_dir))


@query("csv_round_trip", with_stage("raw", "SELECT * FROM raw"))
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark) + "/csv"
    accounts.write_table(inputs.raw(spark, sf_dir), path, "csv")
    return accounts.read_accounts(spark, path)


@query(
    "processed_round_trip",
    with_stage(
        "featured",
        'SELECT * REPLACE (round("_Cost_Per_Service", 6) AS "_Cost_Per_Service") FROM featured',
    ),
)
def processed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark) + "/processed"
    accounts.write_table(inputs.featured(spark, sf_dir), path)
    return accounts.read_table(spark, path)


@query(
    "numeric_coercion",
    with_stage("raw", 'SELECT "customerID", total FROM checked', inputs.DIRTY_SQL),
)
def numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = inputs.dirty(spark, sf_dir)
    return dirty.select(KEY, C.to_number(q("TotalCharges")).alias("total"))


@query(
    "null_fill",
    with_stage("raw", 'SELECT "customerID", coalesce(total, 0) AS total FROM checked', inputs.DIRTY_SQL),
)
def null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = inputs.dirty(spark, sf_dir)
    return dirty.select(KEY, C.fill_zero(C.to_number(q("TotalCharges"))).alias("total"))


@query(
    "padded_yes_no",
    with_stage(
        "raw",
        """SELECT "customerID", CASE trim("Partner") WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS "Partner"
           FROM (SELECT "customerID", ' ' || "Partner" || '  ' AS "Partner" FROM dirty) AS padded""",
        inputs.DIRTY_SQL,
    ),
)
def padded_yes_no(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = inputs.dirty(spark, sf_dir)
    padded = F.concat(F.lit(" "), q("Partner"), F.lit("  "))
    return dirty.select(KEY, C.trimmed_yes_no(padded).alias("Partner"))


_REJECTED = """SELECT '{c}' AS column_name, count(*) FILTER (WHERE {bad}) AS rejected FROM dirty"""


def _listed(column: str, values) -> str:
    return f'"{column}" IN (' + ", ".join(f"'{v}'" for v in values) + ")"


@query(
    "encode_rejects",
    with_stage(
        "raw",
        " UNION ALL ".join(
            [
                _REJECTED.format(c=c, bad=f"NOT coalesce({_listed(c, ok)}, false)")
                for c, ok in {
                    "gender": config.GENDER_CODES,
                    "PhoneService": config.YES_NO,
                    "PaperlessBilling": config.YES_NO,
                    **{c: config.TERNARY_CODES for c in config.TERNARY},
                }.items()
            ]
            + [
                _REJECTED.format(c=c, bad=f"NOT {_listed(c, ok)}")
                for c, ok in config.ONE_HOT.items()
            ]
        ),
        inputs.DIRTY_SQL,
    ),
)
def encode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.encode_rejects(inputs.dirty(spark, sf_dir))


@query(
    "lenient_gender_codes",
    with_stage(
        "raw",
        """SELECT "customerID", CASE gender WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 END AS gender,
           CASE "MultipleLines" WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No phone service' THEN 0 END AS "MultipleLines"
           FROM dirty""",
        inputs.DIRTY_SQL,
    ),
)
def lenient_gender_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.encode(inputs.dirty(spark, sf_dir), strict=False).select(
        KEY, "gender", "MultipleLines"
    )


@query(
    "one_hot_indicators",
    with_stage(
        "raw",
        """SELECT "customerID",
             CASE WHEN "InternetService" = 'Fiber optic' THEN 1 ELSE 0 END AS fiber,
             CASE WHEN "InternetService" = 'No' THEN 1 ELSE 0 END AS none,
             CASE WHEN "PaymentMethod" = 'Credit card (automatic)' THEN 1 ELSE 0 END AS credit,
             CASE WHEN "PaymentMethod" = 'Electronic check' THEN 1 ELSE 0 END AS e_check,
             CASE WHEN "PaymentMethod" = 'Mailed check' THEN 1 ELSE 0 END AS mailed
           FROM raw""",
    ),
)
def one_hot_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = inputs.raw(spark, sf_dir, KEY, "InternetService", "PaymentMethod")
    hot = df.select(q(KEY), *features.one_hot(df, config.ONE_HOT))
    return hot.toDF(KEY, "fiber", "none", "credit", "e_check", "mailed")


for _name, _column in {
    "addon_totals": config.ADDON_TOTAL,
    "autopay_flag": config.AUTO_PAY,
    "loyalty_flag": config.LOYALTY,
    "friction_flag": config.HIGH_FRICTION,
    "household_size": config.HOUSEHOLD,
}.items():
    register(
        _name,
        lambda spark, sf_dir, c=_column: inputs.featured(spark, sf_dir).select(KEY, q(c).alias("value")),
        with_stage("featured", f'SELECT "customerID", "{_column}" AS value FROM featured'),
    )


@query(
    "cost_per_service_or_null",
    with_stage(
        "featured",
        """SELECT "customerID", CASE WHEN isfinite("_Cost_Per_Service")
           THEN round("_Cost_Per_Service", 6) END AS cost FROM featured""",
    ),
)
def cost_per_service_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.add_engineered_features(inputs.encoded(spark, sf_dir), on_zero="null")
    return df.select(KEY, q(config.COST_PER_SERVICE).alias("cost"))


@query(
    "loyalty_flag_train_means",
    with_stage(
        "featured",
        """SELECT "customerID", CASE WHEN tenure > (SELECT avg(tenure) FROM halves WHERE split = 'train')
             AND "MonthlyCharges" < (SELECT avg("MonthlyCharges") FROM halves WHERE split = 'train')
             THEN 1 ELSE 0 END AS value FROM featured""",
        """
halves AS (SELECT *, CASE WHEN ('0x' || substr(md5('42|' || "customerID"), 1, 15))::BIGINT < 230584300921369395
                     THEN 'test' ELSE 'train' END AS split FROM featured)""",
    ),
)
def loyalty_flag_train_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = splits.train_test_split(inputs.encoded(spark, sf_dir))
    means = features.loyalty_means(df.filter(q("split") == "train"))
    return features.add_engineered_features(df, means).select(KEY, q(config.LOYALTY).alias("value"))


@query(
    "display_labels",
    with_stage(
        "featured",
        """SELECT "customerID",
             CASE "Contract" WHEN 'Month-to-month' THEN 'Month-to-Month' WHEN 'One year' THEN 'One Year'
                  WHEN 'Two year' THEN 'Two Year' ELSE "Contract" END AS "Contract_label",
             CASE "PaymentMethod_Electronic check" WHEN 1 THEN 'Elec. Check' WHEN 0 THEN 'Other' END AS elec_check,
             CASE WHEN "InternetService_Fiber optic" = 1 THEN 'Fiber Optic'
                  WHEN "InternetService_No" = 1 THEN 'No Internet' ELSE 'DSL' END AS inet_type,
             CASE "OnlineSecurity" WHEN 1 THEN 'Has Security' WHEN 0 THEN 'No Security' END AS sec_label,
             CASE WHEN tenure > 0 AND tenure <= 12 THEN '0-12 mo' WHEN tenure > 12 AND tenure <= 24 THEN '13-24 mo'
                  WHEN tenure > 24 AND tenure <= 48 THEN '25-48 mo' WHEN tenure > 48 AND tenure <= 72 THEN '49-72 mo'
                  END AS tenure_band,
             CASE "Churn" WHEN 1 THEN 'Churned' WHEN 0 THEN 'Retained' END AS status
           FROM featured""",
    ),
)
def display_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dashboard.load(inputs.featured(spark, sf_dir))
    return df.select(
        KEY, "Contract_label", "elec_check", "inet_type", "sec_label", "tenure_band", "status"
    )


@query(
    "tenure_and_charge_bands",
    with_stage(
        "cleaned",
        """SELECT "customerID",
             CASE WHEN tenure <= 12 THEN 'Under 1 year' WHEN tenure <= 24 THEN 'Between 1 and 2 years'
                  ELSE '2 or more years' END AS tenure_group,
             CASE WHEN tenure > 0 AND tenure <= 12 THEN '0–12m' WHEN tenure > 12 AND tenure <= 24 THEN '13–24m'
                  WHEN tenure > 24 AND tenure <= 48 THEN '25–48m' WHEN tenure > 48 AND tenure <= 72 THEN '49–72m'
                  END AS tenure_band,
             CASE WHEN "MonthlyCharges" > 0 AND "MonthlyCharges" <= 35 THEN 'Low'
                  WHEN "MonthlyCharges" > 35 AND "MonthlyCharges" <= 65 THEN 'Mid'
                  WHEN "MonthlyCharges" > 65 AND "MonthlyCharges" <= 90 THEN 'High'
                  WHEN "MonthlyCharges" > 90 AND "MonthlyCharges" <= 120 THEN 'Premium' END AS charge_band
           FROM cleaned""",
    ),
)
def tenure_and_charge_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = inputs.cleaned(spark, sf_dir, KEY, "tenure", "MonthlyCharges")
    return df.select(
        KEY,
        C.tenure_group(q("tenure")).alias("tenure_group"),
        C.band(q("tenure"), config.TENURE_EDGES, config.TENURE_LABELS).alias("tenure_band"),
        C.band(q("MonthlyCharges"), config.CHARGE_EDGES, config.CHARGE_LABELS).alias("charge_band"),
    )


@query(
    "risk_scores",
    with_stage("featured", 'SELECT "customerID", risk_score, risk FROM segmented', inputs.RISK_SQL),
)
def risk_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.with_risk(inputs.featured(spark, sf_dir)).select(KEY, "risk_score", "risk")


@query(
    "risk_scores_numeric_contract",
    with_stage(
        "featured",
        """SELECT "customerID",
             risk_score + CASE WHEN contains("Contract", 'Month') THEN 0 ELSE 3 END AS risk_score
           FROM segmented""",
        inputs.RISK_SQL,
    ),
)
def risk_scores_numeric_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract as a share below 1: its whole part is 0, which scores for every account."""
    df = splits.apply_shares(
        inputs.featured(spark, sf_dir),
        splits.category_shares(inputs.raw(spark, sf_dir, "Contract"), "Contract"),
        "Contract",
    )
    return segments.with_risk(df).select(KEY, "risk_score")


@query(
    "threshold_predictions",
    with_stage(
        "featured",
        """SELECT "customerID", "Model", CASE WHEN probability >= 0.55 THEN 1 ELSE 0 END AS flagged FROM rules""",
        inputs.RULES_SQL,
    ),
)
def threshold_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tenura.operators.metrics import at_threshold

    df = inputs.rule_scores(spark, sf_dir)
    return df.select(KEY, "Model", at_threshold(F.col("probability")).alias("flagged"))


@query(
    "charge_texts",
    with_stage(
        "cleaned",
        """SELECT "customerID", substr(CAST("Contract" AS VARCHAR), 1, 5) AS clipped,
             (CASE WHEN c % 8 > 4 OR (c % 8 = 4 AND (c // 8) % 2 = 1) THEN c // 8 + 1 ELSE c // 8 END) / 100.0 AS eighth
           FROM (SELECT *, CAST(round("TotalCharges" * 100) AS BIGINT) AS c FROM cleaned) AS t""",
    ),
)
def charge_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clipped text and half-even rounding; the SQL rounds whole cents, so ties are exact."""
    df = inputs.cleaned(spark, sf_dir, KEY, "Contract", "TotalCharges")
    return df.select(
        KEY,
        C.clip_text(q("Contract"), 5).alias("clipped"),
        F.bround(q("TotalCharges") / 8, 2).alias("eighth"),
    )


@query(
    "numeric_points_long",
    with_stage(
        "cleaned",
        " UNION ALL ".join(
            f"""SELECT "Churn", '{c}' AS column_name, CAST("{c}" AS DOUBLE) AS value FROM cleaned"""
            for c in config.NUMERIC
        ),
    ),
)
def numeric_points_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.numeric_points(inputs.cleaned(spark, sf_dir, *config.NUMERIC, "Churn"))


@query(
    "pair_points",
    with_stage(
        "cleaned",
        """SELECT tenure, "MonthlyCharges", "TotalCharges",
             CASE "Churn" WHEN 1 THEN 'Churn' WHEN 0 THEN 'No Churn' END AS "Churn_label" FROM cleaned""",
    ),
)
def pair_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.pair_points(inputs.cleaned(spark, sf_dir, *config.NUMERIC, "Churn"))


@query(
    "missing_total_rows",
    with_stage(
        "raw",
        """SELECT "customerID", tenure, "MonthlyCharges", "Contract", "Churn" FROM checked WHERE total IS NULL""",
        inputs.DIRTY_SQL,
    ),
)
def missing_total_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_total_rows(inputs.dirty(spark, sf_dir))


@query(
    "sample_missing_total",
    with_stage(
        "raw",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, CAST("{c}" AS VARCHAR) AS value FROM first_bad"""
            for c in config.RAW_SCHEMA.fieldNames()
        ),
        inputs.DIRTY_SQL,
        """
first_bad AS (SELECT * FROM checked WHERE total IS NULL ORDER BY "customerID" NULLS FIRST LIMIT 1)""",
    ),
)
def sample_missing_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sample_missing_total(inputs.dirty(spark, sf_dir))


# ---- splits -------------------------------------------------------------------------

HASH_SQL = """('0x' || substr(md5('{seed}|' || "customerID"), 1, 15))::BIGINT"""
FIFTHS = [(i << 60) // 5 for i in range(1, 5)]
SPLIT_SQL = f"""
parted AS (
  SELECT *, CASE WHEN {HASH_SQL.format(seed=42)} < {FIFTHS[0]} THEN 'test' ELSE 'train' END AS split
  FROM featured
)"""

FOLDS_SQL = f"""
folded AS (
  SELECT *, CASE WHEN h < {FIFTHS[0]} THEN 0 WHEN h < {FIFTHS[1]} THEN 1 WHEN h < {FIFTHS[2]} THEN 2
                 WHEN h < {FIFTHS[3]} THEN 3 ELSE 4 END AS fold
  FROM (SELECT *, {HASH_SQL.format(seed=43)} AS h FROM parted) AS t
)"""


@query(
    "hash_split",
    with_stage("featured", 'SELECT "customerID", "Churn", split FROM parted', SPLIT_SQL),
)
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = splits.train_test_split(inputs.cleaned(spark, sf_dir, KEY, "Churn"))
    return df.select(KEY, "Churn", "split")


def _exact_sql(seed: int) -> str:
    """Rows in hash order per class, and the sizes of the classes."""
    return f"""
hashed AS (SELECT "customerID", "Churn", {HASH_SQL.format(seed=seed)} AS h FROM cleaned),
placed AS (SELECT *, row_number() OVER (PARTITION BY "Churn" ORDER BY h) AS place FROM hashed),
sizes AS (SELECT "Churn", count(*) AS size, sum(count(*)) OVER () AS whole FROM placed GROUP BY 1)"""


@query(
    "exact_split",
    with_stage(
        "cleaned",
        """SELECT "customerID", "Churn", CASE WHEN place <= take THEN 'test' ELSE 'train' END AS split
           FROM placed JOIN taken USING ("Churn")""",
        _exact_sql(42),
        """
wanted AS (SELECT "Churn", ceil(whole * 0.2) AS total_take, size * ceil(whole * 0.2) / whole AS exact_take FROM sizes),
taken AS (
  SELECT "Churn", floor(exact_take) + CASE WHEN row_number() OVER (
      ORDER BY exact_take - floor(exact_take) DESC, CAST("Churn" AS VARCHAR))
      <= total_take - sum(floor(exact_take)) OVER () THEN 1 ELSE 0 END AS take
  FROM wanted
)""",
    ),
)
def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = splits.train_test_split(inputs.cleaned(spark, sf_dir, KEY, "Churn"), mode="exact")
    return df.select(KEY, "Churn", "split")


@query(
    "hash_folds",
    with_stage(
        "cleaned",
        f"""SELECT "customerID", "Churn", CASE WHEN h < {FIFTHS[0]} THEN 0 WHEN h < {FIFTHS[1]} THEN 1
              WHEN h < {FIFTHS[2]} THEN 2 WHEN h < {FIFTHS[3]} THEN 3 ELSE 4 END AS fold
            FROM (SELECT "customerID", "Churn", {HASH_SQL.format(seed=43)} AS h FROM cleaned) AS t""",
    ),
)
def hash_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = splits.assign_folds(inputs.cleaned(spark, sf_dir, KEY, "Churn"))
    return df.select(KEY, "Churn", "fold")


@query(
    "exact_fold_sizes",
    with_stage(
        "cleaned",
        """SELECT "Churn", fold, count(*) AS rows FROM (
             SELECT "Churn", CASE WHEN place <= c0 THEN 0 WHEN place <= c1 THEN 1 WHEN place <= c2 THEN 2
                                  WHEN place <= c3 THEN 3 ELSE 4 END AS fold
             FROM placed JOIN cuts USING ("Churn")) AS t GROUP BY 1, 2""",
        _exact_sql(43),
        """
shares AS (SELECT unnest([1, 2, 3, 4]) AS j),
wanted AS (SELECT "Churn", j, ceil(whole * j / 5) AS total_take, size * ceil(whole * j / 5) / whole AS exact_take
           FROM sizes, shares),
taken AS (
  SELECT "Churn", j, floor(exact_take) + CASE WHEN row_number() OVER (
      PARTITION BY j ORDER BY exact_take - floor(exact_take) DESC, CAST("Churn" AS VARCHAR))
      <= total_take - sum(floor(exact_take)) OVER (PARTITION BY j) THEN 1 ELSE 0 END AS take
  FROM wanted
),
cuts AS (SELECT "Churn", max(take) FILTER (WHERE j = 1) AS c0, max(take) FILTER (WHERE j = 2) AS c1,
                max(take) FILTER (WHERE j = 3) AS c2, max(take) FILTER (WHERE j = 4) AS c3
         FROM taken GROUP BY 1)""",
    ),
)
def exact_fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = splits.assign_folds(inputs.cleaned(spark, sf_dir, KEY, "Churn"), mode="exact")
    return df.groupBy("Churn", "fold").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "split_overlap",
    with_stage(
        "featured",
        """SELECT (SELECT count(*) FROM parted WHERE split = 'train' AND "customerID" IN
                     (SELECT "customerID" FROM parted WHERE split = 'test')) AS shared,
                  (SELECT count(*) FROM featured WHERE "customerID" NOT IN
                     (SELECT "customerID" FROM parted WHERE split IN ('train', 'test'))) AS uncovered""",
        SPLIT_SQL,
    ),
)
def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = inputs.cleaned(spark, sf_dir, KEY, "Churn")
    parts = splits.train_test_split(whole)
    train, test = parts.filter(q("split") == "train"), parts.filter(q("split") == "test")
    shared = splits.overlap(train, test).agg(F.count(F.lit(1)).alias("shared"))
    missed = splits.uncovered(whole, parts).agg(F.count(F.lit(1)))
    return shared.withColumn("uncovered", missed.scalar())


@query(
    "contract_frequency",
    with_stage(
        "featured",
        """SELECT "customerID", split, round(share, 6) AS "Contract" FROM parted
           LEFT JOIN (SELECT "Contract", count(*)::DOUBLE / sum(count(*)) OVER () AS share
                      FROM parted WHERE split = 'train' GROUP BY 1) AS f USING ("Contract")""",
        SPLIT_SQL,
    ),
)
def contract_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = splits.train_test_split(inputs.cleaned(spark, sf_dir, KEY, "Contract", "Churn"))
    return splits.frequency_encode(df).select(KEY, "split", "Contract")


@query(
    "dropped_feature_columns",
    with_stage(
        "featured",
        'SELECT * EXCLUDE ("TotalCharges", "_Household_Stability") REPLACE '
        '(round("_Cost_Per_Service", 6) AS "_Cost_Per_Service") FROM featured',
    ),
)
def dropped_feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tenura.operators.correlation import drop_correlated

    df = inputs.featured(spark, sf_dir)
    return drop_correlated(df, df.columns)[0]


@query(
    "selected_feature_columns",
    with_stage(
        "featured",
        'SELECT "customerID", '
        + ", ".join(
            f'round("{c}", 6) AS "{c}"' if c == config.COST_PER_SERVICE else f'"{c}"'
            for c in config.SELECTED_FEATURES
        )
        + " FROM featured",
    ),
)
def selected_feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tenura.operators.correlation import select_features

    df = inputs.featured(spark, sf_dir)
    return df.select(KEY, *[q(c) for c in select_features(df, [])])


@query(
    "cleaning_summary",
    with_stage(
        "cleaned",
        """SELECT count(*) AS row_count, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM cleaned))
             AS duplicate_rows, count(DISTINCT "customerID") AS distinct_keys FROM cleaned""",
    ),
)
def cleaning_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaning_summary(inputs.cleaned(spark, sf_dir))
