"""Aggregating queries: quality rules, profiles, rates, correlations, dashboards, metrics."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura import config
from tenura.functions import columns as C
from tenura.functions.tables import materialize, q
from tenura.operators import (
    correlation, metrics, ordered, profile, quality, rates, segments, selection, splits,
)
from tenura.plans import dashboard, eda, validation
from tenura.registry import inputs
from tenura.registry.account_sql import with_stage
from tenura.registry.book import ORACLES, query, register
from tenura.registry.rows import SPLIT_SQL, scratch
from tenura.sources import accounts

NUM = config.NUMERIC
LABEL = config.LABEL

# ---- quality ------------------------------------------------------------------------


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


ACCURACY = {
    **{
        f"domain:{c}": f'NOT coalesce("{c}" IN ({_in_list(v)}), false)'
        for c, v in config.DOMAINS.items()
    },
    "negative:tenure": "tenure < 0",
    "negative:MonthlyCharges": '"MonthlyCharges" < 0',
    "negative:TotalCharges": "total < 0",
    "missing:TotalCharges": "total IS NULL",
    "format:customerID": """NOT regexp_full_match(coalesce("customerID", 'nan'), '[0-9A-Za-z-]+')""",
}
CONSISTENCY = {
    "no_internet_but_addon": "coalesce(\"InternetService\" = 'No', false) AND ("
    + " OR ".join(f"""coalesce("{c}" <> 'No internet service', true)""" for c in config.ADDONS)
    + ")",
    "no_phone_but_lines": """coalesce("PhoneService" = 'No', false)
        AND coalesce("MultipleLines" <> 'No phone service', true)""",
    "internet_but_none_marked": """coalesce("InternetService" <> 'No', true)
        AND (coalesce("OnlineSecurity" = 'No internet service', false)
             OR coalesce("OnlineBackup" = 'No internet service', false))""",
    "tenure_without_total": "tenure > 0 AND total IS NULL",
}
COMPLETENESS = {f"null:{c}": f'"{c}" IS NULL' for c in config.RAW_SCHEMA.fieldNames()}


def _rules_sql(rules: dict[str, str]) -> str:
    cells = ", ".join(f'count(*) FILTER (WHERE {cond}) AS "{name}"' for name, cond in rules.items())
    rows = " UNION ALL ".join(
        f"""SELECT '{name}' AS rule, "{name}" AS bad_rows FROM one_row""" for name in rules
    )
    return with_stage("raw", rows, inputs.DIRTY_SQL, f"\none_row AS (SELECT {cells} FROM checked)")


register(
    "quality_accuracy",
    lambda s, d: quality.check_accuracy(inputs.dirty(s, d)),
    _rules_sql(ACCURACY),
)
register(
    "quality_consistency",
    lambda s, d: quality.check_consistency(inputs.dirty(s, d)),
    _rules_sql(CONSISTENCY),
)
register(
    "quality_completeness",
    lambda s, d: quality.check_completeness(inputs.dirty(s, d)),
    _rules_sql(COMPLETENESS),
)
register(
    "quality_report",
    lambda s, d: quality.dq_report(inputs.dirty(s, d)),
    _rules_sql(ACCURACY | CONSISTENCY | COMPLETENESS),
)
register(
    "quality_report_clean_input",
    lambda s, d: quality.dq_report(inputs.raw(s, d)),
    _rules_sql(ACCURACY | CONSISTENCY | COMPLETENESS)
    .replace("FROM dirty\n)", "FROM raw\n)"),
)
register(
    "null_percent",
    lambda s, d: quality.null_percent(inputs.dirty(s, d)),
    with_stage(
        "raw",
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name,
                round(count(*) FILTER (WHERE "{c}" IS NULL)::DOUBLE / count(*) * 100, 6) AS null_pct FROM dirty"""
            for c in config.RAW_SCHEMA.fieldNames()
        )
        + ") AS t WHERE null_pct > 0",
        inputs.DIRTY_SQL,
    ),
)
register(
    "new_customers_only",
    lambda s, d: quality.new_customers_only(inputs.dirty(s, d)).unionByName(
        quality.new_customers_only(inputs.raw(s, d, "tenure", "TotalCharges"))
    ),
    with_stage(
        "raw",
        """SELECT count(*) FILTER (WHERE total IS NULL) AS missing_total,
             coalesce(bool_and(tenure = 0) FILTER (WHERE total IS NULL), true) AS all_new FROM checked
           UNION ALL
           SELECT count(*) FILTER (WHERE t IS NULL), coalesce(bool_and(tenure = 0) FILTER (WHERE t IS NULL), true)
           FROM (SELECT tenure, TRY_CAST(trim("TotalCharges") AS DOUBLE) AS t FROM raw) AS u""",
        inputs.DIRTY_SQL,
    ),
)
register(
    "duplicate_rows",
    lambda s, d: quality.duplicate_rows(inputs.repeated(s, d)),
    with_stage(
        "raw",
        """SELECT (SELECT count(*) FROM repeated) - (SELECT count(*) FROM (SELECT DISTINCT * FROM repeated) AS t)
             AS duplicate_rows""",
        inputs.DIRTY_SQL,
        inputs.REPEATED_SQL,
    ),
)
register(
    "duplicate_keys",
    lambda s, d: quality.duplicate_keys(inputs.dirty(s, d)),
    with_stage(
        "raw",
        """SELECT count(*) - count(DISTINCT "customerID") - CASE WHEN count(*) > count("customerID") THEN 1 ELSE 0 END
           AS duplicate_keys FROM dirty""",
        inputs.DIRTY_SQL,
    ),
)
register(
    "null_assertion",
    lambda s, d: quality.require_no_nulls(inputs.featured(s, d)),
    with_stage(
        "featured",
        """SELECT CAST(sum(nulls) AS BIGINT) AS nulls FROM (
             SELECT count(*) - count(COLUMNS(*)) FROM featured) AS t
           UNPIVOT (nulls FOR column_name IN (COLUMNS(*)))""",
    ),
)

# ---- profiles -----------------------------------------------------------------------

LONG = """
long AS (SELECT column_name, value FROM (SELECT tenure::DOUBLE AS tenure, "MonthlyCharges", "TotalCharges" FROM {t})
         UNPIVOT (value FOR column_name IN (tenure, "MonthlyCharges", "TotalCharges")))"""


def _long_sql(stage: str, body: str, *extra: str) -> str:
    return with_stage(stage, body, LONG.format(t=stage), *extra)


register(
    "describe_numeric",
    lambda s, d: profile.describe(inputs.cleaned(s, d, *NUM)),
    _long_sql(
        "cleaned",
        """SELECT column_name, count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
             min(value) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
             round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max FROM long GROUP BY 1""",
    ),
)
register(
    "skewness_and_kurtosis",
    lambda s, d: profile.shape(inputs.cleaned(s, d, *NUM)),
    _long_sql(
        "cleaned",
        """SELECT column_name, round(skewness(value), 6) AS skewness, round(kurtosis(value), 6) AS kurtosis
           FROM long GROUP BY 1""",
    ),
)
FENCES = """
fences AS (
  SELECT *, q3 - q1 AS iqr, q1 - 1.5::DOUBLE * (q3 - q1) AS lower_bound, q3 + 1.5::DOUBLE * (q3 - q1) AS upper_bound
  FROM (SELECT {keys}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
               quantile_cont(value, 0.75) AS q3 FROM {src} GROUP BY {keys})
)"""
BOX = """SELECT {keys}, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
  round(any_value(q3), 6) AS q3, round(any_value(iqr), 6) AS iqr, round(any_value(lower_bound), 6) AS lower_bound,
  round(any_value(upper_bound), 6) AS upper_bound, count(*) AS count,
  round(min(value) FILTER (WHERE value BETWEEN lower_bound AND upper_bound), 6) AS whisker_low,
  round(max(value) FILTER (WHERE value BETWEEN lower_bound AND upper_bound), 6) AS whisker_high,
  count(*) FILTER (WHERE value < lower_bound OR value > upper_bound) AS outliers
  FROM {src} JOIN fences USING ({keys}) GROUP BY {keys}"""


def _box_sql(stage: str, columns: list[str], by: dict[str, str], where: str = "true", *extra: str) -> str:
    """Box statistics of columns per group; ``by`` maps output names to SQL expressions."""
    ids = "".join(f', {expr} AS "{name}"' for name, expr in by.items())
    src = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name{ids}, CAST("{c}" AS DOUBLE) AS value FROM {stage} WHERE {where}"""
        for c in columns
    )
    keys = ", ".join(["column_name", *[f'"{n}"' for n in by]])
    base = stage if stage in ("raw", "coerced", "cleaned", "encoded", "featured") else "featured"
    return with_stage(
        base, BOX.format(keys=keys, src="points"), *extra, f"\npoints AS ({src})",
        FENCES.format(keys=keys, src="points"),
    )


STATUS = """CASE "Churn" WHEN 1 THEN 'Churned' WHEN 0 THEN 'Retained' END"""
CHURN_LABEL = """CASE "Churn" WHEN 1 THEN 'Churn' WHEN 0 THEN 'No Churn' END"""
INET = """CASE WHEN "InternetService_Fiber optic" = 1 THEN 'Fiber Optic'
          WHEN "InternetService_No" = 1 THEN 'No Internet' ELSE 'DSL' END"""
CONTRACT = """CASE "Contract" WHEN 'Month-to-month' THEN 'Month-to-Month' WHEN 'One year' THEN 'One Year'
              WHEN 'Two year' THEN 'Two Year' ELSE "Contract" END"""
CHECK = """CASE "PaymentMethod_Electronic check" WHEN 1 THEN 'Elec. Check' WHEN 0 THEN 'Other' END"""
SECURITY = """CASE "OnlineSecurity" WHEN 1 THEN 'Has Security' WHEN 0 THEN 'No Security' END"""
BAND_LONG = """CASE WHEN tenure > 0 AND tenure <= 12 THEN '0-12 mo' WHEN tenure > 12 AND tenure <= 24 THEN '13-24 mo'
  WHEN tenure > 24 AND tenure <= 48 THEN '25-48 mo' WHEN tenure > 48 AND tenure <= 72 THEN '49-72 mo' END"""

register(
    "iqr_outliers",
    lambda s, d: profile.iqr_outliers(inputs.cleaned(s, d, *NUM)),
    with_stage(
        "cleaned",
        """SELECT column_name, round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
             round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound,
             (SELECT count(*) FROM points WHERE value < lower_bound OR value > upper_bound) AS outliers FROM fences""",
        """
points AS (SELECT 'TotalCharges' AS column_name, "TotalCharges" AS value FROM cleaned)""",
        FENCES.format(keys="column_name", src="points"),
    ),
)
register(
    "outlier_rows",
    lambda s, d: profile.outlier_rows(inputs.cleaned(s, d, "customerID", "MonthlyCharges"), "MonthlyCharges"),
    with_stage(
        "cleaned",
        """SELECT "customerID", "MonthlyCharges" FROM cleaned, fences
           WHERE "MonthlyCharges" < lower_bound OR "MonthlyCharges" > upper_bound""",
        """
points AS (SELECT 'MonthlyCharges' AS column_name, "MonthlyCharges" AS value FROM cleaned)""",
        FENCES.format(keys="column_name", src="points"),
    ),
)
register("numeric_boxes", lambda s, d: eda.numeric_boxes(inputs.cleaned(s, d, *NUM)), _box_sql("cleaned", NUM, {}))
register(
    "charge_boxes_by_churn",
    lambda s, d: eda.charges_by_churn_boxes(inputs.cleaned(s, d, "MonthlyCharges", "TotalCharges", LABEL)),
    _box_sql("cleaned", ["MonthlyCharges", "TotalCharges"], {"Churn_label": CHURN_LABEL}),
)
register(
    "charge_boxes_by_internet",
    lambda s, d: eda.internet_charges(inputs.cleaned(s, d, "MonthlyCharges", "InternetService")),
    _box_sql("cleaned", ["MonthlyCharges"], {"InternetService": '"InternetService"'}),
)
register(
    "charge_boxes_by_addons_and_churn",
    lambda s, d: eda.addon_boxes(inputs.featured(s, d)),
    _box_sql(
        "featured", ["MonthlyCharges"],
        {"_Total_AddOns-Services": '"_Total_AddOns-Services"', "Churn": '"Churn"'},
    ),
)
register(
    "cost_boxes_by_churn",
    lambda s, d: eda.cost_boxes(inputs.featured(s, d)),
    _box_sql(
        "featured", ["_Cost_Per_Service"], {"Churn": '"Churn"'}, 'isfinite("_Cost_Per_Service")'
    ),
)
register(
    "dashboard_boxes_by_status",
    lambda s, d: dashboard.churn_boxes(dashboard.load(inputs.cleaned(s, d, "tenure", "TotalCharges", LABEL))),
    _box_sql("cleaned", ["tenure", "TotalCharges"], {"status": STATUS}),
)
register(
    "dashboard_boxes_by_internet",
    lambda s, d: dashboard.internet_boxes(dashboard.load(inputs.encoded(s, d))),
    _box_sql("encoded", ["MonthlyCharges"], {"inet_type": INET}),
)

HIST = """
span AS (SELECT column_name, bins, lo, hi, (hi - lo) / bins AS w FROM ({span})),
placed AS (
  SELECT *, i - CASE WHEN value < lo + i * w THEN 1 ELSE 0 END
           + CASE WHEN value >= lo + (i + 1) * w AND i < bins - 1 THEN 1 ELSE 0 END AS bin
  FROM (SELECT *, CAST(least(floor((value - lo) / w), bins - 1) AS INTEGER) AS i FROM points JOIN span USING (column_name))
),
every_bin AS (SELECT *, unnest(range(bins)) AS bin FROM span)"""
FIXED_SPAN = "SELECT column_name, {n} AS bins, min(value) AS lo, max(value) AS hi FROM points GROUP BY 1"
AUTO_SPAN = """
SELECT column_name, lo, hi, CAST(ceil((hi - lo) / CASE WHEN fd > 0 THEN least(fd, st) ELSE st END) AS INTEGER) AS bins
FROM (SELECT column_name, min(value) AS lo, max(value) AS hi,
        2 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / pow(count(*), 1.0::DOUBLE / 3) AS fd,
        (max(value) - min(value)) / (log2(count(*)) + 1) AS st FROM points GROUP BY 1)"""
HIST_OUT = """SELECT column_name, CAST(bin AS INTEGER) AS bin, round(lo + bin * w, 6) AS bin_start,
  round(lo + (bin + 1) * w, 6) AS bin_end, coalesce(c, 0) AS count
  FROM every_bin LEFT JOIN (SELECT column_name, bin, count(*) AS c FROM placed GROUP BY 1, 2) AS t
  USING (column_name, bin)"""
NUM_POINTS = "\npoints AS (SELECT * FROM long)"

register(
    "histogram_ten_bins",
    lambda s, d: eda.numeric_histograms(inputs.cleaned(s, d, *NUM), 10),
    _long_sql("cleaned", HIST_OUT, NUM_POINTS, HIST.format(span=FIXED_SPAN.format(n=10))),
)
register(
    "histogram_automatic_bins",
    lambda s, d: eda.numeric_histograms(inputs.cleaned(s, d, *NUM)),
    _long_sql("cleaned", HIST_OUT, NUM_POINTS, HIST.format(span=AUTO_SPAN)),
)
register(
    "histogram_by_status",
    lambda s, d: dashboard.charge_histogram(dashboard.load(inputs.cleaned(s, d, "MonthlyCharges", LABEL))),
    with_stage(
        "cleaned",
        """SELECT column_name, status, CAST(bin AS INTEGER) AS bin, round(lo + bin * w, 6) AS bin_start,
             round(lo + (bin + 1) * w, 6) AS bin_end, coalesce(c, 0) AS count
           FROM every_bin CROSS JOIN (SELECT DISTINCT status FROM points) AS g
           LEFT JOIN (SELECT column_name, status, bin, count(*) AS c FROM placed GROUP BY 1, 2, 3) AS t
           USING (column_name, status, bin)""",
        f"""
points AS (SELECT 'MonthlyCharges' AS column_name, {STATUS} AS status, "MonthlyCharges" AS value FROM cleaned)""",
        HIST.format(span=FIXED_SPAN.format(n=40)),
    ),
)


def _density_sql(stage: str, column: str, group: str, common: bool = False, cut: int = 3) -> str:
    weight = "(SELECT count(*) FROM points)" if common else "m"
    return with_stage(
        stage,
        f"""SELECT "group", point, round(any_value(start + point * step), 6) AS x,
             round(sum(exp(-0.5::DOUBLE * pow((start + point * step - value) / bw, 2)))
                   / (any_value({weight}) * any_value(bw) * sqrt(2 * pi())), 6) AS density
           FROM points JOIN stats USING ("group"), (SELECT unnest(range(200))::INTEGER AS point) AS grid
           GROUP BY 1, 2""",
        f"""
points AS (SELECT CAST({group} AS VARCHAR) AS "group", CAST("{column}" AS DOUBLE) AS value
           FROM {stage} WHERE isfinite(CAST("{column}" AS DOUBLE))),
stats AS (
  SELECT *, lo - {cut} * bw AS start, (hi + {cut} * bw - (lo - {cut} * bw)) / 199 AS step
  FROM (SELECT "group", count(*) AS m, pow(count(*), -0.2::DOUBLE) * stddev_samp(value) AS bw, min(value) AS lo,
               max(value) AS hi FROM points GROUP BY 1)
)""",
    )


register(
    "density_monthly_by_churn",
    lambda s, d: eda.monthly_density(inputs.cleaned(s, d, "MonthlyCharges", LABEL)),
    _density_sql("cleaned", "MonthlyCharges", CHURN_LABEL),
)
register(
    "density_total_by_churn",
    lambda s, d: eda.total_density(inputs.cleaned(s, d, "TotalCharges", LABEL)),
    _density_sql("cleaned", "TotalCharges", CHURN_LABEL),
)
register(
    "density_tenure_common_norm",
    lambda s, d: eda.pair_density(inputs.cleaned(s, d, "tenure", LABEL), "tenure"),
    _density_sql("cleaned", "tenure", CHURN_LABEL, common=True),
)
register(
    "density_cost_by_churn",
    lambda s, d: eda.cost_density(inputs.featured(s, d)),
    _density_sql("featured", "_Cost_Per_Service", '"Churn"'),
)
register(
    "density_monthly_within_range",
    lambda s, d: eda.numeric_density(inputs.cleaned(s, d, "MonthlyCharges"), "MonthlyCharges"),
    _density_sql("cleaned", "MonthlyCharges", "'all'", cut=0),
)
register(
    "density_tenure_overall",
    lambda s, d: profile.kernel_density(inputs.cleaned(s, d, "tenure"), "tenure"),
    _density_sql("cleaned", "tenure", "'all'"),
)

# ---- ranks and correlation ----------------------------------------------------------


@query(
    "average_ranks",
    _long_sql(
        "cleaned",
        """SELECT column_name, value, n, sum(n) OVER (PARTITION BY column_name ORDER BY value)::DOUBLE
             - n + (n + 1) / 2.0::DOUBLE AS rank
           FROM (SELECT column_name, value, count(*) AS n FROM long GROUP BY 1, 2) AS t""",
    ),
)
def average_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = profile.to_long(inputs.cleaned(spark, sf_dir, *NUM), NUM)
    counts = ordered.ordered_counts(long, "value", ["column_name"])
    return counts.select("column_name", "value", "n", ordered.average_rank().alias("rank"))


def _pearson_sql(stage: str, pairs, digits: int = 6) -> str:
    return with_stage(
        stage,
        " UNION ALL ".join(
            f"""SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr("{a}", "{b}"), {digits}) AS corr FROM {stage}"""
            for a, b in pairs
        ),
    )


def _spearman_sql(stage: str, pairs, tail: str = "SELECT * FROM rho", src: str | None = None, *extra: str) -> str:
    """Average ranks among the rows where both columns are present, then Pearson."""
    src = src or stage

    def one(a: str, b: str) -> str:
        both = f"""(SELECT CAST("{a}" AS DOUBLE) AS x, CAST("{b}" AS DOUBLE) AS y FROM {src}
                    WHERE "{a}" IS NOT NULL AND "{b}" IS NOT NULL)"""
        return f"""SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(rx, ry), 6) AS corr FROM (
            SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0::DOUBLE AS rx,
                   rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0::DOUBLE AS ry FROM {both})"""

    rho = "\nrho AS (" + " UNION ALL ".join(one(a, b) for a, b in pairs) + ")"
    return with_stage(stage, tail, *extra, rho)


register(
    "pearson_numeric",
    lambda s, d: correlation.pearson(inputs.cleaned(s, d, *NUM), NUM),
    _pearson_sql("cleaned", list(combinations(NUM, 2))),
)
register(
    "pearson_triangle",
    lambda s, d: correlation.pearson(inputs.cleaned(s, d, *eda.CORRELATED), eda.CORRELATED),
    _pearson_sql("cleaned", list(combinations(eda.CORRELATED, 2))),
)


def _coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = inputs.raw(spark, sf_dir, *NUM)
    return df.select("tenure", "MonthlyCharges", C.to_number(q("TotalCharges")).alias("TotalCharges"))


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric columns in which the cheapest accounts lack a total."""
    return inputs.dirty(spark, sf_dir).select(
        "tenure", "MonthlyCharges", C.to_number(q("TotalCharges")).alias("total")
    )


register(
    "spearman_numeric",
    lambda s, d: correlation.spearman(_coerced(s, d), NUM),
    _spearman_sql("coerced", list(combinations(NUM, 2))),
)
register(
    "spearman_with_missing",
    lambda s, d: correlation.spearman(_with_gaps(s, d), ["tenure", "MonthlyCharges", "total"]),
    _spearman_sql(
        "raw", list(combinations(["tenure", "MonthlyCharges", "total"], 2)), "SELECT * FROM rho",
        "checked", inputs.DIRTY_SQL,
    ),
)
register(
    "spearman_triangle",
    lambda s, d: correlation.spearman(inputs.cleaned(s, d, *eda.CORRELATED), eda.CORRELATED),
    _spearman_sql("cleaned", list(combinations(eda.CORRELATED, 2))),
)
_DASH = dashboard.CORRELATED
register(
    "dashboard_correlations",
    lambda s, d: dashboard.correlations(inputs.encoded(s, d)),
    _spearman_sql(
        "encoded", list(combinations(_DASH, 2)),
        "SELECT col_a, "
        + ", ".join(f"""max(corr) FILTER (WHERE col_b = '{c}') AS "{c}" """ for c in _DASH)
        + """ FROM (SELECT * FROM rho UNION ALL SELECT col_b, col_a, corr FROM rho UNION ALL
              SELECT c, c, 1.0::DOUBLE FROM (SELECT unnest(["""
        + ", ".join(f"'{c}'" for c in _DASH)
        + "]) AS c)) AS sq GROUP BY 1",
    ),
)
register(
    "dashboard_churn_correlations",
    lambda s, d: dashboard.churn_correlations(inputs.encoded(s, d)),
    _spearman_sql(
        "encoded", [(c, LABEL) for c in _DASH if c != LABEL], "SELECT col_a AS feature, corr FROM rho"
    ),
)

# the numeric feature columns, with the contract text as its training share
FEATURES = [
    "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService", "MultipleLines",
    *config.ADDONS, "Contract", "PaperlessBilling", "MonthlyCharges", "TotalCharges", config.FIBER,
    config.NO_INTERNET, config.CREDIT_CARD, config.ELECTRONIC_CHECK, config.MAILED_CHECK,
    config.ADDON_TOTAL, config.COST_PER_SERVICE, config.AUTO_PAY, config.LOYALTY,
    config.HIGH_FRICTION, config.HOUSEHOLD,
]
TRAIN_SQL = (
    SPLIT_SQL
    + """,
shares AS (SELECT "Contract", count(*)::DOUBLE / sum(count(*)) OVER () AS share
           FROM parted WHERE split = 'train' GROUP BY 1),
train AS (SELECT parted.* REPLACE (share AS "Contract") FROM parted JOIN shares USING ("Contract")
          WHERE split = 'train')"""
)


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows, computed once because the correlations pass over them several times."""
    parts = splits.train_test_split(inputs.featured(spark, sf_dir))
    train = parts.filter(q("split") == "train").withColumn("split", F.lit("train"))
    return materialize(splits.frequency_encode(materialize(train)))


register(
    "correlated_features",
    lambda s, d: correlation.correlated_with_earlier(train_rows(s, d), FEATURES),
    _spearman_sql(
        "featured", list(combinations(FEATURES, 2)),
        "SELECT col_b AS feature, max(abs(corr)) AS max_abs_corr FROM rho WHERE abs(corr) > 0.85 GROUP BY 1",
        "train", TRAIN_SQL,
    ),
)
_KEPT = [c for c in FEATURES if c not in config.DROPPED_FEATURES]
register(
    "spearman_with_churn",
    lambda s, d: correlation.with_target(train_rows(s, d), _KEPT),
    _spearman_sql(
        "featured", [(c, LABEL) for c in _KEPT], "SELECT col_a AS feature, corr FROM rho", "train", TRAIN_SQL
    ),
)
register(
    "top_features_by_correlation",
    lambda s, d: correlation.top_by_target(train_rows(s, d), _KEPT),
    _spearman_sql(
        "featured", [(c, LABEL) for c in _KEPT],
        """SELECT feature, corr FROM (SELECT col_a AS feature, corr FROM rho UNION ALL SELECT 'Churn', 1.0)
           ORDER BY abs(corr) DESC, feature LIMIT 11""",
        "train", TRAIN_SQL,
    ),
)

# ---- counts and rates ---------------------------------------------------------------

RATE = 'round(avg("Churn") * 100, 6)'


def _counts_many_sql(columns, table: str = "cleaned", *extra: str) -> str:
    return with_stage(
        "raw" if extra else table,
        f"""SELECT column_name, value, count(*) AS count,
             round(count(*)::DOUBLE / (SELECT count(*) FROM {table}) * 100, 6) AS share FROM ("""
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, CAST("{c}" AS VARCHAR) AS value FROM {table}""" for c in columns
        )
        + ") AS t WHERE value IS NOT NULL GROUP BY 1, 2",
        *extra,
    )


def _rates_sql(stage: str, columns: dict[str, str]) -> str:
    return with_stage(
        stage,
        f"SELECT column_name, value, count(*) AS total, {RATE} AS rate FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, CAST({expr} AS VARCHAR) AS value, "Churn" FROM {stage}"""
            for c, expr in columns.items()
        )
        + ") AS t WHERE value IS NOT NULL GROUP BY 1, 2",
    )


def _rate_sql(stage: str, key: str, expr: str) -> str:
    return with_stage(
        stage,
        f"""SELECT {expr} AS "{key}", count(*) AS total, count(*) FILTER (WHERE "Churn" = 1) AS churned,
              count(*) FILTER (WHERE "Churn" = 0) AS stayed, {RATE} AS rate
            FROM {stage} GROUP BY 1 HAVING {expr} IS NOT NULL""",
    )


def _matrix_sql(stage: str, row: str, row_expr: str, col_expr: str, labels, fill: bool = False) -> str:
    cells = ", ".join(
        (f"coalesce({c}, 0)" if fill else c) + f' AS "{v}"'
        for v in labels
        for c in [f"""round(avg("Churn") FILTER (WHERE {col_expr} = '{v}') * 100, 6)"""]
    )
    return with_stage(
        stage, f'SELECT {row_expr} AS "{row}", {cells} FROM {stage} GROUP BY 1 HAVING {row_expr} IS NOT NULL'
    )


register(
    "churn_distribution",
    lambda s, d: eda.churn_distribution(inputs.cleaned(s, d, LABEL)),
    with_stage(
        "cleaned",
        """SELECT "Churn", count(*) AS count, round(count(*)::DOUBLE / sum(count(*)) OVER () * 100, 6) AS share
           FROM cleaned GROUP BY 1""",
    ),
)
register(
    "binary_distributions",
    lambda s, d: eda.binary_distributions(inputs.cleaned(s, d, *eda.BINARY)),
    _counts_many_sql(eda.BINARY),
)
register(
    "categorical_distributions",
    lambda s, d: eda.categorical_distributions(inputs.cleaned(s, d, *eda.CATEGORICAL)),
    _counts_many_sql(eda.CATEGORICAL),
)
register(
    "counts_with_missing_values",
    lambda s, d: rates.value_counts_many(inputs.dirty(s, d), ["gender", "Partner", "MultipleLines"]),
    _counts_many_sql(["gender", "Partner", "MultipleLines"], "dirty", inputs.DIRTY_SQL),
)
register(
    "distinct_customers",
    lambda s, d: inputs.dirty(s, d).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("customerID").alias("distinct_keys")
    ),
    with_stage(
        "raw", 'SELECT count(*) AS row_count, count(DISTINCT "customerID") AS distinct_keys FROM dirty',
        inputs.DIRTY_SQL,
    ),
)
register(
    "tenure_group_churn",
    lambda s, d: eda.tenure_churn(inputs.cleaned(s, d, "tenure", LABEL)),
    with_stage(
        "cleaned",
        f"""SELECT tenure_group, position, total, churned, stayed, rate, stay_rate FROM
             (VALUES ('Under 1 year', 0), ('Between 1 and 2 years', 1), ('2 or more years', 2)) AS g(tenure_group, position)
             LEFT JOIN (SELECT CASE WHEN tenure <= 12 THEN 'Under 1 year' WHEN tenure <= 24 THEN 'Between 1 and 2 years'
                 ELSE '2 or more years' END AS tenure_group, count(*) AS total,
               count(*) FILTER (WHERE "Churn" = 1) AS churned, count(*) FILTER (WHERE "Churn" = 0) AS stayed,
               {RATE} AS rate, round(count(*) FILTER (WHERE "Churn" = 0)::DOUBLE / count(*) * 100, 6) AS stay_rate
               FROM cleaned GROUP BY 1) AS t USING (tenure_group)""",
    ),
)
register(
    "gender_churn",
    lambda s, d: eda.gender_churn_rate(inputs.cleaned(s, d, "gender", LABEL)),
    _rate_sql("cleaned", "gender", "gender"),
)
register(
    "gender_churn_counts",
    lambda s, d: eda.gender_churn_counts(inputs.cleaned(s, d, "gender", LABEL)),
    with_stage(
        "cleaned",
        """SELECT gender, nullif(count(*) FILTER (WHERE "Churn" = 0), 0) AS "No Churn",
             nullif(count(*) FILTER (WHERE "Churn" = 1), 0) AS "Churn" FROM cleaned GROUP BY 1""",
    ),
)
register(
    "tenure_by_churn_counts_filled",
    lambda s, d: rates.count_matrix(
        inputs.cleaned(s, d, "tenure", LABEL), "tenure", LABEL, [0, 1], ["stayed", "churned"], fill=0
    ),
    with_stage(
        "cleaned",
        """SELECT tenure, count(*) FILTER (WHERE "Churn" = 0) AS stayed, count(*) FILTER (WHERE "Churn" = 1) AS churned
           FROM cleaned GROUP BY 1""",
    ),
)
register(
    "payment_churn",
    lambda s, d: eda.payment_churn(inputs.cleaned(s, d, "PaymentMethod", LABEL)),
    _rate_sql("cleaned", "PaymentMethod", '"PaymentMethod"'),
)
register(
    "payment_churn_counts",
    lambda s, d: eda.payment_churn_counts(inputs.cleaned(s, d, "PaymentMethod", LABEL)),
    with_stage(
        "cleaned",
        """SELECT "PaymentMethod", nullif(count(*) FILTER (WHERE "Churn" = 0), 0) AS "No Churn",
             nullif(count(*) FILTER (WHERE "Churn" = 1), 0) AS "Churn" FROM cleaned GROUP BY 1""",
    ),
)
register(
    "contract_churn",
    lambda s, d: rates.rate_by(inputs.cleaned(s, d, "Contract", LABEL), ["Contract"]),
    _rate_sql("cleaned", "Contract", '"Contract"'),
)
register(
    "addon_churn",
    lambda s, d: eda.addon_churn(inputs.cleaned(s, d, *eda.PROTECTION, LABEL)),
    _rates_sql("cleaned", {c: f'"{c}"' for c in eda.PROTECTION}),
)
register(
    "streaming_churn",
    lambda s, d: eda.streaming_churn(inputs.cleaned(s, d, "StreamingTV", "StreamingMovies", LABEL)),
    _rates_sql("cleaned", {c: f'"{c}"' for c in ["StreamingTV", "StreamingMovies"]}),
)
register(
    "streaming_matrix",
    lambda s, d: eda.streaming_matrix(inputs.cleaned(s, d, "StreamingTV", "StreamingMovies", LABEL)),
    _matrix_sql(
        "cleaned", "StreamingTV", '"StreamingTV"', '"StreamingMovies"', config.DOMAINS["StreamingMovies"]
    ),
)
register(
    "contract_internet_matrix",
    lambda s, d: eda.contract_internet_churn(inputs.cleaned(s, d, "Contract", "InternetService", LABEL)),
    _matrix_sql("cleaned", "Contract", '"Contract"', '"InternetService"', config.DOMAINS["InternetService"]),
)
register(
    "payment_contract_matrix",
    lambda s, d: eda.payment_contract_churn(inputs.cleaned(s, d, "PaymentMethod", "Contract", LABEL)),
    _matrix_sql("cleaned", "PaymentMethod", '"PaymentMethod"', '"Contract"', config.DOMAINS["Contract"]),
)
_BAND = BAND_LONG.replace("-", "–").replace(" mo'", "m'")
_CHARGE = """CASE WHEN "MonthlyCharges" > 0 AND "MonthlyCharges" <= 35 THEN 'Low'
  WHEN "MonthlyCharges" > 35 AND "MonthlyCharges" <= 65 THEN 'Mid'
  WHEN "MonthlyCharges" > 65 AND "MonthlyCharges" <= 90 THEN 'High'
  WHEN "MonthlyCharges" > 90 AND "MonthlyCharges" <= 120 THEN 'Premium' END"""
register(
    "tenure_charge_matrix",
    lambda s, d: eda.tenure_charge_churn(inputs.cleaned(s, d, "tenure", "MonthlyCharges", LABEL)),
    with_stage(
        "cleaned",
        "SELECT * FROM (VALUES "
        + ", ".join(f"('{b}', {i})" for i, b in enumerate(config.TENURE_LABELS))
        + ") AS g(tenure_band, position) LEFT JOIN (SELECT tenure_band, "
        + ", ".join(
            f"""round(avg("Churn") FILTER (WHERE charge_band = '{v}') * 100, 6) AS "{v}" """
            for v in config.CHARGE_LABELS
        )
        + f""" FROM (SELECT {_BAND} AS tenure_band, {_CHARGE} AS charge_band, "Churn" FROM cleaned) AS u
              GROUP BY 1) AS t USING (tenure_band)""",
    ),
)
register(
    "feature_rates",
    lambda s, d: eda.feature_rates(inputs.featured(s, d)),
    _rates_sql(
        "featured",
        {c: f'"{c}"' for c in [config.AUTO_PAY, config.LOYALTY, config.HIGH_FRICTION, config.HOUSEHOLD]},
    ),
)

# ---- dashboard ----------------------------------------------------------------------

register(
    "headline_numbers",
    lambda s, d: rates.kpis(inputs.cleaned(s, d, "MonthlyCharges", "TotalCharges", LABEL)),
    with_stage(
        "cleaned",
        """SELECT count(*) AS customers, CAST(sum("Churn") AS BIGINT) AS churned,
             round(sum("Churn")::DOUBLE / count(*) * 100, 6) AS churn_pct, round(avg("MonthlyCharges"), 6) AS avg_bill,
             round(sum("TotalCharges"), 6) AS total_revenue FROM cleaned""",
    ),
)


@query(
    "overview_texts",
    with_stage(
        "cleaned",
        """SELECT printf('$%.2fM', sum("TotalCharges") / 1000000) AS revenue_text,
             format('{:,}', count(*)) AS customers_text, format('{:,}', CAST(sum("Churn") AS BIGINT)) AS churned_text,
             printf('%.1f%%', sum("Churn")::DOUBLE / count(*) * 100) AS churn_text,
             printf('$%.0f', avg("MonthlyCharges")) AS bill_text FROM cleaned""",
    ),
)
def overview_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dashboard.overview(inputs.cleaned(spark, sf_dir, "MonthlyCharges", "TotalCharges", LABEL))
    return df.select("revenue_text", "customers_text", "churned_text", "churn_text", "bill_text")


register(
    "churn_split",
    lambda s, d: dashboard.churn_split(dashboard.load(inputs.cleaned(s, d, LABEL))),
    with_stage(
        "cleaned",
        f"""SELECT {STATUS} AS status, count(*) AS count,
             round(count(*)::DOUBLE / sum(count(*)) OVER () * 100, 6) AS share FROM cleaned GROUP BY 1""",
    ),
)
register(
    "tenure_band_churn",
    lambda s, d: dashboard.tenure_band_churn(dashboard.load(inputs.cleaned(s, d, "tenure", LABEL))),
    with_stage(
        "cleaned",
        f"""SELECT tenure_band, {RATE} AS rate, count(*) AS total, printf('%.1f%%', avg("Churn") * 100) AS rate_text
            FROM (SELECT {BAND_LONG} AS tenure_band, "Churn" FROM cleaned) AS t
            WHERE tenure_band IS NOT NULL GROUP BY 1""",
    ),
)
register(
    "contract_label_churn",
    lambda s, d: dashboard.contract_churn(dashboard.load(inputs.cleaned(s, d, "Contract", LABEL))),
    _rate_sql("cleaned", "Contract_label", CONTRACT),
)
register(
    "contract_internet_filled",
    lambda s, d: dashboard.contract_internet(dashboard.load(inputs.encoded(s, d))),
    _matrix_sql("encoded", "Contract_label", CONTRACT, f"({INET})", dashboard.INTERNET, fill=True),
)
register(
    "contract_check_filled",
    lambda s, d: dashboard.contract_check(dashboard.load(inputs.encoded(s, d))),
    _matrix_sql("encoded", "Contract_label", CONTRACT, f"({CHECK})", dashboard.CHECK, fill=True),
)
register(
    "dashboard_group_rates",
    lambda s, d: dashboard.group_rates(dashboard.load(inputs.encoded(s, d))),
    _rates_sql(
        "encoded",
        {"elec_check": CHECK, "inet_type": INET, "sec_label": SECURITY, "SeniorCitizen": '"SeniorCitizen"'},
    ),
)
register(
    "addon_count_churn",
    lambda s, d: dashboard.addon_count_churn(inputs.featured(s, d)),
    _rate_sql("featured", config.ADDON_TOTAL, f'"{config.ADDON_TOTAL}"'),
)
for _name, _feature in {
    "autopay_churn": config.AUTO_PAY,
    "loyalty_churn": config.LOYALTY,
    "household_churn": config.HOUSEHOLD,
    "friction_churn": config.HIGH_FRICTION,
    "senior_churn": "SeniorCitizen",
}.items():
    _labels = " ".join(
        f"WHEN {k} THEN '{v}'" for k, v in dashboard.FEATURE_LABELS[_feature].items()
    )
    register(
        _name,
        lambda s, d, f=_feature: dashboard.feature_churn(inputs.featured(s, d), f),
        with_stage(
            "featured",
            f"""SELECT "{_feature}", count(*) AS total, count(*) FILTER (WHERE "Churn" = 1) AS churned,
                  count(*) FILTER (WHERE "Churn" = 0) AS stayed, {RATE} AS rate,
                  CASE "{_feature}" {_labels} END AS label FROM featured GROUP BY "{_feature}" """,
        ),
    )
register(
    "risk_segments",
    lambda s, d: dashboard.risk_segments(inputs.featured(s, d)),
    with_stage(
        "featured",
        f"""SELECT risk AS segment, count(*) AS count, {RATE} AS churn_rate,
              printf('%.1f%%', avg("Churn") * 100) AS rate_text FROM segmented GROUP BY 1""",
        inputs.RISK_SQL,
    ),
)
register(
    "segment_rate_lookup",
    lambda s, d: segments.segment_lookup(segments.with_risk(inputs.featured(s, d))),
    with_stage(
        "featured",
        f"""SELECT segment, count, churn_rate FROM (SELECT risk AS segment, count(*) AS count FROM segmented GROUP BY 1)
            LEFT JOIN (SELECT risk AS segment, {RATE} AS churn_rate FROM segmented GROUP BY 1) USING (segment)""",
        inputs.RISK_SQL,
    ),
)
register(
    "revenue_at_risk",
    lambda s, d: dashboard.revenue_at_risk(inputs.featured(s, d)),
    with_stage(
        "featured",
        """SELECT *, '$' || format('{:,}', CAST(round_even(high_revenue, 0) AS BIGINT)) AS high_text,
             '$' || format('{:,}', CAST(round_even(medium_revenue, 0) AS BIGINT)) AS medium_text,
             '$' || format('{:,}', CAST(round_even(total_at_risk, 0) AS BIGINT)) AS total_text FROM (
           SELECT count(*) FILTER (WHERE risk = 'High Risk') AS high_customers,
             count(*) FILTER (WHERE risk = 'Medium Risk') AS medium_customers,
             round(coalesce(sum("MonthlyCharges") FILTER (WHERE risk = 'High Risk'), 0), 6) AS high_revenue,
             round(coalesce(sum("MonthlyCharges") FILTER (WHERE risk = 'Medium Risk'), 0), 6) AS medium_revenue,
             round(coalesce(sum("MonthlyCharges") FILTER (WHERE risk IN ('High Risk', 'Medium Risk')), 0), 6) AS total_at_risk
           FROM segmented) AS t""",
        inputs.RISK_SQL,
    ),
)

# ---- classifier metrics over rule scores --------------------------------------------

CELLS = """
cells AS (
  SELECT "Model", count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
    count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
    count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
  FROM rules GROUP BY 1
),
areas AS (
  SELECT "Model", (sum(r) FILTER (WHERE label = 1) - p * (p + 1) / 2.0::DOUBLE) / (p * (n - p)) AS auc FROM (
    SELECT "Model", label,
      rank() OVER (PARTITION BY "Model" ORDER BY probability)
        + (count(*) OVER (PARTITION BY "Model", probability) - 1) / 2.0::DOUBLE AS r,
      (sum(label) OVER (PARTITION BY "Model"))::DOUBLE AS p, count(*) OVER (PARTITION BY "Model") AS n FROM rules)
  GROUP BY "Model", p, n
),
money AS (
  SELECT "Model",
    round_even(count(*) FILTER (WHERE label = 1 AND prediction = 1)
      * coalesce(avg("MonthlyCharges") FILTER (WHERE label = 1 AND prediction = 1), 0) * 12, 2) AS "Revenue_Saved",
    round_even(count(*) FILTER (WHERE label = 1 AND prediction = 0)
      * coalesce(avg("MonthlyCharges") FILTER (WHERE label = 1 AND prediction = 0), 0) * 12, 2) AS "Revenue_Leakage"
  FROM rules GROUP BY 1
),
quality AS (
  SELECT "Model", round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 6) AS "Accuracy",
    round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END, 6) AS "Precision",
    round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END, 6) AS "Recall",
    round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp::DOUBLE / (2 * tp + fp + fn) END, 6) AS "F1"
  FROM cells
),
board AS (
  SELECT "Model", "Accuracy", "Precision", "Recall", "F1", round(auc, 6) AS "ROC-AUC", "Revenue_Saved", "Revenue_Leakage"
  FROM quality JOIN areas USING ("Model") JOIN money USING ("Model")
)"""


def _board_sql(body: str) -> str:
    return with_stage("featured", body, inputs.RULES_SQL, CELLS)


def _board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.scoreboard(inputs.rule_scores(spark, sf_dir))


register(
    "confusion_counts",
    lambda s, d: metrics.confusion(inputs.rule_scores(s, d), ["Model"]),
    _board_sql("SELECT * FROM cells"),
)
register(
    "classification_quality",
    lambda s, d: metrics.from_confusion(metrics.confusion(inputs.rule_scores(s, d), ["Model"]), ["Model"]),
    _board_sql("SELECT * FROM quality"),
)
register(
    "roc_auc_by_rule",
    lambda s, d: ordered.roc_auc(inputs.rule_scores(s, d), "probability", "label", ["Model"]),
    _board_sql('SELECT "Model", round(auc, 6) AS roc_auc FROM areas'),
)
register(
    "business_value",
    lambda s, d: metrics.business_value(inputs.rule_scores(s, d), ["Model"]),
    _board_sql("SELECT * FROM money"),
)
register("rule_scoreboard", _board, _board_sql("SELECT * FROM board"))
_MEASURES = [*metrics.STANDARD, *metrics.BUSINESS]
register(
    "metrics_long_form",
    lambda s, d: metrics.metrics_long(_board(s, d)),
    _board_sql(
        " UNION ALL ".join(
            f"""SELECT "Model", '{m}' AS metric, "{m}" AS value FROM board""" for m in _MEASURES
        )
    ),
)
register(
    "metrics_wide_form",
    lambda s, d: metrics.metrics_wide(metrics.metrics_long(_board(s, d))),
    _board_sql("SELECT * FROM board"),
)
register(
    "best_rule",
    lambda s, d: metrics.best_model(_board(s, d)),
    _board_sql('SELECT * FROM board ORDER BY "ROC-AUC" DESC, "Model" LIMIT 1'),
)
SCORECARD_SQL = _board_sql(
    'SELECT "Model", '
    + ", ".join(f'"{m}"' for m in metrics.STANDARD)
    + ", "
    + ", ".join(
        f'"{m}" = max("{m}") OVER () AS "best_{m}", printf(\'%.4f\', "{m}") AS "text_{m}"'
        for m in metrics.STANDARD
    )
    + " FROM board"
)
register("rule_scorecard", lambda s, d: metrics.scorecard(_board(s, d)), SCORECARD_SQL)


@query("written_scorecard", SCORECARD_SQL)
def written_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard as the dashboard shows it: over a results table that was written and read again."""
    path = scratch(spark) + "/model_results"
    accounts.write_results(_board(spark, sf_dir), path)
    return metrics.scorecard(accounts.read_results(spark, path))


@query(
    "fold_spread",
    with_stage(
        "featured",
        """SELECT "Model", round(avg(f1), 6) AS "F1_mean", round(stddev_pop(f1), 6) AS "F1_std" FROM (
             SELECT "Model", fold, 2.0::DOUBLE * count(*) FILTER (WHERE label = 1 AND prediction = 1)
               / nullif(count(*) FILTER (WHERE label = 1) + count(*) FILTER (WHERE prediction = 1), 0) AS f1
             FROM (SELECT *, CASE WHEN h < 858993459 THEN 0 WHEN h < 1717986918 THEN 1 WHEN h < 2576980377 THEN 2
                                  WHEN h < 3435973836 THEN 3 ELSE 4 END AS fold
                   FROM (SELECT *, ('0x' || substr(md5('43|' || "customerID"), 1, 8))::BIGINT AS h FROM rules) AS a) AS b
             GROUP BY 1, 2) AS c GROUP BY 1""",
        inputs.RULES_SQL,
    ),
)
def fold_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = splits.assign_folds(inputs.rule_scores(spark, sf_dir))
    per_fold = metrics.from_confusion(metrics.confusion(folded, ["Model", "fold"]), ["Model", "fold"])
    return metrics.mean_and_spread(per_fold, ["F1"], ["Model"])


register(
    "class_ratio",
    lambda s, d: rates.class_ratio(inputs.cleaned(s, d, LABEL)),
    with_stage(
        "cleaned",
        """SELECT count(*) FILTER (WHERE "Churn" = 0) AS negatives, count(*) FILTER (WHERE "Churn" = 1) AS positives,
             round(count(*) FILTER (WHERE "Churn" = 0)::DOUBLE / count(*) FILTER (WHERE "Churn" = 1), 6) AS ratio
           FROM cleaned""",
    ),
)
register(
    "balanced_weights",
    lambda s, d: rates.balanced_weights(inputs.cleaned(s, d, LABEL)),
    with_stage(
        "cleaned",
        """SELECT "Churn", count(*) AS n, round((SELECT count(*) FROM cleaned)::DOUBLE / (2 * count(*)), 6) AS weight
           FROM cleaned GROUP BY 1""",
    ),
)
register(
    "scaler_statistics",
    lambda s, d: profile._per_column(
        inputs.cleaned(s, d, *NUM), NUM, {"mean": F.avg, "population_std": F.stddev_pop}
    ),
    _long_sql(
        "cleaned",
        """SELECT column_name, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS population_std
           FROM long GROUP BY 1""",
    ),
)
register(
    "contract_shares_train",
    lambda s, d: splits.category_shares(
        splits.train_test_split(inputs.cleaned(s, d, "customerID", "Contract", LABEL)).filter(
            q("split") == "train"
        ),
        "Contract",
    ),
    with_stage(
        "featured",
        """SELECT "Contract", count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share
           FROM parted WHERE split = 'train' GROUP BY 1""",
        SPLIT_SQL,
    ),
)
register(
    "kpis_long",
    lambda s, d: rates.kpis(inputs.cleaned(s, d, "MonthlyCharges", "TotalCharges", LABEL))
    .select(*[q(c).cast("double").alias(c) for c in ["customers", "churned", "churn_pct", "avg_bill", "total_revenue"]])
    .unpivot([], ["customers", "churned", "churn_pct", "avg_bill", "total_revenue"], "kpi", "value"),
    with_stage(
        "cleaned",
        """SELECT 'customers' AS kpi, count(*)::DOUBLE AS value FROM cleaned
           UNION ALL SELECT 'churned', sum("Churn")::DOUBLE FROM cleaned
           UNION ALL SELECT 'churn_pct', round(sum("Churn")::DOUBLE / count(*) * 100, 6) FROM cleaned
           UNION ALL SELECT 'avg_bill', round(avg("MonthlyCharges"), 6) FROM cleaned
           UNION ALL SELECT 'total_revenue', round(sum("TotalCharges"), 6) FROM cleaned""",
    ),
)


# ---- the whole validation ------------------------------------------------------------


def _tidied(name: str, check: str, subject: str, values: list[str]) -> str:
    """Rows (check, subject, measure, value) of another query's SQL."""
    return " UNION ALL ".join(
        f"""SELECT '{check}' AS "check", {subject} AS subject, '{v}' AS measure, CAST("{v}" AS DOUBLE) AS value
            FROM ({ORACLES[name]}) AS t"""
        for v in values
    )


_DUPLICATES_SQL = with_stage(
    "raw",
    """SELECT 'duplicates' AS "check", 'all' AS subject, 'duplicate_rows' AS measure,
         CAST((SELECT count(*) FROM dirty) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS DOUBLE) AS value""",
    inputs.DIRTY_SQL,
)


@query(
    "validation_report",
    " UNION ALL ".join(
        [
            _tidied("quality_accuracy", "accuracy", "rule", ["bad_rows"]),
            _tidied("quality_consistency", "consistency", "rule", ["bad_rows"]),
            _tidied("quality_completeness", "completeness", "rule", ["bad_rows"]),
            _tidied("quality_completeness", "critical", "rule", ["bad_rows"])
            + " WHERE rule IN (" + ", ".join(f"'null:{c}'" for c in config.CRITICAL) + ")",
            f"SELECT * FROM ({_DUPLICATES_SQL}) AS t",
            _tidied("duplicate_keys", "duplicates", "'all'", ["duplicate_keys"]),
        ]
    ),
)
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks that count rows; the profiles have queries of their own."""
    whole = validation.report(inputs.dirty(spark, sf_dir))
    counted = ["accuracy", "consistency", "completeness", "critical", "duplicates"]
    return whole.filter(F.col("check").isin(counted))


# ---- several results of one pass -----------------------------------------------------


def _cells_sql() -> str:
    """One grouping after the other."""
    keys = {
        "tenure_group": """CASE WHEN tenure <= 12 THEN 'Under 1 year' WHEN tenure <= 24 THEN 'Between 1 and 2 years'
          ELSE '2 or more years' END""",
        "tenure_band": """CASE WHEN tenure <= 0 OR tenure > 72 THEN NULL WHEN tenure <= 12 THEN '0–12m' WHEN tenure <= 24 THEN '13–24m'
          WHEN tenure <= 48 THEN '25–48m' WHEN tenure <= 72 THEN '49–72m' END""",
        "charge_band": """CASE WHEN "MonthlyCharges" <= 0 OR "MonthlyCharges" > 120 THEN NULL WHEN "MonthlyCharges" <= 35 THEN 'Low'
          WHEN "MonthlyCharges" <= 65 THEN 'Mid' WHEN "MonthlyCharges" <= 90 THEN 'High' ELSE 'Premium' END""",
    }
    parts = []
    for name, columns in eda.GROUPINGS.items():
        key, second = ([f"CAST({keys.get(c, chr(34) + c + chr(34))} AS VARCHAR)" for c in columns] + ["CAST(NULL AS VARCHAR)"])[:2]
        parts.append(f"""SELECT '{name}' AS grouping, {key} AS key, {second} AS second, count(*) AS total,
          count(*) FILTER (WHERE "Churn" = 1) AS churned, count(*) FILTER (WHERE "Churn" = 0) AS stayed FROM cleaned GROUP BY 2, 3""")
    return with_stage("cleaned", " UNION ALL ".join(parts))


register("full_exploration", lambda s, d: eda.exploration_cells(inputs.cleaned(s, d)), _cells_sql())


@query(
    "published_counts",
    with_stage(
        "cleaned",
        """SELECT count(*) AS rows, count(*) AS read_back, count(*) FILTER (WHERE tenure IS NULL) AS no_tenure,
             count(*) FILTER (WHERE "MonthlyCharges" < 0) AS negative, 0 AS planted,
             count(*) FILTER (WHERE tenure = 1) AS refused FROM cleaned""",
    ),
)
def published_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was counted while a table was written, and what is read back after a faulty one was refused."""
    df = inputs.cleaned(spark, sf_dir, config.KEY, "tenure", "MonthlyCharges")
    path = scratch(spark) + "/accounts"
    faults = {"no_tenure": F.count_if(q("tenure").isNull()), "negative": F.count_if(q("MonthlyCharges") < 0)}
    counts = accounts.publish(df, path, faults)
    planted = df.withColumn("tenure", F.when(q("tenure") != 1, q("tenure")))
    try:
        accounts.publish(planted, path, faults)
        refused = 0
    except ValueError as error:
        refused = int(str(error).split("no_tenure: ")[1].split(",")[0])
    back = accounts.read_table(spark, path).agg(
        F.count(F.lit(1)).alias("read_back"), F.count_if(q("tenure").isNull()).alias("planted"))
    made = {k: F.lit(counts[k]).cast("bigint").alias(k) for k in ("rows", "no_tenure", "negative")}
    return back.select(made["rows"], "read_back", made["no_tenure"], made["negative"], "planted",
                       F.lit(refused).cast("bigint").alias("refused"))


@query(
    "distinct_estimates",
    with_stage(
        "cleaned",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count("{c}") AS rows, count(DISTINCT "{c}") AS exact, true AS within FROM cleaned"""
            for c in ("customerID", "tenure", "MonthlyCharges", "Contract")),
    ),
)
def distinct_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values from the sketches of four loads put together: within 4 % of the exact counts."""
    columns = ["customerID", "tenure", "MonthlyCharges", "Contract"]
    df = inputs.cleaned(spark, sf_dir, *columns)
    load = F.pmod(F.xxhash64(config.KEY), F.lit(4))
    loads = [quality.distinct_sketches(df.filter(load == i), columns) for i in range(4)]
    sketches = loads[0].unionByName(loads[1]).unionByName(loads[2]).unionByName(loads[3])
    found = quality.distinct_estimates(quality.merged_sketches(sketches))
    exact = df.agg(*[F.count_distinct(q(c)).alias(c) for c in columns]).unpivot([], columns, "column_name", "exact")
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.04 * F.col("exact")
    return found.join(exact, "column_name").select("column_name", "rows", "exact", near.alias("within"))


@query(
    "importance_tiers",
    with_stage(
        "cleaned",
        """SELECT "PaymentMethod" AS feature, round(gap, 6) AS importance,
             CASE WHEN gap >= 0.01 THEN 'strong' WHEN gap > 0 THEN 'moderate' ELSE 'weak' END AS tier,
             CASE WHEN gap > 0 THEN row_number() OVER (ORDER BY gap >= 0.01 DESC, gap DESC) END AS place
           FROM (SELECT "PaymentMethod", avg("Churn") - (SELECT avg("Churn") FROM cleaned) AS gap FROM cleaned GROUP BY 1) AS t""",
    ),
)
def importance_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers and the order of the kept names, for numbers that SQL can make: how far each payment method's rate lies above
    the rate of all."""
    df = inputs.cleaned(spark, sf_dir, "PaymentMethod", "Churn")
    whole = df.agg(F.avg("Churn")).first()[0]
    gaps = df.groupBy(q("PaymentMethod").alias("feature")).agg((F.avg("Churn") - F.lit(whole)).alias("importance"))
    tiers = materialize(gaps.withColumn("tier", selection.tier(F.col("importance"))))
    kept = {name: i + 1 for i, name in enumerate(selection.kept_features(tiers))}
    place = F.coalesce(*[F.when(F.col("feature") == n, F.lit(i).cast("bigint")) for n, i in kept.items()], F.lit(None).cast("bigint"))
    return tiers.withColumn("place", place)
