"""The summary tables behind each exploratory view. All take cleaned accounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura import config
from tenura.functions import columns as C
from tenura.functions.tables import materialize, q
from tenura.operators import correlation, profile, rates

BINARY = ["SeniorCitizen", "PhoneService", "Partner", "PaperlessBilling", "Dependents", "Churn"]
CATEGORICAL = [
    "gender", "MultipleLines", "InternetService", *config.ADDONS, "Contract", "PaymentMethod",
]
PROTECTION = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport"]
CORRELATED = [
    "tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen", "Partner", "Dependents", "Churn",
]
CHURN_LABELS = {0: "No Churn", 1: "Churn"}


def with_churn_label(df: DataFrame, labels: dict = CHURN_LABELS) -> DataFrame:
    return df.withColumn("Churn_label", C.map_codes(q(config.LABEL), labels))


def churn_distribution(df: DataFrame) -> DataFrame:
    return rates.value_counts(df, config.LABEL)


def numeric_histograms(df: DataFrame, bins: int | str = "auto") -> DataFrame:
    return profile.histogram(df, config.NUMERIC, bins)


def numeric_density(df: DataFrame, column: str) -> DataFrame:
    """The curve over a column's histogram; it ends at the smallest and largest value."""
    return profile.kernel_density(df, column, cut=0.0)


def numeric_boxes(df: DataFrame) -> DataFrame:
    return profile.box_stats(df, config.NUMERIC)


def numeric_summary(df: DataFrame) -> DataFrame:
    return profile.describe(df, config.NUMERIC)


def binary_distributions(df: DataFrame) -> DataFrame:
    return rates.value_counts_many(df, BINARY)


def categorical_distributions(df: DataFrame) -> DataFrame:
    return rates.value_counts_many(df, CATEGORICAL)


def numeric_points(df: DataFrame, share: float = 1.0, seed: int = config.SEED) -> DataFrame:
    """(class, column, value) points; a share below 1 thins them for plotting."""
    points = profile.to_long(df, config.NUMERIC, [config.LABEL])
    return points if share >= 1 else points.sample(share, seed)


def tenure_churn(df: DataFrame) -> DataFrame:
    """Rows, churned, stayed and both rates per tenure group, in lifecycle order."""
    grouped = rates.rate_by(
        df.withColumn("tenure_group", C.tenure_group(q("tenure"))), ["tenure_group"]
    )
    stay = F.try_divide(F.col("stayed"), F.col("total")) * 100
    return rates.in_domain_order(
        grouped.withColumn("stay_rate", stay), "tenure_group", config.TENURE_GROUPS
    )


def gender_churn_rate(df: DataFrame) -> DataFrame:
    return rates.rate_by(df, ["gender"])


def gender_churn_counts(df: DataFrame) -> DataFrame:
    return rates.count_matrix(
        with_churn_label(df), "gender", "Churn_label", ["No Churn", "Churn"]
    )


def charges_by_churn_boxes(df: DataFrame) -> DataFrame:
    return profile.box_stats(
        with_churn_label(df), ["MonthlyCharges", "TotalCharges"], ["Churn_label"]
    )


def monthly_density(df: DataFrame) -> DataFrame:
    return profile.kernel_density(with_churn_label(df), "MonthlyCharges", "Churn_label")


def total_density(df: DataFrame) -> DataFrame:
    return profile.kernel_density(with_churn_label(df), "TotalCharges", "Churn_label")


def payment_churn(df: DataFrame) -> DataFrame:
    """Rate per payment method, highest first, with both class counts alongside."""
    return rates.rate_by(df, ["PaymentMethod"]).orderBy(F.desc("rate"), "PaymentMethod")


def payment_churn_counts(df: DataFrame) -> DataFrame:
    """Class counts per payment method, in the order of the falling rate."""
    return payment_churn(df).select(
        "PaymentMethod",
        F.when(F.col("stayed") > 0, F.col("stayed")).alias("No Churn"),
        F.when(F.col("churned") > 0, F.col("churned")).alias("Churn"),
    )


def addon_churn(df: DataFrame) -> DataFrame:
    return rates.rates_for(df, PROTECTION)


def streaming_churn(df: DataFrame) -> DataFrame:
    return rates.rates_for(df, ["StreamingTV", "StreamingMovies"])


def streaming_matrix(df: DataFrame) -> DataFrame:
    return rates.rate_matrix(
        df, "StreamingTV", "StreamingMovies", config.DOMAINS["StreamingMovies"]
    )


def correlation_tables(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lower triangles of the Spearman and Pearson matrices, in long form."""
    return correlation.spearman(df, CORRELATED), correlation.pearson(df, CORRELATED)


def internet_charges(df: DataFrame) -> DataFrame:
    return profile.box_stats(df, ["MonthlyCharges"], ["InternetService"])


def contract_internet_churn(df: DataFrame) -> DataFrame:
    return rates.rate_matrix(
        df, "Contract", "InternetService", config.DOMAINS["InternetService"]
    )


def tenure_charge_churn(df: DataFrame) -> DataFrame:
    """Rate by tenure band and charge band; every tenure band is kept."""
    banded = df.select(
        C.band(q("tenure"), config.TENURE_EDGES, config.TENURE_LABELS).alias("tenure_band"),
        C.band(q("MonthlyCharges"), config.CHARGE_EDGES, config.CHARGE_LABELS).alias("charge_band"),
        q(config.LABEL),
    )
    table = rates.rate_matrix(banded, "tenure_band", "charge_band", config.CHARGE_LABELS)
    return rates.in_domain_order(table, "tenure_band", config.TENURE_LABELS)


def payment_contract_churn(df: DataFrame) -> DataFrame:
    return rates.rate_matrix(df, "PaymentMethod", "Contract", config.DOMAINS["Contract"])


def pair_points(df: DataFrame, share: float = 1.0, seed: int = config.SEED) -> DataFrame:
    """The three numeric columns with the class label; a share below 1 thins them."""
    points = with_churn_label(df).select(*[q(c) for c in config.NUMERIC], "Churn_label")
    return points if share >= 1 else points.sample(share, seed)


def pair_density(df: DataFrame, column: str) -> DataFrame:
    return profile.kernel_density(with_churn_label(df), column, "Churn_label", common_norm=True)


def addon_boxes(df: DataFrame) -> DataFrame:
    return profile.box_stats(df, ["MonthlyCharges"], [config.ADDON_TOTAL, config.LABEL])


def cost_boxes(df: DataFrame) -> DataFrame:
    """Cost per service by class; accounts without services have no finite cost."""
    finite = df.filter(F.abs(q(config.COST_PER_SERVICE)) != float("inf"))
    return profile.box_stats(finite, [config.COST_PER_SERVICE], [config.LABEL])


def cost_density(df: DataFrame) -> DataFrame:
    return profile.kernel_density(df, config.COST_PER_SERVICE, config.LABEL)


def feature_rates(df: DataFrame) -> DataFrame:
    return rates.rates_for(
        df, [config.AUTO_PAY, config.LOYALTY, config.HIGH_FRICTION, config.HOUSEHOLD]
    )


GROUPINGS = {
    **{c: [c] for c in dict.fromkeys([config.LABEL, *BINARY, *CATEGORICAL, "tenure_group"])},
    "StreamingTV x StreamingMovies": ["StreamingTV", "StreamingMovies"],
    "Contract x InternetService": ["Contract", "InternetService"],
    "tenure_band x charge_band": ["tenure_band", "charge_band"],
    "PaymentMethod x Contract": ["PaymentMethod", "Contract"],
}


def exploration_cells(df: DataFrame) -> DataFrame:
    """All counts by group of the exploration in one pass over the cleaned accounts."""
    banded = df.withColumns({
        "tenure_group": C.tenure_group(q("tenure")),
        "tenure_band": C.band(q("tenure"), config.TENURE_EDGES, config.TENURE_LABELS),
        "charge_band": C.band(q("MonthlyCharges"), config.CHARGE_EDGES, config.CHARGE_LABELS),
    })
    return rates.grouped_at_once(banded, GROUPINGS)


def _one(cells: DataFrame, grouping: str) -> DataFrame:
    return cells.filter(F.col("grouping") == grouping)


def _rate() -> Column:
    return F.try_divide(F.col("churned"), F.col("churned") + F.col("stayed")) * 100


def rates_from(cells: DataFrame, key: str, name: str | None = None, kind: str = "string") -> DataFrame:
    """``rates.rate_by`` of one grouping."""
    rows = _one(cells, key).filter(F.col("key").isNotNull())
    return rows.select(F.col("key").cast(kind).alias(name or key), "total", "churned", "stayed", _rate().alias("rate"))


def many_rates_from(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``rates.rates_for`` of several groupings."""
    rows = cells.filter(F.col("grouping").isin(list(columns)) & F.col("key").isNotNull())
    return rows.select(F.col("grouping").alias("column_name"), F.col("key").alias("value"), "total", _rate().alias("rate"))


def counts_from(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``rates.value_counts_many`` of several groupings."""
    rows = cells.filter(F.col("grouping").isin(list(columns)))
    whole = F.sum("total").over(Window.partitionBy("grouping"))  # a grouping has one row for each value
    counted = rows.withColumn("share", F.col("total") / whole * 100).filter(F.col("key").isNotNull())
    return counted.select(F.col("grouping").alias("column_name"), F.col("key").alias("value"), F.col("total").alias("count"), "share")


def matrix_from(cells: DataFrame, grouping: str, row: str, labels: Sequence[str]) -> DataFrame:
    """``rates.rate_matrix`` of a grouping of two keys."""
    rows = _one(cells, grouping).filter(F.col("key").isNotNull())
    shown = [F.max(F.when(F.col("second") == v, _rate())).alias(v) for v in labels]
    return rows.groupBy(F.col("key").alias(row)).agg(*shown)


def counted_views(cells: DataFrame) -> dict[str, DataFrame]:
    """The views that are cut from ``exploration_cells``, as their own functions make them."""
    stay = F.try_divide(F.col("stayed"), F.col("total")) * 100
    tenure = rates_from(cells, "tenure_group").withColumn("stay_rate", stay)
    bands = matrix_from(cells, "tenure_band x charge_band", "tenure_band", config.CHARGE_LABELS)
    by_payment = rates_from(cells, "PaymentMethod").orderBy(F.desc("rate"), "PaymentMethod")
    classes = counts_from(cells, [config.LABEL]).select(F.col("value").cast("int").alias(config.LABEL), "count", "share")

    def positive(name: str) -> Column:
        return F.when(F.col(name) > 0, F.col(name))

    return {
        "churn_distribution": classes.orderBy(F.desc("count"), q(config.LABEL)),
        "binary_distributions": counts_from(cells, BINARY),
        "categorical_distributions": counts_from(cells, CATEGORICAL),
        "tenure_churn": rates.in_domain_order(tenure, "tenure_group", config.TENURE_GROUPS),
        "gender_churn_rate": rates_from(cells, "gender"),
        "gender_churn_counts": rates_from(cells, "gender").select(
            "gender", positive("stayed").alias("No Churn"), positive("churned").alias("Churn")),
        "payment_churn": by_payment,
        "payment_churn_counts": by_payment.select(
            "PaymentMethod", positive("stayed").alias("No Churn"), positive("churned").alias("Churn")),
        "addon_churn": many_rates_from(cells, PROTECTION),
        "streaming_churn": many_rates_from(cells, ["StreamingTV", "StreamingMovies"]),
        "streaming_matrix": matrix_from(
            cells, "StreamingTV x StreamingMovies", "StreamingTV", config.DOMAINS["StreamingMovies"]),
        "contract_internet_churn": matrix_from(
            cells, "Contract x InternetService", "Contract", config.DOMAINS["InternetService"]),
        "tenure_charge_churn": rates.in_domain_order(bands, "tenure_band", config.TENURE_LABELS),
        "payment_contract_churn": matrix_from(
            cells, "PaymentMethod x Contract", "PaymentMethod", config.DOMAINS["Contract"]),
    }


def run_full(cleaned: DataFrame, featured: DataFrame | None = None) -> dict[str, DataFrame]:
    """The table behind every exploratory view by name; lazy but for the order statistics and the counts by group.

    All views that count rows by group come from one pass over the accounts.
    """
    spearman, pearson = correlation_tables(cleaned)
    cells = materialize(exploration_cells(cleaned))
    views = {
        **counted_views(cells),
        "numeric_summary": numeric_summary(cleaned),
        "numeric_histograms": numeric_histograms(cleaned),
        "numeric_boxes": numeric_boxes(cleaned),
        **{f"density_{c}": numeric_density(cleaned, c) for c in config.NUMERIC},
        "numeric_points": numeric_points(cleaned),
        "charges_by_churn_boxes": charges_by_churn_boxes(cleaned),
        "monthly_density": monthly_density(cleaned),
        "total_density": total_density(cleaned),
        "spearman": spearman,
        "pearson": pearson,
        "internet_charges": internet_charges(cleaned),
        "pair_points": pair_points(cleaned),
        **{f"pair_density_{c}": pair_density(cleaned, c) for c in config.NUMERIC},
    }
    if featured is not None:
        views |= {
            "addon_boxes": addon_boxes(featured),
            "cost_boxes": cost_boxes(featured),
            "cost_density": cost_density(featured),
            "feature_rates": feature_rates(featured),
        }
    return views
