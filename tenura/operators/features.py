"""Encoding of cleaned accounts and the six derived features."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura import config
from tenura.functions import columns as C
from tenura.functions.tables import q


def encode(df: DataFrame, strict: bool = True) -> DataFrame:
    """Codes for two- and three-valued columns, indicators for nominal ones.

    The first value of each nominal domain gets no indicator. The key column stays.
    With ``strict`` an unmapped value fails the job; otherwise it becomes null. A missing
    nominal value has no indicator set, in both modes.
    """
    codes = {
        "gender": config.GENDER_CODES,
        "PhoneService": config.YES_NO,
        "PaperlessBilling": config.YES_NO,
        **{c: config.TERNARY_CODES for c in config.TERNARY},
    }
    kept = [
        C.map_codes(q(n), codes[n], strict, n).alias(n) if n in codes else q(n).alias(n)
        for n in df.columns
        if n not in config.ONE_HOT
    ]
    return df.select(*kept, *one_hot(df, config.ONE_HOT, strict))


def one_hot(df: DataFrame, domains: Mapping, strict: bool = False) -> list:
    """An indicator for each value but the first; with ``strict`` other values fail the job."""
    out = []
    for column, values in domains.items():
        if column not in df.columns:
            continue
        message = F.concat(F.lit(f"unmapped value in {column}: "), q(column).cast("string"))
        known = q(column).isNull() | q(column).isin(list(values))
        for value in sorted(values)[1:]:
            hit = C.indicator(q(column), value)
            if strict:
                hit = F.when(known, hit).otherwise(F.raise_error(message).cast("byte"))
            out.append(hit.alias(f"{column}_{value}"))
    return out


def encode_rejects(df: DataFrame) -> DataFrame:
    """Values that the strict encoding would refuse, counted per column.

    A missing code is refused, a missing nominal value is not.
    """
    domains = {
        "gender": list(config.GENDER_CODES),
        "PhoneService": list(config.YES_NO),
        "PaperlessBilling": list(config.YES_NO),
        **{c: list(config.TERNARY_CODES) for c in config.TERNARY},
    }
    aggs = [
        F.count_if(~F.coalesce(q(c).isin(v), F.lit(False))).alias(c) for c, v in domains.items()
    ]
    aggs += [
        F.count_if(q(c).isNotNull() & ~q(c).isin(list(v))).alias(c)
        for c, v in config.ONE_HOT.items()
    ]
    names = [*domains, *config.ONE_HOT]
    return df.agg(*aggs).unpivot([], names, "column_name", "rejected")


def loyalty_means(df: DataFrame) -> dict[str, float]:
    """Fit the two thresholds of the loyalty flag, for example on a training split."""
    row = df.agg(F.avg("tenure").alias("tenure"), F.avg("MonthlyCharges").alias("MonthlyCharges"))
    return row.first().asDict()


def add_engineered_features(
    df: DataFrame, means: Mapping[str, float] | None = None, on_zero: str = "inf"
) -> DataFrame:
    """Add the six features. Without ``means`` the loyalty thresholds come from ``df`` itself."""
    addons = C.row_sum([q(c) for c in config.ADDONS])
    services = q("PhoneService") + (1 - q(config.NO_INTERNET)) + addons
    bank_transfer = (
        (q(config.ELECTRONIC_CHECK) == 0)
        & (q(config.MAILED_CHECK) == 0)
        & (q(config.CREDIT_CARD) == 0)
    )
    if means is None:
        both = F.struct(F.avg("tenure").alias("tenure"), F.avg("MonthlyCharges").alias("charge"))
        fitted = df.select(both).scalar()
        tenure_mean, charge_mean = fitted["tenure"], fitted["charge"]
    else:
        tenure_mean, charge_mean = F.lit(means["tenure"]), F.lit(means["MonthlyCharges"])
    loyal = (q("tenure") > tenure_mean) & (q("MonthlyCharges") < charge_mean)
    friction = (q("PaperlessBilling") == 1) & (q(config.ELECTRONIC_CHECK) == 1)

    def flag(cond):
        return F.when(cond, 1).otherwise(0)

    return df.select(
        "*",
        addons.cast("int").alias(config.ADDON_TOTAL),
        C.ratio(q("MonthlyCharges"), services, on_zero).alias(config.COST_PER_SERVICE),
        flag((q(config.CREDIT_CARD) == 1) | bank_transfer).alias(config.AUTO_PAY),
        flag(loyal).alias(config.LOYALTY),
        flag(friction).alias(config.HIGH_FRICTION),
        (q("Partner") + q("Dependents")).alias(config.HOUSEHOLD),
    )


def with_display_columns(df: DataFrame) -> DataFrame:
    """Label and band columns that the dashboard groups by (features may be partly absent)."""
    extra = []
    if "Contract" in df.columns:
        extra.append(
            C.label_or_self(q("Contract"), config.CONTRACT_LABELS).alias("Contract_label")
        )
    if config.ELECTRONIC_CHECK in df.columns:
        extra.append(
            C.map_codes(q(config.ELECTRONIC_CHECK), {0: "Other", 1: "Elec. Check"}).alias(
                "elec_check"
            )
        )
    if config.FIBER in df.columns and config.NO_INTERNET in df.columns:
        extra.append(C.internet_label(q(config.FIBER), q(config.NO_INTERNET)).alias("inet_type"))
    if "OnlineSecurity" in df.columns:
        extra.append(
            C.map_codes(q("OnlineSecurity"), {0: "No Security", 1: "Has Security"}).alias(
                "sec_label"
            )
        )
    if "tenure" in df.columns:
        extra.append(
            C.band(q("tenure"), config.TENURE_EDGES, config.TENURE_LABELS_LONG).alias("tenure_band")
        )
    return df.select("*", *extra)
