"""Raw accounts to scores as one fitted chain that can be saved and loaded.

The steps are ML stages, so a pipeline fits, saves and loads them with the classifier. What a step learns from the training
rows (loyalty thresholds, category shares) is a parameter of the fitted step. All steps are projections: a chain scores a
batch or a stream without a join or a shuffle.

Scoring needs no label column. With ``strict`` a value outside the declared domains, in a column that the score needs, is an
error; otherwise its code, and a missing number, is 0. A category that training did not have has share 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura import config
from tenura.functions import columns as C
from tenura.functions.tables import q
from tenura.operators import cleaning, features, metrics, models


class _Step(DefaultParamsReadable, DefaultParamsWritable):
    """Saved by its parameters."""


class AccountCleaner(Transformer, _Step):
    """Raw accounts to cleaned ones."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return cleaning.clean(df)


class AccountEncoder(Transformer, _Step):
    """Codes and indicators. Without ``strict``, an unmapped or missing code and a missing number is 0."""

    strict = Param(Params._dummy(), "strict", "whether an unmapped value fails the job", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, strict: bool = True):
        super().__init__()
        self._setDefault(strict=True)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        strict = self.getOrDefault(self.strict)
        out = features.encode(df, strict)
        if strict:
            return out
        filled = {"gender", "PhoneService", "PaperlessBilling", "Partner", "Dependents", "SeniorCitizen", "tenure",
                  "MonthlyCharges", *config.TERNARY}
        return out.select(*[F.coalesce(q(c), F.lit(0)).alias(c) if c in filled else q(c) for c in out.columns])


class FeatureBuilderModel(Model, _Step):
    """The six derived features, with fixed loyalty thresholds; accounts without services cost 0 a service."""

    tenureMean = Param(Params._dummy(), "tenureMean", "loyal accounts are older", TypeConverters.toFloat)
    chargeMean = Param(Params._dummy(), "chargeMean", "loyal accounts pay less a month", TypeConverters.toFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        means = {"tenure": self.getOrDefault(self.tenureMean), "MonthlyCharges": self.getOrDefault(self.chargeMean)}
        out = features.add_engineered_features(df, means, on_zero="null")
        return out.withColumn(config.COST_PER_SERVICE, F.coalesce(q(config.COST_PER_SERVICE), F.lit(0.0)))


class FeatureBuilder(Estimator, _Step):
    """Learns the loyalty thresholds as means of the rows it is fitted on."""

    def _fit(self, df: DataFrame) -> FeatureBuilderModel:
        means = features.loyalty_means(df)
        return FeatureBuilderModel()._set(tenureMean=means["tenure"], chargeMean=means["MonthlyCharges"])


class ShareEncoderModel(Model, _Step):
    """A category replaced by its share; others and missing ones have share 0."""

    column = Param(Params._dummy(), "column", "the column to replace", TypeConverters.toString)
    categories = Param(Params._dummy(), "categories", "categories of the fitted rows", TypeConverters.toListString)
    shares = Param(Params._dummy(), "shares", "their shares, in the same order", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        name = self.getOrDefault(self.column)
        known = dict(zip(self.getOrDefault(self.categories), self.getOrDefault(self.shares)))
        share = C.map_codes(q(name), known) if known else F.lit(None)
        return df.withColumn(name, F.coalesce(share.cast("double"), F.lit(0.0)))


class ShareEncoder(Estimator, _Step):
    """Learns the share of each category among the rows that have one. At most ``mostCategories``, else an error."""

    column = Param(Params._dummy(), "column", "the column to replace", TypeConverters.toString)
    mostCategories = Param(Params._dummy(), "mostCategories", "a bound of what the driver receives", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, column: str = "Contract", mostCategories: int = 1000):
        super().__init__()
        self._setDefault(column="Contract", mostCategories=1000)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ShareEncoderModel:
        name, most = self.getOrDefault(self.column), self.getOrDefault(self.mostCategories)
        counted = df.filter(q(name).isNotNull()).groupBy(q(name).cast("string").alias("category")).count()
        rows = counted.orderBy("category").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{name} has more than {most} categories")
        whole = sum(r["count"] for r in rows)
        return ShareEncoderModel()._set(
            column=name, categories=[r["category"] for r in rows], shares=[r["count"] / whole for r in rows])


class ClassWeights(Estimator, _Step):
    """Learns balanced class weights; the fitted step adds them where there is a label."""

    def _fit(self, df: DataFrame) -> ClassWeightsModel:
        fitted = models.class_weights(df, config.LABEL)
        return ClassWeightsModel()._set(zero=fitted.get(0, 0.0), one=fitted.get(1, 0.0))


class ClassWeightsModel(Model, _Step):
    zero = Param(Params._dummy(), "zero", "weight of class 0", TypeConverters.toFloat)
    one = Param(Params._dummy(), "one", "weight of class 1", TypeConverters.toFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        if config.LABEL not in df.columns:
            return df
        weight = F.when(q(config.LABEL) == 1, self.getOrDefault(self.one)).otherwise(self.getOrDefault(self.zero))
        return df.withColumns({models.LABEL: q(config.LABEL).cast("double"), models.WEIGHT: weight})


def raw_chain(
    selected: Sequence[str], params: dict, training_rows: int, strict: bool = False, contract: str = "Contract"
) -> Pipeline:
    """Cleaner, encoder, features, contract shares, class weights, assembler and logistic classifier.

    Balanced weights add up to the number of labelled rows, which the penalty counts against.
    """
    return Pipeline(stages=[
        AccountCleaner(), AccountEncoder(strict=strict), FeatureBuilder(), ShareEncoder(column=contract), ClassWeights(),
        models.assemble(selected), models.logistic(params, float(training_rows)),
    ])


def score_raw(chain, raw: DataFrame, threshold: float = config.DECISION_THRESHOLD) -> DataFrame:
    """Key, probability and class of raw accounts, with the label where there is one."""
    scored = chain.transform(raw)
    label = [models.LABEL] if models.LABEL in scored.columns else []
    kept = scored.select(config.KEY, *label, metrics.positive_probability().alias("probability"))
    return kept.withColumn("prediction", metrics.at_threshold(q("probability"), threshold))
