"""From raw documents to a training mix.

Each stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes it and reads it again for the next
stage. Rows that a stage does not decide against stay, with the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm import decontamination, language_id, line_templates, mixing, ngram_join
from tenura.llm.storage import stored

#: No SQL: stages compress, estimate similarities and draw at random. The stages are tested one by one.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language is rejected: no letter, or too near to a second language."""
    dictionaries = language_id.learn(docs.where(~language_id.held_out(F.col("doc_id"))))
    found = language_id.identify(docs, dictionaries)
    return found.where(~F.col("rejected")).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes recurring lines out of all texts but the first that has them; counts ``n_chars`` anew."""
    found = line_templates.drop_recurring_lines(docs, long_tokens=50)
    return found.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return ngram_join.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of a benchmark item."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words drawn from each document, with the shard and place they go to."""
    return mixing.mixed(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
