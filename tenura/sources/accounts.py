"""Readers and writers of account tables and model results."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura import config
from tenura.functions.tables import literal_table, q


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """Every CSV file of a folder, columns by the names in the header, in the declared order.

    Only the header line is read ahead. A missing column, a file whose header differs from
    the first one's, and a value that does not fit its type are errors.
    """
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.csv")
    header = reader.csv(path).columns
    missing = [c for c in config.RAW_SCHEMA.fieldNames() if c not in header]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    texts = T.StructType([T.StructField(c, T.StringType()) for c in header])
    rows = reader.schema(texts).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    return rows.select(*[q(f.name).cast(f.dataType).alias(f.name) for f in config.RAW_SCHEMA])


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """A written table; a missing one is a clear error.

    CSV columns are text unless a schema is given, which the header must then match.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            raise FileNotFoundError(f"no table at {path}") from err
        raise


def read_results(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The model-results table; extra business columns are read when the header has them."""
    if fmt != "csv":
        return read_table(spark, path, fmt)
    try:
        header = spark.read.option("header", True).csv(path).columns
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            raise FileNotFoundError(f"no table at {path}") from err
        raise
    schema = T.StructType(
        [T.StructField(c, T.StringType() if c == "Model" else T.DoubleType()) for c in header]
    )
    return spark.read.schema(schema).option("header", True).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One file per task; CSV has a header and keeps blank text as it is."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = (
            writer.option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    writer.save(path)


def publish(df: DataFrame, path: str, faults: Mapping[str, Column]) -> dict[str, int]:
    """Write a table and put it in place of the one at ``path`` only if no row has a fault; returns the counts.

    ``faults`` are aggregates that must be 0, like ``F.count_if(q("tenure").isNull())``. They are counted while the table
    is written, without another scan. A faulty table is removed again and its counts are the error; the old table
    stays. The new one is renamed into place; a reader between the two renames finds no table.
    """
    spark = df.sparkSession
    seen = Observation()
    fresh, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in faults.items()])
    counted.write.parquet(fresh)
    counts = {k: v or 0 for k, v in seen.get.items()}
    at = {p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (path, fresh, old)}
    files = at[path].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if any(counts[name] for name in faults):
        files.delete(at[fresh], True)
        found = ", ".join(f"{name}: {counts[name]}" for name in faults if counts[name])
        raise ValueError(f"not published, {found}")
    had = files.exists(at[path])
    if had and not files.rename(at[path], at[old]):
        raise OSError(f"cannot move {path}")
    if not files.rename(at[fresh], at[path]):
        raise OSError(f"cannot move {fresh} to {path}")
    if had:
        files.delete(at[old], True)
    return counts


def write_results(board: DataFrame, path: str) -> None:
    """The scoreboard, one row per model; it holds a handful of rows, so one file."""
    board.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def from_columns(spark: SparkSession, data: dict[str, list], schema: T.StructType) -> DataFrame:
    """A table from a dict of equally long lists."""
    rows = list(zip(*[data[f.name] for f in schema.fields]))
    return spark.createDataFrame(rows, schema)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def column_types(df: DataFrame) -> DataFrame:
    rows = [(i, n, t) for i, (n, t) in enumerate(df.dtypes)]
    return literal_table(df.sparkSession, rows, ["position", "column_name", "type"])


def first_by_key(df: DataFrame, rows: int = 5, key: str = config.KEY) -> DataFrame:
    """A reproducible preview: the first rows in key order."""
    return df.orderBy(q(key)).limit(rows)

