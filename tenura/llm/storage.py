"""Intermediate tables in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """This session's folder below ``spark.checkpoint.dir``; a temporary one where that is unset, in local mode only."""
    base = spark.conf.get(SETTING, None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError(f"set {SETTING} to a folder shared by all executors")
        base = f"file://{tempfile.mkdtemp(prefix='tenura-')}"
        spark.conf.set(SETTING, base)
    return f"{base.rstrip('/')}/tenura-{spark.sparkContext.applicationId}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, written as a table and read back without its lineage.

    The table outlives any executor. ``clear`` removes all tables of the session.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Remove the session's tables; results that still read them must be written before."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
