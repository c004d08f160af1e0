"""Small table helpers: literal tables, lineage cuts."""

from __future__ import annotations

import gc
import json
import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def q(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col(f"`{name}`")


_TYPES = {bool: "boolean", int: "bigint", float: "double", str: "string"}


def _type_of(values: Sequence) -> str:
    kinds = {type(v) for v in values if v is not None}
    return _TYPES[float if kinds == {int, float} else kinds.pop()] if kinds else "string"


def literal_table(spark: SparkSession, rows: Sequence[Sequence], names: Sequence[str]) -> DataFrame:
    """A small table of constants that stays inside the plan (one JSON literal)."""
    fields = ", ".join(
        f"`{n}`: {_type_of([r[i] for r in rows])}" for i, n in enumerate(names)
    )
    text = json.dumps([dict(zip(names, row)) for row in rows])
    parsed = F.from_json(F.lit(text), f"array<struct<{fields}>>")
    return spark.range(1).select(F.inline(parsed))


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage through a reliable checkpoint.

    The folder is ``spark.checkpoint.dir``; only where that is unset, as in a local trial, a
    temporary one is taken. With ``spark.cleaner.referenceTracking.cleanCheckpoints`` Spark removes
    a checkpoint when nothing refers to it any more.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="tenura-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Collect garbage on the driver, so that its heap shrinks and Spark's cleaner drops checkpoints and broadcasts of steps that are over."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
