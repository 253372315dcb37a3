"""Shared pieces of the corpus operators: reading tables, staging, row order."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from aloft.session import scratch_path


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this package where it lies outside their search path."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the re-read of its own files only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, *names: str) -> list[str]:
    """Column names for internal use that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out
