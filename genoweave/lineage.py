"""Cutting lineage in iterative plans."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def cut(df: DataFrame) -> DataFrame:
    """df computed now and written to the checkpoint folder that the cluster names (spark.checkpoint.dir).

    Only where that setting is absent and the master is local, as in tests, a folder is made.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. On a local master, without that setting, a
    temporary one; on any other master its absence is an error, as other machines do not see a local folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir is not set, and {master} has no folder that all executors share")
    return tempfile.mkdtemp(prefix="genoweave-")
