"""Cutting the lineage of plans that grow in a loop."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where it names none, a local session gets a folder of its
    own; a cluster, whose executors would not see it, is refused."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    folder(df.sparkSession)
    return df.checkpoint()
