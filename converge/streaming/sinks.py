"""Idempotent sinks for foreachBatch: a log of document versions, newest wins, and a dead-letter table.

Each micro-batch writes a folder of its own and overwrites it when it is tried again, so nothing is applied twice. A
table's current documents are those with the highest version; compact() folds the log into one folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert(path: str):
    """A function for foreachBatch that adds a micro-batch of documents to the log at path."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def current(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """The document of each key with the strictly newest version; of equal versions the first that came stays."""
    log = spark.read.parquet(path)
    fields = [c for c in log.columns if c not in (*key, "batch")]
    best = F.max_by(F.struct(*fields), F.struct(F.col("projection_version"), -F.col("batch").cast("long")))
    return log.groupBy(*key).agg(best.alias("d")).select(*key, *[F.col(f"d.{c}").alias(c) for c in fields]).where("completeness_status <> 'deleted'")


def compact(spark: SparkSession, path: str, into: str, key: list[str]) -> None:
    """Write the newest version of each key, deletions included, as one batch of a new log at `into`, which then takes the
    place of the old one. Its batch has the largest number of the old log, so that later batches stay later. `into` must not
    exist."""
    log = spark.read.parquet(path)
    fields = [c for c in log.columns if c not in (*key, "batch")]
    best = F.max_by(F.struct(*fields), F.struct("projection_version", -F.col("batch").cast("long")))
    newest = log.groupBy(*key).agg(best.alias("d")).select(*key, *[F.col(f"d.{c}").alias(c) for c in fields])
    newest.withColumn("batch", F.lit(log.agg(F.max(F.col('batch').cast('long'))).first()[0])).write.partitionBy("batch").parquet(into)


def split_writer(documents_path: str, letters_path: str, failed: str):
    """A function for foreachBatch that sends rows for which the condition holds to the dead letters, all others to the log."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.where(f"not ({failed})").write.mode("overwrite").parquet(f"{documents_path}/batch={batch_id}")
            # Nothing of the clock goes along, so a batch that is tried again writes the same.
            batch.where(failed).select(F.to_json(F.struct("*")).alias("payload")).write.mode("overwrite").parquet(f"{letters_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write
