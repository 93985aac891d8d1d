"""Tables in buckets by key, sorted in each, so that joins and groupings by the key shuffle nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 64


def store(rows: DataFrame, name: str, key: list[str], path: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Store rows as the table `name`, a file for each bucket, and read it. Tables of the same key and number of buckets meet
    bucket by bucket. path: where its files lie, by default in the warehouse."""
    writer = rows.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key).format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return rows.sparkSession.table(name)


def forget(spark: SparkSession, name: str) -> None:
    """Drop the table; files at a path of its own stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
