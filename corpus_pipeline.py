"""The corpus pipeline: toxicity, exact and near deduplication, mixing, packing, one stage after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from converge.llm import common, exact, minhash, mixing, packing, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar, learned from the labelled ones that are not held out, does not reject.

    Rows are judged on their own; a null text has no matches and stays.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels.where(~common.held_out("doc_id"))))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of equal texts; null counts as empty, null ids lose."""
    return exact.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates; texts without words and null ids stay."""
    return minhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a null source is one of its own, null texts have no words.

    Of documents with equal keys (equal ids), the smaller size comes first; those that are equal in both go together.
    """
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens; a null text is an end id alone, repeated rows stay apart."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [("toxicity", clean), ("exact_dedup", exact_dedup), ("minhash_near_dedup", near_dedup), ("mixing", mix), ("best_fit_packing", pack)]

#: The learned grammar and the tokeniser have no SQL; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written as Parquet and read again by the next."""
    docs = common.documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.written(docs)
    return docs
