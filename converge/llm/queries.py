"""The opN_ queries over whole tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from converge.llm import align, common, exact, langid, lm, minhash, mixing, packing, resample, substring, suffix, toxicity, urls, winnow


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(common.documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(common.documents(spark, sf_dir), keep="largest")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.compare_with_next(common.documents(spark, sf_dir))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeated_spans(common.documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return lm.score(docs, *lm.fit(docs))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = toxicity.fit(docs, labels.where(~common.held_out("doc_id")))
    return toxicity.score(docs, machine).select("doc_id", common.held_out("doc_id").alias("held_out"), "score", "predicted")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_spans(common.documents(spark, sf_dir)).drop("spans")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    model = langid.fit(docs.where(~common.held_out("doc_id")))
    return langid.identify(docs, model).select("doc_id", common.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.documents(spark, sf_dir)).drop("epochs")


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("high")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(common.documents(spark, sf_dir))[0]


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup, op2_exact_dedup, op3_fingerprints, op4_suffix_dedup, op5_lm_scoring, op6_toxicity, op7_substring_dedup, op8_language_id, op9_best_fit_packing, op10_mixing,
        op11_url_filters, op12_tokenizer_alignment, op13_importance_resampling,
    )
}

ORACLE_SQL: dict[str, str] = {"op2_exact_dedup": exact.SQL, "op10_mixing": mixing.SQL, "op11_url_filters": urls.SQL}
