"""Exact deduplication by a content sort, in DataFrame operations only.

Sampled splitters range-partition the rows by the start and a digest of their normalised text, an external sort inside
each partition puts equal texts next to each other, and each row is compared in full with its neighbour. Texts with many
copies are found by a count of digests first; each such text is dealt over several partitions by a salt, and the winners
of its salts, one row each, are brought together afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from converge.llm import common

#: A text is hot if its digest has more than 1/HOT_SHARE of all rows, so that there are fewer than HOT_SHARE of them.
HOT_SHARE = 2000
#: Rows below which no text is hot.
HOT_LEAST = 256
#: Copies of a hot text in one salt, about.
SALT_ROWS = 128


def _hot(keyed: DataFrame, share: int) -> DataFrame:
    """The digests with more than 1/share of all rows, fewer than `share` by construction, with their number of salts."""
    counts = keyed.groupBy("_digest").agg(F.count("*").alias("_copies"))
    total = keyed.agg(F.count("*").alias("_total"))
    least = F.greatest(F.lit(HOT_LEAST), F.col("_total") / share)
    return counts.where(F.col("_copies") > HOT_LEAST).join(F.broadcast(total), F.col("_copies") > least).select("_digest", F.ceil(F.col("_copies") / SALT_ROWS).cast("long").alias("_salts"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", normalise: Column | None = None, hot_share: int = HOT_SHARE, carry: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    normalise: the text that is compared, by default the text as it is. keep: "smallest" or "largest" identifier of equal
    texts stays. A null text counts as empty. A null id loses to any other; a group whose ids are all null keeps one row,
    with a null keep_id. Of rows with the same id and text one is kept, so each group keeps exactly one row. An empty
    table gives an empty result; other columns of the input are ignored. carry: a column that goes along as _carry, and the
    compared text with it as _text.
    """
    text = F.coalesce(normalise if normalise is not None else F.col(text_col), F.lit("")).cast("string")
    order = F.col("_id").asc_nulls_last() if keep == "smallest" else F.col("_id").desc_nulls_last()
    more = [] if carry is None else ["_carry", "_text"]
    keyed = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), *([] if carry is None else [carry.alias("_carry")])).withColumn("_digest", F.xxhash64("_text"))
    hot = _hot(keyed.select("_digest"), hot_share)
    rows = keyed.join(F.broadcast(hot), "_digest", "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("_id", F.lit(17)), F.col("_salts")), F.lit(0)))
    rows = rows.withColumn("_start", F.substring("_text", 1, 16))
    dealt = rows.repartitionByRange(common.partitions(docs.sparkSession), "_start", "_digest", "_salt")
    near = Window.partitionBy("_start", "_digest", "_salt").orderBy("_text", order)
    first = F.coalesce(~F.col("_text").eqNullSafe(F.lag("_text").over(near)), F.lit(True))
    runs = dealt.select(*more, "_id", "_digest", "_start", "_salt", (F.col("_salts").isNotNull()).alias("_is_hot"), first.alias("_first"), F.row_number().over(near).alias("_at"), F.sha2(F.encode("_text", "UTF-8"), 256).alias("_sha"))
    so_far = Window.partitionBy("_start", "_digest", "_salt").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.withColumn("_run", F.max(F.when(F.col("_first"), F.col("_at"))).over(so_far))
    group = Window.partitionBy("_start", "_digest", "_salt", "_run")
    runs = runs.select(*more, "_id", "_digest", "_start", "_salt", "_sha", "_is_hot", "_first", F.count("*").over(group).alias("_size"), F.first("_id").over(group.orderBy("_at")).alias("_keep"))
    # Winners of the salts of hot texts: fewer than hot_share texts with as many rows each as they have salts.
    winners = runs.where(F.col("_is_hot") & F.col("_first")).groupBy("_digest", "_sha").agg((F.min("_keep") if keep == "smallest" else F.max("_keep")).alias("_all_keep"), F.sum("_size").alias("_all_size"), F.min(F.when(F.col("_keep").isNull(), F.col("_salt"))).alias("_null_salt"))
    out = runs.join(F.broadcast(winners), ["_digest", "_sha"], "left")
    keep_id = F.when(F.col("_is_hot"), F.col("_all_keep")).otherwise(F.col("_keep"))
    in_best_salt = ~F.col("_is_hot") | F.when(F.col("_all_keep").isNotNull(), F.col("_keep").eqNullSafe(F.col("_all_keep"))).otherwise(F.col("_salt").eqNullSafe(F.col("_null_salt")))
    return out.select(F.col("_id").alias(id_col), keep_id.alias("keep_id"), F.when(F.col("_is_hot"), F.col("_all_size")).otherwise(F.col("_size")).alias("group_size"), (F.col("_first") & in_best_salt).alias("kept"), F.col("_sha").alias("text_sha256"), *more)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns, whatever their names.

    A text travels once: unless it is normalised, the compared text stands for the column itself, and only whether that was
    null goes along. Nulls, repeated rows and empty tables are treated as by exact_dedup.
    """
    apart = "normalise" not in options
    others = [F.col(f"`{c}`") for c in docs.columns if not (apart and c == text_col)]
    null = F.col(text_col).isNull() if apart else F.lit(False)
    marked = exact_dedup(docs, id_col, text_col, carry=F.struct(F.struct(*others, F.lit(True)).alias("row"), null.alias("null")), **options)
    text = F.when(~F.col("_carry.null"), F.col("_text")).cast(docs.schema[text_col].dataType)
    return marked.where("kept").select(*[(text if apart and c == text_col else F.col("_carry.row").getField(c)).alias(c) for c in docs.columns])


SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
