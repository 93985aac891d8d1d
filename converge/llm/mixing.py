"""Mixing of sources to target weights by Efraimidis-Spirakis sampling.

Each document gets an exponential key divided by its quality weight. Within a source, documents in the order of their
keys are the weighted sample; a prefix sum of their sizes is cut at the source's token budget. Whole epochs are taken
before the fractional selection. A source of any size is sorted in many partitions: keys fall into bins of equal width of
their logarithm, bins are summed, and only the sums of bins are put in order for a source. The logarithm of an exponential
variable has a density of at most 1/e, whatever its weight, so a bin of width d holds a share of about d/e of a source at
most, for any mixture of weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from converge.llm import common

#: Weights of the sources in the order of their names, repeating.
CYCLE = (3, 1, 2)
SALT = "mix-1|"
#: Bins for each unit of the logarithm of keys, at least, and rows of a bin, about, in a table of one source.
BINS, BIN_ROWS = 256, 65_536
#: Sources that may be broadcast, one row each.
BROADCAST_SOURCES = 100_000


def size_of(text: Column) -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+ of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_of(text: Column) -> Column:
    """Weight from 0.05 to 1: the share of a text's characters that are not ASCII digits or marks, squared."""
    plain = F.length(F.translate(text, "0123456789|#$%&*!<>{}[]=+_^~\\/@", ""))
    share = F.try_divide(plain, F.length(text))
    return F.greatest(F.lit(0.05), F.coalesce(share * share, F.lit(0.05)))


def uniform(doc_id: Column, salt: str) -> Column:
    """A number in (0, 1) that depends on the id and the salt only."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 13), 16, 10).cast("double")
    return (h + 0.5) / float(1 << 52)


def source_targets(sized: DataFrame, share: float = 1.5, most: float = 2.0, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """source, source_size, target: budgets by weight, none above `most` times its source, the excess shared again by weight.

    Works on one row per source: the level at which every source gets the smaller of level times weight and its bound is
    found from the sources in the order in which they reach their bounds. Sources without words get a target of 0.
    """
    # One row per source; a window in one task orders source names, never documents.
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in cycle]), (rank % len(cycle) + 1).cast("int"))
    s = by_source.withColumn("_w", w).withColumn("_bound", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("_bound") / F.col("_w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    s = s.withColumn("_held", F.coalesce(F.sum("_bound").over(before), F.lit(0.0))).withColumn("_free_w", F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))).withColumn("_total", F.sum("source_size").over(whole) * float(share))
    level = (F.col("_total") - F.col("_held")) / F.col("_free_w")
    s = s.withColumn("_level", level)
    # The first source, in that order, whose bound is not reached at its level gives the level of all that follow.
    final = F.min(F.when(F.col("_level") * F.col("_w") < F.col("_bound"), F.struct(F.col("_bound") / F.col("_w"), F.col("_level")))).over(whole)
    s = s.withColumn("_final", final.getField("_level"))
    target = F.when(F.col("_final").isNull(), F.col("_bound")).otherwise(F.least(F.col("_bound"), F.col("_final") * F.col("_w")))
    return s.select("source", "source_size", target.alias("target"))


def _selected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5, most: int = 2, cycle: tuple[int, ...] = CYCLE, salt: str = SALT, weight: Column | None = None, bins: int | None = None) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken, epochs.

    taken is size times epochs. Every document is taken floor(target / source_size) times; what is left of the target goes
    to the documents with the smallest keys, the one that crosses it only if more than half of it fits. A null source is a
    source of its own, the last in the order. Null and empty texts have size 0, and are taken with the whole epochs. Rows
    with equal ids have equal keys and are told apart by their size only; of equal rows that cross the target together all
    go the same way. An empty table gives an empty result; other columns are ignored.
    """
    bins = bins or max(BINS, docs.count() // BIN_ROWS)
    text = F.col(text_col)
    sized = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(source_col).alias("source"), size_of(text).alias("size"), (weight if weight is not None else quality_of(text)).alias("_weight"))
    # Keys are made once from the texts and stored, a few numbers for each document.
    keyed = common.written(sized.select("_id", "source", "size", _key(F.col("_id"), F.col("_weight"), salt).alias("_key")))
    keyed = keyed.withColumn("_bin", F.floor(F.log("_key") * bins).cast("int"))
    targets = source_targets(keyed.select("source", "size"), share, most, cycle)
    by_bin = keyed.groupBy("source", "_bin").agg(F.sum("size").alias("_bin_size"))
    earlier = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    by_bin = by_bin.withColumn("_earlier", F.coalesce(F.sum("_bin_size").over(earlier), F.lit(0))).drop("_bin_size")
    fixed = by_bin.withColumnRenamed("source", "_s1").join(targets.withColumnRenamed("source", "_s2"), F.col("_s1").eqNullSafe(F.col("_s2"))).select("_s1", F.col("_bin").alias("_b1"), "_earlier", "source_size", "target")
    rows = keyed.join(fixed, F.col("source").eqNullSafe(F.col("_s1")) & (F.col("_bin") == F.col("_b1")))
    inside = Window.partitionBy("source", "_bin").orderBy("_key", "_id", "size").rangeBetween(Window.unboundedPreceding, 0)
    upto = F.col("_earlier") + F.sum("size").over(inside)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("_whole", whole).withColumn("_left", F.col("target") - F.col("_whole") * F.col("source_size")).withColumn("_upto", upto)
    more = (F.col("_upto") - F.col("size") / 2.0 < F.col("_left")) & (F.col("_whole") < most) & (F.col("size") > 0)
    rows = rows.withColumn("epochs", F.col("_whole") + more.cast("long"))
    return rows.select(F.col("_id").alias(id_col), "source", "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken"), "epochs", "_whole", "_key")


def _key(doc_id: Column, weight: Column, salt: str) -> Column:
    """Exponential with the weight as its rate; the smallest keys are the weighted sample."""
    return -F.log(uniform(doc_id, salt)) / weight


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken, epochs. See _selected."""
    return _selected(docs, id_col, text_col, source_col, **options).drop("_whole", "_key")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", salt: str = SALT, weight: Column | None = None, **options) -> DataFrame:
    """The rows of docs, with all their columns, each as often as the mix takes it.

    The selection of a source is all rows up to the last in the order of keys, ids and sizes, so the texts stay where they
    are and only one row per source is joined to them. Null ids come before all others of the same key; nulls are treated
    as by _selected, no column's name can clash, and an empty table gives an empty result.
    """
    rank = F.struct(F.col("_key").alias("k"), F.col("_id").alias("i"), F.col("size").alias("s"))
    chosen = _selected(docs, id_col, text_col, source_col, salt=salt, weight=weight, **options).withColumnRenamed(id_col, "_id")
    cuts = common.checkpoint(chosen.groupBy(F.col("source").alias("_source")).agg(F.max("_whole").alias("_whole"), F.max(F.when(F.col("epochs") > F.col("_whole"), rank)).alias("_cut")))
    if cuts.count() <= BROADCAST_SOURCES:
        cuts = F.broadcast(cuts)
    text, doc_id = F.col(text_col), F.col(id_col).cast("long")
    own = F.struct(_key(doc_id, weight if weight is not None else quality_of(text), salt).alias("k"), doc_id.alias("i"), size_of(text).alias("s"))
    joined = common.carried(docs, _of=F.col(source_col), _own=own).join(cuts, F.col("_of").eqNullSafe(F.col("_source")))
    times = F.col("_whole") + (F.coalesce(F.col("_own") <= F.col("_cut"), F.lit(False)) & (F.col("_own.s") > 0)).cast("long")
    return common.restored(joined.withColumn("_time", F.explode(F.sequence(F.lit(0), times.cast("int")))).where("_time > 0"), docs.columns)


_WEIGHT_SQL = r"""greatest(0.05::DOUBLE, coalesce(pow(length(translate(text, '0123456789|#$%&*!<>{}[]=+_^~\/@', ''))::DOUBLE / nullif(length(text), 0), 2), 0.05::DOUBLE))"""

SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         -ln((('0x' || substr(md5('mix-1|' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / {_WEIGHT_SQL} AS k
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER before_it, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before_it, 0)) AS level
  FROM per_source WINDOW before_it AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce((SELECT arg_min(level, 2.0::DOUBLE * source_size / w) FROM levels WHERE level * w < 2.0::DOUBLE * source_size) * w, 2.0::DOUBLE * source_size)) AS target
  FROM levels),
runs AS (
  SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS whole,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
       size * (whole + (upto - size / 2.0::DOUBLE < target - whole * source_size AND whole < 2 AND size > 0)::BIGINT) AS taken
FROM runs
"""
