"""Quality of ranked results: gains, reciprocal ranks, overlap of two rankings and the gate over them.

Rankings are arrays of ids, judgments maps of id to grade; all measures are array expressions, so a query is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 10
#: Least overlap; least gain, largest drop in gain and least reciprocal rank of the shadow. Fixed values.
OVERLAP, NDCG, DROP, MRR = 0.5, 0.85, 0.10, 0.5


def _gain(grades: Column) -> Column:
    """Sum of (2**grade - 1) / log2(rank + 1) over an array of grades."""
    each = F.transform(grades, lambda g, i: (F.pow(F.lit(2.0), g) - 1) / F.log2((i + 2).cast("double")))
    return F.aggregate(each, F.lit(0.0), lambda total, x: total + x)


def _grades(retrieved: Column, judged: Column, k: int) -> Column:
    return F.transform(F.slice(retrieved, 1, k), lambda d: F.coalesce(F.element_at(judged, d), F.lit(0.0)).cast("double"))


def ndcg(retrieved: Column, judged: Column, k: int = K) -> Column:
    """Only positive grades add to the gain; all of the k best, also negative ones, to the ideal. Repeated ids count again."""
    got = _gain(F.transform(_grades(retrieved, judged, k), lambda g: F.greatest(g, F.lit(0.0))))
    ideal = _gain(F.slice(F.reverse(F.array_sort(F.transform(F.map_values(judged), lambda g: g.cast("double")))), 1, k))
    return F.when(F.coalesce(ideal, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(got / ideal)


def reciprocal_rank(retrieved: Column, judged: Column, k: int = K) -> Column:
    at = F.array_position(F.transform(_grades(retrieved, judged, k), lambda g: g > 0), True)
    return F.when(at > 0, 1.0 / at).otherwise(F.lit(0.0))


def evaluate(cases: DataFrame, k: int = K) -> DataFrame:
    """query_id, ndcg_at_k, mrr, zero_results of cases with query_id, retrieved and judged."""
    return cases.select("query_id", ndcg(F.col("retrieved"), F.col("judged"), k).alias("ndcg_at_k"), reciprocal_rank(F.col("retrieved"), F.col("judged"), k).alias("mrr"), (F.size(F.slice("retrieved", 1, k)) == 0).alias("zero_results"))


def corpus_report(evaluated: DataFrame) -> DataFrame:
    """One row of means; zeros for no queries."""
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return evaluated.agg(F.count("*").alias("query_count"), mean("ndcg_at_k").alias("average_ndcg_at_k"), mean("mrr").alias("average_mrr"), mean(F.col("zero_results").cast("int")).alias("zero_result_rate"))


def overlap(primary: Column, shadow: Column, k: int = K) -> dict[str, Column]:
    a, b = F.slice(primary, 1, k), F.slice(shadow, 1, k)
    shared = F.size(F.array_intersect(a, b))
    return {"overlap_at_k": shared, "overlap_rate_at_k": shared / F.greatest(F.size(a), F.size(b), F.lit(1)), "identical_order": a == b}


def paired(primary: DataFrame, shadow: DataFrame, request: str = "request_id") -> DataFrame:
    """Responses (request, query_id, retrieved) of both sides to the same request; requests that only one answered are left out."""
    other = shadow.select(request, F.col("retrieved").alias("shadow"))
    return primary.withColumnRenamed("retrieved", "primary").join(other, request)


def frozen(decisions: DataFrame, by: list[str]) -> DataFrame:
    """Decisions (seq, code and by) with frozen: whether an earlier one of the same `by` showed a regression.

    One aggregate finds the first regression of each, so no log is read in order; the first regression itself still ran.
    """
    first = decisions.where("code is not null").groupBy(*by).agg(F.min("seq").alias("_first"))
    return decisions.join(first, by, "left").withColumn("frozen", F.coalesce(F.col("seq") > F.col("_first"), F.lit(False))).drop("_first")


def gate(pairs: DataFrame, k: int = K, least_overlap: float = OVERLAP, least_ndcg: float = NDCG, largest_drop: float = DROP, least_mrr: float = MRR) -> DataFrame:
    """code and severity of the regression that a pair of rankings shows, null if none.

    pairs: query_id, primary, shadow, judged. With judgments only gains and ranks decide; without, only the overlap does.
    """
    judged = F.col("judged").isNotNull()
    measures = overlap(F.col("primary"), F.col("shadow"), k) | {
        "primary_ndcg": F.when(judged, ndcg(F.col("primary"), F.col("judged"), k)),
        "shadow_ndcg": F.when(judged, ndcg(F.col("shadow"), F.col("judged"), k)),
        "primary_mrr": F.when(judged, reciprocal_rank(F.col("primary"), F.col("judged"), k)),
        "shadow_mrr": F.when(judged, reciprocal_rank(F.col("shadow"), F.col("judged"), k)),
    }
    out = pairs.select("query_id", judged.alias("_judged"), *[c.alias(name) for name, c in measures.items()])
    worse = (F.col("shadow_ndcg") < least_ndcg) | (F.col("primary_ndcg") - F.col("shadow_ndcg") > largest_drop) | (F.col("shadow_mrr") < least_mrr)
    code = F.when(F.col("_judged") & worse, "shadow_relevance_regression").when(~F.col("_judged") & (F.col("overlap_rate_at_k") < least_overlap), "shadow_overlap_regression")
    return out.withColumn("code", code).withColumn("severity", F.when(F.col("code") == "shadow_relevance_regression", "high").when(F.col("code").isNotNull(), "medium")).drop("_judged")
