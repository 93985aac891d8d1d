"""Inputs of the registered queries, derived from the shared tables; each has its DuckDB counterpart in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from converge.policy import Policy, Rule


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: When freshness is judged, so that results do not depend on the clock.
NOW = "2024-01-31 00:00:00"
RULES = (Rule("document_core", freshness_ttl_seconds=15 * 86_400), Rule("customer_profile"), Rule("optional_tags", required=False))
STRICT = Policy("customerDocument", RULES, "customer_documents", allow_partial_optional_publish=False)
PARTIAL = Policy("customerDocument", RULES, None, allow_partial_optional_publish=True)


def now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical events: users' actions as fragments of three owners, with versions out of order."""
    e = table(spark, sf_dir, "events")
    owner = F.when(F.col("event_type").isin("signup", "error"), "document_core").when(F.col("event_type") == "purchase", "customer_profile").otherwise("optional_tags")
    return e.select(
        F.concat(F.lit("tenant-"), (F.col("user_id") % 10).cast("string")).alias("tenant_id"),
        F.lit("customer_documents").alias("domain_name"),
        F.lit("customerDocument").alias("entity_type"),
        (F.col("user_id") * 20 + F.col("event_id") % 20).cast("string").alias("logical_entity_id"),
        owner.alias("fragment_owner"),
        ((F.col("event_id") * 7919) % 1000).alias("source_version"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("event_time_utc"),
        F.when((F.col("event_type") == "error") | (F.col("event_id") % 3 == 0), "delete").otherwise("upsert").alias("change_type"),
        F.col("props").alias("payload"),
    )


CHANGE_EVENTS = """
change_events AS (
  SELECT 'tenant-' || (user_id % 10) AS tenant_id, 'customer_documents' AS domain_name, 'customerDocument' AS entity_type,
         CAST(user_id * 20 + event_id % 20 AS VARCHAR) AS logical_entity_id,
         CASE WHEN event_type IN ('signup', 'error') THEN 'document_core' WHEN event_type = 'purchase' THEN 'customer_profile' ELSE 'optional_tags' END AS fragment_owner,
         (event_id * 7919) % 1000 AS source_version, event_id AS seq, ts AS event_time_utc,
         CASE WHEN event_type = 'error' OR event_id % 3 = 0 THEN 'delete' ELSE 'upsert' END AS change_type, props AS payload
  FROM events)"""


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as one store's documents, and as another's that lost, changed, deleted and added some."""
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    plain = o.select(
        F.col("o_orderkey").alias("_k"),
        F.col("o_orderkey").cast("string").alias("document_id"),
        F.md5(F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus", price)).alias("checksum"),
        (F.col("o_custkey") % 10).cast("string").alias("tenant_id"),
        F.col("o_orderpriority").alias("cohort"),
        F.lit(False).alias("is_deleted"),
    )
    changed = F.when(F.col("_k") % 89 == 0, F.md5(F.concat("checksum", F.lit("!")))).otherwise(F.col("checksum"))
    kept = plain.where("_k % 97 <> 0").select("document_id", changed.alias("checksum"), "tenant_id", "cohort", (F.col("_k") % 83 == 0).alias("is_deleted"))
    added = plain.where("_k % 101 = 0").select((F.col("_k") + 1_000_000).cast("string").alias("document_id"), "checksum", "tenant_id", "cohort", "is_deleted")
    return plain.drop("_k"), kept.unionByName(added)


SNAPSHOTS = """
plain AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS document_id,
         md5(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)))) AS checksum,
         CAST(o_custkey % 10 AS VARCHAR) AS tenant_id, o_orderpriority AS cohort, false AS is_deleted
  FROM orders),
source AS (SELECT document_id, checksum, tenant_id, cohort, is_deleted FROM plain),
target AS (
  SELECT document_id, CASE WHEN k % 89 = 0 THEN md5(checksum || '!') ELSE checksum END AS checksum, tenant_id, cohort, k % 83 = 0 AS is_deleted FROM plain WHERE k % 97 <> 0
  UNION ALL
  SELECT CAST(k + 1000000 AS VARCHAR), checksum, tenant_id, cohort, is_deleted FROM plain WHERE k % 101 = 0)"""

ORDER_FIELDS = {"Status": "o_orderstatus", "Priority": "o_orderpriority", "TotalPrice": "o_totalprice", "OrderDate": "o_orderdate", "Key": "o_orderkey"}


def rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, primary, shadow, judged: documents of a language by length, and by another order, with graded labels."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    l = table(spark, sf_dir, "labels")
    grade = F.greatest(F.col("quality") * 2 - F.col("toxic"), F.lit(0)).cast("double")
    # Each ranking keeps its 20 best by a rank of its own, which Spark applies before it shuffles.
    first = lambda df, side, *order: df.select("lang", "doc_id", F.lit(side).alias("side"), F.row_number().over(_by_lang(*order)).alias("at")).where("at <= 20")
    best = first(d, "primary", F.desc("n_chars"), F.col("doc_id")).unionByName(first(d, "shadow", F.col("doc_id") % 7, F.desc("n_chars"), F.col("doc_id")))
    listed = lambda side: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == side, F.struct("at", F.col("doc_id").cast("string").alias("id"))))), lambda x: x["id"]).alias(side)
    ranked = best.groupBy("lang").agg(listed("primary"), listed("shadow"))
    # Grades of the documents that are ranked or among the 20 best graded ones, which is all that a measure at 10 can need.
    grades = l.select("doc_id", grade.alias("grade"))
    graded = first(d.join(grades, "doc_id"), "graded", F.desc("grade"), F.col("doc_id"))
    wanted = best.unionByName(graded).select("lang", "doc_id").distinct().join(grades, "doc_id")
    judged = wanted.groupBy("lang").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("doc_id").cast("string"), "grade")))).alias("judged"))
    return ranked.join(judged, "lang", "left").select(F.col("lang").alias("query_id"), "primary", "shadow", "judged")


def _by_lang(*order: Column):
    from pyspark.sql import Window

    return Window.partitionBy("lang").orderBy(*order)


RANKINGS = """
p AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS r FROM documents),
s AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id % 7, n_chars DESC, doc_id) AS r FROM documents),
g AS (SELECT lang, doc_id, greatest(quality * 2 - toxic, 0)::DOUBLE AS grade FROM documents JOIN labels USING (doc_id)),
langs AS (SELECT DISTINCT lang FROM documents),
ideal AS (
  SELECT lang, sum((pow(2, grade) - 1) / log2(r + 1)) AS idcg
  FROM (SELECT lang, grade, row_number() OVER (PARTITION BY lang ORDER BY grade DESC) AS r FROM g) WHERE r <= 10 GROUP BY lang),
gain AS (
  SELECT side, lang, sum((pow(2, coalesce(grade, 0)) - 1) / log2(r + 1)) AS dcg, min(CASE WHEN grade > 0 THEN r END) AS first_r
  FROM (SELECT 'primary' AS side, * FROM p WHERE r <= 10 UNION ALL SELECT 'shadow', * FROM s WHERE r <= 10) LEFT JOIN g USING (lang, doc_id)
  GROUP BY side, lang),
measures AS (
  SELECT side, lang, CASE WHEN coalesce(idcg, 0) = 0 THEN 0 ELSE dcg / idcg END AS ndcg, coalesce(1.0::DOUBLE / first_r, 0) AS mrr
  FROM gain LEFT JOIN ideal USING (lang))"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request log: events with their values as latencies, failed if they are errors."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("seq"), F.col("event_type").alias("case_name"), F.concat(F.lit("backend-"), (F.col("user_id") % 5).cast("string")).alias("backend"), F.col("value").alias("latency_ms"), (F.col("event_type") != "error").alias("ok"), (F.col("event_id") % 25).alias("result_count"), F.when(F.col("event_type") == "error", "BackendError").alias("error_type"))


REQUESTS = """
requests AS (
  SELECT event_id AS seq, event_type AS case_name, 'backend-' || (user_id % 5) AS backend, value AS latency_ms, event_type <> 'error' AS ok,
         event_id % 25 AS result_count, CASE WHEN event_type = 'error' THEN 'BackendError' END AS error_type
  FROM events)"""
