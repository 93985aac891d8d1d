"""OData requests over orders and parts, and tenant routing over customers."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from converge.functions import routing, text
from converge.lineage import folder
from converge.operators.search import Search, routed
from converge.plans.inputs import ORDER_FIELDS, table
from converge.tables import textindex

FILTER = "(Status eq 'F' and TotalPrice gt 100000) or not Priority eq '5-LOW'"
_WHERE = "(o_orderstatus = 'F' AND o_totalprice > 100000) OR o_orderpriority IS DISTINCT FROM '5-LOW'"


def _orders(spark: SparkSession, sf_dir: str, **params: str) -> Search:
    return Search(table(spark, sf_dir, "orders"), {f"${k}": v for k, v in params.items()}, ORDER_FIELDS, "o_orderkey")


def odata_filter_and_or_not(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, filter=FILTER).matched


def odata_search_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, filter="search.in(Status, 'O, P,,') and TotalPrice le 250000.5").matched


def odata_not_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null field differs from every value; a third of the statuses are made null first."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")))
    return Search(orders, {"$filter": "Status ne 'F' and not (Status eq 'O')"}, ORDER_FIELDS, "o_orderkey").matched.select("o_orderkey", "o_orderstatus")


def odata_orderby_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, filter=FILTER, orderby="Priority,TotalPrice desc", top="50", skip="20", select="Key,Priority,TotalPrice").page()


def odata_top_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, orderby="OrderDate desc", select="Key").page()


def odata_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, filter=FILTER, facets="Status,Priority").facets()


def odata_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, filter=FILTER).count()


def text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose name or type has a term of the query, with their score."""
    found = Search(table(spark, sf_dir, "part"), {"$search": "Red, SMALL red"}, {}, "p_partkey", {"p_name": 3.0, "p_type": 1.0})
    return found.matched.select("p_partkey", F.col("_score").alias("score"))


def routed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same filter for each of ten tenants, in the table that the tenant's route names."""
    tenant = F.concat(F.lit("tenant-"), (F.col("o_custkey") % 10).cast("string"))
    dedicated = {"tenant-7"}
    orders = table(spark, sf_dir, "orders").withColumn("tenant_id", tenant)
    alias = routing.tenant_route(F.col("tenant_id"), F.lit("order"), dedicated)["read_alias"]
    tables = {f"order-{name}-read": orders.where(alias == f"order-{name}-read") for name in ("tenant-7", "shared_a", "shared_b")}
    each = []
    for k in range(10):
        found = routed(tables, f"tenant-{k}", "order", {"$filter": "Status eq 'F'"}, ORDER_FIELDS, "o_orderkey", "tenant_id", dedicated)
        each.append(found.matched.groupBy("tenant_id").agg(F.count("*").alias("total")))
    return reduce(DataFrame.unionByName, each)


RANKED = "the eratha Thonan, blew"


def text_search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of a query, by an index of all of them."""
    path = f"{folder(spark)}/index-{uuid.uuid4().hex}"
    textindex.build(table(spark, sf_dir, "documents"), path)
    return textindex.TextIndex(spark, path).search(RANKED, 20)


def tenant_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("tenant-"), F.col("c_custkey").cast("string")).alias("tenant_id"))
    route = routing.tenant_route(F.col("tenant_id"), F.lit("customerDocument"), {"tenant-7", "tenant-42"})
    return c.select("tenant_id", *[v.alias(k) for k, v in route.items()])


def ingest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("tenant-"), F.col("c_custkey").cast("string")).alias("tenant_id"))
    lane = routing.ingest_partition(F.col("tenant_id"), F.lit("customerDocument"), {"tenant-7"})
    return c.select("tenant_id", *[v.alias(k) for k, v in lane.items()])


def canary_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("tenant-"), F.col("c_custkey").cast("string")).alias("tenant_id"), F.col("c_name").alias("consumer_id"))
    both = F.concat_ws(":", "tenant_id", "consumer_id")
    shadow = F.concat_ws(":", F.lit("shadow"), "tenant_id", "consumer_id", F.lit("customerDocument"))
    return c.select("consumer_id", routing.traffic_bucket(both).alias("bucket"), routing.in_canary(F.col("tenant_id"), F.col("consumer_id"), 20).alias("in_canary"), (routing.traffic_bucket(shadow) < 50).alias("observed"))


def odata_typed_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literals of other types than their columns: a number for a text, texts for a number and a time, a fraction for an integer."""
    orders = table(spark, sf_dir, "orders").withColumn("code", (F.col("o_orderkey") % 7).cast("string")).withColumn("number", (F.col("o_custkey") % 11).cast("int"))
    fields = ORDER_FIELDS | {"Code": "code", "Number": "number"}
    found = Search(orders, {"$filter": "(Code eq 5 or search.in(Number, '3, 4')) and TotalPrice gt '100000' and OrderDate ge '1995-01-01' and Number lt 8.5"}, fields, "o_orderkey").matched
    return found.select("o_orderkey", "code", "number")


def odata_quoted_not(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, filter="not (Status eq 'F') and Priority ne 'not(x'").matched.select("o_orderkey")


def odata_search_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """$search=* matches everything; the filter still holds."""
    return _orders(spark, sf_dir, search="*", filter="Status eq 'O'").count()


def odata_top_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of more rows than one may have."""
    return _orders(spark, sf_dir, orderby="TotalPrice desc", top="5000", select="Key").page()


def tenant_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The open orders of one tenant, by size."""
    orders = table(spark, sf_dir, "orders").withColumn("tenant_id", F.concat(F.lit("tenant-"), (F.col("o_custkey") % 10).cast("string")))
    return Search(orders, {"$filter": "Status eq 'O'"}, ORDER_FIELDS, "o_orderkey", tenant=("tenant_id", "tenant-3")).matched.select("tenant_id", "o_orderkey")


def names_and_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collection names, quoted paths and flags from the texts of parts and their containers."""
    p = table(spark, sf_dir, "part")
    flag = F.when(F.col("p_partkey") % 5 == 0, " YES ").when(F.col("p_partkey") % 5 == 1, "on").when(F.col("p_partkey") % 5 == 2, "true").when(F.col("p_partkey") % 5 == 3, "no")
    odd = F.concat(F.col("p_name"), F.lit(" é/*~+&?"), F.col("p_type"))
    return p.select("p_partkey", text.collection_name("cutover", odd, "events").alias("collection"), text.quoted(odd).alias("quoted"), text.truth(flag).alias("requested"), text.truth(flag, text.SETTING_TRUE).alias("set"))


QUERIES = {f.__name__: f for f in (odata_typed_literals, odata_quoted_not, odata_search_all, odata_top_clamp, tenant_scope, names_and_flags, odata_filter_and_or_not, odata_search_in, odata_not_equal, odata_orderby_page, odata_top_default, odata_facets, odata_count, tenant_routing, ingest_partition, canary_bucket, text_search, text_search_ranked, routed_search)}

_SHA = "((('0x' || substr(h, 1, 32))::UHUGEINT % n) * (('0xffffffffffffffffffffffffffffffff'::UHUGEINT % n + 1) % n) + ('0x' || substr(h, 33, 32))::UHUGEINT % n) % n"
ORACLE_SQL = {
    "odata_filter_and_or_not": f"SELECT * FROM orders WHERE {_WHERE}",
    "odata_search_in": "SELECT * FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_totalprice <= 250000.5",
    "odata_not_equal": "SELECT o_orderkey, s AS o_orderstatus FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS s FROM orders) WHERE s IS DISTINCT FROM 'F' AND s IS DISTINCT FROM 'O'",
    "odata_orderby_page": f"SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE {_WHERE} ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 20",
    "odata_typed_literals": "SELECT o_orderkey, (o_orderkey % 7)::VARCHAR AS code, (o_custkey % 11)::INTEGER AS number FROM orders WHERE (o_orderkey % 7 = 5 OR o_custkey % 11 IN (3, 4)) AND o_totalprice > 100000 AND o_orderdate >= DATE '1995-01-01' AND o_custkey % 11 < 8.5",
    "odata_quoted_not": "SELECT o_orderkey FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F' AND o_orderpriority IS DISTINCT FROM 'not(x'",
    "odata_search_all": "SELECT count(*) AS total FROM orders WHERE o_orderstatus = 'O'",
    "odata_top_clamp": "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000",
    "tenant_scope": "SELECT 'tenant-' || o_custkey % 10 AS tenant_id, o_orderkey FROM orders WHERE o_custkey % 10 = 3 AND o_orderstatus = 'O'",
    "names_and_flags": """
        SELECT p_partkey, 'cutover__' || regexp_replace(odd, '[^0-9A-Za-z_-]+', '_', 'g') || '__events' AS collection, url_encode(odd) AS quoted, p_partkey % 5 IN (0, 2) AS requested, p_partkey % 5 IN (0, 1, 2) AS "set"
        FROM (SELECT p_partkey, p_name || ' é/*~+&?' || p_type AS odd FROM part)""",
    "odata_top_default": "SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10",
    "odata_facets": f"""
        SELECT * FROM (SELECT 'o_orderstatus' AS field, o_orderstatus AS value, count(*) AS n FROM orders WHERE {_WHERE} GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
        UNION ALL
        SELECT * FROM (SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders WHERE {_WHERE} GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)""",
    "text_search": """
        SELECT p_partkey, greatest(3.0::DOUBLE * n, 1.0::DOUBLE * t) AS score
        FROM (SELECT p_partkey, len(list_intersect(string_split(lower(p_name), ' '), ['red', 'small'])) AS n, len(list_intersect(string_split(lower(p_type), ' '), ['red', 'small'])) AS t FROM part) WHERE n + t > 0""",
    "odata_count": f"SELECT count(*) AS total FROM orders WHERE {_WHERE}",
    "tenant_routing": f"""
        SELECT tenant_id, CASE WHEN own THEN 'dedicated' ELSE shared END AS routing_class, base || '-read' AS read_alias, base || '-write' AS write_alias, CASE WHEN NOT own THEN tenant_id END AS routing_key
        FROM (SELECT *, 'customerDocument-' || CASE WHEN own THEN tenant_id ELSE shared END AS base
              FROM (SELECT tenant_id, tenant_id IN ('tenant-7', 'tenant-42') AS own, CASE WHEN {_SHA.replace("n)", "2)").replace("% n", "% 2")} = 0 THEN 'shared_a' ELSE 'shared_b' END AS shared
                    FROM (SELECT 'tenant-' || c_custkey AS tenant_id, sha256('tenant-' || c_custkey) AS h FROM customer)))""",
    "ingest_partition": f"""
        SELECT tenant_id, grp AS partition_group, grp || ':' || CASE WHEN whale THEN 'dedicated' ELSE tenant_id END AS partition_key, whale AS dedicated
        FROM (SELECT tenant_id, tenant_id = 'tenant-7' AS whale, CASE WHEN tenant_id = 'tenant-7' THEN 'customerDocument-tenant-7' ELSE 'customerDocument-shared-' || lpad(CAST({_SHA.replace("n)", "32)").replace("% n", "% 32")} AS VARCHAR), 2, '0') END AS grp
              FROM (SELECT 'tenant-' || c_custkey AS tenant_id, sha256('tenant-' || c_custkey || ':customerDocument') AS h FROM customer))""",
    "canary_bucket": """
        SELECT c_name AS consumer_id, CAST(('0x' || md5('tenant-' || c_custkey || ':' || c_name))::UHUGEINT % 100 AS BIGINT) AS bucket,
               ('0x' || md5('tenant-' || c_custkey || ':' || c_name))::UHUGEINT % 100 < 20 AS in_canary,
               ('0x' || md5('shadow:tenant-' || c_custkey || ':' || c_name || ':customerDocument'))::UHUGEINT % 100 < 50 AS observed
        FROM customer""",
}

_WANTED = ", ".join(f"'{w}'" for w in ("the", "eratha", "thonan", "blew"))
ORACLE_SQL["text_search_ranked"] = rf"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS words FROM documents),
    a AS (SELECT count(*) AS n, avg(len(words)) AS average FROM w),
    p AS (SELECT doc_id, len(words) AS length, unnest(words) AS term FROM w),
    t AS (SELECT doc_id, length, term, count(*) AS tf FROM p WHERE term IN ({_WANTED}) GROUP BY ALL),
    f AS (SELECT term, ln(1 + ((SELECT n FROM a) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS weight FROM t GROUP BY term)
    SELECT doc_id AS id, round(sum(weight * tf * {textindex.K1 + 1}::DOUBLE / (tf + {textindex.K1}::DOUBLE * ({1 - textindex.B}::DOUBLE + {textindex.B}::DOUBLE * length / (SELECT average FROM a)))), 9) AS score
    FROM t JOIN f USING (term) GROUP BY doc_id ORDER BY score DESC, id LIMIT 20"""
ORACLE_SQL["routed_search"] = "SELECT 'tenant-' || (o_custkey % 10) AS tenant_id, count(*) AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"
