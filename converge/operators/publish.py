"""Search documents as the lines of bulk requests, and what came back from one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from converge.functions.text import quoted

META = ["document_id", "tenant_id", "domain_name", "entity_type", "projection_version", "completeness_status", "source_versions"]


def body(payload: Column) -> Column:
    """The payload with the document's own fields where it has none, and _meta, which always is the document's."""
    given = F.coalesce(F.try_parse_json(payload).cast("map<string,variant>"), F.create_map().cast("map<string,variant>"))
    own = F.parse_json(F.to_json(F.struct(F.col("document_id").alias("id"), *META[1:]))).cast("map<string,variant>")
    meta = F.create_map(F.lit("_meta"), F.parse_json(F.to_json(F.struct(*META))))
    missing = F.map_filter(own, lambda k, _: ~F.array_contains(F.map_keys(given), k))
    return F.to_json(F.map_concat(missing, F.map_filter(given, lambda k, _: k != "_meta"), meta))


def bulk_lines(documents: DataFrame, index: Column) -> DataFrame:
    """document_id, projection_version, lines: one action and, unless it deletes, one body, versioned from outside."""
    gone = F.col("completeness_status") == "deleted"
    action = F.struct(index.alias("_index"), F.col("document_id").alias("_id"), F.col("tenant_id").alias("routing"), F.col("projection_version").alias("version"), F.lit("external").alias("version_type"))
    lines = F.when(gone, F.array(F.to_json(F.struct(action.alias("delete"))))).otherwise(F.array(F.to_json(F.struct(action.alias("index"))), body(F.col("payload"))))
    return documents.select("document_id", "projection_version", lines.alias("lines"))


def single_requests(documents: DataFrame, index: Column) -> DataFrame:
    """One request for each document: document_id, projection_version, method, path (with its parameters) and body.

    A deletion has no body. The version is given from outside, so the index refuses older ones, whatever order requests
    arrive in, and a request that is sent again changes nothing.
    """
    gone = F.col("completeness_status") == "deleted"
    path = F.concat(F.lit("/"), quoted(index), F.lit("/_doc/"), quoted(F.col("document_id")))
    params = F.concat(F.lit("?routing="), quoted(F.col("tenant_id")), F.lit("&version="), F.col("projection_version").cast("string"), F.lit("&version_type=external"))
    return documents.select("document_id", "projection_version", F.when(gone, "DELETE").otherwise("PUT").alias("method"), F.concat(path, params).alias("path"), F.when(~gone, body(F.col("payload"))).alias("body"))


def write_bulk(lines: DataFrame, path: str) -> None:
    """NDJSON files, the lines of a document together."""
    lines.select(F.concat_ws("\n", "lines").alias("value")).write.mode("append").text(path)


_ITEMS = "items array<map<string, struct<_id:string, status:int, error:struct<type:string, reason:string>>>>"


def failed_items(responses: DataFrame, column: str = "response") -> DataFrame:
    """document_id, action, status, error_type, error_reason of each item of a bulk response that failed."""
    item = responses.select(F.explode(F.from_json(column, _ITEMS)["items"]).alias("i")).select(F.explode("i").alias("action", "r"))
    return item.where("r.error is not null").select(F.col("r._id").alias("document_id"), "action", F.col("r.status").alias("status"), F.col("r.error.type").alias("error_type"), F.col("r.error.reason").alias("error_reason"))


def acknowledged(responses: DataFrame, column: str = "response") -> DataFrame:
    """document_id, action, status, error_type, error_reason of each item of bulk responses, failed or not."""
    item = responses.select(F.explode(F.from_json(column, _ITEMS)["items"]).alias("i")).select(F.explode("i").alias("action", "r"))
    return item.select(F.col("r._id").alias("document_id"), "action", F.col("r.status").alias("status"), F.col("r.error.type").alias("error_type"), F.col("r.error.reason").alias("error_reason"))


#: What an attempt to publish comes to. A document that is superseded is settled: the index holds a newer version.
DELIVERED, SUPERSEDED, RETRY, DEAD = "delivered", "superseded", "retry", "dead_letter"
ATTEMPTS = 3


def outcomes(sent: DataFrame, acknowledgements: DataFrame, most_attempts: int = ATTEMPTS, by: str = "document_id") -> DataFrame:
    """What was sent (`by`, unique among it, attempt from 1, and others), with outcome, status and error_type.

    A version conflict is settled, and so is a deletion of what is not there. Refused for now (429, 5xx) or not answered at
    all is tried again, until the attempts are used up; any other refusal is final. Projection states are not touched.
    """
    joined = sent.join(acknowledgements.select(by, "action", "status", "error_type"), by, "left")
    again = F.col("status").isNull() | (F.col("status") == 429) | (F.col("status") >= 500)
    settled = F.when(F.col("status").between(200, 299) | ((F.col("status") == 404) & (F.col("action") == "delete")), DELIVERED).when(F.col("status") == 409, SUPERSEDED)
    return joined.withColumn("outcome", settled.when(again & (F.col("attempt") < most_attempts), RETRY).otherwise(DEAD)).drop("action")


def hits(responses: DataFrame, column: str = "response", id_field: str = "id") -> DataFrame:
    """query_id, ids, total of search responses of either shape: `value` with `@odata.count`, or `hits` with `_source`."""
    v = F.try_parse_json(F.col(column))
    flat = F.try_variant_get(v, "$.value", "array<variant>")
    nested = F.try_variant_get(v, "$.hits.hits", "array<variant>")
    text = lambda x, *paths: F.coalesce(*[F.try_variant_get(x, p, "string") for p in paths])
    ids = F.coalesce(F.transform(flat, lambda x: text(x, f"$.{id_field}", "$.id")), F.transform(nested, lambda x: text(x, f"$._source.{id_field}", "$._id")))
    total = F.coalesce(*[F.try_variant_get(v, p, "bigint") for p in ('$["@odata.count"]', "$.hits.total.value", "$.hits.total")])
    return responses.select("query_id", F.filter(ids, lambda i: i.isNotNull()).alias("ids"), total.alias("total"))


def dead_letters(failed: DataFrame, stage: str, reason: Column) -> DataFrame:
    """Rows as JSON with where and why they failed."""
    return failed.select(F.lit(stage).alias("failure_stage"), reason.alias("reason"), F.to_json(F.struct("*")).alias("payload"))
