"""Change records of each kind of source, made of the shared events, to canonical events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from converge.functions import versions
from converge.plans.inputs import table
from converge.sources import normalise as n

FEED = n.Source("customer_documents", "customerDocument", "document_core", "cosmos", version_field="_lsn")
LOG = n.Source("customer_documents", "customerDocument", "customer_profile", "alloydb", tenant_field="tenant_id", version_field="lsn")
STREAM = n.Source("customer_documents", "customerDocument", "optional_tags", "spanner", tenant_field="tenant_id")


def _out(df: DataFrame, *more: Column | str) -> DataFrame:
    return df.select("tenant_id", "logical_entity_id", F.col("source_version").cast("string").alias("source_version"), F.unix_millis("event_time_utc").alias("event_ms"), "change_type", F.coalesce("problem", F.lit("")).alias("problem"), *more)


def _hex(c: Column) -> Column:
    return F.lower(F.hex(c))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"))


def change_feed_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh record has no id; versions come as text, as numbers and with a fraction."""
    e = _events(spark, sf_dir)
    lsn = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('"'), F.col("event_id").cast("string"), F.lit('"'))).when(F.col("event_id") % 3 == 1, F.col("event_id").cast("string")).otherwise(F.concat(F.col("event_id").cast("string"), F.lit(".5")))
    record = F.format_string('{"id":"%s","tenantId":"t-%d","_lsn":%s,"_ts":%d,"_etag":"x","operationType":"%s","kind":"%s"}', F.when(F.col("event_id") % 7 > 0, F.col("event_id").cast("string")).otherwise(F.lit("")), F.col("user_id") % 10, lsn, F.col("s"), F.when(F.col("event_type") == "error", " Deleted ").otherwise("replace"), F.col("event_type"))
    return _out(n.change_feed(e.select(record.alias("record")), FEED), F.coalesce("payload", F.lit("")).alias("payload"))


def log_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both spellings of log positions, deletions with images before, and truncations, which are refused."""
    e = _events(spark, sf_dir)
    position = F.when(F.col("event_id") % 2 == 0, F.concat(_hex(F.col("event_id") + 16), F.lit("/"), _hex(F.col("user_id") + 1))).otherwise(F.concat(_hex(F.col("event_id") + 16), F.lit(":"), _hex(F.col("user_id") + 1), F.lit(":"), F.lit("0009")))
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "view", "r").when(F.col("event_id") % 97 == 0, "t").otherwise("u")
    image = F.format_string('{"id":"%d","tenant_id":"t-%d"}', F.col("event_id"), F.col("user_id") % 10)
    record = F.format_string('{"payload":{"op":"%s","ts_ms":%d,"source":{"lsn":"%s"},"before":%s,"after":%s}}', op, F.col("s") * 1000, position, F.when(op == "d", image).otherwise("null"), F.when(op != "d", image).otherwise("null"))
    return _out(n.log_capture(e.select(record.alias("record")), LOG))


TIMED = n.Source("customer_documents", "customerDocument", "customer_profile", "alloydb", tenant_field="tenant_id", version_field="lsn", timestamp_versions=True)


def log_normalise_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without a log position: nanoseconds, else microseconds, else milliseconds stand for the version."""
    e = _events(spark, sf_dir)
    clocks = F.when(F.col("event_id") % 3 == 0, F.format_string('"ts_ns":%d', F.col("s") * 1_000_000_000 + 7)).when(F.col("event_id") % 3 == 1, F.format_string('"ts_us":%d', F.col("s") * 1_000_000 + 5)).otherwise('"x":1')
    record = F.format_string('{"payload":{"op":"u","ts_ms":%d,%s,"source":{},"after":{"id":"%d","tenant_id":"t-%d"}}}', F.col("s") * 1000, clocks, F.col("event_id"), F.col("user_id") % 10)
    return _out(n.log_capture(e.select(record.alias("record")), TIMED))


def stream_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenants in the keys, deletions without old values, sequences with other characters, and inserts without values."""
    e = _events(spark, sf_dir)
    gone = F.col("event_type") == "error"
    record = F.format_string('{"mod_type":"%s","keys":{"id":"%d","tenant_id":"t-%d"},"new_values":%s,"record_sequence":"%s","commit_timestamp":"%s"}', F.when(gone, "DELETE").otherwise("update"), F.col("event_id"), F.col("user_id") % 10, F.when(gone | (F.col("event_id") % 11 == 0), "{}").otherwise(F.format_string('{"name":"n%d"}', F.col("event_id"))), F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("seq-"), F.col("event_id").cast("string"))).otherwise(F.col("event_id").cast("string")), F.concat(F.date_format(F.timestamp_seconds("s"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    return _out(n.change_stream(e.select(record.alias("record")), STREAM))


def outbox_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    rows = e.select(
        F.concat(F.lit("t-"), (F.col("user_id") % 10).cast("string")).alias("tenant_id"), F.lit("customer_documents").alias("domain_name"), F.lit("customerDocument").alias("entity_type"), F.col("event_id").cast("string").alias("logical_entity_id"),
        F.lit("document_core").alias("fragment_owner"), (F.col("event_id") - 3).alias("source_version"), F.col("props").alias("payload"), F.when(F.col("event_type") == "click", "upsert").when(F.col("event_type") == "view", "rename").alias("change_type"), F.col("ts").cast("timestamp").alias("event_time_utc"), F.lit(None).cast("string").alias("migration_stage"),
    )
    return _out(n.outbox(rows), "migration_stage")


def lsn_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of 64 and 80 bits, which a 64-bit integer would not hold, from orders."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # Added as a number: keys of more than four digits carry, where a text of four would cut them.
    wide = _hex(F.lit(0xFFFF0000) + F.col("o_custkey"))
    return o.select(
        "o_orderkey",
        versions.log_version(F.concat(wide, F.lit("/"), _hex(F.col("o_orderkey")))).cast("string").alias("postgres"),
        versions.log_version(F.concat(wide, F.lit(":"), _hex(F.col("o_orderkey")), F.lit(":00ff"))).cast("string").alias("sqlserver"),
        versions.log_version(F.col("o_orderkey").cast("string")).cast("string").alias("decimal"),
        versions.log_version(F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))).cast("string").alias("neither"),
    )


QUERIES = {f.__name__: f for f in (change_feed_normalise, log_normalise, log_normalise_timestamps, stream_normalise, outbox_normalise, lsn_parse)}
_E = "e AS (SELECT event_id, user_id, event_type, epoch_us(ts) // 1000000 AS s FROM events)"
ORACLE_SQL = {
    "change_feed_normalise": f"""WITH {_E}
        SELECT 't-' || (user_id % 10) AS tenant_id, CASE WHEN event_id % 7 > 0 THEN CAST(event_id AS VARCHAR) END AS logical_entity_id, CASE WHEN event_id % 3 < 2 THEN CAST(event_id AS VARCHAR) END AS source_version, s * 1000 AS event_ms,
               CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS change_type,
               CASE WHEN event_id % 7 = 0 THEN 'id must be a non-empty string' WHEN event_id % 3 = 2 THEN '_lsn must be a whole number' ELSE '' END AS problem,
               '{{"id":"' || CASE WHEN event_id % 7 > 0 THEN CAST(event_id AS VARCHAR) ELSE '' END || '","kind":"' || event_type || '","tenantId":"t-' || (user_id % 10) || '"}}' AS payload FROM e""",
    "log_normalise": f"""WITH {_E}, x AS (SELECT *, CASE WHEN event_type = 'error' THEN 'delete' WHEN event_type = 'view' THEN 'refresh' WHEN event_id % 97 = 0 THEN NULL ELSE 'upsert' END AS change_type FROM e)
        SELECT 't-' || (user_id % 10) AS tenant_id, CAST(event_id AS VARCHAR) AS logical_entity_id,
               CAST(CASE WHEN event_id % 2 = 0 THEN (event_id + 16)::HUGEINT * 4294967296 + user_id + 1 ELSE (event_id + 16)::HUGEINT * 281474976710656 + (user_id + 1) * 65536 + 9 END AS VARCHAR) AS source_version,
               s * 1000 AS event_ms, change_type, CASE WHEN change_type IS NULL THEN 'op must be a change of one row' ELSE '' END AS problem FROM x""",
    "stream_normalise": f"""WITH {_E}
        SELECT 't-' || (user_id % 10) AS tenant_id, CAST(event_id AS VARCHAR) AS logical_entity_id, CAST(event_id AS VARCHAR) AS source_version, s * 1000 AS event_ms,
               CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS change_type, CASE WHEN event_type <> 'error' AND event_id % 11 = 0 THEN 'no values' ELSE '' END AS problem FROM e""",
    "outbox_normalise": """
        SELECT 't-' || (user_id % 10) AS tenant_id, CAST(event_id AS VARCHAR) AS logical_entity_id, CAST(event_id - 3 AS VARCHAR) AS source_version, epoch_us(ts) // 1000 AS event_ms, CASE WHEN event_type = 'view' THEN 'rename' ELSE 'upsert' END AS change_type,
               CASE WHEN event_id < 3 THEN 'source_version must not be negative' WHEN event_type = 'view' THEN 'unknown change_type' ELSE '' END AS problem, 'gcp_primary_stable' AS migration_stage FROM events""",
    "lsn_parse": """
        SELECT o_orderkey, CAST((4294901760 + o_custkey)::HUGEINT * 4294967296 + o_orderkey AS VARCHAR) AS postgres, CAST((4294901760 + o_custkey)::HUGEINT * 281474976710656 + o_orderkey * 65536 + 255 AS VARCHAR) AS sqlserver,
               CAST(o_orderkey AS VARCHAR) AS "decimal", NULL::VARCHAR AS neither FROM orders""",
}
ORACLE_SQL["log_normalise_timestamps"] = """SELECT 't-' || (user_id % 10) AS tenant_id, event_id::VARCHAR AS logical_entity_id,
    (epoch_us(ts) // 1000000 * 1000000000 + CASE event_id % 3 WHEN 0 THEN 7 WHEN 1 THEN 5000 ELSE 0 END)::VARCHAR AS source_version, epoch_us(ts) // 1000000 * 1000 AS event_ms, 'upsert' AS change_type, '' AS problem FROM events"""
