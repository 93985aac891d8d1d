"""The fold of change events into projections."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from converge.lineage import folder
from converge.operators import projection as p
from converge.operators import publish, reports
from converge.plans.inputs import CHANGE_EVENTS, NOW, PARTIAL, RULES, STRICT, change_events, now
from converge.policy import Policy, resolved
from converge.sources import normalise
from converge.tables import bucketed


def _history(spark: SparkSession, sf_dir: str, policy: Policy = STRICT) -> DataFrame:
    return p.history(change_events(spark, sf_dir), policy, now())


def _text(df: DataFrame) -> DataFrame:
    for c, kind in df.dtypes:
        if kind == "array<string>":
            df = df.withColumn(c, F.array_join(c, ","))
    return df


def fragment_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.latest_fragments(change_events(spark, sf_dir))


def projection_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(_history(spark, sf_dir).drop("payloads", "payload", "age_ms"))


def projection_history_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(_history(spark, sf_dir, PARTIAL).drop("payloads", "payload", "age_ms"))


def projection_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(p.state(_history(spark, sf_dir).drop("payloads", "payload", "age_ms")))


def pending_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.pending(p.state(_history(spark, sf_dir)))


def publish_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = p.documents(_history(spark, sf_dir, PARTIAL))
    return docs.select("document_id", "tenant_id", "seq", "projection_version", "completeness_status", "payload")


def _typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events with payloads of all types: a number that is text in some events, nesting, arrays, null and booleans."""
    k = F.col("seq").cast("string")
    number = F.when(F.col("seq") % 2 == 0, k).otherwise(F.concat(F.lit('"'), k, F.lit('"')))
    own = F.when(F.col("fragment_owner") == "document_core", F.concat(F.lit('{"n":'), number, F.lit(',"core":{"deep":[1,{"x":null}],"on":true}}'))).when(
        F.col("fragment_owner") == "customer_profile", F.concat(F.lit('{"n":'), (F.col("seq") % 2).cast("string"), F.lit(',"list":[1,"1",false],"none":null}'))
    ).otherwise(F.concat(F.lit('{"tags":["a","b"],"ratio":0.5,"k":'), k, F.lit("}")))
    return change_events(spark, sf_dir).withColumn("payload", own)


def merged_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole payloads of what is published, with their types, and the versions that follow from them."""
    docs = p.documents(p.history(_typed_events(spark, sf_dir), PARTIAL, now()))
    return docs.select("document_id", "seq", "projection_version", "payload")


def _with_bad_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.when(F.col("seq") % 21 == 0, F.lit("{broken")).when(F.col("seq") % 21 == 7, F.lit("[1]")).when(F.col("seq") % 21 == 14, F.lit(None).cast("string"))
    return change_events(spark, sf_dir).withColumn("payload", F.when(F.col("seq") % 7 == 0, bad).otherwise(F.col("payload")))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of events of which every seventh cannot be applied, and no job ends for it."""
    return _text(p.history(_with_bad_payloads(spark, sf_dir), STRICT, now()).drop("payloads", "payload", "age_ms"))


def quarantined_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that cannot be applied, with the reason: a payload that is no object, or no policy."""
    e = _with_bad_payloads(spark, sf_dir).withColumn("entity_type", F.when(F.col("seq") % 5 == 0, F.lit("unknown")).otherwise(F.col("entity_type")))
    return p.folded(e, [STRICT, PARTIAL], now())[1].select("seq", "status", "reason_code")


def quarantine_without_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States where every fifth event's type has no policy: its entity is quarantined and stays pending."""
    e = change_events(spark, sf_dir).withColumn("entity_type", F.when(F.col("seq") % 5 == 0, F.lit("unknown")).otherwise(F.col("entity_type")))
    return _text(p.state(p.folded(e, [STRICT], now())[0]).drop("payloads", "payload", "age_ms"))


def _two_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_events(spark, sf_dir).withColumn("domain_name", F.when(F.col("seq") % 3 == 0, F.lit("other")).otherwise(F.col("domain_name")))


def projection_two_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of events of two domains, each by its own policy, in one pass."""
    return _text(p.folded(_two_domains(spark, sf_dir), [STRICT, PARTIAL], now())[0].drop("payloads", "payload", "age_ms"))


def projection_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of the second half of all events, which goes on from what the first half hands over."""
    e = _two_domains(spark, sf_dir)
    half = e.agg(F.max("seq")).first()[0] // 2
    held = p.handed_over(e.where(F.col("seq") <= half), [STRICT, PARTIAL], now())
    return _text(p.folded(e.where(F.col("seq") > half), [STRICT, PARTIAL], now(), held)[0].drop("payloads", "payload", "age_ms"))


def publish_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What publications come to if every seventh is refused, for now or for good, every eleventh is too old, and some get no answer."""
    docs = p.documents(_history(spark, sf_dir, PARTIAL)).withColumn("document_id", F.concat_ws("/", "document_id", "seq"))
    status = F.when(F.col("seq") % 14 == 0, 503).when(F.col("seq") % 7 == 0, 400).when(F.col("seq") % 11 == 0, 409).otherwise(200)
    item = F.create_map(F.when(F.col("completeness_status") == "deleted", "delete").otherwise("index"), F.struct(F.col("document_id").alias("_id"), status.alias("status"), F.when(status >= 400, F.struct(F.lit("refused").alias("type"), F.lit("told").alias("reason"))).alias("error")))
    responses = docs.where("seq % 13 <> 0").select(F.to_json(F.struct(F.array(item).alias("items"))).alias("response"))
    sent = docs.select("document_id", "seq", "projection_version", (F.col("seq") % 3 + 1).alias("attempt"))
    return publish.outcomes(sent, publish.acknowledged(responses)).select("document_id", "seq", "projection_version", "attempt", "status", "error_type", "outcome")


def publish_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole bodies of what is indexed: the payload's fields, the document's own and _meta."""
    docs = p.documents(_history(spark, sf_dir))
    return publish.single_requests(docs, F.col("entity_type")).where("body is not null").select("document_id", "projection_version", "body")


def source_version_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which version of which owner each entity's state was made of."""
    states = p.state(_history(spark, sf_dir))
    return states.select("tenant_id", "logical_entity_id", F.explode(p.version_map(F.col("source_versions"))).alias("fragment_owner", "version")).withColumn("version", F.col("version").cast("long"))


def ordering_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the key that a broker orders them by."""
    return change_events(spark, sf_dir).groupBy(normalise.ordering_key().alias("ordering_key")).agg(F.count("*").alias("events"), F.max("seq").alias("last_seq"))


def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of the entity with the smallest id of each tenant."""
    keys = change_events(spark, sf_dir).groupBy("tenant_id", "domain_name", "entity_type").agg(F.min("logical_entity_id").alias("logical_entity_id"))
    return p.looked_up(p.state(_history(spark, sf_dir)), keys).select("tenant_id", "logical_entity_id", "status", "projection_version")


def state_with_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = p.with_fragments(p.state(_history(spark, sf_dir)), p.latest_fragments(change_events(spark, sf_dir)))
    listed = F.array_join(F.transform("fragments", lambda f: F.concat_ws("=", f["fragment_owner"], f["source_version"].cast("string"))), ",")
    return whole.select("tenant_id", "logical_entity_id", "status", listed.alias("fragments"))


def state_with_fragments_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over tables that are stored in buckets by entity: once they are, neither side is shuffled."""
    mark = uuid.uuid4().hex
    sides = {"states": p.state(_history(spark, sf_dir)), "fragments": p.latest_fragments(change_events(spark, sf_dir))}
    states, fragments = (bucketed.store(df, f"{name}_{mark}", p.KEY, f"{folder(spark)}/{name}-{mark}", 8) for name, df in sides.items())
    whole = p.with_fragments(states, fragments)
    listed = F.array_join(F.transform("fragments", lambda f: F.concat_ws("=", f["fragment_owner"], f["source_version"].cast("string"))), ",")
    return whole.select("tenant_id", "logical_entity_id", "status", listed.alias("fragments"))


def handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream takes over after a backfill: each tenant's events after the watermark of the first half of its days."""
    e = change_events(spark, sf_dir)
    marks = reports.watermarks(e.where("event_time_utc < timestamp_ntz'2024-01-16 00:00:00'"), ["tenant_id"])
    return reports.after_watermarks(e, marks, ["tenant_id"]).groupBy("tenant_id").agg(F.count("*").alias("events"), F.min("seq").alias("first_seq"), F.max("watermark").alias("watermark"))


def current_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an index holds after all publications: the newest version of each document, without deleted ones."""
    docs = p.documents(_history(spark, sf_dir, PARTIAL))
    best = docs.groupBy("tenant_id", "document_id").agg(F.max_by(F.struct("completeness_status", "projection_version"), F.struct("projection_version", -F.col("seq"))).alias("d"))
    return best.select("tenant_id", "document_id", "d.*").where("completeness_status <> 'deleted'")


def bulk_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = p.documents(_history(spark, sf_dir))
    lines = publish.bulk_lines(docs, F.concat_ws("-", "entity_type", F.lit("write")))
    return lines.select("document_id", "projection_version", F.size("lines").alias("n_lines"), F.get_json_object(F.element_at("lines", 1), "$.index.version").cast("long").alias("indexed_version"), F.get_json_object(F.element_at("lines", -1), "$._meta.document_id").alias("meta_id"))


def single_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request for each publication, with the whole body of a document."""
    docs = p.documents(_history(spark, sf_dir))
    sent = publish.single_requests(docs, F.concat_ws("-", "entity_type", F.lit("write")))
    return sent.select("document_id", "projection_version", "method", "path", F.get_json_object("body", "$._meta.completeness_status").alias("completeness"))


def time_to_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.completion_times(_history(spark, sf_dir))


def policy_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many events each policy gets: one of their domain first, then one for any domain, else none."""
    e = change_events(spark, sf_dir).withColumn("domain_name", F.when(F.col("seq") % 3 == 0, F.lit("other")).otherwise(F.col("domain_name"))).withColumn("entity_type", F.when(F.col("seq") % 5 == 0, F.lit("unknown")).otherwise(F.col("entity_type")))
    return resolved(e, [STRICT, PARTIAL]).groupBy("policy_at").agg(F.count("*").alias("events"))


def backfill_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = change_events(spark, sf_dir)
    return reports.backfill(p.history(events, STRICT, now()), events, start=100)


def admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last tenth of events against the state before them, over the threshold."""
    events = change_events(spark, sf_dir)
    late = events.where("seq % 10 = 9").withColumn("change_type", F.when(F.col("seq") % 50 == 49, F.lit("repair")).otherwise(F.col("change_type")))
    states = p.state(p.history(events.where("seq % 10 <> 9"), STRICT, now()))
    out = reports.admission(late, states, pending=100, most_pending=100)
    return out.groupBy("reason_code", "accepted").agg(F.count("*").alias("events"))


QUERIES = {f.__name__: f for f in (fragment_latest, projection_history, projection_history_partial, projection_state, pending_count, publish_documents, merged_payload, quarantine, quarantined_events, quarantine_without_policy, projection_two_policies, projection_resumed, publish_outcomes, publish_bodies, source_version_map, ordering_keys, state_lookup, state_with_fragments, state_with_fragments_stored, handoff, current_documents, bulk_requests, single_requests, time_to_completeness, policy_resolution, backfill_summary, admission)}


def _fold(partial: bool, events: str = "change_events", merged: str = "coalesce(f2.p, f1.p, f0.p)") -> str:
    """The fold as SQL: fragments after each event, what they decide, and versions by the last digest.

    An event whose column `bad` is true, where there is one, cannot be applied. merged: the payload of all fragments; those
    of the shared tables have the same single key.
    """
    held = ",\n".join(
        f"max_by(CASE WHEN fragment_owner = '{r.owner}' AND NOT bad THEN {{'v': source_version, 't': event_time_utc, 'p': payload, 'd': change_type = 'delete'}} END, CASE WHEN fragment_owner = '{r.owner}' AND NOT bad THEN row(source_version, seq) END) OVER w AS f{i}"
        for i, r in enumerate(RULES)
    )
    key = "tenant_id, domain_name, entity_type, logical_entity_id"
    last = "WHEN f2 IS NULL THEN {'s': 'pending_required_fragment', 'r': 'optional_publish_disabled', 'c': 'partial'}" if not partial else ""
    return f"""
f AS (SELECT *, {held}, max(CASE WHEN NOT bad THEN event_time_utc END) OVER w AS last_source_change_utc, row_number() OVER w AS entity_revision
  FROM (SELECT *, coalesce(try_cast(payload AS JSON) IS NULL OR json_type(try_cast(payload AS JSON)) <> 'OBJECT', true) AS bad FROM {events}) WINDOW w AS (PARTITION BY {key} ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
d AS (SELECT *, CASE
    WHEN bad THEN {{'s': 'quarantined', 'r': 'quarantined', 'c': NULL}}
    WHEN f0 IS NULL OR f1 IS NULL THEN {{'s': 'pending_required_fragment', 'r': 'missing_required_fragment', 'c': 'partial'}}
    WHEN TIMESTAMP '{NOW}' > f0.t + INTERVAL 15 DAY THEN {{'s': 'pending_rehydration', 'r': 'stale_required_fragment', 'c': 'partial'}}
    WHEN f0.d AND f1.d AND coalesce(f2.d, true) THEN {{'s': 'deleted', 'r': 'all_fragments_deleted', 'c': 'deleted'}}
    {last}
    ELSE {{'s': 'published', 'r': 'published', 'c': CASE WHEN f2 IS NULL THEN 'partial' ELSE 'complete' END}} END AS x,
    concat_ws(',', CASE WHEN f0 IS NULL THEN 'document_core' END, CASE WHEN f1 IS NULL THEN 'customer_profile' END) AS missing,
    CASE WHEN TIMESTAMP '{NOW}' > f0.t + INTERVAL 15 DAY THEN 'document_core' ELSE '' END AS stale,
    concat_ws(',', CASE WHEN f0 IS NOT NULL THEN 'document_core=' || f0.v END, CASE WHEN f1 IS NOT NULL THEN 'customer_profile=' || f1.v END, CASE WHEN f2 IS NOT NULL THEN 'optional_tags=' || f2.v END) AS source_versions,
    {merged} AS merged, least(f0.t, f1.t, f2.t) AS earliest
  FROM f),
h AS (SELECT *, x.s AS status, x.r AS reason_code, coalesce(last_value(x.c IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'partial') AS completeness, CASE x.s WHEN 'deleted' THEN 'd' || source_versions WHEN 'published' THEN 'p' || merged END AS digest FROM d),
l AS (SELECT *, lag(status) OVER o AS previous_status, last_value(digest IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_digest
  FROM h WINDOW o AS (PARTITION BY {key} ORDER BY seq)),
m AS (SELECT *, status IN ('published', 'deleted') AS ends, digest IS NOT DISTINCT FROM last_digest AND status IS NOT DISTINCT FROM previous_status AS same FROM l),
history AS (
  SELECT *, CAST(sum(CASE WHEN ends AND NOT same THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS projection_version,
         status = 'published' OR (status = 'deleted' AND NOT same) AS publish,
         ends AND coalesce(previous_status NOT IN ('published', 'deleted'), true) AS completed
  FROM m)"""


_KEY = "tenant_id, domain_name, entity_type, logical_entity_id"
_ROW = f"{_KEY}, seq, status, reason_code, completeness, missing, stale, source_versions, CAST(entity_revision AS INTEGER) AS entity_revision, last_source_change_utc, previous_status, projection_version, publish, completed"
_STATE = f"(SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY seq DESC) = 1)"
_DOCS = "docs AS (SELECT *, logical_entity_id AS document_id, completeness AS completeness_status FROM history WHERE publish)"
#: The merged payload of typed events with its keys in order; core and n come from document_core unless customer_profile has n.
_WHOLE = """'{' || concat_ws(',', CASE WHEN f0 IS NOT NULL THEN '"core":' || (f0.p -> '$.core') END, CASE WHEN f2 IS NOT NULL THEN '"k":' || (f2.p -> '$.k') END,
        CASE WHEN f1 IS NOT NULL THEN '"list":' || (f1.p -> '$.list') END, CASE WHEN coalesce(f1.p, f0.p) IS NOT NULL THEN '"n":' || (coalesce(f1.p, f0.p) -> '$.n') END,
        CASE WHEN f1 IS NOT NULL THEN '"none":null' END, CASE WHEN f2 IS NOT NULL THEN '"ratio":' || (f2.p -> '$.ratio') || ',"tags":' || (f2.p -> '$.tags') END) || '}'"""
_DOMAINS = "two AS (SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN 'other' ELSE domain_name END AS domain_name) FROM change_events)"
_TWO = " UNION ALL ".join(
    f"SELECT * FROM (WITH {CHANGE_EVENTS}, {_DOMAINS}, mine AS (SELECT * FROM two WHERE domain_name = '{domain}'), {_fold(partial, 'mine')} SELECT {_ROW} FROM history)" for domain, partial in (("customer_documents", False), ("other", True))
)
_BAD = """spoiled AS (SELECT * REPLACE (CASE WHEN seq % 7 <> 0 THEN payload WHEN seq % 21 = 0 THEN '{broken' WHEN seq % 21 = 7 THEN '[1]' END AS payload) FROM change_events)"""
ORACLE_SQL = {
    "fragment_latest": f"""WITH {CHANGE_EVENTS}
        SELECT {_KEY}, fragment_owner, source_version, seq, event_time_utc, payload, change_type, change_type = 'delete' AS delete_flag
        FROM change_events QUALIFY row_number() OVER (PARTITION BY {_KEY}, fragment_owner ORDER BY source_version DESC, seq DESC) = 1""",
    "projection_history": f"WITH {CHANGE_EVENTS}, {_fold(False)} SELECT {_ROW} FROM history",
    "projection_history_partial": f"WITH {CHANGE_EVENTS}, {_fold(True)} SELECT {_ROW} FROM history",
    "projection_state": f"WITH {CHANGE_EVENTS}, {_fold(False)} SELECT {_ROW} FROM {_STATE}",
    "pending_count": f"WITH {CHANGE_EVENTS}, {_fold(False)} SELECT count(*) FILTER (NOT ends) AS pending_count FROM {_STATE}",
    "publish_documents": f"WITH {CHANGE_EVENTS}, {_fold(True)}, {_DOCS} SELECT document_id, tenant_id, seq, projection_version, completeness_status, CASE WHEN status = 'deleted' THEN '{{\"is_deleted\":true}}' ELSE json(merged)::VARCHAR END AS payload FROM docs",
    "merged_payload": f"""WITH {CHANGE_EVENTS}, typed AS (
          SELECT * REPLACE (CASE fragment_owner
            WHEN 'document_core' THEN '{{"n":' || CASE WHEN seq % 2 = 0 THEN seq::VARCHAR ELSE '"' || seq || '"' END || ',"core":{{"deep":[1,{{"x":null}}],"on":true}}}}'
            WHEN 'customer_profile' THEN '{{"n":' || (seq % 2) || ',"list":[1,"1",false],"none":null}}'
            ELSE '{{"tags":["a","b"],"ratio":0.5,"k":' || seq || '}}' END AS payload) FROM change_events), {_fold(True, "typed", _WHOLE)}, {_DOCS}
        SELECT document_id, seq, projection_version, CASE WHEN status = 'deleted' THEN '{{"is_deleted":true}}' ELSE merged END AS payload FROM docs""",
    "quarantine": f"WITH {CHANGE_EVENTS}, {_BAD}, {_fold(False, 'spoiled')} SELECT {_ROW} FROM history",
    "quarantined_events": f"""WITH {CHANGE_EVENTS}, {_BAD}
        SELECT seq, 'quarantined' AS status, CASE WHEN seq % 5 = 0 THEN 'no dependency policy' ELSE 'payload is not a JSON object' END AS reason_code FROM spoiled WHERE seq % 5 = 0 OR seq % 7 = 0""",
    "quarantine_without_policy": f"""WITH {CHANGE_EVENTS}, typed AS (SELECT * REPLACE (CASE WHEN seq % 5 = 0 THEN 'unknown' ELSE entity_type END AS entity_type, CASE WHEN seq % 5 > 0 THEN payload END AS payload) FROM change_events), {_fold(False, 'typed')}
        SELECT * REPLACE (CASE WHEN entity_type = 'unknown' THEN '' ELSE missing END AS missing) FROM (SELECT {_ROW} FROM {_STATE})""",
    "projection_two_policies": _TWO,
    "projection_resumed": f"SELECT * FROM ({_TWO}) WHERE seq > (SELECT max(event_id) // 2 FROM events)",
    "publish_outcomes": f"""WITH {CHANGE_EVENTS}, {_fold(True)}, {_DOCS},
        told AS (SELECT document_id || '/' || seq AS document_id, seq, projection_version, seq % 3 + 1 AS attempt, CASE WHEN seq % 13 = 0 THEN NULL WHEN seq % 14 = 0 THEN 503 WHEN seq % 7 = 0 THEN 400 WHEN seq % 11 = 0 THEN 409 ELSE 200 END::INTEGER AS status FROM docs)
        SELECT *, CASE WHEN status >= 400 THEN 'refused' END AS error_type, CASE WHEN status = 200 THEN 'delivered' WHEN status = 409 THEN 'superseded' WHEN coalesce(status, 503) = 503 AND attempt < 3 THEN 'retry' ELSE 'dead_letter' END AS outcome FROM told""",
    "publish_bodies": f"""WITH {CHANGE_EVENTS}, {_fold(False)}, {_DOCS}
        SELECT document_id, projection_version, '{{"completeness_status":"' || completeness_status || '","domain_name":"' || domain_name || '","entity_type":"' || entity_type || '","id":"' || document_id || '","projection_version":' || projection_version
          || ',"source_versions":["' || replace(source_versions, ',', '","') || '"],"tenant_id":"' || tenant_id || '",' || substr(json(merged)::VARCHAR, 2, length(json(merged)::VARCHAR) - 2) || ',"_meta":{{"completeness_status":"' || completeness_status || '","document_id":"' || document_id
          || '","domain_name":"' || domain_name || '","entity_type":"' || entity_type || '","projection_version":' || projection_version || ',"source_versions":["' || replace(source_versions, ',', '","') || '"],"tenant_id":"' || tenant_id || '"}}}}' AS body
        FROM docs WHERE status <> 'deleted'""",
    "ordering_keys": f"WITH {CHANGE_EVENTS} SELECT tenant_id || '|' || domain_name || '|' || logical_entity_id AS ordering_key, count(*) AS events, max(seq) AS last_seq FROM change_events GROUP BY 1",
    "state_lookup": f"""WITH {CHANGE_EVENTS}, {_fold(False)}
        SELECT tenant_id, logical_entity_id, status, projection_version FROM {_STATE} WHERE (tenant_id, logical_entity_id) IN (SELECT (tenant_id, min(logical_entity_id)) FROM change_events GROUP BY tenant_id)""",
    "state_with_fragments": f"""WITH {CHANGE_EVENTS}, {_fold(False)}, latest AS (SELECT * FROM change_events QUALIFY row_number() OVER (PARTITION BY {_KEY}, fragment_owner ORDER BY source_version DESC, seq DESC) = 1)
        SELECT tenant_id, logical_entity_id, any_value(s.status) AS status, string_agg(l.fragment_owner || '=' || l.source_version, ',' ORDER BY l.fragment_owner) AS fragments
        FROM {_STATE} s JOIN (SELECT {_KEY}, fragment_owner, source_version FROM latest) l USING ({_KEY}) GROUP BY {_KEY}""",
    "handoff": f"""WITH {CHANGE_EVENTS}, marks AS (SELECT tenant_id, max(seq) AS watermark FROM change_events WHERE event_time_utc < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1)
        SELECT tenant_id, count(*) AS events, min(seq) AS first_seq, max(watermark) AS watermark FROM change_events LEFT JOIN marks USING (tenant_id) WHERE watermark IS NULL OR seq > watermark GROUP BY 1""",
    "current_documents": f"WITH {CHANGE_EVENTS}, {_fold(True)}, {_DOCS} SELECT tenant_id, document_id, completeness_status, projection_version FROM docs QUALIFY row_number() OVER (PARTITION BY tenant_id, document_id ORDER BY projection_version DESC, seq) = 1 AND completeness_status <> 'deleted'",
    "bulk_requests": f"""WITH {CHANGE_EVENTS}, {_fold(False)}, {_DOCS}
        SELECT document_id, projection_version, CASE WHEN status = 'deleted' THEN 1 ELSE 2 END::INTEGER AS n_lines, CASE WHEN status <> 'deleted' THEN projection_version END AS indexed_version, CASE WHEN status <> 'deleted' THEN document_id END AS meta_id FROM docs""",
    "single_requests": f"""WITH {CHANGE_EVENTS}, {_fold(False)}, {_DOCS}
        SELECT document_id, projection_version, CASE WHEN status = 'deleted' THEN 'DELETE' ELSE 'PUT' END AS method,
               '/customerDocument-write/_doc/' || document_id || '?routing=' || tenant_id || '&version=' || projection_version || '&version_type=external' AS path, CASE WHEN status <> 'deleted' THEN completeness_status END AS completeness FROM docs""",
    "time_to_completeness": f"WITH {CHANGE_EVENTS}, {_fold(False)} SELECT {_KEY}, seq, status, completeness, previous_status, greatest(0, epoch_us(TIMESTAMP '{NOW}') // 1000 - epoch_us(earliest) // 1000) AS time_to_completeness_ms FROM history WHERE completed",
    "policy_resolution": f"WITH {CHANGE_EVENTS} SELECT CASE WHEN seq % 5 = 0 THEN NULL WHEN seq % 3 = 0 THEN 1 ELSE 0 END::INTEGER AS policy_at, count(*) AS events FROM change_events GROUP BY 1",
    "backfill_summary": f"""WITH {CHANGE_EVENTS}, {_fold(False)}
        SELECT (SELECT count(*) FROM change_events WHERE seq >= 100) AS ingested_events, (SELECT arg_max(event_time_utc, seq) FROM change_events WHERE seq >= 100) AS last_event_time_utc,
               count(*) FILTER (publish AND status = 'published' AND seq >= 100) AS published_documents, count(*) FILTER (publish AND status = 'deleted' AND seq >= 100) AS deleted_documents,
               (SELECT count(*) FILTER (NOT ends) FROM {_STATE}) AS pending_documents FROM history""",
    "admission": f"""WITH {CHANGE_EVENTS}, before_ AS (SELECT * FROM change_events WHERE seq % 10 <> 9), {_fold(False, "before_")},
        late AS (SELECT {_KEY}, CASE WHEN seq % 50 = 49 THEN 'repair' ELSE change_type END AS change_type FROM change_events WHERE seq % 10 = 9),
        judged AS (SELECT CASE WHEN late.change_type = 'repair' THEN 'priority_change_type' WHEN s.status IN ('pending_required_fragment', 'pending_rehydration') THEN 'pending_entity_completion' ELSE 'pending_threshold_exceeded' END AS reason_code
          FROM late LEFT JOIN {_STATE} s USING ({_KEY}))
        SELECT reason_code, reason_code <> 'pending_threshold_exceeded' AS accepted, count(*) AS events FROM judged GROUP BY ALL""",
}
ORACLE_SQL["state_with_fragments_stored"] = ORACLE_SQL["state_with_fragments"]
ORACLE_SQL["source_version_map"] = f"WITH {CHANGE_EVENTS} SELECT tenant_id, logical_entity_id, fragment_owner, max(source_version) AS version FROM change_events GROUP BY {_KEY}, fragment_owner"
