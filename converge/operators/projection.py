"""The fold of change events into entity projections, as windows over the full history of each entity.

One exchange by entity serves all windows. Salting is not needed: an entity is one document's history, never a tenant's.
`now` is given, so that a result does not depend on when it is computed.

Payloads are JSON objects and keep their types: numbers, booleans, nulls, arrays and nested objects. An event whose payload
is none cannot be applied; it changes no fragment and quarantines its entity until the next event that can be.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from converge.functions.text import parsed
from converge.policy import Policy, resolved

KEY = ["tenant_id", "domain_name", "entity_type", "logical_entity_id"]
PENDING, STALE, DELETED, PUBLISHED, QUARANTINED = "pending_required_fragment", "pending_rehydration", "deleted", "published", "quarantined"
TERMINAL = (PUBLISHED, DELETED)


def latest_fragments(events: DataFrame, by: list[str] = KEY) -> DataFrame:
    """One row per entity and owner: the fragment with the highest version, and of equal ones the last to arrive."""
    fields = ["source_version", "seq", "event_time_utc", "payload", "change_type"]
    best = F.max_by(F.struct(*fields), F.struct("source_version", "seq")).alias("f")
    return events.groupBy(*by, "fragment_owner").agg(best).select(*by, "fragment_owner", *[F.col(f"f.{c}").alias(c) for c in fields], (F.col("f.change_type") == "delete").alias("delete_flag"))


def fields_of(payload: Column) -> Column:
    """The top-level fields of a JSON object, name to `"name":value` in JSON with sorted keys; null if the text is no JSON object.

    Equal values have equal texts, whatever their layout and the order of keys. Of a text that is read once, all that follows
    works on these texts: what is equal, what overrides what, and the merged object.
    """
    value = payload if isinstance(payload, Column) else F.col(payload)
    members = F.when(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), value.cast("map<string,variant>"))
    inside = lambda whole: F.substring(whole, F.lit(2), F.length(whole) - 2)
    return F.transform_values(members, lambda k, v: F.transform(F.array(F.to_json(F.create_map(k, v))), inside)[0])


def with_fields(events: DataFrame) -> DataFrame:
    """Events with `fields` (see fields_of) in the place of their payload."""
    read = parsed(events, "payload", "_variant")
    return read.select(*[c for c in events.columns if c != "payload"], F.explode(F.array(fields_of(F.col("_variant")))).alias("fields"))


def object_of(fields: Column) -> Column:
    """The JSON object of fields, its keys in order."""
    keys = F.array_sort(F.map_keys(fields))
    return F.concat(F.lit("{"), F.array_join(F.transform(keys, lambda k: F.element_at(fields, k)), ","), F.lit("}"))


def merged(held: Column) -> Column:
    """One JSON object with the fields of an array of maps, sorted by key; a later field overrides an earlier one."""
    none = F.create_map().cast("map<string,string>")
    over = lambda old, new: F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new)
    return object_of(F.aggregate(held, none, over))


_FRAGMENT = "struct<source_version:decimal(38,0),seq:bigint,event_time_utc:timestamp_ntz,fields:map<string,string>,delete_flag:boolean>"
#: What an entity's history goes on from: its fragments by owner, and what its last event left behind.
HELD = f"fragments map<string,{_FRAGMENT}>, status string, completeness string, digest string, projection_version bigint, entity_revision int, last_source_change_utc timestamp_ntz"
_HELD_TYPE = "struct<" + HELD.replace(" ", ":").replace(",:", ", ") + ">"


def _decided(events: DataFrame, policies: list[Policy], now: Column, held: DataFrame | None) -> DataFrame:
    """A row per event with what follows from the fragments present after it: status, reason, digest and so on.

    events have policy_at, the place of their policy; without one an event cannot be applied. An entity has one policy, since
    domain and type are part of its key. A row of `held` stands before its entity's events, with what it holds in _carry.
    """
    rows = with_fields(events).withColumn("_carry", F.lit(None).cast(_HELD_TYPE))
    if held is not None:
        names = [f.split()[0] for f in _split(HELD)]
        rows = rows.unionByName(resolved(held, policies).select(*KEY, "policy_at", F.struct(*names).cast(_HELD_TYPE).alias("_carry")), allowMissingColumns=True)
    order = Window.partitionBy(*KEY).orderBy(F.col("seq").asc_nulls_first())
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    carry, new = F.col("_carry"), F.col("seq").isNotNull()
    applies = new & F.col("fields").isNotNull() & F.col("policy_at").isNotNull()
    out = rows.withColumn("source_version", F.col("source_version").cast("decimal(38,0)")).withColumn("applies", applies)
    owners = list(dict.fromkeys(r.owner for p in policies for r in p.rules))
    fragment = F.struct("source_version", "seq", "event_time_utc", "fields", (F.col("change_type") == "delete").alias("delete_flag"))
    for i, owner in enumerate(owners):
        mine = F.when(F.col("applies") & (F.col("fragment_owner") == owner), fragment)
        found = mine if held is None else F.coalesce(carry["fragments"].getItem(owner), mine)
        out = out.withColumn(f"_e{i}", found).withColumn(f"_f{i}", F.max_by(f"_e{i}", F.when(F.col(f"_e{i}").isNotNull(), F.struct(F.col(f"_e{i}.source_version"), F.col(f"_e{i}.seq")))).over(upto)).drop(f"_e{i}")
    changed = F.coalesce(carry["last_source_change_utc"], F.when(F.col("applies"), F.col("event_time_utc")))
    out = out.withColumn("last_source_change_utc", F.max(changed).over(upto))
    revision = F.row_number().over(order) if held is None else F.sum(F.coalesce(carry["entity_revision"], F.lit(1))).over(upto).cast("int")
    out = out.withColumn("entity_revision", revision)
    fragments = {owner: F.col(f"_f{i}") for i, owner in enumerate(owners)}
    each = [_outcome(p, fragments, now) for p in policies]
    chosen = F.when(F.col("policy_at") == 0, each[0])
    for i, one in enumerate(each[1:], 1):
        chosen = chosen.when(F.col("policy_at") == i, one)
    out = out.withColumn("_o", chosen)
    as_before = F.struct(carry["status"], F.lit(None).cast("string"), carry["completeness"])
    lost = F.struct(F.lit(QUARANTINED), F.lit(QUARANTINED), F.lit(None).cast("string"))
    kind = "struct<status:string,reason_code:string,completeness:string>"
    out = out.withColumn("_s", F.when(~new, as_before.cast(kind)).when(~F.col("applies"), lost.cast(kind)).otherwise(F.col("_o.decision").cast(kind)))
    # A quarantined entity keeps the completeness that it had.
    completeness = F.coalesce(F.last("_s.completeness", ignorenulls=True).over(upto), F.lit("partial"))
    named = lambda c, kind: F.coalesce(F.col(f"_o.{c}"), F.array().cast(kind)).alias(c)
    known = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(o).alias("key"), f.alias("value")) for o, f in fragments.items()]), lambda e: e["value"].isNotNull())).alias("fragments")
    return out.select(
        *KEY, "seq", "last_source_change_utc", "entity_revision", F.col("_s.status").alias("status"), F.col("_s.reason_code").alias("reason_code"), completeness.alias("completeness"),
        named("missing", "array<string>"), named("stale", "array<string>"), named("source_versions", "array<string>"), named("held", "array<map<string,string>>"), F.col("_o.earliest").alias("_earliest"), known, "_carry",
    )


def _split(schema: str) -> list[str]:
    """The fields of a schema text, without cutting inside brackets."""
    out, depth = [""], 0
    for c in schema:
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [f.strip() for f in out]


def _outcome(policy: Policy, fragments: dict[str, Column], now: Column) -> Column:
    """What a policy decides from the fragments by owner, and the lists that it does so by."""
    rules = [(r, fragments[r.owner]) for r in policy.rules]
    listed = lambda values, kind: F.array_compact(F.array(*values, F.lit(None).cast(kind)))
    missing = listed([F.when(f.isNull(), F.lit(r.owner)) for r, f in rules if r.required], "string")
    stale = listed([F.when(f.isNotNull() & r.stale(f["event_time_utc"], now), F.lit(r.owner)) for r, f in rules if r.required], "string")
    versions = listed([F.when(f.isNotNull(), F.concat_ws("=", F.lit(r.owner), f["source_version"].cast("string"))) for r, f in rules], "string")
    # Payloads merge shallowly in the order of rules, so the merged payload follows from the list of fields and its order.
    held = listed([f["fields"] for _, f in rules], "map<string,string>")
    present = reduce(lambda a, b: a + b, [f.isNotNull().cast("int") for _, f in rules], F.lit(0))
    all_deleted = reduce(lambda a, b: a & b, [F.coalesce(f["delete_flag"], F.lit(True)) for _, f in rules], F.lit(True)) & (present > 0)
    earliest = F.least(*[f["event_time_utc"] for _, f in rules], F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("timestamp_ntz"))
    outcome = lambda status, reason, completeness: F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason_code"), completeness.alias("completeness"))
    short = present < len(rules)
    lacks, old = reduce(lambda a, b: a | b, [f.isNull() for r, f in rules if r.required], F.lit(False)), reduce(lambda a, b: a | b, [f.isNotNull() & r.stale(f["event_time_utc"], now) for r, f in rules if r.required], F.lit(False))
    decision = F.when(lacks, outcome(PENDING, "missing_required_fragment", F.lit("partial"))).when(old, outcome(STALE, "stale_required_fragment", F.lit("partial"))).when(all_deleted, outcome(DELETED, "all_fragments_deleted", F.lit("deleted")))
    if not policy.allow_partial_optional_publish:
        decision = decision.when(short, outcome(PENDING, "optional_publish_disabled", F.lit("partial")))
    decision = decision.otherwise(outcome(PUBLISHED, "published", F.when(short, F.lit("partial")).otherwise(F.lit("complete"))))
    return F.struct(decision.alias("decision"), missing.alias("missing"), stale.alias("stale"), versions.alias("source_versions"), held.alias("held"), earliest.alias("earliest"))


HISTORY = ["seq", "status", "reason_code", "completeness", "missing", "stale", "source_versions", "payloads", "payload", "entity_revision", "last_source_change_utc", "previous_status", "projection_version", "publish", "completed", "age_ms"]


def _followed(events: DataFrame, policies: list[Policy], now: Column, held: DataFrame | None) -> DataFrame:
    """The columns of HISTORY, and fragments and digest, a row per event with policy_at."""
    out = _decided(events, policies, now, held).withColumn("payload", F.when(F.col("status") == PUBLISHED, merged(F.col("held"))))
    # A deletion is the same if its versions are; a publication if its merged payload is.
    text = F.when(F.col("status") == DELETED, F.concat(F.lit("deleted|"), F.array_join("source_versions", ","))).when(F.col("status") == PUBLISHED, F.concat(F.lit("published|"), F.col("payload")))
    out = out.withColumn("_digest", F.when(F.col("seq").isNull(), F.col("_carry.digest")).otherwise(F.sha2(text, 256)))
    order = Window.partitionBy(*KEY).orderBy(F.col("seq").asc_nulls_first())
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("_last_digest", F.last("_digest", ignorenulls=True).over(before)).withColumn("digest", F.last("_digest", ignorenulls=True).over(upto)).withColumn("previous_status", F.lag("status").over(order))
    same = F.col("_digest").eqNullSafe(F.col("_last_digest")) & F.col("previous_status").eqNullSafe(F.col("status"))
    ends = F.col("status").isin(*TERMINAL)
    step = F.when(F.col("seq").isNull(), F.col("_carry.projection_version")).otherwise((ends & ~same).cast("long"))
    age = F.greatest(F.lit(0), F.unix_millis(now.cast("timestamp")) - F.unix_millis(F.col("_earliest").cast("timestamp")))
    out = out.withColumn("_step", step).select(
        *KEY, "seq", "status", "reason_code", "completeness", "missing", "stale", "source_versions", F.transform("held", object_of).alias("payloads"), "payload", "entity_revision", "last_source_change_utc", "previous_status",
        F.sum("_step").over(upto).alias("projection_version"),
        ((F.col("status") == PUBLISHED) | ((F.col("status") == DELETED) & ~same)).alias("publish"),
        (ends & ~F.coalesce(F.col("previous_status").isin(*TERMINAL), F.lit(False))).alias("completed"),
        F.when(F.col("_earliest").isNotNull(), age).alias("age_ms"), "fragments", "digest",
    )
    return out if held is None else out.where("seq is not null")


def history(events: DataFrame, policy: Policy, now: Column, held: DataFrame | None = None) -> DataFrame:
    """A row per event: the entity's state and the decision after it.

    An event older than the fragment that is held changes nothing but is evaluated: it counts as a revision and can find
    fragments stale. Events need seq, a total order in each entity. payload is the merged payload of a publication. held:
    what earlier events left (see handed_over); the history goes on as if they stood before.
    """
    return _followed(events.withColumn("policy_at", F.lit(0)), [policy], now, held).select(*KEY, *HISTORY)


def handed_over(events: DataFrame, policies: list[Policy], now: Column, held: DataFrame | None = None) -> DataFrame:
    """What each entity's events leave for those that follow, in batch or as a stream: the columns of KEY and HELD."""
    rows = _followed(resolved(events, policies), policies, now, held)
    names = [f.split()[0] for f in _split(HELD)]
    last = rows.groupBy(*KEY).agg(F.max_by(F.struct(*names), "seq").alias("s"))
    return last.select(*KEY, *[F.col(f"s.{c}").alias(c) for c in names])


def state(history_: DataFrame) -> DataFrame:
    """The last row of each entity's history."""
    fields = [c for c in history_.columns if c not in KEY]
    return history_.groupBy(*KEY).agg(F.max_by(F.struct(*fields), "seq").alias("s")).select(*KEY, *[F.col(f"s.{c}").alias(c) for c in fields])


def folded(events: DataFrame, policies: list[Policy], now: Column, held: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """History of all events, in one pass over all policies, and the events that cannot be applied, with status and reason_code.

    These have no policy, or no JSON object as their payload; the history has them as quarantined.
    """
    with_policy = resolved(events, policies)
    whole = _followed(with_policy, policies, now, held).select(*KEY, *HISTORY)
    is_object = F.startswith(F.schema_of_variant(F.try_parse_json("payload")), F.lit("OBJECT"))
    reason = F.when(F.col("policy_at").isNull(), F.lit("no dependency policy")).when(~F.coalesce(is_object, F.lit(False)), F.lit("payload is not a JSON object"))
    lost = with_policy.withColumn("reason_code", reason).where("reason_code is not null").drop("policy_at").withColumn("status", F.lit(QUARANTINED))
    return whole, lost


def version_map(source_versions: Column) -> Column:
    """owner to version, from texts owner=version; owners may hold = themselves."""
    cut = lambda v: F.length(v) - F.length(F.substring_index(v, "=", -1))
    return F.map_from_entries(F.transform(source_versions, lambda v: F.struct(F.substring(v, F.lit(1), cut(v) - 1).alias("key"), F.substring_index(v, "=", -1).cast("decimal(38,0)").alias("value"))))


def looked_up(states: DataFrame, keys: DataFrame) -> DataFrame:
    """The states of the entities that keys (the columns of KEY) names, once each; keys that have no state are missing."""
    return states.join(keys.select(*KEY).distinct(), KEY, "left_semi")


def with_fragments(states: DataFrame, fragments: DataFrame) -> DataFrame:
    """States with `fragments`, an array of their latest fragments by owner; empty without any. Both sides lie by KEY."""
    nested = fragments.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("fragment_owner", "source_version", "payload", "delete_flag"))).alias("fragments"))
    empty = F.array().cast(nested.schema["fragments"].dataType)
    return states.join(nested, KEY, "left").withColumn("fragments", F.coalesce("fragments", empty))


def pending(states: DataFrame) -> DataFrame:
    """One row: how many entities are neither published nor deleted."""
    return states.agg(F.count_if(~F.col("status").isin(*TERMINAL)).alias("pending_count"))


def documents(history_: DataFrame) -> DataFrame:
    """The search documents that the history publishes, a deletion with the payload {"is_deleted": true}."""
    body = F.when(F.col("status") == DELETED, F.lit('{"is_deleted":true}')).otherwise(F.col("payload"))
    return history_.where("publish").select(*KEY, "seq", F.col("logical_entity_id").alias("document_id"), "projection_version", F.col("completeness").alias("completeness_status"), "source_versions", body.alias("payload"))


def completion_times(history_: DataFrame) -> DataFrame:
    """A row per transition to published or deleted: how long after its earliest held fragment, in milliseconds.

    Fragments of owners that the policy does not name are left out.
    """
    return history_.where("completed").select(*KEY, "seq", "status", "completeness", "previous_status", F.col("age_ms").alias("time_to_completeness_ms"))
