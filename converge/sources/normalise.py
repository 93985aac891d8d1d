"""Change records of four kinds of sources to canonical events.

Every normaliser takes a DataFrame with a column of JSON text (or, for the outbox, plain columns) and returns canonical
columns with `problem`: null for a valid event, else what is wrong. No record aborts a job; split() parts the two.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from converge.functions import versions
from converge.functions.text import parsed

CANONICAL = ["event_id", "domain_name", "entity_type", "logical_entity_id", "tenant_id", "source_technology", "source_version", "event_time_utc", "change_type", "fragment_owner", "payload", "migration_stage", "trace_id"]
# Change types and migration stages of canonical events.
CHANGE_TYPES = ("upsert", "delete", "refresh", "repair")
STAGES = ("azure_primary", "azure_primary_gcp_warming", "gcp_shadow_validated", "gcp_primary_fallback_window", "gcp_primary_stable")


#: A record's variant while it is taken apart.
_VARIANT = "_variant"


@dataclass(frozen=True)
class Source:
    """Names that a source's records do not carry, and the fields that they do."""

    domain_name: str
    entity_type: str
    fragment_owner: str
    technology: str
    tenant_field: str = "tenantId"
    id_field: str = "id"
    version_field: str | None = "lsn"
    time_field: str = "_ts"
    change_field: str = "operationType"
    version_kind: str = "auto"
    timestamp_versions: bool = False
    migration_stage: str = STAGES[0]


def _text(v: Column, path: str) -> Column:
    """The value at a path as text, null if it is absent."""
    return F.try_variant_get(v, path, "string")


def _kind(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _string(v: Column, field: str) -> Column:
    """A string that is not empty, else null: numbers do not stand for ids."""
    value = _text(v, f"$.{field}")
    return F.when((_kind(v, f"$.{field}") == "STRING") & (value != ""), value)


def _object(v: Column) -> Column:
    """The variant if it is an object, else null."""
    return F.when(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), v)


def _canonical(df: DataFrame, source: Source, fields: dict[str, Column], problems: list[tuple[Column, str]]) -> DataFrame:
    out = df.select("*", *[c.alias(f"_c_{k}") for k, c in fields.items()])
    problem = F.coalesce(*[F.when(F.coalesce(c, F.lit(True)), F.lit(text)) for c, text in problems])
    ident = F.sha2(F.concat_ws("|", F.lit(source.domain_name), F.lit(source.entity_type), "_c_tenant_id", "_c_logical_entity_id", F.lit(source.fragment_owner), F.col("_c_source_version").cast("string"), "_c_change_type"), 256)
    columns = {
        "event_id": ident,
        "domain_name": F.lit(source.domain_name),
        "entity_type": F.lit(source.entity_type),
        "source_technology": F.lit(source.technology),
        "fragment_owner": F.lit(source.fragment_owner),
        "migration_stage": F.lit(source.migration_stage),
        "trace_id": F.lit(None).cast("string"),
    } | {k: F.col(f"_c_{k}") for k in fields}
    return out.select(*[columns[c].alias(c) for c in CANONICAL], problem.alias("problem"), *[c for c in df.columns if c not in CANONICAL and c not in ("problem", _VARIANT)])


def _absent(name: str) -> Column:
    return F.col(f"_c_{name}").isNull()


def change_feed(df: DataFrame, source: Source, record: str = "record") -> DataFrame:
    """Documents with system fields: the payload is what is left without fields that start with _ or say version, time or kind."""
    df, v = parsed(df, record, _VARIANT), F.col(_VARIANT)
    system = [f for f in (source.version_field, source.time_field, source.change_field) if f]
    payload = F.map_filter(_object(v).cast("map<string,variant>"), lambda k, _: ~F.startswith(k, F.lit("_")) & ~k.isin(*system))
    spelled = F.when(_kind(v, f"$.{source.change_field}") == "STRING", _text(v, f"$.{source.change_field}"))
    fields = {
        "tenant_id": _string(v, source.tenant_field),
        "logical_entity_id": _string(v, source.id_field),
        "source_version": versions.whole_number(_text(v, f"$.{source.version_field}")),
        "event_time_utc": versions.moment(_text(v, f"$.{source.time_field}")),
        "change_type": F.coalesce(versions.spelled_change(spelled), F.lit("upsert")),
        "payload": F.to_json(payload),
    }
    return _canonical(df, source, fields, [(_absent("payload"), "not an object"), (_absent("tenant_id"), f"{source.tenant_field} must be a non-empty string"), (_absent("logical_entity_id"), f"{source.id_field} must be a non-empty string"), (_absent("source_version") | (F.col("_c_source_version") < 0), f"{source.version_field} must be a whole number"), (_absent("event_time_utc"), f"{source.time_field} must be a time")])


def log_capture(df: DataFrame, source: Source, record: str = "record") -> DataFrame:
    """Row images of a transaction log: the one before for deletions, the one after for all else."""
    df, v = parsed(df, record, _VARIANT), F.col(_VARIANT)
    op = F.when(_kind(v, "$.payload.op") == "STRING", _text(v, "$.payload.op"))
    image = _object(F.when(F.lower(op) == "d", F.try_variant_get(v, "$.payload.before", "variant")).otherwise(F.try_variant_get(v, "$.payload.after", "variant")))
    own = versions.log_version(_text(v, f"$.payload.source.{source.version_field}"), source.version_kind) if source.version_field else F.lit(None).cast(versions.VERSION)
    clock = lambda name: F.coalesce(_text(v, f"$.payload.{name}"), _text(v, f"$.payload.source.{name}"))
    if source.timestamp_versions:
        given = F.lit(False) if not source.version_field else _text(v, f"$.payload.source.{source.version_field}").isNotNull()
        own = F.when(given, own).otherwise(versions.timestamp_version(clock("ts_ns"), clock("ts_us"), clock("ts_ms")))
    fields = {
        "tenant_id": _string(image, source.tenant_field),
        "logical_entity_id": _string(image, source.id_field),
        "source_version": own,
        "event_time_utc": F.timestamp_millis(_text(v, "$.payload.ts_ms").try_cast("bigint")),
        "change_type": F.when(op != "", versions.op_change(op)),
        "payload": F.to_json(image),
    }
    return _canonical(df, source, fields, [(_absent("change_type"), "op must be a change of one row"), (_absent("payload"), "no row image"), (_absent("tenant_id"), f"{source.tenant_field} must be a non-empty string"), (_absent("logical_entity_id"), f"{source.id_field} must be a non-empty string"), (_absent("source_version"), "no source version"), (_absent("event_time_utc"), "ts_ms is missing")])


def change_stream(df: DataFrame, source: Source, record: str = "record") -> DataFrame:
    """Modifications with keys, new and old values; tenant and id may be in the keys."""
    df, v = parsed(df, record, _VARIANT), F.col(_VARIANT)
    part = lambda name: _object(F.try_variant_get(v, f"$.{name}", "variant"))
    filled = lambda c: F.when(F.to_json(c) != "{}", c)
    kind = F.upper(F.when(_kind(v, "$.mod_type") == "STRING", _text(v, "$.mod_type")))
    data = F.when(kind == "DELETE", F.coalesce(filled(part("old_values")), part("keys"))).otherwise(filled(part("new_values")))
    either = lambda field: F.when(F.try_variant_get(data, f"$.{field}", "variant").isNotNull(), _string(data, field)).otherwise(_string(part("keys"), field))
    fields = {
        "tenant_id": either(source.tenant_field),
        "logical_entity_id": either(source.id_field),
        "source_version": versions.record_sequence(_text(v, "$.record_sequence")),
        "event_time_utc": _text(v, "$.commit_timestamp").try_cast("timestamp"),
        "change_type": F.when(kind == "DELETE", "delete").when(kind != "", "upsert"),
        "payload": F.to_json(data),
    }
    return _canonical(df, source, fields, [(_absent("change_type"), "mod_type must be a non-empty string"), (part("keys").isNull(), "keys must be an object"), (_absent("payload"), "no values"), (_absent("tenant_id"), f"{source.tenant_field} must be a non-empty string"), (_absent("logical_entity_id"), f"{source.id_field} must be a non-empty string"), (_absent("source_version"), "record_sequence must be a number of 63 bits"), (_absent("event_time_utc"), "commit_timestamp must be a time")])


def outbox(df: DataFrame) -> DataFrame:
    """Rows that are canonical but for their id, technology and trace; defaults are filled in."""
    change, stage = F.coalesce("change_type", F.lit("upsert")), F.coalesce("migration_stage", F.lit(STAGES[-1]))
    named = ["tenant_id", "domain_name", "entity_type", "logical_entity_id", "fragment_owner", "payload"]
    problem = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in named], F.when(F.coalesce(F.col("source_version") < 0, F.lit(True)), F.lit("source_version must not be negative")), F.when(~change.isin(*CHANGE_TYPES), F.lit("unknown change_type")), F.when(~stage.isin(*STAGES), F.lit("unknown migration_stage")))
    ident = F.sha2(F.concat_ws("|", "domain_name", "entity_type", "tenant_id", "logical_entity_id", "fragment_owner", F.col("source_version").cast("string"), change), 256)
    columns = {"event_id": ident, "source_technology": F.lit("firestore"), "source_version": F.col("source_version").cast(versions.VERSION), "change_type": change, "migration_stage": stage, "trace_id": F.lit(None).cast("string")}
    return df.select(*[columns.get(c, F.col(c)).alias(c) for c in CANONICAL], problem.alias("problem"), *[c for c in df.columns if c not in CANONICAL and c != "problem"])


def ordering_key() -> Column:
    """The key by which a broker orders events; entities of several types can share one."""
    return F.concat_ws("|", "tenant_id", "domain_name", "logical_entity_id")


def split(normalised: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid canonical events, and rejected records with their problem for a dead-letter table."""
    return normalised.where("problem is null").drop("problem"), normalised.where("problem is not null")
