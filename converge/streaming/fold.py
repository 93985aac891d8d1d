"""The entity fold as a stateful stream: the same decisions as the batch history, an event at a time.

State per entity: a map of owner to its latest fragment, and what the last event left behind. A stream can start from what a
batch has handed over. Events of a micro-batch are applied in the order of seq. Nothing expires; freshness is judged when an
event arrives. Payloads are read by Spark before the stateful operator, as in the batch, so that this one compares texts
only and both have the same digests. Needs the RocksDB state store.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from converge.operators.projection import DELETED, KEY, PENDING, PUBLISHED, QUARANTINED, STALE, TERMINAL, with_fields
from converge.policy import Policy, checked, resolved

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = (
    "tenant_id string, domain_name string, entity_type string, logical_entity_id string, seq long, status string, reason_code string, completeness string, missing array<string>, stale array<string>, source_versions array<string>, "
    "payloads array<string>, payload string, entity_revision int, previous_status string, projection_version long, publish boolean, completed boolean, age_ms long"
)
_FRAGMENT = "source_version decimal(38,0), seq long, event_time_us long, fields string, delete_flag boolean"
_STATE = "status string, completeness string, digest string, projection_version long, entity_revision int"
_EPOCH_US = "unix_micros(cast(event_time_utc as timestamp))"


def _object(fields: dict[str, str]) -> str:
    return "{" + ",".join(fields[k] for k in sorted(fields)) + "}"


class Fold(StatefulProcessor):
    def __init__(self, policies: list[Policy], now_us: int) -> None:
        self.policies, self.now_us = policies, now_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.fragments = handle.getMapState("fragments", "owner string", _FRAGMENT)
        self.state = handle.getValueState("state", _STATE)

    def handleInitialState(self, key: tuple, rows: pd.DataFrame, timers: object) -> None:
        for r in rows.itertuples():
            for f in json.loads(r.fragments):
                self.fragments.updateValue((f["owner"],), (Decimal(f["source_version"]), f["seq"], f["event_time_us"], f["fields"], f["delete_flag"]))
            self.state.update((r.status, r.completeness, r.digest, int(r.projection_version), int(r.entity_revision)))

    def decide(self, policy: Policy, held: dict[str, tuple]) -> tuple:
        """status, reason, completeness, missing, stale, and the fragments that the policy names, by owner in its order."""
        rules = [(r, held.get(r.owner)) for r in policy.rules]
        present = [(r.owner, f) for r, f in rules if f is not None]
        missing = [r.owner for r, f in rules if r.required and f is None]
        stale = [r.owner for r, f in rules if r.required and f is not None and r.freshness_ttl_seconds is not None and self.now_us - f[2] > r.freshness_ttl_seconds * 1_000_000]
        short = len(present) < len(rules)
        if missing:
            decision = PENDING, "missing_required_fragment", "partial"
        elif stale:
            decision = STALE, "stale_required_fragment", "partial"
        elif present and all(f[4] for _, f in present):
            decision = DELETED, "all_fragments_deleted", "deleted"
        elif short and not policy.allow_partial_optional_publish:
            decision = PENDING, "optional_publish_disabled", "partial"
        else:
            decision = PUBLISHED, "published", "partial" if short else "complete"
        return *decision, missing, stale, present

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers: object) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values("seq")
        last, partly, digest, version, revision = self.state.get() if self.state.exists() else (None, "partial", None, 0, 0)
        held = {k[0]: tuple(v) for k, v in self.fragments.iterator()}
        out = []
        for e in events.itertuples():
            policy = self.policies[e.policy_at] if e.policy_at >= 0 else None
            applies = policy is not None and e.fields is not None
            if applies and (e.fragment_owner not in held or (e.source_version, e.seq) >= held[e.fragment_owner][:2]):
                held[e.fragment_owner] = (Decimal(e.source_version), int(e.seq), int(e.event_time_us), e.fields, e.change_type == "delete")
                self.fragments.updateValue((e.fragment_owner,), held[e.fragment_owner])
            status, reason, completeness, missing, stale, present = self.decide(policy, held) if policy else (None, None, None, [], [], [])
            if not applies:
                status, reason, completeness = QUARANTINED, "quarantined", partly
            versions = [f"{owner}={int(f[0])}" for owner, f in present]
            each = [json.loads(f[3]) for _, f in present]
            payload = None
            if status == PUBLISHED:
                whole: dict[str, str] = {}
                for fields in each:
                    whole |= fields
                payload = _object(whole)
            revision += 1
            same = True
            if status in TERMINAL:
                text = f"published|{payload}" if status == PUBLISHED else "deleted|" + ",".join(versions)
                found = hashlib.sha256(text.encode()).hexdigest()
                same = found == digest and status == last
                version, digest = version + (not same), found
            age = max(0, self.now_us // 1000 - min(f[2] for _, f in present) // 1000) if present else None
            publish = status == PUBLISHED or (status == DELETED and not same)
            out.append((*key, e.seq, status, reason, completeness, missing, stale, versions, [_object(x) for x in each], payload, revision, last, version, publish, status in TERMINAL and last not in TERMINAL, age))
            last, partly = status, completeness
        self.state.update((last, partly, digest, version, revision))
        frame = pd.DataFrame(out, columns=[f.split()[0] for f in OUTPUT.split(", ")])
        yield frame.assign(age_ms=frame["age_ms"].astype("Int64"))

    def close(self) -> None:
        pass


def _initial(held: DataFrame) -> DataFrame:
    """What a batch hands over, with an entity's fragments as one text."""
    entry = lambda e: F.struct(
        e["key"].alias("owner"), e["value"]["source_version"].cast("string").alias("source_version"), e["value"]["seq"].alias("seq"), F.unix_micros(e["value"]["event_time_utc"].cast("timestamp")).alias("event_time_us"),
        F.to_json(e["value"]["fields"]).alias("fields"), e["value"]["delete_flag"].alias("delete_flag"),
    )
    fragments = F.to_json(F.transform(F.map_entries("fragments"), entry)).alias("fragments")
    return held.select(*KEY, fragments, "status", "completeness", "digest", "projection_version", "entity_revision")


def folded(events: DataFrame, policies: list[Policy], now_us: int, held: DataFrame | None = None) -> DataFrame:
    """A row per event, as in the batch history; the session must use the RocksDB state store.

    held: what a batch hands over (projection.handed_over); the stream's first batch puts it into its state, once.
    """
    source = resolved(with_fields(events), checked(policies))
    source = source.select(*KEY, "fragment_owner", F.col("source_version").cast("decimal(38,0)").alias("source_version"), F.expr(_EPOCH_US).alias("event_time_us"), F.to_json("fields").alias("fields"), "change_type", "seq", F.coalesce("policy_at", F.lit(-1)).alias("policy_at"))
    initial = None if held is None else _initial(held).groupBy(*KEY)
    return source.groupBy(*KEY).transformWithStateInPandas(Fold(policies, now_us), OUTPUT, "Append", "None", initialState=initial)


def stored_states(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """KEY and the last state of each entity, read from a stream's checkpoint; the stream need not run."""
    read = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator).option("stateVarName", "state").load()
    return read.select("key.*", "value.*")


def stored_fragments(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """KEY, fragment_owner and its latest fragment, a row each, read from a stream's checkpoint."""
    read = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator).option("stateVarName", "fragments").option("flattenCollectionTypes", True).load()
    payload = F.from_json("user_map_value.fields", "map<string,string>")
    return read.select("key.*", F.col("user_map_key.owner").alias("fragment_owner"), "user_map_value.*", payload.alias("_fields")).withColumn("fields", F.col("_fields")).drop("_fields")
