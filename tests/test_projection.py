"""The fold against a plain sequential one, over random histories, in batch and as a stream."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from converge.operators import projection as p
from converge.operators import reports
from converge.policy import Policy, Rule, checked, resolved
from converge.streaming import fold, sinks

NOW = datetime(2024, 2, 1)
SCHEMA = "tenant_id string, domain_name string, entity_type string, logical_entity_id string, fragment_owner string, source_version long, seq long, event_time_utc timestamp_ntz, change_type string, payload string"
RULES = (Rule("core", True, 86_400 * 5), Rule("profile"), Rule("tags", False, 3600))


def events(n=900, entities=60, seed=3):
    r = random.Random(seed)
    return [("t", "d", "doc", f"e{r.randrange(entities)}", r.choice(["core", "core", "profile", "profile", "tags", "alien"]), r.randrange(6), i, NOW - timedelta(hours=r.randrange(170)), r.choice(["upsert", "upsert", "delete"]), json.dumps({r.choice("ab"): r.randrange(2)})) for i in range(n)]


def read(payload):
    try:
        found = json.loads(payload)
    except (TypeError, ValueError):
        return None
    return found if isinstance(found, dict) else None


def plain(rows, partial):
    """The decision table, an event at a time; one whose payload is no object quarantines its entity."""
    held, state, out = {}, {}, {}
    for _, _, _, entity, owner, version, seq, at, change, payload in rows:
        mine = held.setdefault(entity, {})
        applies = read(payload) is not None
        if applies and (owner not in mine or version >= mine[owner][0]):
            mine[owner] = (version, at, read(payload), change == "delete")
        last, digest, number, revision = state.get(entity, (None, None, 0, 0))
        present = [(r.owner, mine[r.owner]) for r in RULES if r.owner in mine]
        publish = False
        if not applies:
            now = ("quarantined", "quarantined")
        elif any(r.required and r.owner not in mine for r in RULES):
            now = ("pending_required_fragment", "missing_required_fragment")
        elif any(r.required and r.freshness_ttl_seconds and NOW - mine[r.owner][1] > timedelta(seconds=r.freshness_ttl_seconds) for r in RULES):
            now = ("pending_rehydration", "stale_required_fragment")
        elif all(f[3] for _, f in present):
            now, found = ("deleted", "all_fragments_deleted"), ("d", [(o, f[0]) for o, f in present])
            publish = (last, digest) != ("deleted", found)
            number, digest = number + publish, found
        elif len(present) < 3 and not partial:
            now = ("pending_required_fragment", "optional_publish_disabled")
        else:
            whole = {}
            for _, f in present:
                whole |= f[2]
            now, publish = ("published", "published"), True
            number, digest = number + ((last, digest) != ("published", ("p", whole))), ("p", whole)
        state[entity] = (now[0], digest, number, revision + 1)
        out[seq] = (*now, number, publish, revision + 1)
    return out


@pytest.mark.parametrize("partial", [False, True])
def test_history(spark, partial):
    rows = events()
    history = p.history(spark.createDataFrame(rows, SCHEMA), Policy("doc", RULES, "d", partial), F.lit(NOW))
    got = {r.seq: (r.status, r.reason_code, r.projection_version, r.publish, r.entity_revision) for r in history.collect()}
    assert got == plain(rows, partial)


def spoiled(rows):
    """Numbers and texts that look alike, nesting, arrays, nulls and booleans; some payloads that are no objects."""
    r = random.Random(8)
    kinds = ['{"n":1}', '{"n":"1"}', '{"n":1,"b":{"c":[2,{"x":null}]}}', '{"l":[true,false]}', '{"l":null}', "{}", "{broken", "[1]", "7", None]
    return [(*e[:-1], r.choice(kinds)) for e in rows]


def test_bad_payloads_quarantine_and_types_stay(spark):
    rows = spoiled(events())
    history = p.history(spark.createDataFrame(rows, SCHEMA), Policy("doc", RULES, "d", True), F.lit(NOW))
    got = {r.seq: (r.status, r.reason_code, r.projection_version, r.publish, r.entity_revision) for r in history.collect()}
    assert got == plain(rows, True)
    held, wanted = {}, {}
    for _, _, _, entity, owner, version, seq, _, _, payload in rows:
        mine = held.setdefault(entity, {})
        if read(payload) is not None and (owner not in mine or version >= mine[owner][0]):
            mine[owner] = (version, read(payload))
        wanted[seq] = {k: v for r in RULES if r.owner in mine for k, v in mine[r.owner][1].items()}
    docs = p.documents(history).collect()
    assert any(d.completeness_status == "deleted" for d in docs)
    for d in docs:
        assert json.loads(d.payload) == ({"is_deleted": True} if d.completeness_status == "deleted" else wanted[d.seq])
        assert type(json.loads(d.payload).get("n")) is type(wanted[d.seq].get("n")) or d.completeness_status == "deleted"


def test_events_that_cannot_be_applied_are_told_with_a_reason(spark):
    rows = [("t", "d", "doc", "e", "core", 1, 0, NOW, "upsert", "{}"), ("t", "d", "doc", "e", "core", 1, 1, NOW, "upsert", "no"), ("t", "d", "other", "e", "core", 1, 2, NOW, "upsert", "{}")]
    whole, lost = p.folded(spark.createDataFrame(rows, SCHEMA), [Policy("doc", RULES, "d")], F.lit(NOW))
    assert {r.seq: r.reason_code for r in lost.collect()} == {1: "payload is not a JSON object", 2: "no dependency policy"}
    assert {r.seq: r.status for r in whole.collect()} == {0: "pending_required_fragment", 1: "quarantined", 2: "quarantined"}


def test_positions_are_saved_and_loaded(spark, tmp_path):
    path = str(tmp_path / "position")
    assert reports.load_position(spark, path) == 0
    for n in (5, 50_000):
        reports.save_position(spark, path, n)
        assert reports.load_position(spark, path) == n


def test_history_shuffles_once_and_stays_in_the_jvm(spark, tmp_path):
    # Read from a file: rows of Python objects would bring a Python node of their own.
    spark.createDataFrame(events(50), SCHEMA).write.parquet(str(tmp_path / "e"))
    plan = p.history(spark.read.parquet(str(tmp_path / "e")), Policy("doc", RULES, "d"), F.lit(NOW))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Python" not in plan


NOW_US = int((NOW - datetime(1970, 1, 1)).total_seconds() * 1_000_000)
WIDE = SCHEMA.replace("source_version long", "source_version decimal(38,0)")
TWO = [Policy("doc", RULES, "d", True), Policy("doc", (Rule("profile"), Rule("core", False)), None, False)]
#: Texts that Python and Spark read differently, or that are equal only as values.
ODD = ['{"a":1}', '{"a":1.0}', '{"a":1,"a":2}', '{"a":3}', '{"a":NaN}', '{"a":12345678901234567890123456789012345678901234567890}', '{"b":{"y":1,"x":[1.50,2e0]},"a":"\\u00e9"}', '{ "a" : "é", "b":{"x":[1.5,2.0],"y":1} }', '{"q\\"k":1}', "{broken", None]


def odd_events(n=400, entities=25, seed=11):
    """Versions of 80 bits, odd payloads, two policies and a type that has none."""
    r = random.Random(seed)
    where = [("d", "doc"), ("d", "doc"), ("x", "doc"), ("d", "other")]
    rows = []
    for e in events(n, entities, seed):
        domain, kind = where[int(e[3][1:]) % 4]
        rows.append(("t", domain, kind, e[3], e[4], Decimal(e[5] + (1 << 79)), *e[6:9], r.choice(ODD)))
    return rows


SHARED = [*p.KEY, "seq", "status", "reason_code", "completeness", "missing", "stale", "source_versions", "payloads", "payload", "entity_revision", "previous_status", "projection_version", "publish", "completed", "age_ms"]


def streamed(spark, folder, rows, held=None, batches=3):
    for k in range(batches):
        spark.createDataFrame(rows[k * len(rows) // batches : (k + 1) * len(rows) // batches], WIDE).coalesce(1).write.mode("append").parquet(str(folder / "in"))
    stream = spark.readStream.schema(WIDE).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
    query = fold.folded(stream, TWO, NOW_US, held).writeStream.format("parquet").option("path", str(folder / "out")).option("checkpointLocation", str(folder / "c")).trigger(availableNow=True).start()
    query.awaitTermination(240)
    query.stop()
    assert query.exception() is None
    return spark.read.parquet(str(folder / "out"))


def seen(df):
    return {r.seq: tuple(r) for r in df.select(*SHARED).collect()}


def test_stream_decides_as_the_batch(spark, tmp_path):
    rows = odd_events()
    wanted, _ = p.folded(spark.createDataFrame(rows, WIDE), TWO, F.lit(NOW))
    got = seen(streamed(spark, tmp_path, rows))
    assert got == seen(wanted) and len(got) == len(rows)
    assert {s for s in {r[5] for r in got.values()}} >= {"quarantined", "published", "pending_required_fragment"}
    # What the stopped stream holds is what the batch holds.
    left = {tuple(r[c] for c in p.KEY): r for r in p.handed_over(spark.createDataFrame(rows, WIDE), TWO, F.lit(NOW)).collect()}
    states = fold.stored_states(spark, str(tmp_path / "c")).collect()
    assert {tuple(r[c] for c in p.KEY): (r.status, r.completeness, r.digest, r.projection_version, r.entity_revision) for r in states} == {k: (r.status, r.completeness, r.digest, r.projection_version, r.entity_revision) for k, r in left.items()}
    fragments = fold.stored_fragments(spark, str(tmp_path / "c")).where("fragment_owner <> 'alien'").collect()
    held = {(k, owner): (f.source_version, f.seq, f.fields, f.delete_flag) for k, r in left.items() for owner, f in r.fragments.items()}
    got = {(tuple(r[c] for c in p.KEY), r.fragment_owner): (r.source_version, r.seq, r.fields, r.delete_flag) for r in fragments}
    assert {k: v for k, v in got.items() if k in held} == held
    # The stream keeps fragments that the entity's policy does not name as well.
    assert {k[1] for k in got.keys() - held.keys()} <= {"tags"}


def test_texts_that_are_one_value_are_one_version(spark):
    payloads = ['{"a":1}', '{"a":1.0}', '{"a":1,"a":2}', '{"a":3}', '{ "a" : 3 }']
    rows = [("t", "d", "doc", "e", "core", Decimal(k), k, NOW, "upsert", x) for k, x in enumerate(payloads)]
    got = {r.seq: (r.status, r.projection_version) for r in p.history(spark.createDataFrame(rows, WIDE), Policy("doc", (Rule("core"),), "d"), F.lit(NOW)).collect()}
    assert got == {0: ("published", 1), 1: ("published", 1), 2: ("quarantined", 1), 3: ("published", 2), 4: ("published", 2)}


def test_batch_hands_over_to_batch_and_stream(spark, tmp_path):
    rows = odd_events(420)
    whole = seen(p.folded(spark.createDataFrame(rows, WIDE), TWO, F.lit(NOW))[0])
    first, second = (spark.createDataFrame(x, WIDE) for x in (rows[:200], rows[200:]))
    # Stored, as a backfill would leave it.
    p.handed_over(first, TWO, F.lit(NOW)).write.parquet(str(tmp_path / "held"))
    held = spark.read.parquet(str(tmp_path / "held"))
    assert seen(p.folded(second, TWO, F.lit(NOW), held)[0]) == {s: r for s, r in whole.items() if s >= 200}
    assert seen(streamed(spark, tmp_path, rows[200:], held, 2)) == {s: r for s, r in whole.items() if s >= 200}
    again = lambda df: {tuple(r[c] for c in p.KEY): r for r in df.collect()}
    later, at_once = again(p.handed_over(second, TWO, F.lit(NOW), held)), again(p.handed_over(spark.createDataFrame(rows, WIDE), TWO, F.lit(NOW)))
    assert later == {k: v for k, v in at_once.items() if k in later}


def test_payloads_are_parsed_once(spark, tmp_path):
    spark.createDataFrame(events(50), SCHEMA).write.parquet(str(tmp_path / "e"))
    plan = p.history(spark.read.parquet(str(tmp_path / "e")), Policy("doc", RULES, "d"), F.lit(NOW))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("ParseJson") <= 1


def test_policies(spark):
    with pytest.raises(ValueError):
        checked([Policy("doc", RULES), Policy("doc", ())])
    df = spark.createDataFrame([("d", "doc"), ("x", "doc"), ("d", "other"), (None, "doc")], "domain_name string, entity_type string")
    got = {(r.domain_name, r.entity_type): r.policy_at for r in resolved(df, [Policy("doc", RULES, "d"), Policy("doc", RULES)]).collect()}
    assert got == {("d", "doc"): 0, ("x", "doc"): 1, ("d", "other"): None, (None, "doc"): 1}


def test_newest_version_wins_and_a_retried_batch_changes_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "document_id string, projection_version long, completeness_status string, payload string"
    write = sinks.upsert(path)
    batches = [[("a", 2, "complete", "new"), ("b", 1, "complete", "b")], [("a", 1, "complete", "old"), ("a", 2, "complete", "later"), ("b", 2, "deleted", "")]]
    for _ in range(2):
        for k, rows in enumerate(batches):
            write(spark.createDataFrame(rows, schema), k)
    assert [(r.document_id, r.payload) for r in sinks.current(spark, path, ["document_id"]).collect()] == [("a", "new")]
    sinks.compact(spark, path, str(tmp_path / "new"), ["document_id"])
    again = spark.read.parquet(str(tmp_path / "new"))
    assert {(r.document_id, r.projection_version, r.batch) for r in again.collect()} == {("a", 2, 1), ("b", 2, 1)}
    assert [(r.document_id, r.payload) for r in sinks.current(spark, str(tmp_path / "new"), ["document_id"]).collect()] == [("a", "new")]
