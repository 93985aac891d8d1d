"""The loop of a micro-batch as a stream, against the batch history of the same events."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from test_projection import NOW, RULES, SCHEMA, events, plain, spoiled

from converge.operators import projection as p
from converge.policy import Policy
from converge.streaming import outbox, process
from converge.tables.leveled import Leveled
from converge.tables.log import NumberedLog

POLICIES = [Policy("doc", RULES, "d", True)]


def test_loop(spark, tmp_path):
    rows = spoiled(events(240, 20))
    for k in range(3):
        spark.createDataFrame(rows[k * 80 : k * 80 + 80], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    loop = process.processor(out, POLICIES, F.lit(NOW), buckets=4)
    seen = []

    def twice(batch, batch_id):
        loop(batch, batch_id)
        loop(batch, batch_id)
        seen.append(batch_id)

    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = stream.writeStream.foreachBatch(twice).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert query.exception() is None and seen == [0, 1, 2]
    checked_against_plain(spark, out, rows, 80)


def checked_against_plain(spark, out, rows, size):
    wanted = plain(rows, True)
    published = {r.seq: r.projection_version for r in spark.read.parquet(f"{out}/documents").collect()}
    assert published == {seq: w[2] for seq, w in wanted.items() if w[3]}
    letters = spark.read.parquet(f"{out}/letters").collect()
    assert {json.loads(r.payload)["seq"] for r in letters} == {seq for seq, w in wanted.items() if w[0] == "quarantined"}
    last = {e[3]: wanted[e[6]] for e in rows}
    assert {r.logical_entity_id: (r.status, r.projection_version) for r in process.states(spark, out).collect()} == {k: (w[0], w[2]) for k, w in last.items()}
    told = {r.batch: r for r in process.counts(spark, out).collect()}
    pending = {}
    for k in range(len(rows) // size):
        mine = [wanted[e[6]] for e in rows[k * size : k * size + size]]
        pending |= {e[3]: wanted[e[6]][0] not in p.TERMINAL for e in rows[k * size : k * size + size]}
        assert (told[k].accepted, told[k].refused, told[k].quarantined) == (size, 0, sum(w[0] == "quarantined" for w in mine))
        assert (told[k].published, told[k].deleted) == tuple(sum(w[3] and w[0] == s for w in mine) for s in ("published", "deleted"))
        assert told[k].pending == sum(pending.values())


def test_a_batch_that_stops_before_its_commit_is_done_again(spark, tmp_path, monkeypatch):
    rows, out = spoiled(events(180, 15)), str(tmp_path / "out")
    loop = process.processor(out, POLICIES, F.lit(NOW), buckets=4, fanout=2)
    batches = [spark.createDataFrame(rows[k * 60 : k * 60 + 60], SCHEMA) for k in range(3)]
    loop(batches[0], 0)
    for name in ("_write", "log.add", "letters"):

        def stop(*_):
            raise InterruptedError(name)

        with monkeypatch.context() as m:
            if name == "_write":
                m.setattr(Leveled, "_write", stop)
            elif name == "log.add":
                m.setattr(NumberedLog, "add", stop)
            else:
                m.setattr(process, "dead_letters", stop)
            with pytest.raises(InterruptedError):
                loop(batches[1], 1)
    loop(batches[1], 1)
    loop(batches[2], 2)
    checked_against_plain(spark, out, rows, 60)


def test_a_batch_reads_a_bounded_number_of_files(spark, tmp_path):
    schema = StructType.fromDDL("k string, v long")
    table = lambda: Leveled(spark, str(tmp_path / "t"), schema, ["k"], buckets=4, fanout=4)
    wanted, r, most = {}, random.Random(2), 0
    for batch in range(50):
        rows = [(f"k{k}", batch * 100 + k) for k in sorted({r.randrange(30) for _ in range(6)})]
        t = table()
        asked = spark.createDataFrame([(k, 0) for k, _ in rows[:1]], schema)
        before = {x.k: x.v for x in t.read(asked).collect()}
        assert before == {k: wanted[k] for k, _ in rows[:1] if k in wanted}
        bucket = t._bucketed(asked).first()["_bucket"]
        files = sum(len(list((tmp_path / "t" / run["path"] / f"_bucket={bucket}").glob("*.parquet"))) for run in t.entry["runs"])
        if t.entry["runs"]:
            plan = t.read(asked)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("PartitionFilters: [isnotnull(_bucket") == plan.count("FileScan parquet") == len(t.entry["runs"]), plan
        most = max(most, files)
        # One bucket, at most three runs on each of four levels, one file each.
        assert files <= 3 * 4 and len(t.entry["runs"]) <= 3 * 4
        assert t.commit(spark.createDataFrame(rows, schema), batch, {"n": batch}) and not t.commit(spark.createDataFrame(rows, schema), batch)
        wanted |= dict(rows)
    assert most >= 2
    t = table()
    assert {x.k: x.v for x in t.read().collect()} == wanted and t.facts == {"n": 49}
    assert t.vacuum(1) and {x.k: x.v for x in table().read().collect()} == wanted and not t.vacuum(1)


def test_of_two_writers_one_commits(spark, tmp_path):
    schema = StructType.fromDDL("k string, v long")
    a, b = (Leveled(spark, str(tmp_path / "t"), schema, ["k"]) for _ in range(2))
    assert a.commit(spark.createDataFrame([("x", 1)], schema), 0) and not b.commit(spark.createDataFrame([("x", 2)], schema), 1)
    assert [r.v for r in Leveled(spark, str(tmp_path / "t"), schema, ["k"]).read().collect()] == [1]


def test_backpressure_counts_from_state(spark, tmp_path):
    rows = events(120, 20)
    out = str(tmp_path / "out")
    loop = process.processor(out, POLICIES, F.lit(NOW), most_pending=1, buckets=4)
    loop(spark.createDataFrame(rows[:60], SCHEMA), 0)
    states = {r.logical_entity_id: r.status for r in process.states(spark, out).collect()}
    assert sum(s not in p.TERMINAL for s in states.values()) >= 1
    loop(spark.createDataFrame(rows[60:], SCHEMA), 1)
    refused = {json.loads(r.payload)["seq"] for r in spark.read.parquet(f"{out}/letters").where("failure_stage = 'backpressure'").collect()}
    assert refused == {e[6] for e in rows[60:] if states.get(e[3]) in (None, *p.TERMINAL)}
    assert {r.batch: r.refused for r in process.counts(spark, out).collect()} == {0: 0, 1: len(refused)}


def test_publications_that_fail_are_tried_again_or_end_as_letters(spark, tmp_path):
    rows, out = events(240, 20), str(tmp_path / "out")
    loop = process.processor(out, POLICIES, F.lit(NOW), buckets=4)
    size, wanted = 60, plain(rows, True)
    # The server by entity: some are refused for good, some for two attempts, some for ever, some are behind, some stay silent.
    kind = lambda e: int(e[1:]) % 6

    def send(sent):
        answers = []
        for r in sent.collect():
            k = kind(r.logical_entity_id)
            status = 400 if k == 0 else 503 if k == 1 and r.attempt < 3 else 429 if k == 2 else 409 if k == 3 else 200
            if k != 4:
                answers.append((r.request_id, "index", status, "refused" if status > 299 else None))
        return spark.createDataFrame(answers, "request_id string, action string, status int, error_type string")

    waiting, dead = {}, []
    for batch in range(4):
        mine = rows[batch * size : batch * size + size]
        loop(spark.createDataFrame(mine, SCHEMA), batch)
        before = {r.logical_entity_id: r.asDict() for r in process.states(spark, out).collect()}
        told = outbox.deliver(spark, out, batch, send)
        assert outbox.deliver(spark, out, batch, send) == told
        assert {r.logical_entity_id: r.asDict() for r in process.states(spark, out).collect()} == before
        sent = {e: (s, a + 1) for e, (s, a) in waiting.items()} | {e[3]: (e[6], 1) for e in mine if wanted[e[6]][3]}
        expected = {"delivered": 0, "superseded": 0, "retry": 0, "dead_letter": 0}
        waiting = {}
        for e, (s, attempt) in sent.items():
            k = kind(e)
            outcome = "dead_letter" if k == 0 else "superseded" if k == 3 else "delivered" if k == 5 or (k == 1 and attempt == 3) else "retry" if attempt < 3 else "dead_letter"
            expected[outcome] += 1
            if outcome == "retry":
                waiting[e] = (s, attempt)
            if outcome == "dead_letter":
                dead.append((e, s, "no answer" if k == 4 else "refused"))
        assert told == expected
    letters = [(json.loads(r.payload), r.reason) for r in spark.read.parquet(f"{out}/undelivered").where("failure_stage = 'publication'").collect()]
    assert sorted((x["logical_entity_id"], x["seq"], reason) for x, reason in letters) == sorted(dead) and dead
