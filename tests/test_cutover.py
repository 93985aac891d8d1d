"""Replay of requests against a loop, and writers that append at once."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor

import pytest

from converge.operators import cutover, publish, reports
from converge.tables.log import NumberedLog

SCHEMA = "domain_name string, track string, to_state string, operator string, reason string, seq long"


def requests(n=700, seed=4):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        track = r.choice(["backend", "search", "search"])
        target = r.choice([*cutover.STATES[track][1:4], r.choice(cutover.STATES[track]), "nowhere"])
        rows.append((r.choice("ab"), track, target, r.choice(["ops", "ops", "ops", " ", None]), r.choice(["why", "why", ""]), 10 + k * 3))
    return [*rows, ("a", "unknown", "x", "ops", "why", 5)]


def plain(rows):
    state, out = {}, {}
    for domain, track, target, operator, reason, seq in sorted(rows, key=lambda r: r[-1]):
        now = state.get((domain, track), cutover.START.get(track))
        edge = (track, now, target) in cutover.EDGES
        named = bool((operator or "").strip() and reason.strip())
        problem = "unknown_track" if track not in cutover.START else "illegal_transition" if not edge else None if named else "missing_operator_or_reason"
        if problem is None:
            state[domain, track] = target
        out[seq] = (now, state.get((domain, track), now), problem is None, problem)
    return out


@pytest.mark.parametrize("segment", [7, 256, 100_000])
def test_replay(spark, segment):
    rows = requests()
    got = {r.seq: (r.from_state, r.state, r.accepted, r.problem) for r in cutover.replayed(spark.createDataFrame(rows, SCHEMA), segment).collect()}
    wanted = plain(rows)
    assert got == wanted and sum(w[2] for w in wanted.values()) > 20
    assert cutover.replayed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_refused_request_leaves_the_state(spark):
    b = cutover.BACKEND
    rows = [("d", "backend", b[1], "o", "r", 0), ("d", "backend", b[3], "o", "r", 1), ("d", "backend", b[2], "o", "r", 2)]
    assert [(r.accepted, r.state) for r in cutover.replayed(spark.createDataFrame(rows, SCHEMA)).orderBy("seq").collect()] == [(True, b[1]), (False, b[1]), (True, b[2])]


def test_of_writers_at_once_one_is_first_and_the_others_see_its_state(spark, tmp_path):
    s = cutover.SEARCH
    path = str(tmp_path / "log")

    def write(k):
        try:
            return cutover.append(NumberedLog(spark, path), "d", "search", s[1], f"op{k}", "planned")
        except ValueError as e:
            return str(e)

    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(write, range(8)))
    assert sum(isinstance(f, dict) for f in found) == 1 and sum(f == f"search of d cannot go from {s[1]} to {s[1]}" for f in found if isinstance(f, str)) == 7
    with ThreadPoolExecutor(8) as pool:
        # Different domains do not stand in each other's way, though they share the numbers of the log.
        each = list(pool.map(lambda k: cutover.append(NumberedLog(spark, path), f"x{k}", "search", s[1], "op", "planned"), range(8)))
    log = NumberedLog(spark, path)
    assert log.numbers() == list(range(9)) and sorted(e["seq"] for e in each) == list(range(1, 9))
    for target, operator in ((s[3], "op"), (s[2], " ")):
        with pytest.raises(ValueError):
            cutover.append(log, "d", "search", target, operator, "planned")
    assert log.numbers() == list(range(9))
    entries = spark.createDataFrame([log.read(n) for n in log.numbers()])
    assert {r.domain_name: r.search_state for r in cutover.latest(entries).collect()} == {d: s[1] for d in ["d", *[f"x{k}" for k in range(8)]]}


def test_the_last_entry_is_found_without_a_list(spark, tmp_path):
    log = NumberedLog(spark, str(tmp_path / "log"))
    assert log.last() is None
    for n in range(19):
        assert log.add(n, {"n": n}) and not log.add(n, {"n": -1}) and log.last() == (n, {"n": n})
    assert log.numbers() == list(range(19))


def test_outcomes(spark):
    sent = spark.createDataFrame([(d, a) for d, a in (("ok", 1), ("gone", 1), ("old", 3), ("busy", 2), ("busy3", 3), ("bad", 1), ("silent", 1), ("silent3", 3), ("lost", 1))], "document_id string, attempt int")
    items = [("index", "ok", 201, None), ("delete", "gone", 404, None), ("index", "old", 409, "version_conflict"), ("index", "busy", 429, "busy"), ("index", "busy3", 503, "busy"), ("index", "bad", 400, "mapping"), ("index", "lost", 404, "no index")]
    body = '{"items":[' + ",".join(f'{{"{a}":{{"_id":"{i}","status":{s}' + (f',"error":{{"type":"{e}","reason":"x"}}' if e else "") + "}}" for a, i, s, e in items) + "]}"
    acknowledged = publish.acknowledged(spark.createDataFrame([(body,)], "response string"))
    got = {r.document_id: r.outcome for r in publish.outcomes(sent, acknowledged).collect()}
    assert got == {"ok": "delivered", "gone": "delivered", "old": "superseded", "busy": "retry", "busy3": "dead_letter", "bad": "dead_letter", "silent": "retry", "silent3": "dead_letter", "lost": "dead_letter"}


def test_a_backfill_goes_on_where_it_stopped(spark, tmp_path):
    events, seen, path = spark.range(3, 47).withColumnRenamed("id", "seq"), [], str(tmp_path / "position")

    def apply(stretch, number):
        if number == 2 and not any(n == "stopped" for n, _ in seen):
            seen.append(("stopped", []))
            raise InterruptedError
        seen.append((number, sorted(r.seq for r in stretch.collect())))

    with pytest.raises(InterruptedError):
        reports.resumed(events, path, apply, interval=10)
    assert reports.load_position(spark, path) == 20
    assert reports.resumed(events, path, apply, interval=10) == 47
    assert [n for n, _ in seen] == [0, 1, "stopped", 2, 3, 4] and sorted(s for _, x in seen for s in x) == list(range(3, 47))
    assert reports.resumed(events, path, apply, interval=10) == 47 and len(seen) == 6
