"""A replay whose segments are composed over many levels, against a loop."""

from __future__ import annotations

from converge.operators import cutover
from test_cutover import SCHEMA, plain, requests


def test_replay_over_many_levels(spark, monkeypatch):
    monkeypatch.setattr(cutover, "FAN", 3, raising=False)
    # Positions below zero and far apart, and a request that has none, which is the first.
    rows = [(*r[:-1], r[-1] * (1 if k % 2 else 40) - 900) for k, r in enumerate(requests(400))]
    rows = list({r[-1]: r for r in rows}.values()) + [("a", "search", cutover.SEARCH[1], "ops", "why", None)]
    out = cutover.replayed(spark.createDataFrame(rows, SCHEMA), 5)
    got = {r.seq: (r.from_state, r.state, r.accepted, r.problem) for r in out.collect()}
    wanted = plain([r if r[-1] is not None else (*r[:-1], -(10**9)) for r in rows])
    wanted[None] = wanted.pop(-(10**9))
    assert got == wanted and len(got) == len(rows)
    # No window gathers the segments of a track.
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
