"""Relevance, reports, publication and files on small cases."""

from __future__ import annotations

import json
import math
import random

import numpy as np
import pytest

from converge.operators import publish, relevance, reports
from converge.sources import files, normalise


def test_gain(spark):
    rows = [("a", ["doc-2", "doc-1", "doc-3"], {"doc-1": 3.0, "doc-2": 2.0}), ("b", [f"doc-{i}" for i in range(1, 21)], {"doc-20": 1.0}), ("c", [], {"doc-1": 1.0}), ("d", ["x"], {}), ("e", ["doc-1", "doc-1"], {"doc-1": 1.0})]
    got = {r.query_id: r for r in relevance.evaluate(spark.createDataFrame(rows, "query_id string, retrieved array<string>, judged map<string,double>")).collect()}
    assert got["a"].ndcg_at_k == pytest.approx((3 + 7 / math.log2(3)) / (7 + 3 / math.log2(3))) and got["a"].mrr == 1.0
    assert (got["b"].ndcg_at_k, got["b"].mrr) == (0.0, 0.0)
    assert got["c"].zero_results and got["d"].ndcg_at_k == 0.0
    assert got["e"].ndcg_at_k > 1  # a repeated id counts again
    empty = relevance.corpus_report(relevance.evaluate(spark.createDataFrame([], "query_id string, retrieved array<string>, judged map<string,double>"))).first()
    assert tuple(empty) == (0, 0.0, 0.0, 0.0)


def test_gate(spark):
    rows = [("fine", ["a", "b"], ["a", "b"], {"a": 1.0}), ("worse", ["a", "b"], ["b", "c", "a"], {"a": 1.0}), ("apart", ["a", "b"], ["c", "d"], None), ("near", ["a", "b"], ["b", "c"], None)]
    got = {r.query_id: (r.code, r.severity) for r in relevance.gate(spark.createDataFrame(rows, "query_id string, primary array<string>, shadow array<string>, judged map<string,double>")).collect()}
    assert got == {"fine": (None, None), "worse": ("shadow_relevance_regression", "high"), "apart": ("shadow_overlap_regression", "medium"), "near": (None, None)}


def test_runs_over_seams(spark):
    r = random.Random(4)
    rows = [(f"b{i % 3}", i, r.random() < 0.4) for i in range(600)]
    wanted = []
    for b in ("b0", "b1", "b2"):
        run = []
        for _, seq, ok in [x for x in rows if x[0] == b] + [(b, None, True)]:
            if ok:
                wanted += [(b, run[0], run[-1], len(run), len(run) >= 3)] if run else []
                run = []
            else:
                run.append(seq)
    df = spark.createDataFrame(rows, "backend string, seq long, ok boolean")
    for span in (1, 7, 50, 10**6):
        got = reports.failure_runs(df, "backend", 3, span)
        assert sorted(map(tuple, got.select("backend", "first_seq", "last_seq", "failures", "opened").collect())) == sorted(wanted)


def test_pairs_and_freeze(spark):
    side = lambda *rows: spark.createDataFrame(rows, "request_id string, query_id string, retrieved array<string>")
    got = relevance.paired(side(("a", "q", ["1"]), ("b", "q", ["2"])), side(("b", "q", ["3"]), ("c", "q", [])))
    assert [(r.request_id, r.primary, r.shadow) for r in got.collect()] == [("b", ["2"], ["3"])]
    log = spark.createDataFrame([("x", 1, None), ("x", 2, "bad"), ("x", 3, None), ("y", 4, None)], "kind string, seq long, code string")
    assert {r.seq: r.frozen for r in relevance.frozen(log, ["kind"]).collect()} == {1: False, 2: False, 3: True, 4: False}


def test_report_file(spark, tmp_path):
    reports.write_report(spark.createDataFrame([(3,)], "total_requests long"), str(tmp_path / "r"))
    assert [json.loads(x.value) for x in spark.read.text(str(tmp_path / "r")).collect()] == [{"total_requests": 3}]


def test_percentiles_of_one_and_none(spark):
    schema = "latency_ms double, ok boolean, result_count long"
    one = reports.latency(spark.createDataFrame([(5.0, True, 2)], schema)).first()
    assert (one.p50_latency_ms, one.p99_latency_ms, one.average_result_count) == (5.0, 5.0, 2.0)
    none = reports.latency(spark.createDataFrame([], schema)).first()
    assert (none.total_requests, none.p50_latency_ms) == (0, 0.0)


def test_body_and_bulk(spark):
    docs = spark.createDataFrame([("d1", "t", "dom", "doc", 3, "complete", ["core=1"], '{"id":"own","_meta":1,"x":{"b":2,"a":1}}'), ("d2", "t", "dom", "doc", 4, "deleted", [], '{"is_deleted":true}')], "document_id string, tenant_id string, domain_name string, entity_type string, projection_version long, completeness_status string, source_versions array<string>, payload string")
    got = {r.document_id: [json.loads(x) for x in r.lines] for r in publish.bulk_lines(docs, docs["entity_type"]).collect()}
    action, body = got["d1"]
    assert action["index"]["version"] == 3 and body["id"] == "own" and body["tenant_id"] == "t" and body["_meta"]["document_id"] == "d1" and body["x"] == {"a": 1, "b": 2}
    assert list(got["d2"][0]) == ["delete"] and len(got["d2"]) == 1


def test_responses(spark):
    bulk = json.dumps({"items": [{"index": {"_id": "a", "status": 200}}, {"delete": {"_id": "b", "status": 409, "error": {"type": "version_conflict", "reason": "older"}}}]})
    assert [tuple(r) for r in publish.failed_items(spark.createDataFrame([(bulk,)], "response string")).collect()] == [("b", "delete", 409, "version_conflict", "older")]
    rows = [("q1", json.dumps({"value": [{"id": 1}, {"id": None}, {"id": "x"}], "@odata.count": 9})), ("q2", json.dumps({"hits": {"total": {"value": 2}, "hits": [{"_id": "a", "_source": {}}, {"_id": "b", "_source": {"id": "c"}}]}})), ("q3", "not json")]
    got = {r.query_id: (r.ids, r.total) for r in publish.hits(spark.createDataFrame(rows, "query_id string, response string")).collect()}
    assert got == {"q1": (["1", "x"], 9), "q2": (["a", "c"], 2), "q3": (None, None)}


def test_rejected_records_go_to_dead_letters(spark):
    source = normalise.Source("d", "doc", "core", "cosmos", version_field="_lsn")
    rows = ['{"id":"1","tenantId":"t","_lsn":42.0,"_ts":0,"a":1,"_x":2}', '{"id":1,"tenantId":"t","_lsn":1,"_ts":0}', "broken", None]
    valid, rejected = normalise.split(normalise.change_feed(spark.createDataFrame([(r,) for r in rows], "record string"), source))
    got = valid.first()
    assert (got.payload, int(got.source_version), got.change_type) == ('{"a":1,"id":"1","tenantId":"t"}', 42, "upsert")
    assert sorted(r.problem for r in rejected.collect()) == ["id must be a non-empty string", "not an object", "not an object"]


def test_files(spark, tmp_path):
    domain = {"name": "d", "entity_type": "doc", "target_store": "spanner", "projection_policy": {"rules": [{"owner": "core", "required": True, "freshness_ttl_seconds": 900}]}}
    (tmp_path / "ok.json").write_text(json.dumps({"domains": [domain]}))
    (policy,) = files.policies(spark, str(tmp_path / "ok.json"))
    assert policy.rules[0].freshness_ttl_seconds == 900 and policy.domain_name == "d"
    (tmp_path / "bad.json").write_text(json.dumps({"domains": [domain | {"target_store": "paper"}]}))
    with pytest.raises(ValueError):
        files.policies(spark, str(tmp_path / "bad.json"))
    (tmp_path / "cases.jsonl").write_text('{"name":"a","raw_params":{"$top":"5"},"weight":3}\n{"name":"b"}\n')
    assert sorted((r.name, r.weight) for r in files.search_cases(spark, str(tmp_path / "cases.jsonl")).collect()) == [("a", 3), ("b", 1)]


def test_percentiles_are_those_of_all_values(spark):
    x = random.Random(3)
    rows = [(g, v, True, 1) for g, values in {"a": [x.expovariate(0.1) for _ in range(501)], "b": [7.0] * 40, "c": [x.randrange(-4, 5) * 1.0 for _ in range(64)], None: [1.0, 2.0], "d": [None]}.items() for v in values]
    got = {r.g: r for r in reports.latency(spark.createDataFrame(rows, "g string, latency_ms double, ok boolean, result_count long"), ["g"]).collect()}
    assert len(got) == 5 and got["d"].p99_latency_ms == 0
    for g in ("a", "b", "c", None):
        values = [v for k, v, _, _ in rows if k == g]
        assert [got[g].p50_latency_ms, got[g].p95_latency_ms, got[g].p99_latency_ms] == pytest.approx(np.percentile(values, [50, 95, 99]).tolist())
