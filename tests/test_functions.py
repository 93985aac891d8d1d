"""Hashing, routing and versions against plain Python."""

from __future__ import annotations

import hashlib

import pytest

from pyspark.sql import functions as F

from converge.functions import hashing, routing, versions


def _int(kind, text):
    return int(hashlib.new(kind, text.encode()).hexdigest(), 16)


def test_hashes_modulo(spark):
    ids = [f"doc-{i}" for i in range(300)] + ["", "é", "x" * 5000]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    got = df.select("id", hashing.md5_mod(F.col("id"), 1024).alias("a"), hashing.sha256_mod(F.col("id"), 7).alias("b"), hashing.sha256_mod(F.col("id"), (1 << 31) - 1).alias("c"), hashing.bucket_id(F.col("id"), 100_000).alias("d"), hashing.child_bucket_id(F.lit("bucket-0001"), 2, F.col("id")).alias("e")).collect()
    for r in got:
        assert (r.a, r.b, r.c) == (_int("md5", r.id) % 1024, _int("sha256", r.id) % 7, _int("sha256", r.id) % ((1 << 31) - 1))
        assert r.d == f"bucket-{_int('md5', r.id) % 100_000:06d}"
        assert r.e == f"bucket-0001/child-{_int('sha256', f'bucket-0001:2:{r.id}') % 16:02d}"


def test_routes(spark):
    df = spark.createDataFrame([("tenant-a",), ("tenant-whale",), ("z",), (None,)], "t string")
    route = routing.tenant_route(F.col("t"), F.lit("customerDocument"), {"tenant-a"})
    lane = routing.ingest_partition(F.col("t"), F.lit("customerDocument"), {"tenant-whale"})
    rows = {r.t: r for r in df.select("t", *[c.alias(k) for k, c in {**route, **lane}.items()]).collect()}
    assert rows["tenant-a"].read_alias == "customerDocument-tenant-a-read" and rows["tenant-a"].routing_key is None
    assert rows["z"].routing_class == ("shared_a" if _int("sha256", "z") % 2 == 0 else "shared_b")
    assert rows["tenant-whale"].partition_group == "customerDocument-tenant-whale" and rows["tenant-whale"].dedicated
    assert rows["z"].partition_group == f"customerDocument-shared-{_int('sha256', 'z:customerDocument') % 32:02d}"


def test_versions(spark):
    cases = {"1/AF3C0": (1 << 32) | 0xAF3C0, "00000016:00000123:0009": (0x16 << 48) | (0x123 << 16) | 9, "12345": 12345, " 7 ": 7, "ffffffff:ffffffff:ffff": (0xFFFFFFFF << 48) | (0xFFFFFFFF << 16) | 0xFFFF, "1/2/3": None, "a:b": None, "x1": None, "": None, "/1": None}
    got = spark.createDataFrame([(k,) for k in cases], "t string").select("t", versions.log_version(F.col("t")).alias("v")).collect()
    assert {r.t: None if r.v is None else int(r.v) for r in got} == cases


def test_numbers_and_changes(spark):
    df = spark.createDataFrame([("42", "42"), ("42.0", "seq-12-3"), ("4.5", "none"), ("9007199254740993", str(1 << 63)), (None, None)], "a string, b string")
    got = df.select(versions.whole_number(F.col("a")).alias("a"), versions.record_sequence(F.col("b")).alias("b")).collect()
    assert [(None if r.a is None else int(r.a), None if r.b is None else int(r.b)) for r in got] == [(42, 42), (42, 123), (None, None), (9007199254740993, None), (None, None)]
    words = spark.createDataFrame([(" Deleted ",), ("repair",), ("refresh",), ("replace",)], "w string").select(versions.spelled_change(F.col("w")).alias("c")).collect()
    assert [r.c for r in words] == ["delete", "repair", "refresh", "upsert"]


def test_a_record_is_parsed_once_and_a_digest_made_once(spark, tmp_path):
    from converge.functions import routing
    from converge.sources import normalise as n

    spark.createDataFrame([('{"id":"1","tenantId":"t","_lsn":1,"_ts":1,"a":2}',), ("no",), (None,)], "record string").write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    for normalised in (n.change_feed(stored, n.Source("d", "e", "o", "cosmos", version_field="_lsn")), n.log_capture(stored, n.Source("d", "e", "o", "alloydb")), n.change_stream(stored, n.Source("d", "e", "o", "spanner"))):
        plan = normalised._jdf.queryExecution().optimizedPlan().toString()
        assert sum(plan.lower().count(x) for x in ("parse_json", "parsejson")) == 1, plan
    plan = stored.select(*[c.alias(k) for k, c in routing.ingest_partition(F.col("record"), F.lit("e")).items()])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha2(") <= 2


def test_policies_are_read_from_yaml_and_json(spark, tmp_path):
    import json

    from converge.policy import Policy, Rule
    from converge.sources import files

    domain = {"name": "d", "entity_type": "doc", "target_store": "elasticsearch", "projection_policy": {"allow_partial_optional_publish": True, "rules": [{"owner": "core", "freshness_ttl_seconds": 900}, {"owner": "tags", "required": False}]}}
    wanted = [Policy("doc", (Rule("core", True, 900), Rule("tags", False)), "d", True)]
    (tmp_path / "p.json").write_text(json.dumps({"domains": [domain]}))
    assert files.policies(spark, str(tmp_path / "p.json")) == wanted
    yaml = pytest.importorskip("yaml")
    (tmp_path / "p.yaml").write_text(yaml.safe_dump([domain]))
    assert files.policies(spark, str(tmp_path / "p.yaml")) == wanted
    (tmp_path / "bad.yaml").write_text(yaml.safe_dump([domain | {"target_store": "attic"}]))
    with pytest.raises(ValueError):
        files.policies(spark, str(tmp_path / "bad.yaml"))


def test_transition_logs_are_read_by_domain(spark, tmp_path):
    from converge.operators import cutover
    from converge.sources import files

    s = cutover.SEARCH
    rows = [("d", "search", s[0], s[1], "o", "r", None, 1), ("e", "search", s[0], s[1], "o", "r", None, 2), ("d", "search", s[1], s[2], "o", "r", None, 3)]
    files.append_transitions(spark.createDataFrame(rows[:2], files.TRANSITIONS), str(tmp_path / "log"))
    files.append_transitions(spark.createDataFrame(rows[2:], files.TRANSITIONS), str(tmp_path / "log"))
    assert {r.domain_name: r.search_state for r in cutover.latest(files.transition_log(spark, str(tmp_path / "log"))).collect()} == {"d": s[2], "e": s[1]}
    assert files.transition_log(spark, str(tmp_path / "log"), "e").count() == 1


def test_one_route_is_that_of_the_table(spark):
    tenants = [f"tenant-{k}" for k in range(40)]
    route = routing.tenant_route(F.col("t"), F.lit("doc"), {"tenant-3"})
    for r in spark.createDataFrame([(t,) for t in tenants], "t string").select("t", *[c.alias(k) for k, c in route.items()]).collect():
        assert routing.route_of(r.t, "doc", {"tenant-3"}) == {k: r[k] for k in route}
