"""Reconciliation against sets in plain Python."""

from __future__ import annotations

import hashlib
import random

from converge.functions.hashing import bucket_id
from converge.operators import reconcile as r
from converge.sources import paged

SCHEMA = "document_id string, checksum string, tenant_id string, cohort string, is_deleted boolean"


def stores(n=400, seed=1):
    x = random.Random(seed)
    source = [(f"d{i}", f"c{i}", x.choice(["t1", "t2", "", None]), x.choice(["gold", "silver"]), x.random() < 0.1) for i in range(n)]
    target = [(d, "changed" if x.random() < 0.05 else c, t, g, x.random() < 0.1 if x.random() < 0.1 else gone) for d, c, t, g, gone in source if x.random() > 0.05] + [(f"x{i}", "c", "t1", "gold", False) for i in range(40)]
    return source, target


def test_findings(spark):
    source, target = stores()
    a, b = ({d[0]: d for d in side} for side in (source, target))
    here = [{k for k, d in side.items() if not d[4]} for side in (a, b)]
    gone = [{k for k, d in side.items() if d[4]} for side in (a, b)]
    wanted = {
        "missing_documents": sorted(here[0] - here[1]),
        "unexpected_documents": sorted(here[1] - here[0]),
        "checksum_drift": sorted(k for k in here[0] & here[1] if a[k][1] != b[k][1]),
        "delete_state_mismatch": sorted(gone[0] ^ gone[1]),
    }
    got = {f.code: f for f in r.findings(spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA)).collect()}
    for code, ids in wanted.items():
        assert (got[code].affected_ids, got[code].total_affected) == (ids[:25], len(ids))
    assert ("count_mismatch" in got) == (len(here[0]) != len(here[1]))
    overridden = r.findings(spark.createDataFrame(source, SCHEMA), spark.createDataFrame(source, SCHEMA), target_count=1)
    assert [f.code for f in overridden.collect()] == ["count_mismatch"]


def test_equal_stores_pass(spark):
    df = spark.createDataFrame(stores()[0], SCHEMA)
    assert r.passed(r.findings(df, df)).first()[0]
    assert r.drilled(df, df, buckets=4).count() == 0


def test_digest(spark):
    rows = [("b", "2", None, "gold", True), ("a", "1", "t", "", False)]
    got = r.digests(r.in_buckets(spark.createDataFrame(rows, SCHEMA), 1)).first()
    lane = lambda texts, k: sum(int(hashlib.md5(t.encode()).hexdigest()[8 * k : 8 * k + 8], 16) for t in texts)
    of = lambda *texts: hashlib.sha256(":".join(str(lane(texts, k)) for k in range(4)).encode()).hexdigest()
    assert (got.active_count, got.deleted_count) == (1, 1)
    assert got.aggregate_checksum == of("a|1|t||0", "b|2||gold|1")
    assert (got.tenant_scope_checksum, got.cohort_scope_checksum) == (of("t"), of("gold"))


def test_tree_adds_up(spark):
    """Digests of the tree are those of the documents of each bucket and child, and no list of documents is collected."""
    source, _ = stores()
    df = spark.createDataFrame(source, SCHEMA)
    nodes = {x.bucket_id: x for x in r.tree(r.with_paths(df, 4, 3, 16), 3).collect()}
    at = r.in_buckets(df, 4)
    for depth in (1, 2, 3):
        direct = r.digests(at).collect()
        assert len(direct) == sum(n.depth == depth for n in nodes.values())
        assert all(tuple(nodes[d.bucket_id][c] for c in r.DIGEST) == tuple(d[c] for c in r.DIGEST) for d in direct)
        assert all(nodes[d.bucket_id].parent == d.bucket_id.rpartition("/")[0] for d in direct)
        at = r.in_children(at, depth)
    assert "collect_list" not in r.digests(r.in_buckets(df, 4))._jdf.queryExecution().optimizedPlan().toString()


def test_hashes_are_made_once(spark, tmp_path):
    spark.createDataFrame(stores()[0], SCHEMA).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    plan = r.in_buckets(stored, 1000)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
    assert {x.b for x in stored.select(bucket_id(stored.document_id, 1000).alias("b")).collect()} == {f"bucket-{int(hashlib.md5(d[0].encode()).hexdigest(), 16) % 1000:04d}" for d in stores()[0]}


def _drilled(source, target, buckets, most, depths, leaf, remote):
    """The drill as a plain recursion over dictionaries."""
    number = lambda kind, text, n: int(hashlib.new(kind, text.encode()).hexdigest(), 16) % n
    out = []

    def grouped(docs, name):
        found = {}
        for k, d in docs.items():
            found.setdefault(name(k), {})[k] = d
        return found

    def look(name, s, t, depth):
        if s is None or t is None:
            if not remote:
                out.append((name, "bucket_drilldown_unavailable", "warning", 1))
            return
        if depth >= depths or max(len(s), len(t)) <= leaf:
            x, y = ({k for k, d in side.items() if not d[4]} for side in (s, t))
            for code, ids in (("bucket_missing_documents", x - y), ("bucket_unexpected_documents", y - x), ("bucket_checksum_drift", {k for k in x & y if s[k][1] != t[k][1]})):
                if ids:
                    out.append((name, code, "critical", len(ids)))
            return
        child = lambda k: f"{name}/child-{number('sha256', f'{name}:{depth}:{k}', 16):02d}"
        visit(grouped(s, child), grouped(t, child), depth + 1, remote)

    def visit(s, t, depth, compare, most=None):
        names = sorted(set(s) | set(t))
        if compare:
            # Digests count null and empty scopes alike, so these are compared as such.
            plain = lambda docs: docs and {k: (d[1], d[2] or "", d[3] or "", d[4]) for k, d in docs.items()}
            names = [n for n in names if plain(s.get(n)) != plain(t.get(n))]
            out.extend((n, "bucket_mismatch" if n in s and n in t else "bucket_missing", "critical", 1) for n in names)
        for n in names[:most]:
            look(n, s.get(n), t.get(n), depth)

    top = lambda k: f"bucket-{number('md5', k, buckets):04d}"
    a, b = ({d[0]: d for d in side} for side in (source, target))
    visit(grouped(a, top), grouped(b, top), 1, True, most)
    return sorted(out)


def test_drill(spark):
    source, target = stores()
    for remote, most in ((False, 3), (True, None)):
        got = r.drilled(spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA), buckets=4, most_buckets=most, depths=3, leaf_size=16, remote=remote)
        assert sorted((x.bucket_id, x.code, x.severity, x.total_affected) for x in got.collect()) == _drilled(source, target, 4, most, 3, 16, remote)


def test_pages_are_fetched_of_buckets_that_differ_only(spark, tmp_path):
    source, _ = stores(600)
    target = [(d, "changed" if d in ("d7", "d300") else c, *rest) for d, c, *rest in source]
    frames = [spark.createDataFrame(x, SCHEMA) for x in (source, target)]
    kept = [paged.write_pages(df, str(tmp_path / n), 64) for df, n in zip(frames, "ab", strict=True)]
    whole = paged.read(spark, kept[0], 7)
    assert sorted(map(tuple, whole.drop("bucket_id").collect()), key=repr) == sorted(source, key=repr)
    bad = sorted({x.bucket_id for x in r.in_buckets(frames[0].where("document_id in ('d7', 'd300')"), 64).collect()})
    assert whole.where(whole.bucket_id.isin(bad)).rdd.getNumPartitions() == len(bad)
    trees = [r.tree(r.with_paths(df, 64)) for df in frames]
    asked = []
    monkey = paged.read
    try:
        paged.read = lambda spark, store, size: (lambda df: asked.append(df) or df)(monkey(spark, store, size))
        got = paged.drilled(spark, kept[0], trees[0], kept[1], trees[1], 64, leaf_size=2, page_size=7)
        wanted = r.drilled(*frames, buckets=64, most_buckets=None, leaf_size=2, remote=True)
        key = lambda x: (x.bucket_id, x.code, x.severity, tuple(x.affected_ids), x.total_affected)
        assert sorted(map(key, got.collect())) == sorted(map(key, wanted.collect())) and len(asked) == 2
        assert {i for x in got.collect() if x.code == "bucket_checksum_drift" for i in x.affected_ids} <= {"d7", "d300"}
    finally:
        paged.read = monkey
