"""Reconciliation of two stores of orders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from converge.lineage import folder
from converge.operators import reconcile as r
from converge.plans.inputs import SNAPSHOTS, snapshots
from converge.sources import paged

BUCKETS = 256


def _differing(code: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return r.differences(r.joined(*snapshots(spark, sf_dir))).where(F.col("code") == code)

    return query


def _text(df: DataFrame) -> DataFrame:
    return df.withColumn("affected_ids", F.array_join("affected_ids", ","))


def recon_scope_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = snapshots(spark, sf_dir)
    parts = [r.scope_counts(*stores, field, deleted).withColumn("kind", F.lit(kind)) for field, deleted, kind in (("tenant_id", False, "tenant"), ("cohort", False, "cohort"), ("tenant_id", True, "deleted tenant"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def recon_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(r.findings(*snapshots(spark, sf_dir)))


def recon_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, _ = snapshots(spark, sf_dir)
    return r.passed(r.findings(source, source)).withColumn("stores", F.lit("same")).unionByName(r.passed(r.findings(*snapshots(spark, sf_dir))).withColumn("stores", F.lit("different")))


def bucket_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.digests(r.in_buckets(snapshots(spark, sf_dir)[1], BUCKETS))


def bucket_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.compare_digests(*[r.digests(r.in_buckets(s, BUCKETS)) for s in snapshots(spark, sf_dir)])


def bucket_leaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(r.compare_leaves(*[r.in_buckets(s, BUCKETS) for s in snapshots(spark, sf_dir)]))


def bucket_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.in_children(r.in_buckets(snapshots(spark, sf_dir)[1], BUCKETS), 1).groupBy("bucket_id").agg(F.count("*").alias("documents"), F.min("document_id").alias("first_id"))


def bucket_drill_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(r.drilled(*snapshots(spark, sf_dir), buckets=8))


def bucket_drill_remote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(r.drilled(*snapshots(spark, sf_dir), buckets=8, most_buckets=None, remote=True))


def bucket_drill_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drill over 1,024 buckets, of which the first 16 that differ are looked into, down to leaves of 4."""
    return _text(r.drilled(*snapshots(spark, sf_dir), leaf_size=4))


def bucket_drill_wide_remote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(r.drilled(*snapshots(spark, sf_dir), most_buckets=None, leaf_size=4, remote=True))


def bucket_drill_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The remote drill over two stores of pages, written from the snapshots, that keep their trees of digests."""
    at = f"{folder(spark)}/pages-{uuid.uuid4().hex}"
    sides = []
    for name, snapshot in zip(("source", "target"), snapshots(spark, sf_dir), strict=True):
        r.tree(r.with_paths(snapshot, 32)).write.parquet(f"{at}/{name}-tree")
        sides += [paged.write_pages(snapshot, f"{at}/{name}", 32), spark.read.parquet(f"{at}/{name}-tree")]
    return _text(paged.drilled(spark, *sides, buckets=32, leaf_size=4, page_size=10))


def digest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all buckets and children of the second store, from its documents once."""
    return r.tree(r.with_paths(snapshots(spark, sf_dir)[1], 64, 2), 2).select("depth", "bucket_id", "parent", "active_count", "deleted_count", "aggregate_checksum")


def recon_reported_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings where the second store reports a count of its own, as many documents as the first has: no count_mismatch is left."""
    source, target = snapshots(spark, sf_dir)
    return _text(r.findings(source, target, source_count=source.count(), target_count=source.count()))


QUERIES = {f"recon_{name}": _differing(code) for name, code in (("missing", "missing_documents"), ("extra", "unexpected_documents"), ("drift", "checksum_drift"), ("delete_state", "delete_state_mismatch"))}
QUERIES |= {f.__name__: f for f in (recon_scope_counts, recon_findings, recon_passed, bucket_digest, bucket_mismatch, bucket_leaf, bucket_children, bucket_drill_local, bucket_drill_remote, bucket_drill_wide, bucket_drill_wide_remote, bucket_drill_paged, digest_tree, recon_reported_counts)}

_BOTH = SNAPSHOTS + """,
both_ AS (
  SELECT document_id, coalesce(NOT s.is_deleted, false) AS s_here, coalesce(NOT t.is_deleted, false) AS t_here, coalesce(s.is_deleted, false) AS s_gone, coalesce(t.is_deleted, false) AS t_gone,
         s.checksum AS s_sum, t.checksum AS t_sum
  FROM source s FULL JOIN target t USING (document_id)),
diff AS (
  SELECT document_id, 'missing_documents' AS code FROM both_ WHERE s_here AND NOT t_here
  UNION ALL SELECT document_id, 'unexpected_documents' FROM both_ WHERE t_here AND NOT s_here
  UNION ALL SELECT document_id, 'checksum_drift' FROM both_ WHERE s_here AND t_here AND s_sum <> t_sum
  UNION ALL SELECT document_id, 'delete_state_mismatch' FROM both_ WHERE s_gone <> t_gone),
sides AS (SELECT 's' AS side, * FROM source UNION ALL SELECT 't', * FROM target),
scopes AS (
  SELECT 'tenant' AS kind, 'tenant_scope_mismatch' AS code, tenant_id AS scope, side FROM sides WHERE NOT is_deleted
  UNION ALL SELECT 'cohort', 'cohort_scope_mismatch', cohort, side FROM sides WHERE NOT is_deleted
  UNION ALL SELECT 'deleted tenant', 'tenant_delete_scope_mismatch', tenant_id, side FROM sides WHERE is_deleted),
scope_counts AS (SELECT kind, code, scope, count(*) FILTER (side = 's') AS source_count, count(*) FILTER (side = 't') AS target_count FROM scopes WHERE scope <> '' GROUP BY ALL),
affected AS (SELECT code, document_id AS id FROM diff UNION ALL SELECT code, scope FROM scope_counts WHERE source_count <> target_count),
listed AS (SELECT code, string_agg(id, ',' ORDER BY id) FILTER (r <= 25) AS affected_ids, count(*) AS total_affected FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY id) AS r FROM affected) GROUP BY code)"""
_BUCKET = f"'bucket-' || lpad(CAST(('0x' || md5(document_id))::UHUGEINT % {BUCKETS} AS VARCHAR), 4, '0')"


def _digest_sql(name: str) -> str:
    line = "concat_ws('|', document_id, checksum, tenant_id, cohort, CASE WHEN is_deleted THEN '1' ELSE '0' END)"
    sums = lambda text: ", ".join(f"coalesce(sum(('0x' || substr(md5({text}), {8 * k + 1}, 8))::BIGINT), 0)::BIGINT" for k in range(r.LANES))
    return f"""
    {name}_b AS (SELECT *, {_BUCKET} AS bucket_id FROM {name}),
    {name}_digest AS (
      SELECT bucket_id, count(*) FILTER (NOT is_deleted) AS active_count, count(*) FILTER (is_deleted) AS deleted_count, sha256(concat_ws(':', {sums(line)})) AS aggregate_checksum,
             sha256(concat_ws(':', {sums("nullif(tenant_id, '')")})) AS tenant_scope_checksum, sha256(concat_ws(':', {sums("nullif(cohort, '')")})) AS cohort_scope_checksum
      FROM {name}_b GROUP BY bucket_id)"""


_LEAF = """
    leaf AS (
      SELECT bucket_id, document_id, CASE WHEN t.checksum IS NULL THEN 'bucket_missing_documents' WHEN s.checksum IS NULL THEN 'bucket_unexpected_documents' WHEN s.checksum <> t.checksum THEN 'bucket_checksum_drift' END AS code
      FROM (SELECT * FROM source_b WHERE NOT is_deleted) s FULL JOIN (SELECT * FROM target_b WHERE NOT is_deleted) t USING (bucket_id, document_id))"""
_CHILD = "('0x' || substr(h, 1, 32))::UHUGEINT"
ORACLE_SQL = {f"recon_{name}": f"WITH {_BOTH} SELECT document_id, code FROM diff WHERE code = '{code}'" for name, code in (("missing", "missing_documents"), ("extra", "unexpected_documents"), ("drift", "checksum_drift"), ("delete_state", "delete_state_mismatch"))} | {
    "recon_scope_counts": f"WITH {_BOTH} SELECT kind, scope, source_count, target_count FROM scope_counts",
    "recon_findings": f"""WITH {_BOTH} SELECT *, 'critical' AS severity FROM listed
        UNION ALL SELECT 'count_mismatch', '', 0, 'critical' WHERE (SELECT count(*) FROM source WHERE NOT is_deleted) <> (SELECT count(*) FROM target WHERE NOT is_deleted)""",
    "recon_passed": f"WITH {_BOTH} SELECT 'same' AS stores, true AS passed UNION ALL SELECT 'different', NOT EXISTS (SELECT 1 FROM affected)",
    "bucket_digest": f"WITH {SNAPSHOTS}, {_digest_sql('target')} SELECT * FROM target_digest",
    "bucket_mismatch": f"""WITH {SNAPSHOTS}, {_digest_sql('source')}, {_digest_sql('target')}
        SELECT bucket_id, CASE WHEN s.active_count IS NULL OR t.active_count IS NULL THEN 'bucket_missing' ELSE 'bucket_mismatch' END AS code,
               greatest(coalesce(s.active_count + s.deleted_count, 0), coalesce(t.active_count + t.deleted_count, 0)) AS size
        FROM source_digest s FULL JOIN target_digest t USING (bucket_id)
        WHERE (s.active_count, s.deleted_count, s.aggregate_checksum, s.tenant_scope_checksum, s.cohort_scope_checksum) IS DISTINCT FROM (t.active_count, t.deleted_count, t.aggregate_checksum, t.tenant_scope_checksum, t.cohort_scope_checksum)""",
    "bucket_leaf": f"""WITH {SNAPSHOTS}, {_digest_sql('source')}, {_digest_sql('target')}, {_LEAF}
        SELECT bucket_id, code, string_agg(document_id, ',' ORDER BY document_id) FILTER (r <= 25) AS affected_ids, count(*) AS total_affected
        FROM (SELECT *, row_number() OVER (PARTITION BY bucket_id, code ORDER BY document_id) AS r FROM leaf WHERE code IS NOT NULL) GROUP BY ALL""",
    "bucket_children": f"""WITH {SNAPSHOTS}
        SELECT bucket_id || '/child-' || lpad(CAST(({_CHILD} % 16 * 0 + ('0x' || substr(h, 64, 1))::UHUGEINT) AS VARCHAR), 2, '0') AS bucket_id, count(*) AS documents, min(document_id) AS first_id
        FROM (SELECT *, sha256(bucket_id || ':1:' || document_id) AS h FROM (SELECT *, {_BUCKET} AS bucket_id FROM target)) GROUP BY 1""",
}
ORACLE_SQL["bucket_children"] = ORACLE_SQL["bucket_children"].replace(f"({_CHILD} % 16 * 0 + ('0x' || substr(h, 64, 1))::UHUGEINT)", "('0x' || substr(h, 64, 1))::UHUGEINT")


def _drill_sql(remote: bool, buckets: int = 8, most: int = 16, depths: int = 3, leaf: int = 128) -> str:
    """The drill of fixed depth, a few tables for each depth: buckets that are looked into, documents of the next depth."""
    top = _BUCKET.replace(f"% {BUCKETS} ", f"% {buckets} ")
    with_ = [f"{side}_1 AS (SELECT *, {top} AS bucket_id FROM {side})" for side in ("source", "target")]
    out = []
    for k in range(1, depths + 1):
        compared = k == 1 or remote
        limit = f"ORDER BY bucket_id LIMIT {most}" if k == 1 and not remote else ""
        with_.append(f"""each_{k} AS (
          SELECT bucket_id, count(s.is_deleted) AS ns, count(t.is_deleted) AS nt, bool_or((s.checksum, s.tenant_id, s.cohort, s.is_deleted) IS DISTINCT FROM (t.checksum, t.tenant_id, t.cohort, t.is_deleted)) AS differs
          FROM source_{k} s FULL JOIN target_{k} t USING (bucket_id, document_id) GROUP BY bucket_id)""")
        with_.append(f"off_{k} AS (SELECT bucket_id, CASE WHEN ns = 0 OR nt = 0 THEN 'bucket_missing' ELSE 'bucket_mismatch' END AS code, greatest(ns, nt) AS size FROM each_{k} WHERE differs OR {not compared})")
        with_.append(f"open_{k} AS (SELECT * FROM off_{k} {limit})")
        if compared:
            out.append(f"SELECT bucket_id, code, 'critical' AS severity, bucket_id AS affected_ids, 1 AS total_affected FROM off_{k}")
        if not remote:
            out.append(f"SELECT bucket_id, 'bucket_drilldown_unavailable' AS code, 'warning' AS severity, bucket_id AS affected_ids, 1 AS total_affected FROM open_{k} WHERE code = 'bucket_missing'")
        mine = lambda side, of: f"(SELECT * FROM {side}_{k} WHERE bucket_id IN (SELECT bucket_id FROM open_{k} WHERE code <> 'bucket_missing' AND {of}))"  # noqa: E731, B023
        small = "true" if k == depths else f"size <= {leaf}"
        with_.append(f"""leaf_{k} AS (
          SELECT bucket_id, document_id, CASE WHEN t.checksum IS NULL THEN 'bucket_missing_documents' WHEN s.checksum IS NULL THEN 'bucket_unexpected_documents' WHEN s.checksum <> t.checksum THEN 'bucket_checksum_drift' END AS code
          FROM (SELECT * FROM {mine("source", small)} WHERE NOT is_deleted) s FULL JOIN (SELECT * FROM {mine("target", small)} WHERE NOT is_deleted) t USING (bucket_id, document_id))""")
        out.append(f"""SELECT bucket_id, code, 'critical' AS severity, string_agg(document_id, ',' ORDER BY document_id) FILTER (r <= 25) AS affected_ids, count(*) AS total_affected
          FROM (SELECT *, row_number() OVER (PARTITION BY bucket_id, code ORDER BY document_id) AS r FROM leaf_{k} WHERE code IS NOT NULL) GROUP BY bucket_id, code""")
        if k < depths:
            child = f"lpad(CAST(('0x' || substr(sha256(bucket_id || ':{k}:' || document_id), 64, 1))::UHUGEINT AS VARCHAR), 2, '0')"
            with_ += [f"{side}_{k + 1} AS (SELECT * REPLACE (bucket_id || '/child-' || {child} AS bucket_id) FROM {mine(side, f'size > {leaf}')})" for side in ("source", "target")]
    return f"WITH {SNAPSHOTS}, {', '.join(with_)} {' UNION ALL '.join(out)}"


ORACLE_SQL |= {"bucket_drill_local": _drill_sql(False), "bucket_drill_remote": _drill_sql(True), "bucket_drill_wide": _drill_sql(False, 1024, leaf=4), "bucket_drill_wide_remote": _drill_sql(True, 1024, leaf=4)}


def _tree_sql() -> str:
    top = _BUCKET.replace(f"% {BUCKETS} ", "% 64 ")
    line = "concat_ws('|', document_id, checksum, tenant_id, cohort, CASE WHEN is_deleted THEN '1' ELSE '0' END)"
    sums = ", ".join(f"sum(('0x' || substr(md5({line}), {8 * k + 1}, 8))::BIGINT)::BIGINT" for k in range(r.LANES))
    level = lambda depth, node, parent: f"SELECT {depth} AS depth, {node} AS bucket_id, {parent} AS parent, count(*) FILTER (NOT is_deleted) AS active_count, count(*) FILTER (is_deleted) AS deleted_count, sha256(concat_ws(':', {sums})) AS aggregate_checksum FROM children GROUP BY ALL"
    return f"""WITH {SNAPSHOTS}, tops AS (SELECT *, {top} AS top FROM target),
        children AS (SELECT *, top || '/child-' || lpad(CAST(('0x' || substr(sha256(top || ':1:' || document_id), 64, 1))::UHUGEINT AS VARCHAR), 2, '0') AS child FROM tops)
        {level(1, "top", "''")} UNION ALL {level(2, "child", "top")}"""


ORACLE_SQL["digest_tree"] = _tree_sql()
ORACLE_SQL["recon_reported_counts"] = f"WITH {_BOTH} SELECT *, 'critical' AS severity FROM listed"
ORACLE_SQL["bucket_drill_paged"] = _drill_sql(True, 32, leaf=4)
