"""Queries against their SQL over orders whose keys reach what only larger tables hold."""

from __future__ import annotations

import duckdb
import pytest

from converge import queries
from converge.operators import reconcile as r
from pyspark.sql import functions as F


def against_sql(name, spark, tmp_path, orders):
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    wanted = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in wanted.description]
    got = queries.QUERIES[name](spark, str(tmp_path))
    assert sorted(columns) == sorted(got.columns)
    return sorted(map(tuple, got.select(*columns).collect()), key=repr), sorted(wanted.fetchall(), key=repr)


def orders(spark, keys, customers):
    return spark.range(1).select(F.explode(keys).alias("o_orderkey")).select("o_orderkey", customers.alias("o_custkey"), F.lit("F").alias("o_orderstatus"), (F.col("o_orderkey") % 1000 + 0.5).alias("o_totalprice"), F.concat((F.col("o_orderkey") % 5).cast("string"), F.lit("-X")).alias("o_orderpriority"))


def test_positions_of_customers_beyond_16_bits(spark, tmp_path):
    got, wanted = against_sql("lsn_parse", spark, tmp_path, orders(spark, F.sequence(F.lit(1), F.lit(50)).cast("array<bigint>"), F.element_at(F.array(F.lit(7), F.lit(65_535), F.lit(65_536), F.lit(899_999)), (F.col("o_orderkey") % 4 + 1).cast("int")).cast("bigint")))
    assert got == wanted


@pytest.mark.parametrize("name", ["recon_findings", "recon_scope_counts", "recon_reported_counts", "recon_passed"])
def test_stores_that_hold_an_id_twice(name, spark, tmp_path):
    """The second store adds orders of keys a million higher, which are other orders' keys once there are so many."""
    keys = F.concat(F.sequence(F.lit(1), F.lit(30_000)), F.sequence(F.lit(1_000_001), F.lit(1_030_000))).cast("array<bigint>")
    got, wanted = against_sql(name, spark, tmp_path, orders(spark, keys, F.col("o_orderkey") * 7 % 1000))
    assert got == wanted


def test_an_id_twice_on_either_side(spark):
    """Documents of one id are compared in pairs, sides are counted for themselves."""
    one = [("a", "1", "t", "g", False), ("a", "2", "t", "g", False), ("b", "1", "t", "", None)]
    two = [("a", "1", "t", "g", False), ("a", "1", "u", "g", True)]
    x, y = (spark.createDataFrame(rows, "document_id string, checksum string, tenant_id string, cohort string, is_deleted boolean") for rows in (one, two))
    got = {f.code: (f.affected_ids, f.total_affected) for f in r.findings(x, y).collect()}
    assert got == {"checksum_drift": (["a"], 1), "missing_documents": (["a", "a"], 2), "delete_state_mismatch": (["a", "a"], 2), "count_mismatch": ([], 0), "tenant_scope_mismatch": (["t"], 1), "cohort_scope_mismatch": (["g"], 1), "tenant_delete_scope_mismatch": (["u"], 1)}
    assert {s.scope: (s.source_count, s.target_count) for s in r.scope_counts(x, y, "tenant_id").collect()} == {"t": (2, 1)}
