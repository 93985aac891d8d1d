"""The registered queries: against DuckDB where SQL says the same, and the pipeline against a plain version of its stages."""

from __future__ import annotations

from pathlib import Path

import duckdb
import plain
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from converge.llm import common, queries, toxicity

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.is_dir(), reason="no shared tables here")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows(name, spark):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    wanted = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in wanted.description]
    got = queries.QUERIES[name](spark, str(SF)).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, wanted.fetchall()), key=repr)


def test_each_operator_has_a_query():
    assert [f"op{n}_" for n in range(1, 14)] == [q[: q.index("_") + 1] for q in queries.QUERIES]
    assert "pipeline" in __spark_entry__.queries()


def test_pipeline(spark):
    docs = common.documents(spark, str(SF))
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(~common.held_out("doc_id"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    stay = {r.doc_id: r.text or "" for r in docs.collect() if scores[r.doc_id] < 0.5}
    texts = {}
    for i in sorted(stay):
        texts.setdefault(stay[i], i)
    once = {i: t for t, i in texts.items()}
    kept = {i for i, (_, c) in plain.components(list(once.items())).items() if c == i}
    out = docs
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        out = common.written(stage(spark, out, str(SF)))
        seen.append(out)
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in seen]
    assert ids[0] == set(stay) and ids[1] == set(once) and ids[2] == kept and ids[3] <= kept and ids[4] == ids[3]
    assert all(s.columns == docs.columns for s in seen[:4])
    whole = corpus_pipeline.run(spark, str(SF))
    assert sorted(map(tuple, whole.select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(tuple, seen[4].select("doc_id", "piece", "ids_crc32").collect()))
    most = seen[4].groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert most <= 2048
