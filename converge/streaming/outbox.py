"""Publication of what the loop wrote, with what came of it: delivered, superseded, to be tried again, or a dead letter.

A delivery sends a batch's newest document of each entity, and with it what earlier deliveries left to be tried again, unless
the entity has a newer document now. What is left over lies in one folder for each delivery, so a delivery reads the last one
only. States stay as they are, whatever becomes of a publication. A delivery is noted in a numbered log when all is written;
one that stopped before is done again, which sends again, and the versions that go along make that harmless.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from converge.operators.projection import KEY
from converge.operators.publish import ATTEMPTS, DEAD, DELIVERED, RETRY, SUPERSEDED, dead_letters, outcomes
from converge.tables.log import NumberedLog

DOCUMENTS = ", ".join(f"{c} string" for c in KEY) + ", seq long, document_id string, projection_version long, completeness_status string, source_versions array<string>, payload string"
_WAITING = DOCUMENTS + ", request_id string, attempt int"


def newest(documents: DataFrame) -> DataFrame:
    """The document of each entity that came last."""
    fields = [c for c in documents.columns if c not in KEY]
    return documents.groupBy(*KEY).agg(F.max_by(F.struct(*fields), "seq").alias("d")).select(*KEY, *[F.col(f"d.{c}").alias(c) for c in fields])


def deliver(spark: SparkSession, folder: str, batch_id: int, send: Callable[[DataFrame], DataFrame], most_attempts: int = ATTEMPTS) -> dict[str, int]:
    """Send what batch batch_id of the loop below `folder` wrote, and what waits; how many had which outcome.

    send: from documents with request_id (unique) and attempt to acknowledgements: request_id, action, status, error_type.
    Dead letters of publications lie in undelivered/batch=N, with the document, its status and the attempt.
    """
    log = NumberedLog(spark, f"{folder}/deliveries")
    last = log.last()
    if last and batch_id <= last[1]["batch"]:
        return last[1]["outcomes"] if batch_id == last[1]["batch"] else {}
    read = lambda name, batch, schema: spark.read.schema(StructType.fromDDL(schema)).parquet(f"{folder}/{name}/batch={batch}")
    new = newest(read("documents", batch_id, DOCUMENTS)).withColumns({"request_id": F.sha2(F.to_json(F.array(*KEY)), 256), "attempt": F.lit(1)})
    every = new
    if last:
        waiting = read("waiting", last[1]["batch"], _WAITING).join(new.select(*KEY), KEY, "left_anti")
        every = new.unionByName(waiting.withColumn("attempt", F.col("attempt") + 1))
    # What is sent is written first: the answers belong to these rows, however often they are computed.
    every.write.mode("overwrite").parquet(f"{folder}/sent/batch={batch_id}")
    sent = read("sent", batch_id, _WAITING)
    told = outcomes(sent, send(sent), most_attempts, "request_id").persist()
    try:
        seen = Observation()
        count = lambda o: F.count_if(F.col("outcome") == o).alias(o)
        left = told.observe(seen, *[count(o) for o in (DELIVERED, SUPERSEDED, RETRY, DEAD)]).where(F.col("outcome") == RETRY)
        left.select(*sent.columns).write.mode("overwrite").parquet(f"{folder}/waiting/batch={batch_id}")
        lost = told.where(F.col("outcome") == DEAD)
        dead_letters(lost, "publication", F.coalesce("error_type", F.lit("no answer"))).write.mode("overwrite").parquet(f"{folder}/undelivered/batch={batch_id}")
        entry = {"batch": batch_id, "outcomes": {k: int(v) for k, v in seen.get.items()}}
    finally:
        told.unpersist()
    log.add(last[0] + 1 if last else 0, entry)
    return entry["outcomes"]
