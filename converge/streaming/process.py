"""The whole loop of a micro-batch: admission, fold, publication and dead letters.

States lie in a leveled table (converge.tables.leveled) with what the fold goes on from, so a batch reads and writes the
buckets of its own entities only, and no event a second time. Documents, letters and counts are logs of batches. The states
are committed last: a batch that stops before that is done again from the same states and overwrites its own folders; one
that is tried again after it changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from converge.operators import projection, reports
from converge.operators.projection import HELD, KEY, QUARANTINED, TERMINAL
from converge.operators.publish import dead_letters
from converge.policy import Policy
from converge.tables.leveled import BUCKETS, FANOUT, Leveled

STATES = ", ".join(f"{c} string" for c in KEY) + f", {HELD}"


def state_table(spark: SparkSession, folder: str, buckets: int = BUCKETS, fanout: int = FANOUT) -> Leveled:
    """The states below a loop's folder: KEY and HELD, read from its log as it is now."""
    return Leveled(spark, f"{folder}/states", StructType.fromDDL(STATES), KEY, buckets, fanout)


def states(spark: SparkSession, folder: str) -> DataFrame:
    """The newest state of each entity."""
    return state_table(spark, folder).read()


def processor(folder: str, policies: list[Policy], now: Column, most_pending: int = 100_000, buckets: int = BUCKETS, fanout: int = FANOUT):
    """A function for foreachBatch over canonical events with seq.

    Below `folder`: states, documents (published) and letters (rejected or impossible to apply, with failure_stage, reason and
    payload), the latter two in a folder for each batch. The log of the states notes for each batch how many entities are pending, and
    how many events were accepted, refused, published, deleted and quarantined, as they are written.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = state_table(spark, folder, buckets, fanout)
        if batch_id <= table.batch:
            return
        write = lambda df, name: df.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")
        kept = [batch.persist()]
        keep = lambda df: kept.append(df.persist()) or kept[-1]
        try:
            known = keep(table.read(batch))
            waiting = table.facts.get("pending", 0)
            judged = keep(reports.admission(batch, known.select(*KEY, "status"), waiting, most_pending))
            accepted = judged.where("accepted").select(*batch.columns)
            history, lost = projection.folded(accepted, policies, now, known)
            # Counted in the pass that writes: which rows are published, and all letters.
            published, refused, whole = Observation(), Observation(), Observation()
            counted = history.observe(whole, F.count(F.lit(1)).alias("accepted"), F.count_if(F.col("status") == QUARANTINED).alias("quarantined"))
            docs = projection.documents(counted)
            gone = F.col("completeness_status") == "deleted"
            write(docs.observe(published, F.count_if(~gone).alias("published"), F.count_if(gone).alias("deleted")), "documents")
            letters = dead_letters(judged.where("not accepted").drop("accepted"), "backpressure", F.col("reason_code")).observe(refused, F.count(F.lit(1)).alias("refused"))
            write(letters.unionByName(dead_letters(lost, "projection", F.col("reason_code"))), "letters")
            after = keep(projection.handed_over(accepted, policies, now, known))
            open_ = lambda df: df.agg(F.count_if(~F.col("status").isin(*TERMINAL))).first()[0]
            pending = waiting + open_(after) - open_(known.join(after.select(*KEY), KEY, "left_semi"))
            table.commit(after, batch_id, {"pending": pending} | whole.get | published.get | refused.get)
        finally:
            for df in kept:
                df.unpersist()

    return process


def counts(spark: SparkSession, folder: str) -> DataFrame:
    """batch, pending, accepted, refused, published, deleted, quarantined of each batch, from the log of the states."""
    log = state_table(spark, folder).log
    entries = [log.read(n) for n in log.numbers()]
    names = ["pending", "accepted", "refused", "published", "deleted", "quarantined"]
    return spark.createDataFrame([(e["batch"], *[int(e["facts"][c]) for c in names]) for e in entries], "batch long, " + ", ".join(f"{c} long" for c in names))
