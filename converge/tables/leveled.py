"""A table of the newest row of each key, in hash buckets and levels, for states that micro-batches read and write.

A commit adds one run, which holds the rows that changed, in a folder for each bucket. When a level has as many runs as the
fanout, they are merged into one run of the next level, so n commits leave at most (fanout - 1) runs on each of log n levels,
and a row is rewritten once for each level. A reader looks only into the buckets of the keys that it asks for. The runs that
make up the table stand in a numbered log: a commit is there when its entry is, and what a failed one left is overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from converge.tables.log import NumberedLog

BUCKETS, FANOUT = 64, 4
_BATCH, _BUCKET = "_batch", "_bucket"


class Leveled:
    """Rows of `schema`, with no two of a key, below `folder`. Buckets and fanout are fixed by the first commit."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, key: list[str], buckets: int = BUCKETS, fanout: int = FANOUT) -> None:
        self.spark, self.folder, self.key = spark, folder, key
        self.schema = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
        self.log = NumberedLog(spark, f"{folder}/log")
        last = self.log.last()
        self.number, self.entry = last if last else (-1, {"batch": -1, "runs": [], "buckets": buckets, "fanout": fanout, "facts": {}})

    @property
    def batch(self) -> int:
        """The last batch that was committed, -1 before the first."""
        return self.entry["batch"]

    @property
    def facts(self) -> dict:
        """What the last commit noted beside the rows."""
        return self.entry["facts"]

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.key), F.lit(self.entry["buckets"])).cast("int"))

    def _newest(self, rows: DataFrame) -> DataFrame:
        """The row of each key with the highest batch."""
        fields = [f.name for f in self.schema.fields if f.name not in self.key]
        best = F.max_by(F.struct(*fields, _BATCH), _BATCH).alias("_r")
        return rows.groupBy(_BUCKET, *self.key).agg(best).select(_BUCKET, *self.key, *[F.col(f"_r.{c}").alias(c) for c in [*fields, _BATCH]])

    def _stored(self, runs: list[dict]) -> DataFrame:
        stored = StructType([*self.schema.fields, StructField(_BATCH, LongType())])
        if not runs:
            return self._bucketed(self.spark.createDataFrame([], stored))
        with_bucket = StructType([*stored.fields, StructField(_BUCKET, LongType())])
        parts = [self.spark.read.schema(with_bucket).parquet(f"{self.folder}/{r['path']}") for r in runs]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.withColumn(_BUCKET, F.col(_BUCKET).cast("int"))

    def read(self, keys: DataFrame | None = None) -> DataFrame:
        """All rows, or those of the given keys; of the files only those of the keys' buckets are read."""
        rows = self._stored(self.entry["runs"])
        names = [f.name for f in self.schema.fields]
        if keys is None:
            return self._newest(rows).select(*names)
        wanted = self._bucketed(keys.select(*self.key).distinct())
        # At most as many numbers as there are buckets.
        touched = [r[0] for r in wanted.select(_BUCKET).distinct().collect()]
        mine = rows.where(F.col(_BUCKET).isin(touched)) if touched else rows.limit(0)
        return self._newest(mine.join(wanted.drop(_BUCKET), self.key, "left_semi")).select(*names)

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.repartition(F.col(_BUCKET)).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.folder}/{path}")

    def commit(self, rows: DataFrame, batch: int, facts: dict | None = None) -> bool:
        """Put rows, one for each key, in the place of those of their keys, as a batch with a number above all before.

        False, and nothing changes, if the batch was committed already or another writer was faster.
        """
        if batch <= self.batch:
            return False
        path = f"run-0-{batch:012d}"
        self._write(self._bucketed(rows.select(*[f.name for f in self.schema.fields])).withColumn(_BATCH, F.lit(batch).cast("long")), path)
        runs = [*self.entry["runs"], {"level": 0, "path": path}]
        level = 0
        while len(full := [r for r in runs if r["level"] == level]) >= self.entry["fanout"]:
            merged = f"run-{level + 1}-{batch:012d}"
            self._write(self._newest(self._stored(full)), merged)
            runs = [{"level": level + 1, "path": merged}, *[r for r in runs if r not in full]]
            level += 1
        entry = self.entry | {"batch": batch, "runs": runs, "facts": facts or {}}
        if not self.log.add(self.number + 1, entry):
            return False
        self.number, self.entry = self.number + 1, entry
        return True

    def vacuum(self, entries: int = 2) -> list[str]:
        """Remove the runs that the last so many entries of the log do not name; readers of these go on."""
        named = {r["path"] for n in self.log.numbers()[-entries:] for r in self.log.read(n)["runs"]}
        gone = [n for n in self.log.beside(self.folder) if n.startswith("run-") and n not in named]
        self.log.delete([f"{self.folder}/{n}" for n in gone])
        return gone
