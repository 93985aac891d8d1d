"""Shared helpers: whole-text byte and word arithmetic in numpy, and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step works on; a longer text is one step of its own.
STEP_BYTES = 2 << 20

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUES = np.random.RandomState(7).randint(1, 2**62, size=256, dtype=np.int64).astype(U64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id: str | Column) -> Column:
    """True where crc32 of the id as text leaves no remainder modulo 5."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where it names none, a local session, whose executors are
    the driver, gets a folder of its own; a cluster is refused, since its executors would not see that folder."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def carried(docs: DataFrame, **own: Column) -> DataFrame:
    """docs as one column of structs, _row, beside columns of our own, so that no name can clash with another."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[c.alias(k) for k, c in own.items()])


def restored(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that carried() put into _row."""
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in columns])


def written(df: DataFrame) -> DataFrame:
    """The rows of df, written once as Parquet in the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def packed_exchange(df: DataFrame, part: str = "part") -> DataFrame:
    """Send each row to the partition that its column `part` names."""
    return df.repartitionById(partitions(df.sparkSession), F.col(part))


#: A key that more than one in so many rows have is joined by broadcast: there are no more such keys than this.
HOT_SHARE = 500


def spread_join(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """rows with the columns of table that belong to their key (null where table has none), whatever the keys' frequencies.

    table has a row per key, with `count`, how many of the rows have it. Rows of the frequent keys get theirs from a broadcast
    of fewer than HOT_SHARE rows and are dealt over keys that match nothing, so no task gathers a key. table is read three
    times, so it is to be stored. Null keys match nothing.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    values = [c for c in table.columns if c not in (key, count)]
    kept = table.where(F.col(key).isNotNull())
    hot = F.broadcast(kept.where(F.col(count) * HOT_SHARE > total).select(F.col(key).alias("_hot_key"), F.struct(*values).alias("_hot")))
    cold = kept.where(F.col(count) * HOT_SHARE <= total).select(F.col(key).cast("binary").alias("_cold_key"), F.struct(*values).alias("_cold"))
    some = F.concat(F.lit("-"), F.xxhash64(*rows.columns).cast("string")).cast("binary")
    found = rows.join(hot, F.col(key) == F.col("_hot_key"), "left")
    dealt = F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.concat(F.lit("+").cast("binary"), F.col(key).cast("binary"))).otherwise(some)
    found = found.withColumn("_dealt", dealt).join(cold.withColumn("_cold_key", F.concat(F.lit("+").cast("binary"), F.col("_cold_key"))), F.col("_dealt") == F.col("_cold_key"), "left")
    return found.select(*rows.columns, *[F.coalesce(F.col("_hot").getField(v), F.col("_cold").getField(v)).alias(v) for v in values])


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", step: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with their texts as one byte array and its offsets; null texts are empty."""
    for batch in batches:
        col = pc.fill_null(batch.column(text).cast(pa.large_binary()), b"")
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        if not len(col):
            continue
        offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
        data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
        i = 0
        while i < len(col):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + step, side="right")) - 1)
            yield batch.slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            i = j


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+, and for each document the index of its first word (one more at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    space = _SPACE[data]
    before, after = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
    before[1:] = space[:-1]
    after[:-1] = space[1:]
    before[off[:-1][off[:-1] < n]] = True
    after[off[1:][off[1:] > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, off)


def _power(n: int, base: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.empty(size, dtype=U64)
        have[0] = 1
        done = 1
        while done < size:
            m = min(done, size - done)
            have[done : done + m] = have[:m] * U64(pow(base, done, 1 << 64))
            done += m
        if size <= 4 * STEP_BYTES:
            _powers[name] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[s:e] for each range, from one prefix sum of a polynomial modulo 2**64."""
    n = len(values)
    prefix = np.zeros(n + 1, dtype=U64)
    np.cumsum(values * _power(n, _BASE, "up"), out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * _power(n + 1, _BASE_INV, "down")[starts]
    return mix(h ^ (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hashes(byte_values(data), starts, ends)


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the width-word shingles of each document, lower-cased A-Z; with fewer words, of all of them."""
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, off)
    words = word_hashes(data, starts, ends)
    n = np.diff(first)
    counts = np.where(n >= width, n - width + 1, (n > 0).astype(n.dtype))
    at = np.concatenate([[0], np.cumsum(counts)])
    begin = np.repeat(first[:-1], counts) + (np.arange(at[-1]) - np.repeat(at[:-1], counts))
    end = np.minimum(begin + width, np.repeat(first[1:], counts))
    h = range_hashes(words, begin, end)
    return [np.unique(h[at[k] : at[k + 1]]) for k in range(len(n))]
