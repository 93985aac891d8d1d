"""Document fingerprints by winnowing.

Every K consecutive bytes are hashed, and of each WINDOW consecutive hashes the smallest is chosen, the rightmost of equal
ones. Chosen hashes are kept with their positions. Any two texts that share K + WINDOW - 1 bytes in a row share a chosen hash.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from converge.llm import common
from converge.llm.common import U64

K, WINDOW = 12, 24
_LAST = np.iinfo(np.uint64).max
_LOW = U64(0xFFFFFFFF)


def chosen(data: np.ndarray, off: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, 32-bit hash and byte position of each chosen k-gram, in order.

    A document of fewer than k bytes has one hash, of all its bytes; an empty one has none.
    """
    lengths = np.diff(off)
    grams = np.where(lengths >= k, lengths - k + 1, (lengths > 0).astype(lengths.dtype))
    at = np.concatenate([[0], np.cumsum(grams)])
    nth = np.arange(at[-1]) - np.repeat(at[:-1], grams)
    begin = np.repeat(off[:-1], grams) + nth
    end = np.minimum(begin + k, np.repeat(off[1:], grams))
    h = common.range_hashes(common.byte_values(data), begin, end) >> U64(32)
    # Each document's hashes lie in a row of their own, apart by what no window reaches over, so that windows stay inside.
    gap = window - 1
    places = np.arange(at[-1]) + np.repeat(np.arange(len(lengths)) * gap, grams)
    key = np.full(int(at[-1]) + len(lengths) * gap, _LAST, dtype=U64)
    key[places] = (h << U64(32)) | (_LOW - places.astype(U64))
    least, have = key.copy(), 1
    while have < window:
        step = min(have, window - have)
        least[: len(least) - step] = np.minimum(least[: len(least) - step], least[step:])
        have += step
    windows = np.maximum(grams - window + 1, (grams > 0).astype(grams.dtype))
    first = np.concatenate([[0], np.cumsum(windows)])
    starts = np.arange(first[-1]) - np.repeat(first[:-1], windows) + np.repeat(at[:-1] + np.arange(len(lengths)) * gap, windows)
    best = least[starts]
    new = np.ones(len(best), dtype=bool)
    new[1:] = best[1:] != best[:-1]
    best = best[new]
    place = (_LOW - (best & _LOW)).astype(np.int64)
    doc = np.searchsorted(at[:-1] + np.arange(len(lengths)) * gap, place, side="right") - 1
    return doc, (best >> U64(32)).astype(np.uint32), place - (at[:-1] + np.arange(len(lengths)) * gap)[doc]


def _by_document(doc: np.ndarray, values: np.ndarray, n: int) -> list[np.ndarray]:
    cuts = np.searchsorted(doc, np.arange(n + 1))
    return [values[cuts[i] : cuts[i + 1]] for i in range(n)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared over all distinct hashes; two empty fingerprints are alike."""
    a, b = np.unique(a), np.unique(b)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) or len(b) else 1.0


def digest(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def _finger(k: int, window: int):
    def finger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, data, off in common.pieces(batches, "_text"):
            doc, h, at = chosen(data, off, k, window)
            hashes, places = (_by_document(doc, v.astype(np.int64), piece.num_rows) for v in (h, at))
            yield pa.RecordBatch.from_arrays([piece.column("_id"), pa.array(hashes, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int64()))], names=["_id", "hashes", "positions"])

    return finger


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """One row per input row: doc_id, hashes, positions (of the chosen k-grams, in bytes of UTF-8).

    A null or empty text has none. Equal texts have equal fingerprints, whatever their ids; repeated rows give repeated
    results. An empty table gives an empty result; other columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return source.mapInArrow(_finger(k, window), "_id long, hashes array<long>, positions array<long>").withColumnRenamed("_id", id_col)


class _Compared:
    """Rows of one partition in their order: each is emitted once the text that follows it is known."""

    def __init__(self, k: int, window: int) -> None:
        self.k, self.window = k, window

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple[int | None, str] | None = None
        step: list[tuple[int | None, str, str]] = []
        size = 0
        ended = False
        for batch in batches:
            for doc_id, text, copy in zip(batch.column("_id"), batch.column("_text"), batch.column("_copy").to_pylist(), strict=True):
                if ended:
                    continue
                t = text.as_py()
                if waiting is not None:
                    step.append((*waiting, t))
                    size += len(waiting[1]) + len(t)
                # The head of the next partition is a copy that only ends this one.
                waiting, ended = (None, True) if copy else ((doc_id.as_py(), t), False)
                if size > common.STEP_BYTES:
                    yield self.compare(step)
                    step, size = [], 0
        if step:
            yield self.compare(step)

    def compare(self, rows: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
        texts, edited = [], []
        for _, text, after in rows:
            half = len(text) // 2
            texts.append(text)
            edited.append(text[: len(text) - half] + after[:half])
        after = [r[2] for r in rows]
        # The text after a row is mostly the next row's.
        every = list(dict.fromkeys([*texts, *edited, *after]))
        raw = [t.encode() for t in every]
        off = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
        doc, h, at = chosen(np.frombuffer(b"".join(raw), np.uint8), off, self.k, self.window)
        own = dict(zip(every, _by_document(doc, h, len(every)), strict=True))
        places = dict(zip(every, _by_document(doc, at.astype(np.int32), len(every)), strict=True))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array([digest(own[t]) for t in texts]),
                pa.array([digest(own[t]) for t in edited]),
                pa.array([likeness(own[t], own[e]) for t, e in zip(texts, edited, strict=True)], pa.float64()),
                pa.array([likeness(own[t], own[a]) for t, a in zip(texts, after, strict=True)], pa.float64()),
                pa.array([places[t] for t in texts], pa.list_(pa.int32())),
            ],
            names=["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "positions"],
        )


def _halved(bounds: Column):
    """A step of the search for the number of bounds (which fall) that are not below the id."""

    def step(x: Column, _: Column) -> Column:
        middle = ((x["lo"] + x["hi"]) / 2).cast("int")
        above = F.coalesce(F.get(bounds, middle) >= F.col("_id"), F.lit(False))
        return F.struct(F.when(above, middle + 1).otherwise(x["lo"]).alias("lo"), F.when(above, x["hi"]).otherwise(middle).alias("hi"))

    return step


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    positions (in bytes of UTF-8, of the chosen k-grams of the text, in the order of the fingerprint's hashes).

    The next document is the one with the next smaller id, and after the last the first. Rows with equal ids follow in the
    order of their texts; null ids come last. The edited text has its last floor(n / 2) code points replaced by the first
    as many of the next text. Null texts are empty; a single row is its own next. Texts move once, dealt out by ranges of
    ids; the head of each range is copied to the range before it.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    n = common.partitions(spark)
    # Ids that head the ranges: as many numbers as partitions, each an id of the table, the largest first.
    cuts = source.agg(F.max("_id").alias("top"), F.percentile_approx("_id", [i / n for i in range(1, n)] or [0.5], 10 * n).alias("cuts"), F.max(F.col("_id").isNull()).alias("nulls")).first()
    heads = sorted({cuts["top"], *(cuts["cuts"] or [])} - {None}, reverse=True)
    nulls = [len(heads)] if cuts["nulls"] else []
    last = max(0, len(heads) - 1 + len(nulls))
    # Range i has the ids from heads[i] down to above heads[i + 1]; null ids have a range of their own, after the others.
    # One constant of eight bytes for each partition, however many there are.
    bounds = F.from_json(F.lit(json.dumps(heads)), "array<bigint>")
    found = F.aggregate(F.sequence(F.lit(0), F.lit(len(heads).bit_length())), F.struct(F.lit(0).alias("lo"), F.lit(len(heads)).alias("hi")), _halved(bounds), lambda x: x["lo"] - 1)
    place = F.when(F.col("_id").isNull(), F.lit(len(heads))).otherwise(found)
    heading = F.col("_id").isNull() | F.get(bounds, F.col("_part")).eqNullSafe(F.col("_id"))
    before = F.when(F.col("_part") == 0, F.lit(last)).otherwise(F.col("_part") - 1)
    own = F.struct(F.col("_part").alias("p"), F.lit(False).alias("c"))
    places = F.when(heading, F.array(own, F.struct(before.cast("int").alias("p"), F.lit(True).alias("c")))).otherwise(F.array(own))
    dealt = source.withColumn("_part", place.cast("int")).withColumn("_to", F.explode(places)).select("_id", "_text", F.col("_to.p").alias("_part"), F.col("_to.c").alias("_copy"))
    ordered = dealt.repartitionById(last + 1, F.col("_part")).sortWithinPartitions(F.col("_copy"), F.col("_id").desc_nulls_last(), "_text")
    return ordered.mapInArrow(_Compared(k, window), "_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, positions array<int>").withColumnRenamed("_id", id_col)
