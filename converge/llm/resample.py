"""Importance resampling towards a target distribution of hashed words and pairs of words.

Identical texts are one: they are grouped by their full text, and features, counts and weight are made once for each and
weigh as often as the text occurs. A document's weight is the mean gain of its features, the logarithm of how much more
frequent a bucket is in the target than in all documents. Weights go back to the documents by a digest of the text. Noise of
each document's own (a Gumbel variable from its id) makes the highest scores a sample without replacement.

Ranks come from a histogram of scores, which are whole numbers, and the order within a score. The noise has a density of at
most 1/e, so of any weight, and of any mixture of weights, no score holds more than a share of about 1/2,700.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from converge.llm import common

BUCKETS = 10_000
#: Documents with fewer words are not drawn; of the others so many in a hundred are.
LEAST_WORDS, PERCENT = 20, 25
SEED = 7
#: Bytes of a word up to which its checksum is made beside those of others; those of longer words are made one by one.
SHORT = 48

_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _crc_table() -> np.ndarray:
    """The remainders of all bytes, as the standard 32-bit checksum has them."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def _extended(crc: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Checksums (as after an inversion) of what they stand for followed by the bytes of each range."""
    crc, sizes = crc.copy(), ends - starts
    for k in np.flatnonzero(sizes > SHORT).tolist():
        crc[k] = ~np.uint32(zlib.crc32(data[starts[k] : ends[k]], int(~crc[k])))
    left = np.flatnonzero(sizes <= SHORT)
    for at in range(int(sizes[left].max(initial=0))):
        left = left[sizes[left] > at]
        c = crc[left]
        crc[left] = _CRC[(c ^ data[starts[left] + at]) & np.uint32(255)] ^ (c >> np.uint32(8))
    return crc


def spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of ASCII digits, small letters and all that is not ASCII, and each text's first word."""
    word = _WORD[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    before[off[:-1][off[:-1] < len(data)]] = False
    after[off[1:][off[1:] > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    return starts, np.flatnonzero(word & ~after) + 1, np.searchsorted(starts, off)


def feature_buckets(data: np.ndarray, off: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of all features of texts in small letters, the text of each, and the number of words of each text."""
    starts, ends, first = spans(data, off)
    of = np.repeat(np.arange(len(off) - 1), np.diff(first))
    one = _extended(np.full(len(starts), 0xFFFFFFFF, np.uint32), data, starts, ends)
    follows = np.flatnonzero(of[1:] == of[:-1]) if len(of) else np.zeros(0, np.int64)
    c = one[follows]
    spaced = _CRC[(c ^ np.uint32(32)) & np.uint32(255)] ^ (c >> np.uint32(8))
    two = _extended(spaced, data, starts[follows + 1], ends[follows + 1])
    return np.concatenate([~one, ~two]) % np.uint32(buckets), np.concatenate([of, of[follows]]), np.diff(first)


def _featured(buckets: int):
    def feature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in common.pieces(batches, "_text"):
            found, of, words = feature_buckets(common.lower_ascii(data), off, buckets)
            key, times = np.unique(of * buckets + found.astype(np.int64), return_counts=True)
            cuts = np.searchsorted(key, np.arange(1, len(words)) * buckets)
            packed = [zlib.compress(np.concatenate([np.diff(k % buckets, prepend=0), n]).astype("<u4").tobytes(), 1) for k, n in zip(np.split(key, cuts), np.split(times, cuts), strict=True)]
            n = np.bincount(of, minlength=len(words))
            yield pa.RecordBatch.from_arrays([batch.column("_sha"), batch.column("_copies"), pa.array(words, pa.int64()), pa.array(n, pa.int64()), pa.array(packed, pa.binary())], names=["_sha", "_copies", "n_words", "n_features", "_packed"])

    return feature


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(blob), "<u4").astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


#: Buckets of a row of sums: every task tells all its buckets in as many rows as it takes, zeros too.
ROW = 100


def _tallied(buckets: int):
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for copies, blob in zip(batch.column("_copies").to_pylist(), batch.column("_packed").to_pylist(), strict=True):
                at, n = _unpacked(blob)
                total[at] += n * copies
        rows = np.concatenate([total, np.zeros(-buckets % ROW, np.int64)]).reshape(-1, ROW)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows.tolist(), pa.list_(pa.int64()))], names=["row", "n"])

    return tally


def _weighed(gains: list[int]):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.array(gains, np.int64)
        for batch in batches:
            weights = []
            for n, blob in zip(batch.column("n_features").to_pylist(), batch.column("_packed").to_pylist(), strict=True):
                at, times = _unpacked(blob)
                weights.append(int((gain[at] * times).sum()) // n if n else 0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_sha", "_copies", "n_words", "n_features")), pa.array(weights, pa.int64())], names=["_sha", "_copies", "n_words", "n_features", "weight"])

    return weigh


def text_features(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """A row per different text: _sha, _copies, n_words, n_features and its buckets with their counts; null counts as empty."""
    same = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text")).groupBy("_text").agg(F.count("*").alias("_copies"))
    return same.select(_digest(F.col("_text")).alias("_sha"), "_copies", "_text").mapInArrow(_featured(buckets), "_sha binary, _copies long, n_words long, n_features long, _packed binary")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> dict[int, int]:
    """How many features, copies included, each bucket holds: no more rows than there are buckets."""
    each = features.select("_copies", "_packed").mapInArrow(_tallied(buckets), "row int, n array<long>")
    rows = each.groupBy("row").agg(F.array(*[F.sum(F.get("n", F.lit(k))) for k in range(ROW)]).alias("n")).collect()
    return {r.row * ROW + k: n for r in rows for k, n in enumerate(r.n) if n}


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """floor(1000 ln) of how much more frequent each bucket is in the target, counts raised by one."""
    s_all, t_all = sum(source.values()), sum(target.values())
    return [math.floor(1000 * math.log((target.get(b, 0) + 1) * (s_all + buckets) / ((source.get(b, 0) + 1) * (t_all + buckets)))) for b in range(buckets)]


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel variable in thousandths, from a hash of the seed and the id; a null id is the text null."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weights(docs: DataFrame, target: DataFrame, text_col: str = "text", target_text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """A row per different text: _sha, _copies, n_words, n_features and weight."""
    features = common.written(text_features(docs, text_col, buckets))
    gains = bucket_gains(bucket_counts(features, buckets), bucket_counts(text_features(target, target_text, buckets), buckets), buckets)
    return features.mapInArrow(_weighed(gains), "_sha binary, _copies long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """One row per input row: id, n_features, weight, score, rank (1, 2, ... of those drawn, else null).

    Of the rows with at least least_words words, `percent` in a hundred (rounded down) with the highest scores are drawn, of
    equal scores the smaller ids, null ids last. Null and empty texts have no features and weight 0. Repeated rows are rows of
    their own, with ranks of their own. A target without features, or an empty table, is counted as none. Other columns are ignored.
    """
    table = common.written(weights(docs, target, text_col, target_text, buckets))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), _digest(F.col(text_col)).alias("_sha"))
    joined = common.spread_join(rows, table, "_sha", "_copies")
    scored = common.written(joined.select("_id", "n_features", "weight", (F.col("weight") + noise(F.col("_id"), seed)).alias("score"), (F.col("n_words") >= least_words).alias("_able")))
    # Scores are whole numbers between bounds that follow from the logarithms, some 100,000 at most.
    histogram = scored.where("_able").groupBy("score").agg(F.count("*").alias("_n"))
    above = F.coalesce(F.sum("_n").over(Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = common.checkpoint(histogram.select(F.col("score").alias("_score"), above.alias("_above"), "_n"))
    wanted = (places.agg(F.sum("_n")).first()[0] or 0) * percent // 100
    found = scored.join(F.broadcast(places.where(F.col("_above") < wanted)), F.col("_able") & (F.col("score") == F.col("_score")), "left")
    order = Window.partitionBy("score").orderBy(F.col("_id").asc_nulls_last())
    drawn = found.where("_above is not null").withColumn("rank", F.col("_above") + F.row_number().over(order))
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    columns = [F.col("_id").alias(id_col), "n_features", "weight", "score", "rank"]
    return found.where("_above is null").withColumn("rank", F.lit(None).cast("long")).select(*columns).unionByName(drawn.select(*columns))
