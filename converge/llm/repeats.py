"""The exchange under both kinds of substring deduplication.

Texts are dealt to homes by their ids, once and compressed. A home works out keys of its texts, and sends each distinct key
once, with the smallest id of its own documents that have it and, if wanted, with a range of bytes, to the part that the key
falls to. A part sees who else has a key and answers with a few bits per key or window, in the order in which the home sent them, so that answers are tiny. However often
a passage occurs, a part gets it once from each home, and no pairs are made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from converge.llm import common
from converge.llm.common import U64

#: Bits of a key that a part sorts by; the bits above choose the part.
LOW = 40
_MASK = U64((1 << LOW) - 1)
#: The least number of homes for each shuffle partition, so that they even out over tasks; and of shuffle partitions for each
#: part. A home sends a row to each part that one of its keys falls to.
HOMES_EACH, EACH_PART = 2, 2
#: Bytes of text in a home, and of texts whose keys fall to a part, on average: what a task holds at a time. More input makes
#: more homes and parts, not larger ones.
HOME_BYTES, PART_BYTES = 16 << 20, 64 << 20
#: Stands for a null id, which counts as larger than any other.
NO_ID = np.iinfo(np.int64).max
STEP = 8 << 20


def sizes(docs: DataFrame, text_col: str, home_bytes: int = HOME_BYTES, part_bytes: int = PART_BYTES) -> tuple[int, int]:
    """Numbers of homes and of parts, by the bytes of all texts."""
    partitions = common.partitions(docs.sparkSession)
    n = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(HOMES_EACH * partitions, -(-n // home_bytes)), max(1, partitions // EACH_PART, -(-n // part_bytes))


_HOMES = "home int, ids array<long>, lengths binary, blob binary"
_ENTRIES = "part int, home int, n long, keys binary, extra binary, least binary, flags binary, spans array<binary>"
_ANSWERS = "home int, round int, part int, bits binary"
_ENTRY_TYPES = {"part": pa.int32(), "home": pa.int32(), "n": pa.int64(), "keys": pa.binary(), "extra": pa.binary(), "least": pa.binary(), "flags": pa.binary(), "spans": pa.list_(pa.binary())}
_ANSWER_TYPES = {"home": pa.int32(), "round": pa.int32(), "part": pa.int32(), "bits": pa.binary()}


def pack(values: np.ndarray) -> bytes:
    """The bytes of all values, lowest bytes first and together, compressed: their size, then the rest."""
    flat = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()
    return len(flat).to_bytes(8, "little") + pa.compress(flat, codec="zstd", asbytes=True)


def unpack(data: bytes, dtype: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.zeros(0, dtype)
    flat = np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(flat.reshape(width, -1).T).reshape(-1).view(dtype)


@dataclass
class Texts:
    """The documents of one home: ids (NO_ID for null), one byte array and its offsets."""

    ids: np.ndarray
    data: np.ndarray
    off: np.ndarray

    @property
    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), np.diff(self.off))


def _dealer(homes: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, data, off in common.pieces(batches, "_text", STEP):
            ids, lengths = piece.column("_id"), np.diff(off)
            number = common.mix(ids.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64).view(U64) + U64(0x2545F4914F6CDD1D))
            home = (number % U64(homes)).astype(np.int64)
            order = np.argsort(home, kind="stable")
            cuts = np.flatnonzero(np.diff(home[order], prepend=-1))
            rows = {"home": [], "ids": [], "lengths": [], "blob": []}
            for at in np.split(order, cuts[1:]):
                rows["home"].append(int(home[at[0]]))
                rows["ids"].append(ids.take(pa.array(at)).to_pylist())
                rows["lengths"].append(lengths[at].astype(np.int64).tobytes())
                blob = b"".join(data[off[i] : off[i + 1]].tobytes() for i in at)
                rows["blob"].append(pa.Codec("zstd", 3).compress(blob, asbytes=True))
            yield pa.RecordBatch.from_arrays([pa.array(rows["home"], pa.int32()), pa.array(rows["ids"], pa.list_(pa.int64())), pa.array(rows["lengths"], pa.binary()), pa.array(rows["blob"], pa.binary())], names=list(rows))

    return deal


def _texts(table: pa.Table) -> Texts:
    ids, lengths, blobs = [], [], []
    for row in table.select(["ids", "lengths", "blob"]).to_pylist():
        own = np.frombuffer(row["lengths"], np.int64)
        ids += [NO_ID if i is None else i for i in row["ids"]]
        lengths.append(own)
        size = int(own.sum())
        blobs.append(pa.decompress(row["blob"], size, codec="zstd", asbytes=True) if size else b"")
    off = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype(np.int64)
    return Texts(np.array(ids, dtype=np.int64), np.frombuffer(b"".join(blobs), np.uint8), off)


def each(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of so many: the group of each member, and its place in the group."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


@dataclass
class Spans:
    """Ranges of bytes that are sent themselves: data[begin:end], with `count` windows in it, the first at place `first`."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    count: np.ndarray

    def take(self, at: np.ndarray | slice) -> Spans:
        return Spans(self.data, self.begin[at], self.end[at], self.first[at], self.count[at])

    def gathered(self) -> Spans:
        """The same ranges, one after the other in an array of their own."""
        lengths = self.end - self.begin
        owner, place = each(lengths)
        end = np.cumsum(lengths)
        return Spans(self.data[self.begin[owner] + place], end - lengths, end, self.first, self.count)

    def packed(self) -> list[bytes]:
        own = self.gathered()
        return [*(pack(v.astype(np.uint32)) for v in (own.end - own.begin, own.first, own.count)), pack(own.data)]

    @staticmethod
    def unpacked(rows: list[list[bytes]]) -> Spans:
        lengths, first, count = (np.concatenate([unpack(r[k], np.uint32) for r in rows]).astype(np.int64) for k in range(3))
        end = np.cumsum(lengths)
        return Spans(np.concatenate([unpack(r[3], np.uint8) for r in rows]), end - lengths, end, first, count)


class Sent:
    """The distinct keys of a home in the order in which they are sent: by part, key and extra.

    back: for each given key, its place among the distinct ones. Where there are spans, they are sent and extra, which only
    tells them apart, is not.
    """

    def __init__(self, keys: np.ndarray, docs: np.ndarray, parts: int, extra: np.ndarray | None = None, marks: np.ndarray | None = None, spans: Spans | None = None) -> None:
        comp = (((keys >> U64(LOW)) % U64(parts)) << U64(LOW)) | (keys & _MASK)
        order = np.argsort(comp, kind="stable") if extra is None else np.lexsort((extra, comp))
        sorted_comp, sorted_docs = comp[order], docs[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = sorted_comp[1:] != sorted_comp[:-1]
        if extra is not None:
            new[1:] |= extra[order][1:] != extra[order][:-1]
        at = np.flatnonzero(new)
        self.back = np.empty(len(order), dtype=np.int64)
        self.back[order] = np.cumsum(new) - 1
        self.comp, self.parts = sorted_comp[at], parts
        self.extra = None if extra is None else extra[order][at]
        self.least = np.minimum.reduceat(sorted_docs, at) if len(at) else sorted_docs
        most = np.maximum.reduceat(sorted_docs, at) if len(at) else sorted_docs
        self.spans = None if spans is None else spans.take(order[at])
        #: Bit 0: several documents of the home have the key. Bit 1: one of its occurrences is marked. From bit 2 on: the
        #: logarithm of the number of its occurrences, rounded down.
        self.flags = (most != self.least).astype(np.uint8)
        if len(at):
            self.flags |= np.log2(np.diff(np.append(at, len(order)))).astype(np.uint8) << np.uint8(2)
        if marks is not None and len(at):
            self.flags |= np.maximum.reduceat(marks[order].astype(np.uint8), at) << np.uint8(1)

    def rows(self, home: int, with_least: bool) -> pa.Table:
        cuts = np.searchsorted(self.comp, np.arange(self.parts + 1, dtype=U64) << U64(LOW))
        out: dict[str, list] = {c: [] for c in _ENTRY_TYPES}
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            span = slice(cuts[part], cuts[part + 1])
            out["part"].append(part)
            out["home"].append(home)
            out["n"].append(int(cuts[part + 1] - cuts[part]))
            out["keys"].append(pack(np.diff(self.comp[span] & _MASK, prepend=U64(0))))
            out["extra"].append(None if self.extra is None or self.spans is not None else pack(self.extra[span]))
            out["spans"].append(None if self.spans is None else self.spans.take(span).packed())
            out["least"].append(pack(self.least[span]) if with_least else None)
            out["flags"].append(pack(self.flags[span]))
        return pa.table({c: pa.array(v, _ENTRY_TYPES[c]) for c, v in out.items()})


@dataclass
class Seen:
    """All that homes sent to a part: keys, extras, least ids, flags, spans, and the groups of equal keys (or keys and extras)."""

    low: np.ndarray
    extra: np.ndarray | None
    least: np.ndarray | None
    flags: np.ndarray
    spans: Spans | None = None

    def grouped(self, with_extra: bool) -> tuple[np.ndarray, np.ndarray]:
        """Order that brings equal ones together, and the starts of groups in it."""
        order = np.lexsort((self.extra, self.low)) if with_extra else np.argsort(self.low, kind="stable")
        new = np.ones(len(order), dtype=bool)
        new[1:] = self.low[order][1:] != self.low[order][:-1]
        if with_extra:
            new[1:] |= self.extra[order][1:] != self.extra[order][:-1]
        return order, np.flatnonzero(new)


def spread(values: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A value for each group to a value for each entry, in the entries' own order."""
    out = np.empty(len(order), dtype=values.dtype)
    out[order] = np.repeat(values, np.diff(np.append(starts, len(order))))
    return out


def shared(seen: Seen) -> np.ndarray:
    """1 for a key that several documents have, and, if any key is marked, one of whose occurrences is."""
    order, starts = seen.grouped(False)
    flags = seen.flags[order]
    many = (np.diff(np.append(starts, len(order))) > 1) | (np.bitwise_or.reduceat(flags, starts) & 1 > 0)
    return spread(many.astype(np.uint8), order, starts)


def shared_and_hot(hot: int) -> Callable[[Seen], np.ndarray]:
    """Bit 0 as of shared(). Bit 1: the key occurs about `hot` times or more, between half as often and exactly as often."""

    def judge(seen: Seen) -> np.ndarray:
        order, starts = seen.grouped(False)
        times = np.add.reduceat(np.int64(1) << (seen.flags[order] >> 2).astype(np.int64), starts)
        return shared(seen) | (spread((times >= hot).astype(np.uint8), order, starts) << np.uint8(1))

    return judge


def shared_and_marked(seen: Seen) -> np.ndarray:
    order, starts = seen.grouped(False)
    marked = ((np.bitwise_or.reduceat(seen.flags[order], starts) >> 1) & 1).astype(np.uint8)
    return shared(seen) & spread(marked, order, starts)


def earlier(seen: Seen) -> np.ndarray:
    """Bit 0: a document of another home with a smaller id has the same key and extra. Bit 1: the key has several extras."""
    order, starts = seen.grouped(True)
    least = np.minimum.reduceat(seen.least[order], starts)
    bits = (spread(least, order, starts) < seen.least).astype(np.uint8)
    by_key, key_starts = seen.grouped(False)
    kinds = np.zeros(len(order), dtype=np.int64)
    kinds[order[starts]] = 1
    several = np.add.reduceat(kinds[by_key], key_starts) > 1
    return bits | (spread(several.astype(np.uint8), by_key, key_starts) << np.uint8(1))


def _answerer(round_: int, judge: Callable[[Seen], np.ndarray]):
    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        low = np.concatenate([np.cumsum(unpack(r["keys"], U64), dtype=U64) for r in rows])
        extra = None if rows[0]["extra"] is None else np.concatenate([unpack(r["extra"], U64) for r in rows])
        least = None if rows[0]["least"] is None else np.concatenate([unpack(r["least"], np.int64) for r in rows])
        spans = None if rows[0]["spans"] is None else Spans.unpacked([r["spans"] for r in rows])
        bits = judge(Seen(low, extra, least, np.concatenate([unpack(r["flags"], np.uint8) for r in rows]), spans))
        cuts = np.cumsum([0] + [r["n"] for r in rows])
        if spans is not None:
            # An answer for each window.
            cuts = np.append(0, np.cumsum(spans.count))[cuts]
        return pa.table({"home": pa.array([r["home"] for r in rows], pa.int32()), "round": pa.array([round_] * len(rows), pa.int32()), "part": pa.array([r["part"] for r in rows], pa.int32()), "bits": pa.array([pack(bits[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})

    return answer


def _answers(table: pa.Table) -> dict[int, np.ndarray]:
    """Bits of each round, in the order in which its keys were sent."""
    found: dict[int, list[tuple[int, bytes]]] = {}
    for r in table.to_pylist():
        found.setdefault(r["round"], []).append((r["part"], r["bits"]))
    return {k: np.concatenate([unpack(b, np.uint8) for _, b in sorted(v)]) for k, v in found.items()}


#: Given texts, the parts and the answers so far, the keys to send next.
Sender = Callable[[Texts, int, dict[int, np.ndarray]], Sent]


def _first(sender: Sender, parts: int, with_least: bool):
    def send(table: pa.Table) -> pa.Table:
        return sender(_texts(table), parts, {}).rows(table["home"][0].as_py(), with_least)

    return send


def _later(sender: Sender, parts: int, with_least: bool):
    def send(table: pa.Table, said: pa.Table) -> pa.Table:
        return sender(_texts(table), parts, _answers(said)).rows(table["home"][0].as_py(), with_least)

    return send


def run(docs: DataFrame, rounds: list[tuple[Sender, bool, Callable[[Seen], np.ndarray]]], finish: Callable[[Texts, int, dict[int, np.ndarray]], pa.Table], schema: str, id_col: str, text_col: str, home_bytes: int = HOME_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """rounds: what a home sends (with least ids or not) and how a part judges it. finish makes a home's result.

    One plan holds all rounds, so that the exchange of the texts is made once and reused.
    """
    partitions = common.partitions(docs.sparkSession)
    n_homes, n = sizes(docs, text_col, home_bytes, part_bytes)
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    homes = source.mapInArrow(_dealer(n_homes), _HOMES).repartition(partitions, "home")
    answers: DataFrame | None = None
    for k, (sender, with_least, judge) in enumerate(rounds):
        if answers is None:
            entries = homes.groupBy("home").applyInArrow(_first(sender, n, with_least), _ENTRIES)
        else:
            entries = homes.groupBy("home").cogroup(answers.groupBy("home")).applyInArrow(_later(sender, n, with_least), _ENTRIES)
        # Dealt to homes here, so that later rounds reuse the exchange and no part answers twice.
        said = entries.groupBy("part").applyInArrow(_answerer(k, judge), _ANSWERS).repartition(partitions, "home")
        answers = said if answers is None else answers.union(said)

    def last(table: pa.Table, said: pa.Table) -> pa.Table:
        return finish(_texts(table), n, _answers(said))

    return homes.groupBy("home").cogroup(answers.groupBy("home")).applyInArrow(last, schema)


def steps(off: np.ndarray, size: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about so many bytes."""
    i = 0
    while i < len(off) - 1:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
        yield i, j
        i = j


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """True for each of n places within one of the ranges."""
    depth = np.zeros(n + 1, dtype=np.int32)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1], dtype=np.int32) > 0


def ids_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)
