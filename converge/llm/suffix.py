"""Suffix deduplication by a depth-limited radix sort of suffixes, most significant digits first.

Suffixes are ordered by their bytes, through their first THRESHOLD bytes only; those that are equal so far are exactly the
repeated windows. Not all suffixes can be sent, so what cannot be equal is dropped first:

1. Of all windows only the least gram of GRAM bytes of each (the rightmost of equal ones) is looked at; equal windows have the
   same gram at the same place. Grams that only one document has end here, with their windows.
2. What remains meets by its gram: all that windows around the gram can hold is sent, as bytes, once from each home. There the
   suffixes that start at windows are sorted: a pass takes the next digit of eight bytes of all suffixes that are not alone yet,
   and splits their groups by it. Grams with the same bytes around them everywhere need no pass. Of a gram that occurs HOT times
   or more, windows are sent one by one and meet by the hash of all their bytes, so that no part gets all of them.

Hashes only say where suffixes meet; two are equal only if their bytes are. Within a home, ranges of bytes are told apart by a
hash and what their key adds to it, about 100 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from converge.llm import common, repeats
from converge.llm.common import U64
from converge.llm.repeats import Seen, Sent, Spans, Texts

THRESHOLD, GRAM = 50, 18
#: Occurrences from which on a gram's windows meet one by one; windows that are sorted at a time, but for those of one key.
HOT, SORTED = 1 << 16, 1 << 20
_DIGIT = 8
_LAST = np.iinfo(np.uint64).max
_LOW = U64(0xFFFFFFFF)


class _Grams:
    """The chosen grams of a home's texts: place, hash, and the windows (first and after the last start) of each."""

    def __init__(self, texts: Texts, threshold: int, gram: int) -> None:
        self.texts, self.threshold, self.gram = texts, threshold, gram
        places, keys, begins, ends = [], [], [], []
        reach = threshold - gram + 1
        for i, j in repeats.steps(texts.off):
            base = int(texts.off[i])
            data, off = texts.data[base : texts.off[j]], texts.off[i : j + 1] - base
            if len(data) < threshold:
                continue
            n = len(data) - gram + 1
            at = np.arange(n)
            h = common.range_hashes(common.byte_values(data), at, at + gram)
            least = np.full(len(data), _LAST, dtype=U64)
            least[:n] = (h & ~_LOW) | (_LOW - at.astype(U64))
            have = 1
            while have < reach:
                step = min(have, reach - have)
                least[: len(data) - step] = np.minimum(least[: len(data) - step], least[step:])
                have += step
            fits = np.arange(len(data)) + threshold <= np.repeat(off[1:], np.diff(off))
            starts = np.flatnonzero(fits)
            if not len(starts):
                continue
            place = (_LOW - (least[starts] & _LOW)).astype(np.int64)
            new = np.ones(len(place), dtype=bool)
            new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
            first = np.flatnonzero(new)
            places.append(place[first] + base)
            keys.append(h[place[first]])
            begins.append(starts[first] + base)
            ends.append(starts[np.append(first[1:], len(starts)) - 1] + 1 + base)
        none = np.zeros(0, np.int64)
        self.place, self.begin, self.end = (np.concatenate(x) if x else none for x in (places, begins, ends))
        self.key = np.concatenate(keys) if keys else none.view(U64)
        self.doc = np.searchsorted(texts.off, self.place, side="right") - 1
        self.id = texts.ids[self.doc]

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each range of bytes; ranges come in the order of their documents."""
        out, off = np.empty(len(begin), dtype=U64), self.texts.off
        cuts = [(i, j) for i, j in repeats.steps(off)]
        for i, j in cuts:
            a, b = np.searchsorted(begin, [off[i], off[j]])
            if b > a:
                out[a:b] = common.range_hashes(common.byte_values(self.texts.data[off[i] : off[j]]), begin[a:b] - off[i], end[a:b] - off[i])
        return out

    def around(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All that windows of each gram can hold: begin and end."""
        off = self.texts.off
        begin = np.maximum(off[self.doc[at]], self.place[at] - (self.threshold - self.gram))
        return begin, np.minimum(off[self.doc[at] + 1], self.place[at] + self.threshold)


def least_of_equal(data: np.ndarray, starts: np.ndarray, values: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix of data that begins at one of the starts, the least value of those equal to it through depth bytes.

    A radix sort from the most significant digit on; a suffix that is alone in its group leaves it.
    """
    out = values.copy()
    digits = np.ndarray(len(data) + 1, ">u8", np.append(data, np.zeros(_DIGIT, np.uint8)), strides=(1,))
    here, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for done in range(0, depth, _DIGIT):
        if not len(here):
            break
        digit = digits[starts[here] + done].astype(U64) >> U64(8 * max(0, done + _DIGIT - depth))
        by_digit = np.argsort(digit)
        rank = np.empty(len(here), np.int64)
        rank[by_digit] = np.cumsum(np.diff(digit[by_digit], prepend=digit[by_digit[:1]]) != 0)
        both = group * (rank[by_digit[-1]] + 1) + rank
        order = np.argsort(both)
        first = np.flatnonzero(np.diff(both[order], prepend=-1))
        sizes = np.diff(np.append(first, len(order)))
        stay = np.repeat(sizes > 1, sizes)
        here = here[order][stay]
        group = np.repeat(np.arange(np.count_nonzero(sizes > 1)), sizes[sizes > 1])
    if len(here):
        first = np.flatnonzero(np.diff(group, prepend=-1))
        out[here] = np.repeat(np.minimum.reduceat(values[here], first), np.diff(np.append(first, len(here))))
    return out


def _same(spans: Spans) -> np.ndarray:
    """For each of gathered spans, one with the same bytes and windows, the same for all of them."""
    n = spans.end - spans.begin
    keys = common.mix(common.range_hashes(common.byte_values(spans.data), spans.begin, spans.end) + spans.first.astype(U64))
    _, one, kind = np.unique(keys, return_index=True, return_inverse=True)
    other = one[kind]
    alike = (n == n[other]) & (spans.first == spans.first[other]) & (spans.count == spans.count[other])
    other = np.where(alike, other, np.arange(len(n)))
    owner, place = repeats.each(n)
    equal = np.logical_and.reduceat(spans.data == spans.data[spans.begin[other][owner] + place], spans.begin)
    return np.where(equal, other, np.arange(len(n)))


def _settled(spans: Spans, key: np.ndarray, least: np.ndarray, threshold: int) -> np.ndarray:
    """1 for each window of the spans (ordered by key) that a document with an id below its span's own least has."""
    spans = spans.gathered()
    other = _same(spans)
    lowest = np.full(len(other), repeats.NO_ID)
    np.minimum.at(lowest, other, least)
    alone = other == np.arange(len(other))
    kinds = np.add.reduceat(alone.astype(np.int64), np.flatnonzero(np.diff(key, prepend=~key[:1])))
    group = np.cumsum(np.diff(key, prepend=key[:1]) != 0)
    # Windows of the spans that stand for others, those of keys with several spans in order.
    count = np.where(alone, spans.count, 0)
    owner, place = repeats.each(count)
    found = lowest[owner]
    sort = (kinds[group] > 1)[owner]
    found[sort] = least_of_equal(spans.data, (spans.begin[owner] + spans.first[owner] + place)[sort], found[sort], threshold)
    entry, window = repeats.each(spans.count)
    return (found[(np.cumsum(count) - count)[other][entry] + window] < least[entry]).astype(np.uint8)


def earlier_windows(threshold: int, at_a_time: int = SORTED):
    """What a part answers: 1 for each window of each span that it was sent, if a smaller id than the span's own has it."""

    def judge(seen: Seen) -> np.ndarray:
        spans, order = seen.spans, np.argsort(seen.low, kind="stable")
        ends = np.cumsum(spans.count)
        bits = np.zeros(ends[-1], np.uint8)
        keys = np.append(np.flatnonzero(np.diff(seen.low[order], prepend=~seen.low[order[:1]])), len(order))
        windows = np.append(0, np.cumsum(spans.count[order]))[keys]
        k = 0
        while k < len(keys) - 1:
            to = max(k + 1, int(np.searchsorted(windows, windows[k] + at_a_time, side="right")) - 1)
            here = order[keys[k] : keys[to]]
            owner, place = repeats.each(spans.count[here])
            bits[(ends - spans.count)[here][owner] + place] = _settled(spans.take(here), seen.low[here], seen.least[here], threshold)
            k = to
        return bits

    return judge


class _Passes:
    """What a home sends in each pass, and its result."""

    def __init__(self, threshold: int, gram: int) -> None:
        self.threshold, self.gram = threshold, gram

    def first(self, texts: Texts, parts: int, said: dict[int, np.ndarray]) -> Sent:
        grams = _Grams(texts, self.threshold, self.gram)
        return Sent(grams.key, grams.id, parts)

    def _second(self, texts: Texts, parts: int, said: dict[int, np.ndarray]) -> tuple[Spans, np.ndarray, Sent]:
        """The spans with windows that may recur, the ids of their documents, and what is sent of them."""
        grams = _Grams(texts, self.threshold, self.gram)
        back = Sent(grams.key, grams.id, parts).back
        bits = said[0][back] if len(back) else np.zeros(0, np.uint8)
        warm, hot = np.flatnonzero(bits == 1), np.flatnonzero(bits == 3)
        begin, end = grams.around(warm)
        owner, place = repeats.each(grams.end[hot] - grams.begin[hot])
        starts = grams.begin[hot][owner] + place
        first = grams.begin[warm] - begin
        around = common.mix(grams.hashes(begin, end) + first.astype(U64) * U64(0x9E3779B97F4A7C15))
        alone = grams.hashes(starts, starts + self.threshold)
        spans = Spans(
            texts.data,
            np.append(begin, starts),
            np.append(end, starts + self.threshold),
            np.append(first, np.zeros(len(starts), np.int64)),
            np.append(grams.end[warm] - grams.begin[warm], np.ones(len(starts), np.int64)),
        )
        ids = np.append(grams.id[warm], grams.id[hot][owner])
        sent = Sent(np.append(grams.key[warm], alone), ids, parts, extra=np.append(around, alone >> U64(repeats.LOW)), spans=spans)
        return spans, ids, sent

    def second(self, texts: Texts, parts: int, said: dict[int, np.ndarray]) -> Sent:
        return self._second(texts, parts, said)[2]

    def _repeated(self, texts: Texts, parts: int, said: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of bytes that are removed."""
        spans, ids, sent = self._second(texts, parts, said)
        if not len(ids):
            return spans.begin, spans.end
        later = ids > sent.least[sent.back]
        windows = spans.begin + spans.first
        at = np.cumsum(sent.spans.count) - sent.spans.count
        rest = np.flatnonzero(~later & (np.add.reduceat(said[1], at, dtype=np.int64) > 0)[sent.back])
        owner, place = repeats.each(spans.count[rest])
        hit = said[1][at[sent.back[rest]][owner] + place] > 0
        starts = (windows[rest][owner] + place)[hit]
        return np.append(windows[later], starts), np.append((windows + spans.count - 1)[later], starts) + self.threshold

    def finish(self, texts: Texts, parts: int, said: dict[int, np.ndarray]) -> pa.Table:
        gone = repeats.covered(*self._repeated(texts, parts, said), len(texts.data))
        spans: list[list[dict]] = []
        removed, kept = [], []
        for a, b in zip(texts.off[:-1], texts.off[1:], strict=True):
            mine = gone[a:b]
            edges = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
            spans.append([{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)])
            removed.append(int(mine.sum()))
            kept.append(texts.data[a:b][~mine].tobytes())
        return pa.table({"_id": repeats.ids_array(texts.ids), "n_bytes": pa.array(np.diff(texts.off), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept])})


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: int = THRESHOLD,
    gram: int = GRAM,
    home_bytes: int = repeats.HOME_BYTES,
    part_bytes: int = repeats.PART_BYTES,
    hot: int = HOT,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, spans (start, end in bytes), kept_sha256.

    A span is a maximal run of bytes that lie in windows of `threshold` bytes which also start in a document with a smaller
    id. Windows are compared by their bytes. A null text is empty. A null id is larger than any other; documents with
    equal ids are not earlier than each other. An empty table gives an empty result; other columns are ignored. home_bytes and
    part_bytes bound what a task holds at a time, but for a single longer text; hot bounds what meets by one gram.
    """
    p = _Passes(threshold, gram)
    rounds = [(p.first, False, repeats.shared_and_hot(hot)), (p.second, True, earlier_windows(threshold))]
    schema = "_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string"
    return repeats.run(docs, rounds, p.finish, schema, id_col, text_col, home_bytes, part_bytes).withColumnRenamed("_id", id_col)
