"""Substring deduplication by fixed blocks as anchors.

The index holds the non-overlapping blocks of BLOCK words of every document; every rolling window of as many words probes
it. A repeated window of 2 * BLOCK - 1 words holds exactly one whole block of the earlier document, so it has a hit at that
place. Hits are extended to all windows around them, those that an earlier document has are kept, and overlapping ones
join to maximal exact repeats.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from converge.llm import common, repeats
from converge.llm.common import U64
from converge.llm.repeats import Sent, Texts

WINDOW = 13


class _Words:
    """Words of a home's texts: spans, hashes, and for each document the index of its first word."""

    def __init__(self, texts: Texts) -> None:
        starts, ends, hashes, first = [], [], [], [np.zeros(1, np.int64)]
        n = 0
        for i, j in repeats.steps(texts.off):
            base = texts.off[i]
            data = texts.data[base : texts.off[j]]
            s, e, f = common.word_spans(data, texts.off[i : j + 1] - base)
            starts.append(s + base)
            ends.append(e + base)
            hashes.append(common.word_hashes(data, s, e))
            first.append(f[1:] + n)
            n += len(s)
        none = np.zeros(0, np.int64)
        self.start, self.end = (np.concatenate(x) if x else none for x in (starts, ends))
        self.hash = np.concatenate(hashes) if hashes else none.view(U64)
        self.first = np.concatenate(first)
        self.doc = np.repeat(np.arange(len(texts.ids)), np.diff(self.first))
        self.id = texts.ids[self.doc]

    def grams(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all runs of width words within a document, and their hashes."""
        at = np.flatnonzero(np.arange(len(self.doc)) + width <= self.first[self.doc + 1])
        return at, common.range_hashes(self.hash, at, at + width)


class _Rounds:
    def __init__(self, window: int) -> None:
        self.window, self.block = window, (window + 1) // 2

    def _probes(self, texts: Texts, parts: int) -> tuple[_Words, np.ndarray, Sent]:
        words = _Words(texts)
        at, keys = words.grams(self.block)
        indexed = (at - words.first[words.doc[at]]) % self.block == 0
        return words, at, Sent(keys, words.id[at], parts, marks=indexed)

    def probes(self, texts: Texts, parts: int, said: dict[int, np.ndarray]) -> Sent:
        return self._probes(texts, parts)[2]

    def _windows(self, texts: Texts, parts: int, said: dict[int, np.ndarray]) -> tuple[_Words, np.ndarray, Sent]:
        words, at, sent = self._probes(texts, parts)
        hits = np.zeros(len(words.doc) + 1, dtype=np.int64)
        if len(at):
            hits[at + 1] = said[0][sent.back] & 1
        hits = np.cumsum(hits)
        starts = np.flatnonzero(np.arange(len(words.doc)) + self.window <= words.first[words.doc + 1])
        # A hit anywhere among the blocks that the window holds.
        starts = starts[hits[starts + self.window - self.block + 1] > hits[starts]]
        keys = common.range_hashes(words.hash, starts, starts + self.window)
        return words, starts, Sent(keys, words.id[starts], parts, extra=keys >> U64(repeats.LOW))

    def windows(self, texts: Texts, parts: int, said: dict[int, np.ndarray]) -> Sent:
        return self._windows(texts, parts, said)[2]

    def finish(self, texts: Texts, parts: int, said: dict[int, np.ndarray]) -> pa.Table:
        words, starts, sent = self._windows(texts, parts, said)
        later = starts[:0]
        if len(starts):
            later = starts[((said[1][sent.back] & 1) > 0) | (words.id[starts] > sent.least[sent.back])]
        gone = repeats.covered(later, later + self.window, len(words.doc))
        raw = texts.data.tobytes()
        removed, kept, spans = [], [], []
        for a, b in zip(words.first[:-1], words.first[1:], strict=True):
            mine = gone[a:b]
            removed.append(int(mine.sum()))
            kept.append(b" ".join(raw[s:e] for s, e in zip(words.start[a:b][~mine].tolist(), words.end[a:b][~mine].tolist(), strict=True)))
            edges = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
            spans.append([{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)])
        return pa.table({"_id": repeats.ids_array(texts.ids), "n_words": pa.array(np.diff(words.first), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept])})


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, home_bytes: int = repeats.HOME_BYTES, part_bytes: int = repeats.PART_BYTES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, spans (first word, word after the last), kept_sha256.

    A span is a maximal run of words that lie in windows of `window` (odd) words which also start in a document with a
    smaller id. Windows are compared by 64 bits of a hash. A null text has no words. A null id is larger than any other;
    documents with equal ids are not earlier than each other. An empty table gives an empty result; other columns are
    ignored. home_bytes and part_bytes bound what a task holds at a time, but for a single longer text.
    """
    r = _Rounds(window)
    found = repeats.run(docs, [(r.probes, False, repeats.shared_and_marked), (r.windows, True, repeats.earlier)], r.finish, "_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string", id_col, text_col, home_bytes, part_bytes)
    return found.withColumnRenamed("_id", id_col)
