"""Language identification by unigram pieces, with the segmentation summed out.

The pieces are all of a fixed public vocabulary that are made of letters, whatever their length, and every single byte.
Each language has its own probability of each piece, learned by expectation maximisation over the words of labelled
documents. A word's probability in a language is the sum over all its segmentations into pieces, by the forward algorithm;
a text's is the product over its words. Words are the runs of ASCII letters, lower-cased, and of bytes outside ASCII, with a
mark in front. They are scored whole: sums are scaled on the way, so a word of any length stays within range.

A long word, as a text without spaces is, falls apart where no piece of the vocabulary holds both neighbouring characters: no
segmentation has a piece across, so the sum over all is the product of the parts' sums. What stays long, or alone in its
length, is walked through with a trie, a place at a time; all else side by side.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from converge.llm import common
from converge.llm.common import U64

#: Bound on the labelled rows that the probabilities are learned from, drawn by a hash of the id.
TRAIN_ROWS = 8000
ITERATIONS = 2
#: Least probability of a single byte, and of any piece that a language was seen without.
FLOOR = 1e-6
#: Bytes of a word after which sums are scaled: FLOOR to this power is far within floating-point range.
SCALED = 32
#: Bytes of the words that are scored together, about.
BLOCK_BYTES = 1 << 18
#: Bytes of a word from which on it is looked at for places where it falls apart.
LONG = 32
#: Words of similar length below which each is walked through alone.
FEW = 64
#: Stands for the start of a word in pieces; not a byte of any word.
MARK = 1
STEP = 8 << 20
UNKNOWN = "und"

_WORD = np.zeros(256, dtype=bool)
_WORD[97:123] = True
_WORD[128:] = True


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str | None = None) -> list[bytes]:
    """The pieces in order, lower-cased, and every single byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or vocabulary_path())
    found = {bytes([b]) for b in range(1, 256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            piece = common.lower_ascii(np.frombuffer(model.id_to_piece(i).replace("▁", chr(MARK)).encode(), np.uint8))
            if (_WORD[piece] | (piece == MARK)).all():
                found.add(piece.tobytes())
    return sorted(found)


_BASE = 0x9E3779B97F4A7C15


def _trie(pieces: list[bytes]) -> dict:
    """Pieces by their bytes from the front; at -1 the number of the piece that ends there."""
    root: dict = {}
    for k, piece in enumerate(pieces):
        node = root
        for byte in piece:
            node = node.setdefault(byte, {})
        node[-1] = k
    return root


class _Endings:
    """All endings of all pieces by a 64-bit hash of their bytes, read from the last to the first, in an open table.

    number: the piece that an ending is, or `none`. more: whether a longer ending goes on from it.
    """

    def __init__(self, pieces: list[bytes]) -> None:
        self.none, self.longest = len(pieces), max(map(len, pieces))
        found: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            key = 0
            for n, byte in enumerate(reversed(piece)):
                key = (key * _BASE + byte + 1) & 0xFFFFFFFFFFFFFFFF
                node = found.setdefault(key, [self.none, 0])
                if n + 1 < len(piece):
                    node[1] = 1
                else:
                    node[0] = k
        keys = np.array(list(found), dtype=U64)
        values = np.array(list(found.values()), dtype=np.int32).reshape(-1, 2)
        self.bits = max(12, int(len(keys) * 4).bit_length())
        self.keys = np.zeros(1 << self.bits, dtype=U64)
        self.number = np.full(1 << self.bits, self.none, dtype=np.int32)
        self.more = np.zeros(1 << self.bits, dtype=bool)
        left, self.probes = np.arange(len(keys)), 0
        while len(left):
            slots = self.slot(keys[left], self.probes)
            free = np.flatnonzero(self.keys[slots] == 0)
            slots, first = np.unique(slots[free], return_index=True)
            put = left[free[first]]
            self.keys[slots], self.number[slots], self.more[slots] = keys[put], values[put, 0], values[put, 1] > 0
            left, self.probes = np.setdiff1d(left, put, assume_unique=True), self.probes + 1

    def slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return ((keys * U64(0xC2B2AE3D27D4EB4F + 2 * probe * 0x165667B19E3779F9 & 0xFFFFFFFFFFFFFFFF)) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 for one that is no ending. A key lies at its first probe or where all before are taken."""
        slots = self.slot(keys, 0)
        there = self.keys[slots]
        out = np.where(there == keys, slots, -1)
        left = np.flatnonzero((there != keys) & (there != 0))
        for probe in range(1, self.probes):
            if not len(left):
                break
            slots = self.slot(keys[left], probe)
            there = self.keys[slots]
            hit = there == keys[left]
            out[left[hit]] = slots[hit]
            left = left[~hit & (there != 0)]
        return out


class Segmenter:
    """Piece probabilities of one or more languages: a row for each piece, a column for each language."""

    def __init__(self, pieces: list[bytes], probabilities: np.ndarray, endings: _Endings | None = None) -> None:
        self.endings, self.p, self.pieces = endings or _Endings(pieces), probabilities, pieces
        self.rows = probabilities.tolist()

    @cached_property
    def trie(self) -> dict:
        return _trie(self.pieces)

    def _walked(self, word: bytes) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Each place of the word, with ends and numbers of the pieces that start there."""
        for i in range(len(word)):
            node, found = self.trie, []
            for j in range(i, len(word)):
                node = node.get(word[j])
                if node is None:
                    break
                if -1 in node:
                    found.append((j + 1, node[-1]))
            yield i, found

    def log_probability(self, word: bytes) -> list[float]:
        """Of one word, in each language."""
        kinds, ring = range(self.p.shape[1]), self.endings.longest + 1
        sums, scale = [[0.0] * len(kinds) for _ in range(ring)], [0.0] * len(kinds)
        sums[0] = [1.0] * len(kinds)
        for i, found in self._walked(word):
            now = sums[i % ring]
            if i % SCALED == 0:
                top = [max(x, 1e-300) for x in now]
                scale = [s + math.log(t) for s, t in zip(scale, top, strict=True)]
                for row in sums:
                    for k in kinds:
                        row[k] /= top[k]
            for end, number in found:
                then, p = sums[end % ring], self.rows[number]
                for k in kinds:
                    then[k] += now[k] * p[k]
            sums[i % ring] = [0.0] * len(kinds)
        return [math.log(max(x, 1e-300)) + s for x, s in zip(sums[len(word) % ring], scale, strict=True)]

    def expected_of(self, word: bytes, weight: float, out: np.ndarray) -> None:
        """Add the expected uses of each piece in one word that occurs weight times, for the first language."""
        total, ring = [0.0] * (len(word) + 1), self.endings.longest + 1
        sums, scale = [0.0] * ring, 0.0
        sums[0] = 1.0
        for i, found in self._walked(word):
            now = sums[i % ring]
            total[i] = math.log(max(now, 1e-300)) + scale
            if i % SCALED == 0:
                top = max(now, 1e-300)
                scale += math.log(top)
                sums = [x / top for x in sums]
                now = sums[i % ring]
            for end, number in found:
                sums[end % ring] += now * self.rows[number][0]
            sums[i % ring] = 0.0
        total[len(word)] = math.log(max(sums[len(word) % ring], 1e-300)) + scale
        # How often a segmentation has a boundary at a place: a place that comes later is known first.
        met = [0.0] * len(word) + [weight]
        for i in range(len(word) - 1, -1, -1):
            node, mine = self.trie, 0.0
            for j in range(i, len(word)):
                node = node.get(word[j])
                if node is None:
                    break
                number = node.get(-1)
                if number is not None and met[j + 1]:
                    used = math.exp(total[i] - total[j + 1]) * self.rows[number][0] * met[j + 1]
                    mine += used
                    out[number, 0] += used
            met[i] = mine

    def _lookups(self, words: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Ends and lengths of pieces, and the words (numbers of rows) and pieces that they are in and are.

        words is a matrix of bytes, the mark first, of rising lengths. A word is followed to longer pieces only while its
        bytes are the ending of one.
        """
        wide = words.T.astype(U64) + U64(1)
        for end in range(1, words.shape[1] + 1):
            live = np.arange(np.searchsorted(lengths, end), len(words))
            key = np.zeros(len(live), U64)
            for n in range(1, min(self.endings.longest, end) + 1):
                key = key * U64(_BASE) + wide[end - n, live]
                slot = self.endings.find(key)
                known = slot >= 0
                if not known.all():
                    live, key, slot = live[known], key[known], slot[known]
                number = self.endings.number[slot]
                hit = number != self.endings.none
                if hit.any():
                    yield end, n, live[hit], number[hit]
                more = self.endings.more[slot]
                live, key = live[more], key[more]
                if not len(live):
                    break

    def log_probabilities(self, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of words of rising lengths. Sums of the last places are divided by the newest one from time to time."""
        if len(words) < FEW:
            return np.array([self.log_probability(w[:n].tobytes()) for w, n in zip(words, lengths.tolist(), strict=True)]).reshape(len(words), -1)
        deep, rows, kinds = self.endings.longest + SCALED, len(words), self.p.shape[1]
        alpha = np.zeros((min(deep, words.shape[1] + 1), rows, kinds))
        alpha[0] = 1
        scale, out = np.zeros((rows, kinds)), np.zeros((rows, kinds))
        ring, at = len(alpha), 0

        def leave(end: int) -> None:
            a, b = np.searchsorted(lengths, [end, end + 1])
            out[a:b] = np.log(np.maximum(alpha[end % ring, a:b], 1e-300)) + scale[a:b]
            if end % SCALED == 0:
                top = np.maximum(alpha[end % ring], 1e-300)
                scale[b:] += np.log(top[b:])
                alpha[:, b:] /= top[b:]

        for end, n, row, number in self._lookups(words, lengths):
            if end != at:
                if at:
                    leave(at)
                at = end
                alpha[end % ring] = 0
            alpha[end % ring, row] += alpha[(end - n) % ring, row] * self.p[number]
        if at:
            leave(at)
        return out

    def expected(self, words: np.ndarray, lengths: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece, in each language, over words (of rising lengths) that occur weight times."""
        if len(words) < FEW and self.p.shape[1] == 1:
            out = np.zeros_like(self.p)
            for w, n, times in zip(words, lengths.tolist(), weight.tolist(), strict=True):
                self.expected_of(w[:n].tobytes(), times, out)
            return out
        uses = list(self._lookups(words, lengths))
        shape = (words.shape[1] + 1, len(words), self.p.shape[1])
        # Sums of a place, or for long words their logarithms, so that any length stays within range.
        alpha, long = np.zeros(shape), words.shape[1] > SCALED
        alpha[0] = 0.0 if long else 1.0
        at = 0
        for end, n, row, number in uses:
            if long and end != at:
                if at:
                    alpha[at] = base + np.log(np.where(alpha[at] > 0, alpha[at], 1.0))
                at, base = end, alpha[end - 1].copy()
            before = np.exp(alpha[end - n, row] - base[row]) if long else alpha[end - n, row]
            alpha[end, row] += before * self.p[number]
        if long and at:
            alpha[at] = base + np.log(np.where(alpha[at] > 0, alpha[at], 1.0))
        # How often, on the average, a segmentation has a boundary at a place: each is reached from its piece's end.
        met, out = np.zeros(shape), np.zeros_like(self.p)
        met[lengths, np.arange(len(words))] = weight[:, None]
        for end, n, row, number in reversed(uses):
            share = np.exp(alpha[end - n, row] - alpha[end, row]) if long else alpha[end - n, row] / np.maximum(alpha[end, row], 1e-300)
            used = share * self.p[number] * met[end, row]
            met[end - n, row] += used
            for k in range(self.p.shape[1]):
                out[:, k] += np.bincount(number, used[:, k], len(self.p))
        return out


@cache
def _joins(pieces: tuple[bytes, ...]) -> np.ndarray:
    """Pairs of neighbouring characters, as two numbers of their bytes in one, that some piece holds, in order."""
    found = set()
    for piece in pieces:
        if len(piece) > 1:
            # Single bytes aside, pieces are whole characters.
            codes = [int.from_bytes(c.encode(), "big") for c in piece.decode()]
            found.update(x << 32 | y for x, y in zip(codes, codes[1:], strict=False))
    return np.array(sorted(found), dtype=U64)


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where characters of UTF-8 start, and each one's bytes as a number."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    size = np.diff(np.append(starts, len(data)))
    code = np.zeros(len(starts), dtype=U64)
    for k in range(4):
        more = size > k
        code[more] = code[more] << U64(8) | data[starts[more] + k].astype(U64)
    return starts, code


def _parts(data: np.ndarray, start: int, length: int, joins: np.ndarray) -> np.ndarray:
    """Where the parts of a word start that no piece reaches across."""
    starts, code = _characters(data[start : start + length])
    pair = code[:-1] << U64(32) | code[1:]
    at = np.minimum(np.searchsorted(joins, pair), max(0, len(joins) - 1))
    held = joins[at] == pair if len(joins) else np.zeros(len(pair), bool)
    return start + np.append(0, starts[1:][~held])


def _words(data: np.ndarray, off: np.ndarray, pieces: tuple[bytes, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and lengths of words, the document of each, and whether it has a mark in front.

    Given the pieces, long words are taken apart where none of them reaches across; only the first part has the mark.
    """
    data = common.lower_ascii(data)
    inside = _WORD[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < len(data)]] = False
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    marked = np.ones(len(starts), dtype=bool)
    if pieces and (long := np.flatnonzero(lengths > LONG)).size:
        joins = _joins(pieces)
        parts = [_parts(data, int(starts[k]), int(lengths[k]), joins) for k in long]
        short = lengths <= LONG
        firsts = np.concatenate([starts[short], *parts])
        ends = np.concatenate([(starts + lengths)[short], *[np.append(p[1:], starts[k] + lengths[k]) for k, p in zip(long, parts, strict=True)]])
        marked = np.concatenate([np.ones(int(short.sum()), bool), *[np.arange(len(p)) == 0 for p in parts]])
        order = np.argsort(firsts, kind="stable")
        starts, lengths, marked = firsts[order], (ends - firsts)[order], marked[order]
    return data, starts, lengths, np.searchsorted(off, starts, side="right") - 1, marked


def _blocks(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, marked: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct words of rising, similar lengths as matrices of bytes, the mark in front of those that have it: positions, matrix, lengths."""
    for mark in (1, 0):
        mine = np.flatnonzero(marked == bool(mark))
        order = mine[np.argsort(lengths[mine], kind="stable")]
        rising = lengths[order]
        k = 0
        while k < len(order):
            shortest = int(rising[k])
            # No word is more than about twice as long as the first, nor the matrix larger than by as much.
            end = min(int(np.searchsorted(rising, 2 * shortest + 8, side="right")), k + max(1, size // (shortest + 1)))
            at = order[k:end]
            n = lengths[at]
            width = int(n.max())
            places = np.minimum(starts[at][:, None] + np.arange(width), len(data) - 1)
            matrix = np.full((len(at), width + mark), MARK, dtype=np.uint8)
            matrix[:, mark:] = np.where(np.arange(width) < n[:, None], data[places], 0)
            yield at, matrix, n + mark
            k = end


def _distinct(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = common.word_hashes(data, starts, starts + lengths) ^ marked.astype(U64)
    _, first, back = np.unique(h, return_index=True, return_inverse=True)
    return first, back


def _counter(pieces: list[bytes], languages: list[str], start: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, endings, whole = np.zeros((len(pieces), len(languages))), None, tuple(pieces)
        for piece, raw, off in common.pieces(batches, "_text", STEP):
            endings = endings or _Endings(pieces)
            data, starts, lengths, doc, marked = _words(raw, off, whole)
            langs = np.array([languages.index(x) for x in piece.column("_lang").to_pylist()], dtype=np.int64)
            for k in range(len(languages)):
                mine = langs[doc] == k if len(doc) else np.zeros(0, bool)
                if not mine.any():
                    continue
                s, n, m = starts[mine], lengths[mine], marked[mine]
                first, back = _distinct(data, s, n, m)
                times = np.bincount(back)
                own = Segmenter(pieces, start[:, k : k + 1], endings)
                for at, matrix, size in _blocks(data, s[first], n[first], m[first]):
                    sums[:, k] += own.expected(matrix, size, times[at].astype(float))[:, 0]
        which, lang = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(which, pa.int64()), pa.array(lang, pa.int64()), pa.array(sums[which, lang])], names=["piece", "lang", "uses"])

    return count


class LanguageModel:
    """Pieces with a probability in each of the languages that were learned."""

    def __init__(self, pieces: list[bytes], languages: list[str], probabilities: np.ndarray) -> None:
        self.pieces, self.languages, self.probabilities = pieces, languages, probabilities


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", rows: int = TRAIN_ROWS, iterations: int = ITERATIONS, path: str | None = None) -> LanguageModel:
    """Learn from at most about `rows` rows with a language, drawn by a hash of the id. Null texts and languages are left out."""
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    counts = {r["_lang"]: r["n"] for r in known.groupBy("_lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    pieces = vocabulary(path)
    if not languages:
        return LanguageModel(pieces, [], np.zeros((len(pieces), 0)))
    each = rows / len(languages)  # the rarer languages are learned from as many rows as the others, if they have them
    share = F.coalesce(*[F.when(F.col("_lang") == k, F.lit(min(1.0, each / n))) for k, n in counts.items()])
    sample = common.checkpoint(known.where(F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1 << 20)) < share * (1 << 20)).drop("_id"))
    start = np.full((len(pieces), len(languages)), 1 / len(pieces))
    for _ in range(iterations):
        sums = np.zeros((len(pieces), len(languages)))
        for r in sample.mapInArrow(_counter(pieces, languages, start), "piece long, lang long, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).collect():
            sums[r["piece"], r["lang"]] = r["uses"]
        start = np.maximum(sums / np.maximum(sums.sum(axis=0), 1), FLOOR)
        start /= start.sum(axis=0)
    return LanguageModel(pieces, languages, start)


_SCHEMA_OUT = "lang_pred string, score double"


def _scorer(model: LanguageModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter, whole = Segmenter(model.pieces, model.probabilities), tuple(model.pieces)
        for piece, raw, off in common.pieces(batches, "_text", STEP):
            data, starts, lengths, doc, marked = _words(raw, off, whole)
            total = np.zeros((piece.num_rows, len(model.languages)))
            if len(starts) and model.languages:
                first, back = _distinct(data, starts, lengths, marked)
                by_word = np.zeros((len(first), len(model.languages)))
                for at, matrix, n in _blocks(data, starts[first], lengths[first], marked[first]):
                    by_word[at] = segmenter.log_probabilities(matrix, n)
                for k in range(len(model.languages)):
                    total[:, k] = np.bincount(doc, by_word[back, k], piece.num_rows)
            letter = pc.fill_null(pc.match_substring_regex(piece.column("_text"), r"\p{L}"), False).to_numpy(zero_copy_only=False)
            if model.languages:
                best = total.argmax(axis=1)
                sure = 1 / np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -700)).sum(axis=1)
                names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letter, strict=True)]
                sure = np.where(letter, sure, 0.0)
            else:
                names, sure = [UNKNOWN] * piece.num_rows, np.zeros(piece.num_rows)
            yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in piece.schema.names if c != "_text"], pa.array(names, pa.string()), pa.array(np.round(sure, 9))], names=[*[c for c in piece.schema.names if c != "_text"], "lang_pred", "score"])

    return score


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (the posterior of lang_pred, languages equally likely before).

    A null text, or one without a letter in any script, is `und` with score 0; so is any text if no language was learned.
    Rows are scored on their own, so repeated rows and ids give repeated results, and ties go to the first language by
    name. An empty table gives an empty result; other columns are ignored.
    """
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).mapInArrow(_scorer(model), "_id long, " + _SCHEMA_OUT).withColumnRenamed("_id", id_col)
