"""Scoring of documents by masked pseudo-likelihood.

Every word is predicted from the words on both sides of it; the logarithms of these conditional probabilities, summed,
score a document. A word is its class and which word of the class it is. Frequent words are a class each, and there are
the more of them the larger the corpus is; the other words are classed by their shape. The class is predicted by a small
network over a window on both sides, trained in numpy: a Huffman tree over the classes whose heaviest TOP subtrees, most
of them single words, are chosen by a softmax and from which on every turn is a choice of two. Over all rounds every word is a target once. The word within its class has the
probability that its count in the whole corpus gives it. Counts are exact (for 64-bit hashes of words) and stay in a
distributed table that is joined to the words of the documents.

The network starts as the model of plain counts: the constants of the tree's nodes are the odds of the counts below them.
Documents are dealt to shards by a hash of id and text and are read in its order, so the network does not depend on how
the input is split into files. Each shard trains on all its documents from the same start, and weights are averaged by the
words seen where they were changed. A shard has as many words as pay for the weights that it sends, so that there are as
many shards as modelled words for each of them, of the order of the square root of the corpus.
"""

from __future__ import annotations

import functools
import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from converge.llm import common
from converge.llm.common import U64

BUCKET_BITS = 18
#: Classes of the most frequent words, one each, at least; of all others, by shape; and one that pads the ends of documents.
FREQUENT, OTHERS = 128, 63
CLASSES = FREQUENT + OTHERS + 1
PAD = CLASSES - 1
#: Frequent words for each square root of the number of words in the corpus.
GROWTH = 4
#: Words on each side, and widths of the network (even, since gradients are summed in pairs of columns).
SIDE, EMBEDDING, HIDDEN = 2, 12, 16
OFFSETS = [o for o in range(-SIDE, SIDE + 1) if o]
MASKED = 8
ROUNDS, BATCH, RATE = 2, 4096, 0.15
#: Subtrees that the softmax at the top chooses from.
TOP = 96
#: Distinct words that counting holds at once, and rows of weights that are averaged together.
HELD, CHUNK = 1 << 20, 512
#: Words of a shard for each class, at least.
SHARD_WORDS = 100
#: Sums of logarithms are taken in steps of 2**-FRACTION, so that they do not depend on their order.
FRACTION = 32


def modelled(total: int) -> int:
    """Words with a class of their own in a corpus of so many words."""
    return max(FREQUENT, GROWTH * math.isqrt(total))


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shape of each word, lower-cased, and the index of each document's first word.

    The shape is which of digits, letters beyond ASCII and other marks it holds, how long it is, and how it ends.
    """
    data = common.lower_ascii(data)
    starts, ends, first = common.word_spans(data, off)
    # Between a word's start and the next one lie only its own bytes and blanks, which are of no kind.
    has = np.bitwise_or.reduceat(_KIND_BITS.take(data), starts).astype(np.int64) if len(starts) else np.zeros(0, np.int64)
    long = np.searchsorted(_LENGTHS, ends - starts)
    shape = (has * (len(_LENGTHS) + 1) + long) * 256 + (data[ends - 1] if len(ends) else 0)
    return common.word_hashes(data, starts, ends).view(np.int64), shape % OTHERS, first


_BYTES = np.arange(256)
_DIGIT = (_BYTES >= 48) & (_BYTES < 58)
_KINDS = (_DIGIT, _BYTES >= 128, ~_DIGIT & (_BYTES < 128) & ~((_BYTES >= 97) & (_BYTES < 123)))
_KIND_BITS = np.where((_BYTES == 32) | (_BYTES >= 9) & (_BYTES <= 13), 0, sum(kind.astype(np.uint8) << bit for bit, kind in enumerate(_KINDS))).astype(np.uint8)
_LENGTHS = np.array([2, 4, 6, 8, 12])


def _counted(word: np.ndarray, shape: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words in the order of their first places, their shapes, and how often each occurs (the sum of its n)."""
    coded = pa.array(word).dictionary_encode()
    back, found = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    shapes = np.empty(len(found), np.int64)
    shapes[back] = shape
    return found, shapes, np.bincount(back, n, len(found)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def summed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _counted(*(np.concatenate(c) for c in zip(*held, strict=True)))

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0
    for _, data, off in common.pieces(batches, "_text"):
        word, shape, _ = words(data, off)
        word, shape, n = _counted(word, shape)
        held.append((word, shape, n))
        size += len(word)
        if size > HELD:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in summed()], names=["word", "shape", "n"])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in summed()], names=["word", "shape", "n"])


class Vocabulary:
    """Frequent words, most frequent first, and the weight of all others by shape.

    Counts alone are those of a whole table of words with the numbers 0, 1, ..., whose classes and logarithms of their
    share of the class are then at hand as well. A share is that of the count plus one, with one word never seen beside.
    """

    def __init__(self, counts: np.ndarray, frequent: np.ndarray | None = None, rest: np.ndarray | None = None) -> None:
        if frequent is None:
            frequent = np.argsort(-counts, kind="stable")[: modelled(int(counts.sum()))]
            shape = np.arange(len(counts)) % OTHERS
            other = np.ones(len(counts), dtype=bool)
            other[frequent] = False
            rest = np.bincount(shape[other], counts[other] + 1.0, OTHERS)
            self._set(counts[frequent], frequent, rest)
            self.classes = self.class_of(np.arange(len(counts)), shape)
            self.share = np.where(other, np.log(counts + 1.0), 0) + self.log_rest(self.classes)
        else:
            self._set(counts, frequent, rest)

    def _set(self, counts: np.ndarray, frequent: np.ndarray, rest: np.ndarray) -> None:
        self.class_counts = np.concatenate([counts, rest, [0.0]])
        self.order = np.argsort(frequent, kind="stable")
        self.sorted = frequent[self.order]
        self.frequent, self.size = len(frequent), len(frequent) + OTHERS + 1
        self.rest = -np.log(rest + 1.0)
        # Where the words with each beginning (of so many bits) are; beginnings are twice to four times as many as words.
        self.shift = 64 - min(max(self.frequent * 2, 2).bit_length(), 30)
        beginnings = self.beginning(self.sorted)
        self.begin = np.searchsorted(beginnings, np.arange(1 << (64 - self.shift))).astype(np.int32)
        self.crowd = int(np.bincount(beginnings).max()) if self.frequent else 0

    def beginning(self, word: np.ndarray) -> np.ndarray:
        return (word >> self.shift) + (1 << (63 - self.shift))

    def class_of(self, word: np.ndarray, shape: np.ndarray) -> np.ndarray:
        if not self.frequent:
            return shape
        if self.crowd > 16:
            at = np.searchsorted(self.sorted, word)
        else:
            at = self.begin.take(self.beginning(word))
            after = np.arange(len(word))
            for _ in range(self.crowd):
                after = after[self.sorted.take(at.take(after), mode="clip") < word.take(after)]
                at[after] += 1
        at = np.minimum(at, self.frequent - 1)
        return np.where(self.sorted[at] == word, self.order[at], self.frequent + shape)

    def log_rest(self, classes: np.ndarray) -> np.ndarray:
        """What the logarithm of a word's count plus one is added to: its class's, and 0 for a frequent word."""
        return np.where(classes < self.frequent, 0.0, self.rest[np.maximum(classes - self.frequent, 0)])


@functools.lru_cache(maxsize=2)
def tree(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A Huffman tree over the classes for frequencies that fall as their ranks do, cut into its TOP heaviest subtrees.

    Inner nodes below the cut and turns (1 or -1) of all classes one after the other, where each class's begin, and the
    subtree of each class. With no more than TOP classes each is a subtree of its own.
    """
    own = size - OTHERS - 1
    heap = [((1 / (k + 8) if k < own else 1 / 64 if k < size - 1 else 1e-9), k) for k in range(size)]
    heapq.heapify(heap)
    parent, turn = np.zeros(2 * size - 1, np.int64), np.ones(2 * size - 1, np.float32)
    for node in range(size, 2 * size - 1):
        (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
        parent[left] = parent[right] = node
        turn[right] = -1
        heapq.heappush(heap, (a + b, node))
    # The last TOP - 1 nodes are the heaviest and make the top; a walk up ends where its next node is one of them.
    top = max(size, 2 * size - TOP)
    at, which, subtree = np.arange(size), np.arange(size), np.arange(size)
    nodes, turns, owners = [], [], []
    while len(at):
        inside = parent[at] < top
        subtree[which[~inside]] = at[~inside]
        at, which = at[inside], which[inside]
        nodes.append(parent[at] - size)
        turns.append(turn[at])
        owners.append(which)
        at = parent[at]
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(nodes)[order].astype(np.int32), np.concatenate(turns)[order], np.searchsorted(owner[order], np.arange(size + 1)), np.unique(subtree, return_inverse=True)[1]


def start_weights(seed: int = 1, size: int = CLASSES, counts: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Of so many classes: embeddings e, the hidden layer w and b, and outputs whose last column is a constant: t of the
    subtrees and v of the nodes below.

    With counts of the classes, the tree gives each class its share of them, whatever stands around it.
    """
    r = np.random.RandomState(seed)
    nodes, turns, begin, subtree = tree(size)
    tops = int(subtree.max()) + 1
    t, v = (r.normal(0, 0.05, (n, HIDDEN + 1)).astype(np.float32) for n in (tops, size - tops))
    t[:, -1], v[:, -1] = 0, 0
    if counts is not None:
        below = np.repeat(counts, np.diff(begin))
        left, right = (np.bincount(nodes, np.where(turns == side, below, 0.0), size - tops) for side in (1, -1))
        t[:], v[:] = 0, 0
        t[:, -1] = np.log(np.bincount(subtree, counts, tops) + 0.5)
        v[:, -1] = np.log(left + 0.5) - np.log(right + 0.5)
    return {"e": r.normal(0, 0.3, (size, EMBEDDING)).astype(np.float32), "w": r.normal(0, 0.2, (len(OFFSETS) * EMBEDDING, HIDDEN)).astype(np.float32), "b": np.zeros((1, HIDDEN), np.float32), "t": t, "v": v}


def contexts(classes: np.ndarray, first: np.ndarray, pad: int = PAD, targets: np.ndarray | None = None) -> np.ndarray:
    """A row for each offset: the class of the word at that distance (from the targets only, if given), pad beyond the
    document's ends."""
    # Documents one after the other with SIDE pads around each, so that a distance never leads into another document.
    at = np.arange(len(classes)) + SIDE * np.repeat(np.arange(1, len(first)), np.diff(first))
    padded = np.full(len(classes) + SIDE * len(first), pad, dtype=np.int64)
    padded[at] = classes
    if targets is not None:
        at = at.take(targets)
    out = np.empty((len(OFFSETS), len(at)), dtype=np.int64)
    for k, o in enumerate(OFFSETS):
        out[k] = padded.take(at + o)
    return out


def _inputs(p: dict[str, np.ndarray], context: np.ndarray) -> np.ndarray:
    return p["e"].take(context.T, axis=0).reshape(context.shape[1], -1)


def _hidden(p: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The hidden layer, and the constant 1 beside it."""
    h = np.ones((len(x), HIDDEN + 1), dtype=np.float32)
    inner = x @ p["w"]
    inner += p["b"]
    h[:, :-1] = np.tanh(inner, out=inner)
    return h


def _deepest_first(target: np.ndarray, size: int) -> np.ndarray:
    """The order of targets by the lengths of their paths, longest first: the nodes of a level belong to the first so many."""
    begin = tree(size)[2]
    return np.argsort((begin.take(target) - begin.take(target + 1)).astype(np.int16), kind="stable")


class _Path:
    """The nodes below the subtrees of all targets, which come deepest first: a level after the other, with the rows of v,
    turns and logits; ends says where levels end, rows which target a node is of."""

    def __init__(self, p: dict[str, np.ndarray], h: np.ndarray, target: np.ndarray) -> None:
        nodes, turns, begin, _ = tree(len(p["e"]))
        begins = begin.take(target)
        n = len(target) - np.cumsum(np.bincount(begin.take(target + 1) - begins))[:-1]
        self.ends = [0, *np.cumsum(n).tolist()]
        self.rows = np.concatenate([np.arange(k) for k in n] or [np.arange(0)])
        at = begins.take(self.rows)
        at += np.repeat(np.arange(len(n)), n)
        self.nodes, self.turns = nodes.take(at), turns.take(at)
        self.v = p["v"].take(self.nodes, axis=0)
        self.z = np.empty(len(self.nodes), np.float32)
        for a, b in self.levels():
            np.einsum("ij,ij->i", self.v[a:b], h[: b - a], out=self.z[a:b])
        self.z *= self.turns

    def levels(self) -> Iterator[tuple[int, int]]:
        return zip(self.ends[:-1], self.ends[1:], strict=True)

    def log_below(self, out: np.ndarray) -> None:
        """Adds the logarithms of all turns' probabilities to the rows of out."""
        turned = np.abs(self.z)
        np.negative(turned, out=turned)
        np.exp(turned, out=turned)
        turned += 1
        np.log(turned, out=turned)
        np.subtract(np.minimum(self.z, 0), turned, out=turned)
        for a, b in self.levels():
            out[: b - a] += turned[a:b]


def _shares(p: dict[str, np.ndarray], h: np.ndarray, subtree: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unnormalised shares of the subtrees for each row of h, their sums, and the logarithm of the share of the row's own."""
    # The hidden layer lies within 1 of 0, which bounds every row's largest logit; where both bounds are near, one of them
    # can be taken from all logits instead of each row's largest.
    reach = np.abs(p["t"][:, :-1]).sum(axis=1)
    high, low = (p["t"][:, -1] + reach).max(), (p["t"][:, -1] - reach).max()
    t = p["t"].copy()
    t[:, -1] -= high
    shares = h @ t.T
    if not high - low < 60:
        shares -= shares.max(axis=1, keepdims=True)
    own = shares[np.arange(len(h)), subtree]
    np.exp(shares, out=shares)
    return shares, shares @ np.ones(len(t), np.float32), own


def class_log_probabilities(p: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray, step: int = 4096) -> np.ndarray:
    out = np.empty(len(target), dtype=np.float64)
    subtree = tree(len(p["e"]))[3]
    for i in range(0, len(target), step):
        order = _deepest_first(target[i : i + step], len(p["e"]))
        order += i
        own = target.take(order)
        h = _hidden(p, _inputs(p, context.take(order, axis=1)))
        _, total, log = _shares(p, h, subtree.take(own))
        log = log - np.log(total, dtype=np.float64)
        _Path(p, h, own).log_below(log)
        out[order] = log
    return out


def _summed(at: np.ndarray, rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers, and for each the sum of its rows times their weights, a column at a time."""
    found, back = np.unique(at, return_inverse=True)
    out = np.empty((len(found), rows.shape[1]), rows.dtype)
    for k, column in enumerate(np.ascontiguousarray(rows.T)):
        out[:, k] = np.bincount(back, column * weight, len(found))
    return found, out


class _Trainer:
    """Adagrad on the cross-entropy of targets; rows of e and v that a step does not meet stay as they are."""

    def __init__(self, p: dict[str, np.ndarray]) -> None:
        self.p = {k: v.copy() for k, v in p.items()}
        self.s = {k: np.zeros_like(v) for k, v in p.items()}
        self.last = np.zeros(len(p["e"]), dtype=np.int64)

    def moved(self, name: str) -> np.ndarray:
        return np.flatnonzero(self.s[name].any(axis=1))

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        p, n, size = self.p, len(target), len(self.p["e"])
        order = _deepest_first(target, size)
        target, context = target.take(order), context.take(order, axis=1)
        x = _inputs(p, context)
        h = _hidden(p, x)
        path = _Path(p, h, target)
        subtree = tree(size)[3].take(target)
        d, total, _ = _shares(p, h, subtree)
        d[np.arange(n), subtree] -= total
        scale = (1 / (total * np.float32(n)))[:, None]
        dh, dt = d @ p["t"], d.T @ (h * scale)
        dh *= scale
        if len(path.z):
            below = np.minimum(path.z, 30)
            np.exp(below, out=below)
            below += 1
            below *= np.float32(-n)
            np.divide(path.turns, below, out=below)
            path.v *= below[:, None]
            for a, b in path.levels():
                dh[: b - a] += path.v[a:b]
            twice = below.astype(np.complex128)
            self._move_rows("v", path.nodes, (pair.take(path.rows) * twice for pair in _pairs(h[:, :-1])), below.astype(np.float64))
        dh = dh[:, :-1] * (1 - h[:, :-1] ** 2)
        dx = (dh @ p["w"].T).astype(np.float64).view(np.complex128).reshape(n, len(OFFSETS), -1)
        self._move_rows("e", context.T.ravel(), (dx[:, :, k].ravel() for k in range(EMBEDDING // 2)))
        self._move("t", dt)
        self._move("w", x.T @ dh)
        self._move("b", np.ones((1, n), np.float32) @ dh)

    def _move_rows(self, name: str, at: np.ndarray, pairs: Iterable[np.ndarray], last: np.ndarray | None = None) -> None:
        """Moves the rows that at names by the sums of their gradients, which come in pairs of columns; last is one without a partner."""
        # Of equal numbers the last one stands for all.
        place = np.arange(len(at))
        self.last[at] = place
        stands = self.last.take(at)
        first = stands == place
        found = at[first]
        back = (np.cumsum(first) - 1).take(stands)
        width = self.p[name].shape[1]
        total = np.zeros((width // 2, len(found)), np.complex128)
        for pair, of in zip(total, pairs, strict=True):
            np.add.at(pair, back, of)
        grad = np.empty((len(found), width), np.float32)
        grad[:, : width // 2 * 2] = np.ascontiguousarray(total.T).view(np.float64)
        if last is not None:
            grad[:, -1] = np.bincount(back, last, len(found))
        s = self.s[name].take(found, axis=0)
        s += grad * grad
        _put(self.s[name], found, s)
        np.sqrt(s, out=s)
        s += np.float32(1e-9)
        grad *= np.float32(RATE)
        grad /= s
        _put(self.p[name], found, self.p[name].take(found, axis=0) - grad)

    def _move(self, name: str, grad: np.ndarray) -> None:
        s = self.s[name]
        s += grad * grad
        self.p[name] -= np.float32(RATE) * grad / (np.sqrt(s) + np.float32(1e-9))


def _pairs(rows: np.ndarray) -> np.ndarray:
    """Columns of rows as parts of complex numbers, a row for each two of them: one addition sums both."""
    return np.ascontiguousarray(rows.astype(np.float64).view(np.complex128).T)


def _put(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """table[at] = rows, a row as one value, which takes less than half the time."""
    row = f"V{table.itemsize * table.shape[1]}"
    table.view(row)[:, 0][at] = rows.view(row)[:, 0]


def _coded(vocabulary: Vocabulary):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The classes of each document's words, four bytes each, compressed."""
        for piece, data, off in common.pieces(batches, "_text"):
            word, shape, first = words(data, off)
            classes = vocabulary.class_of(word, shape).astype("<i4")
            packed = [pa.compress(classes[a:b].tobytes(), codec="zstd", asbytes=True) for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column("_h"), pa.array(np.diff(first)), pa.array(packed, pa.binary())], names=["_h", "n", "classes"])

    return code


def _documents(batches: Iterator[pa.RecordBatch], step: int = common.STEP_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Shards with classes of some of their documents, one after the other, and where each document begins. Rows come
    ordered by shard; a step ends with the shard or with so many bytes, wherever batches end."""
    shard, held, size = None, [], 0

    def given() -> tuple[int, np.ndarray, np.ndarray]:
        return shard, np.frombuffer(b"".join(held), "<i4").astype(np.int64), np.cumsum([0] + [len(h) // 4 for h in held])

    for batch in batches:
        for k, n, packed in zip(batch.column("shard").to_pylist(), batch.column("n").to_pylist(), batch.column("classes").to_pylist(), strict=True):
            if not n:
                continue
            classes = pa.decompress(packed, 4 * n, codec="zstd", asbytes=True)
            if held and (k != shard or size > step):
                yield given()
                held, size = [], 0
            shard = k
            held.append(classes)
            size += len(classes)
    if held:
        yield given()


def _train(size: int, start: dict[str, np.ndarray], turn: int, rounds: int):
    def moved(trainer: _Trainer, shard: int, seen: int) -> Iterator[pa.RecordBatch]:
        for k, name in enumerate(sorted(start) if seen else []):
            rows = trainer.moved(name)
            for i in range(0, len(rows), CHUNK * 16):
                at = rows[i : i + CHUNK * 16]
                values = pa.FixedSizeListArray.from_arrays(pa.array(trainer.p[name][at].ravel()), start[name].shape[1]).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k)), pa.array(at // CHUNK), pa.array(at), values, pa.array(np.full(len(at), float(seen))), pa.array(np.full(len(at), shard))], names=["name", "chunk", "at", "value", "weight", "shard"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, trainer, seen = None, None, 0
        for k, classes, first in _documents(batches):
            if k != shard:
                if trainer is not None:
                    yield from moved(trainer, shard, seen)
                shard, trainer, seen = k, _Trainer(start), 0
            place = (np.arange(len(classes)) - np.repeat(first[:-1], np.diff(first))) % MASKED
            # The residues are dealt to the rounds, so each word of a document is a target in one of them.
            for residue in range(turn % MASKED, MASKED, min(rounds, MASKED)):
                masked = np.flatnonzero(place == residue)
                context, target = contexts(classes, first, size - 1, masked), classes.take(masked)
                for i in range(0, len(masked), BATCH):
                    trainer.step(context[:, i : i + BATCH], target[i : i + BATCH])
                seen += len(masked)
        if trainer is not None:
            yield from moved(trainer, shard, seen)

    return train


_WEIGHTS = "name long, chunk long, at long, value array<float>, weight double, shard long"


def _averaged(rows: pa.Table) -> pa.Table:
    # In the order of shards, so that sums do not depend on the order in which rows arrive.
    rows = rows.sort_by([("shard", "ascending"), ("at", "ascending")])
    at, weight = rows["at"].to_numpy(), rows["weight"].to_numpy()
    value = rows["value"].combine_chunks().flatten().to_numpy().reshape(len(at), -1)
    found, total = _summed(at, value.astype(np.float64), weight)
    mean = (total / _summed(at, np.ones((len(at), 1)), weight)[1]).astype(np.float32)
    values = pa.FixedSizeListArray.from_arrays(pa.array(mean.ravel()), mean.shape[1]).cast(pa.list_(pa.float32()))
    return pa.table([pa.array(np.full(len(found), rows["name"][0].as_py())), pa.array(found), values], names=["name", "at", "value"])


def count(texts: DataFrame) -> tuple[DataFrame, Vocabulary]:
    """The exact count of every word as a table (word, shape, n), and the vocabulary; the driver gets the frequent words only."""
    counts = common.written(texts.mapInArrow(_count, "word long, shape long, n long").groupBy("word").agg(F.min("shape").alias("shape"), F.sum("n").alias("n")))
    often = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).collect()
    wanted, least, have = modelled(sum(r["n"] * r["words"] for r in often)), 1, 0
    for r in often:
        least, have = r["n"], have + r["words"]
        if have >= wanted:
            break
    frequent = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(wanted).toPandas()
    rest = np.zeros(OTHERS)
    for r in counts.groupBy("shape").agg(F.sum(F.col("n") + 1).alias("n")).collect():
        rest[r["shape"]] = r["n"]
    rest -= np.bincount(frequent["shape"].to_numpy(dtype=np.int64), frequent["n"].to_numpy(dtype=np.int64) + 1, OTHERS)
    vocabulary = Vocabulary(frequent["n"].to_numpy(dtype=np.int64), frequent["word"].to_numpy(dtype=np.int64), rest)
    vocabulary.total = sum(r["n"] * r["words"] for r in often)
    return counts, vocabulary


def fit(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, id_col: str = "doc_id", shard_words: int = SHARD_WORDS) -> tuple[Vocabulary, dict[str, np.ndarray], DataFrame]:
    """Count all words of the corpus, then train on all its documents: the averaged network of each round starts the next.

    Documents travel once, as classes. The driver gets the frequent words and their weights, which grow as the square root
    of the corpus. Rows with equal ids and texts fall to the same shard; without the column id_col, equal texts do.
    """
    identity = [F.col(id_col)] if id_col in docs.columns else []
    texts = docs.select(F.col(text_col).alias("_text"), F.xxhash64(*identity, F.col(text_col)).alias("_h"))
    counts, vocabulary = count(texts.select("_text"))
    p = start_weights(size=vocabulary.size, counts=vocabulary.class_counts)
    shards = -(-vocabulary.total // (shard_words * vocabulary.size)) or 1
    coded = texts.mapInArrow(_coded(vocabulary), "_h long, n long, classes binary").withColumn("shard", F.pmod("_h", F.lit(shards)))
    dealt = common.checkpoint(coded.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "_h"))
    for turn in range(rounds):
        sums = dealt.mapInArrow(_train(vocabulary.size, p, turn, rounds), _WEIGHTS).groupBy("name", "chunk").applyInArrow(_averaged, "name long, at long, value array<float>").toArrow()
        for k, name in enumerate(sorted(p)):
            of = sums.filter(pc.equal(sums["name"], k))
            if len(of):
                p[name] = p[name].copy()
                p[name][of["at"].to_numpy()] = of["value"].combine_chunks().flatten().to_numpy().reshape(len(of), -1)
    return vocabulary, p, counts


def _scorer(vocabulary: Vocabulary, p: dict[str, np.ndarray]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, data, off in common.pieces(batches, "_text"):
            word, shape, first = words(data, off)
            classes = vocabulary.class_of(word, shape)
            n = np.diff(first)
            doc = np.repeat(np.arange(len(n)), n)
            scores = class_log_probabilities(p, contexts(classes, first, vocabulary.size - 1), classes) + vocabulary.log_rest(classes)
            total = np.bincount(doc, scores, len(n)) if len(word) else np.zeros(len(n))
            other = classes >= vocabulary.frequent
            begin = np.concatenate([[0], np.cumsum(np.bincount(doc[other], minlength=len(n)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([piece.column("_id"), pa.array(n.astype(np.int64)), pa.array(total), pa.ListArray.from_arrays(pa.array(begin), pa.array(word[other]))], names=["_id", "n_tokens", "known", "others"])

    return score


def score(docs: DataFrame, vocabulary: Vocabulary, p: dict[str, np.ndarray], counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, log_likelihood (the sum over all words), mean_log_likelihood, perplexity.

    A null text or one without words has no tokens, a sum of 0 and a null mean. Rows are scored on their own, so repeated
    rows and ids give repeated results. An empty table gives an empty result; other columns are ignored. Words that are
    not frequent are joined with their counts; one that the corpus does not hold counts as 0.
    """
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    scored = common.written(source.mapInArrow(_scorer(vocabulary, p), "_id long, n_tokens long, known double, others array<long>").withColumn("_row", F.monotonically_increasing_id()))
    others = scored.select("_row", F.explode("others").alias("word")).join(counts.select("word", "n"), "word", "left")
    share = F.round(F.log(F.coalesce("n", F.lit(0)) + 1) * (1 << FRACTION)).cast("long")
    shares = others.groupBy("_row").agg(F.sum(share).alias("share"))
    whole = scored.select("_row", "_id", "n_tokens", "known").join(shares, "_row", "left")
    whole = whole.withColumn("log_likelihood", F.col("known") + F.coalesce("share", F.lit(0)) / (1 << FRACTION)).withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
    return whole.select(F.col("_id").alias(id_col), "n_tokens", "log_likelihood", "mean_log_likelihood", F.exp(-F.col("mean_log_likelihood")).alias("perplexity"))
