"""Alignment of two tokenizers: which tokens of one overlap which of the other, and how often over the corpus.

Both tokenizers see the same bytes, so the cumulative ends of their tokens are two ascending runs. Two pointers walk over
both runs: at each end the pointer whose token ends moves on, and every step is a link between the tokens that were open.
Where both move a group ends. Spark counts the pairs of all documents and joins the counts and the maxima of either side back.

A text is cut before each single space between two characters that are no blanks. Both tokenizers always end a token
there (none of their tokens holds a blank after another character), so parts are aligned on their own, and equal parts once.

Documents are gathered in blocks of about BLOCK_BYTES of text. A block asks for each of its pairs once, so what is counted
and joined is far smaller than the links, and no pair of ids is frequent in it.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from converge.llm import common, tokens

#: Bytes of text of a block, about; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Parts up to this length are remembered, so many of them; they are forgotten together when there are more.
SHORT, REMEMBERED = 64, 200_000
_CUT = re.compile(r"(?<=\S) (?=\S)")

_BLOCKS = "block long, id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, times binary, a array<int>, b array<int>, docs array<long>"
_DIGEST = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def merged(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the tokens of a and of b of each link, and whether both tokens end with it.

    Both runs ascend and have the same last end. The stable sort of the two runs is their merge, in which the pointers are
    the counts of the ends of either run so far.
    """
    both = np.concatenate([ends_a, ends_b])
    order = np.argsort(both, kind="stable")
    of_a = order < len(ends_a)
    new = np.append(True, both[order[1:]] != both[order[:-1]]) if len(order) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    pointer_a, pointer_b = (np.cumsum(x) - x for x in (of_a.astype(np.int64), (~of_a).astype(np.int64)))
    return pointer_a[at], pointer_b[at], np.diff(np.append(at, len(order))) == 2


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices of all ranges of so many from each start, one range after the other."""
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) + np.repeat(starts - before, counts)


#: A part's ids on both sides, or None where a tokenizer's bytes are not the part's.
_Part = tuple[list[int], list[int]] | None


class Aligner:
    """Aligns texts of a block. a_path: ranks of a byte-level vocabulary; b_path: a piece model."""

    def __init__(self, a_path: str | None = None, b_path: str | None = None) -> None:
        a_path = a_path or tokens.ranks_path()
        self.encode_a = tokens.byte_level(a_path, plain=True)
        self.model_b = tokens.piece_model(b_path or tokens.pieces_path())
        ranks = tokens.ranks(a_path)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.bytes_a[i] = piece
        self.bytes_b = tokens.piece_bytes(b_path or tokens.pieces_path())
        self.len_a, self.len_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.bytes_a, self.bytes_b))
        # An id as text with what follows it: within a side, after a group's last token of a, after its last of b.
        self.size = max(len(self.bytes_a), len(self.bytes_b))
        self.names = np.array([f"{i}{after}" for after in ",|;" for i in range(self.size)], dtype=object)
        self.known: dict[str, _Part] = {}

    def encoded(self, parts: list[str]) -> list[_Part]:
        """The ids of new parts. That the bytes are right is seen for all together, and part by part only if they are not."""
        a = [self.encode_a(f" {p}") for p in parts]
        b = self.model_b.encode(parts, num_threads=1) if parts else []
        ends = np.cumsum([len(p.encode()) + 1 for p in parts], dtype=np.int64)
        same = all(np.array_equal(self.ends(sizes, ids), ends) for sizes, ids in ((self.len_a, a), (self.len_b, b)))
        whole = f" {' '.join(parts)}".encode() if parts else b""
        if same and all(self.joined(names, itertools.chain.from_iterable(ids)) == whole for names, ids in ((self.bytes_a, a), (self.bytes_b, b))):
            return list(zip(a, b, strict=True))
        right = lambda p, x, y: self.joined(self.bytes_a, x) == f" {p}".encode() == self.joined(self.bytes_b, y)
        return [(x, y) if right(p, x, y) else None for p, x, y in zip(parts, a, b, strict=True)]

    @staticmethod
    def ends(sizes: np.ndarray, ids: list[list[int]]) -> np.ndarray:
        """Where the bytes of each list of ids end, one list after the other."""
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64)
        return np.append(0, np.cumsum(sizes[flat]))[np.cumsum([len(x) for x in ids], dtype=np.int64)]

    @staticmethod
    def joined(names: list[bytes], ids: Iterable[int]) -> bytes:
        return b"".join(map(names.__getitem__, ids))

    def parts(self, texts: list[str | None]) -> tuple[list[_Part], list[list[int]]]:
        """The different parts of the texts, and for each text the numbers of its parts; none if one cannot be aligned."""
        number: dict[str, int] = {}
        of = [[number.setdefault(p, len(number)) for p in _CUT.split(text)] if text else [] for text in texts]
        new = [p for p in number if p not in self.known]
        own = dict(zip(new, self.encoded(new), strict=True))
        found = [own[p] if p in own else self.known[p] for p in number]
        if len(self.known) + len(own) > REMEMBERED:
            self.known.clear()
        self.known |= {p: x for p, x in own.items() if len(p) <= SHORT}
        lost = {k for k, p in enumerate(found) if p is None}
        return found, [x if not lost or lost.isdisjoint(x) else [] for x in of]

    def block(self, texts: list[str | None]) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
        """A row per text with counts, groups and links (numbers of pairs) and how often each; the pairs; documents of each."""
        found, of = self.parts(texts)
        sides = [[p[side] if p else [] for p in found] for side in (0, 1)]
        n_a, n_b = (np.array([len(x) for x in side], dtype=np.int64) for side in sides)
        ids_a, ids_b = (np.fromiter(itertools.chain.from_iterable(side), np.int64) for side in sides)
        at_a, at_b, ends = merged(np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b]))
        part_of = np.repeat(np.arange(len(found)), n_a)
        pairs, link = np.unique(ids_a[at_a] << 32 | ids_b[at_b], return_inverse=True)
        n_links = np.bincount(part_of[at_a], minlength=len(found))
        n_groups = np.bincount(part_of[at_a], weights=ends, minlength=len(found)).astype(np.int64)
        groups = self.groups(ids_a, ids_b, at_a, at_b, ends, n_a + n_b)
        first_link = np.cumsum(n_links) - n_links

        sizes = np.array([len(x) for x in of], dtype=np.int64)
        numbers = np.fromiter(itertools.chain.from_iterable(of), np.int64)
        doc = np.repeat(np.arange(len(texts)), sizes)
        total = lambda per_part: np.bincount(doc, weights=per_part[numbers], minlength=len(texts)).astype(np.int64)
        links = link[_ragged(first_link[numbers], n_links[numbers])]
        own, times = np.unique(np.repeat(doc, n_links[numbers]) * max(1, len(pairs)) + links, return_counts=True)
        of_pair, cuts = own % max(1, len(pairs)), np.searchsorted(own, np.arange(1, len(texts)) * max(1, len(pairs)))
        text_of = lambda x: hashlib.sha256(";".join([groups[k] for k in x]).encode()).hexdigest() if x else ""
        rows = pd.DataFrame({
            "n_a": total(n_a), "n_b": total(n_b), "n_groups": total(n_groups), "n_links": total(n_links), "groups_sha256": [text_of(x) for x in of],
            "links": [x.astype("<u4").tobytes() for x in np.split(of_pair, cuts)], "times": [x.astype("<u4").tobytes() for x in np.split(times, cuts)],
        })
        return rows, pairs, np.bincount(of_pair, minlength=len(pairs))

    def groups(self, ids_a: np.ndarray, ids_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The groups of each part as text: of each group the ids of a, a bar, the ids of b."""
        last_a, last_b = at_a[ends], at_b[ends]
        after_a, after_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        after_a[last_a], after_b[last_b] = 1, 2
        # A group's tokens of a stand before its tokens of b.
        group_a, group_b = (np.cumsum(after > 0) - (after > 0) for after in (after_a, after_b))
        place = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
        names = self.names[np.concatenate([ids_a + self.size * after_a, ids_b + self.size * after_b])[place]].tolist()
        stops = np.cumsum(sizes).tolist()
        return ["".join(names[i:j])[:-1] for i, j in zip([0, *stops], stops, strict=False)]


def _gathered(a_path: str | None, b_path: str | None, block_bytes: int):
    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(a_path, b_path)
        number = TaskContext.get().partitionId() << 32

        def done(ids: list, texts: list) -> pd.DataFrame:
            rows, pairs, docs = aligner.block(texts)
            asked = {"block": number, "a": (pairs >> 32).astype(np.int32), "b": (pairs & 0xFFFFFFFF).astype(np.int32), "docs": docs}
            whole = [{"block": number, "id": i, **row} for i, row in zip(ids, rows.to_dict("records"), strict=True)] + [asked]
            return pd.DataFrame({c: pd.Series([r.get(c) for r in whole], dtype=object) for c in (f.split()[0] for f in _BLOCKS.split(", "))})

        ids, texts, held = [], [], 0
        for frame in frames:
            for i, text in zip(frame["_id"].tolist(), frame["_text"].tolist(), strict=True):
                size = len(text.encode()) if text else 0
                if texts and held + size > block_bytes:
                    yield done(ids, texts)
                    ids, texts, held, number = [], [], 0, number + 1
                ids.append(i)
                texts.append(text or None)
                held += size
        if texts:
            yield done(ids, texts)

    return gather


def _counted(docs: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """The rows of a block with the counts of their links. Ids are texts here, since pandas would round long ones beside nulls."""
    counts, best_a, best_b = np.zeros((3, int(pairs["pos"].max()) + 1 if len(pairs) else 0), np.int64)
    for out, column in ((counts, "count"), (best_a, "best_a"), (best_b, "best_b")):
        out[pairs["pos"].to_numpy()] = pairs[column].to_numpy()
    sums = []
    for links, times in zip(docs["links"], docs["times"], strict=True):
        i, n = np.frombuffer(links, "<u4"), np.frombuffer(times, "<u4").astype(np.int64)
        sums.append([int((n * x[i]).sum()) for x in (best_a, best_b, counts)])
    out = docs[_DIGEST].reset_index(drop=True)
    out[["n_best", "n_best_b", "count_sum"]] = np.array(sums, dtype=np.int64).reshape(-1, 3)
    return out


def pair_counts(asked: DataFrame) -> DataFrame:
    """a, b and count, the number of documents that hold the pair linked, over all blocks."""
    return asked.groupBy("a", "b").agg(F.sum("docs").alias("count"))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """One row per document, and the counts of the pairs of ids.

    The rows: id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their id of a), n_best_b (that of
    their id of b), count_sum, groups_sha256. The counts: a, b, count. A null or empty text, and one whose tokens on either
    side do not give a space and the text, has no tokens: zeros and an empty digest. Rows with equal or null ids stay apart
    and count each. Paths name files that every executor has; by default the installed vocabularies. An empty table gives
    empty results; other columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").cast("string").alias("_id"), F.col(text_col).alias("_text"))
    blocks = common.written(source.mapInPandas(_gathered(a_path, b_path, block_bytes), _BLOCKS))
    asked = blocks.where("a is not null").select("block", F.posexplode(F.arrays_zip("a", "b", "docs"))).select("block", "pos", "col.a", "col.b", "col.docs").where("docs > 0")
    counts = common.written(pair_counts(asked))
    # A row per id: no more than the vocabularies have.
    most_a, most_b = (F.broadcast(counts.groupBy(side).agg(F.max("count").alias(f"most_{side}"))) for side in "ab")
    told = asked.join(counts, ["a", "b"]).join(most_a, "a").join(most_b, "b").select(F.col("block").alias("told"), "pos", "count", *[(F.col("count") == F.col(f"most_{s}")).cast("int").alias(f"best_{s}") for s in "ab"])
    rows = blocks.where("a is null").select("block", *_DIGEST, "links", "times").groupBy("block").cogroup(told.groupBy("told"))
    out = rows.applyInPandas(_counted, "id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, n_best_b long, count_sum long")
    return out.select(F.col("id").cast("long").alias(id_col), *[c for c in out.columns if c != "id"]), counts
