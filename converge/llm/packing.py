"""Packing of token sequences by a grouping genetic algorithm on islands.

Texts are tokenised where they lie and only lengths travel. Pieces fall by a hash into populations of about GROUP pieces.
Each population evolves on several islands; the genes are whole bins. A child gets well-filled bins of its second parent,
loses its own bins that hold one of the injected pieces, and the pieces that this displaces are put back by best fit,
longest first. After an epoch the elite of each island migrates to the next one, and last the best island wins.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from converge.llm import common, tokens

CAPACITY = 2048
#: The id that ends each document.
END_ID = 0
#: Pieces of one population, about.
GROUP = 4096
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 3, 3, 12, 6

def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Starts and lengths of the pieces of n ids: all of full length but the first, which has the rest."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _pieces(path: str | None, capacity: int):
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokens.byte_level(path or tokens.ranks_path())
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column("_text")):
                t = text.as_py()
                ids = np.array([*(ids_of(t) if t else ()), END_ID], dtype="<u4")
                for k, (s, n) in enumerate(cut(len(ids), capacity)):
                    at.append(row)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[s : s + n].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["_id", "piece", "start", "length", "ids_crc32"],
            )

    return tokenise


Bins = list[list[int]]


class _Population:
    """Bins of the pieces with these sizes; a solution is a list of bins, each a list of piece numbers."""

    def __init__(self, sizes: list[int], capacity: int, seed: int) -> None:
        self.sizes, self.capacity, self.random = sizes, capacity, random.Random(seed)
        self.least = -(-sum(sizes) // capacity)

    def put(self, bins: Bins, pieces: list[int]) -> Bins:
        """Add the pieces in their order, each to the bin that it leaves least room in, or to a new one."""
        by_room: dict[int, list[int]] = {}
        rooms = 0  # bit r is set if a bin has room r
        for b, bin_ in enumerate(bins):
            room = self.capacity - sum(self.sizes[i] for i in bin_)
            by_room.setdefault(room, []).append(b)
            rooms |= 1 << room
        for i in pieces:
            size = self.sizes[i]
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                same = by_room[room]
                b = same.pop()
                if not same:
                    rooms &= ~(1 << room)
                bins[b].append(i)
            else:
                room, b = self.capacity, len(bins)
                bins.append([i])
            room -= size
            by_room.setdefault(room, []).append(b)
            rooms |= 1 << room
        return bins

    def longest_first(self, pieces: list[int], noise: float = 0.0) -> list[int]:
        return sorted(pieces, key=lambda i: -self.sizes[i] * (1 + noise * self.random.random()))

    def fill(self, bin_: list[int]) -> int:
        return sum(self.sizes[i] for i in bin_)

    def fitness(self, bins: Bins) -> tuple[int, float]:
        """Fewer bins first, then the mean square of their fill: full bins beside empty ones over even ones."""
        return -len(bins), sum((self.fill(b) / self.capacity) ** 2 for b in bins)

    def child(self, one: Bins, other: Bins) -> Bins:
        ranked = sorted(other, key=self.fill, reverse=True)
        well = ranked[: max(1, len(ranked) // 2)]
        injected = self.random.sample(well, max(1, len(well) // 2))
        taken = {i for b in injected for i in b}
        stay, displaced = [], []
        for b in one:
            if taken.isdisjoint(b):
                stay.append(list(b))
            else:
                displaced += [i for i in b if i not in taken]
        # Mutation: the emptiest of the bins that stay are given up as well.
        stay.sort(key=self.fill)
        lost = min(len(stay), 1 + self.random.randrange(4))
        displaced += [i for b in stay[:lost] for i in b]
        return self.put(stay[lost:] + [list(b) for b in injected], self.longest_first(displaced))

    def evolve(self, start: list[Bins], generations: int, population: int) -> Bins:
        everyone = list(range(len(self.sizes)))
        living = list(start)
        while len(living) < population:
            living.append(self.put([], self.longest_first(everyone, 0.0 if not living else 0.15)))
        living.sort(key=self.fitness, reverse=True)
        for _ in range(generations):
            if len(living[0]) <= self.least:
                break
            one, other = self.random.sample(living, 2)
            living.append(self.child(one, other))
            living.sort(key=self.fitness, reverse=True)
            living = living[:population]
        return living[0]


_SOLUTION = "group long, island int, id array<long>, piece array<int>, start array<long>, length array<long>, ids_crc32 array<long>, bin array<int>"


def _solution(like: dict, group: int, island: int, bins: Bins) -> pa.Table:
    where = [0] * len(like["length"])
    for b, bin_ in enumerate(bins):
        for i in bin_:
            where[i] = b
    return pa.table({"group": pa.array([group], pa.int64()), "island": pa.array([island], pa.int32()), "id": pa.array([like["id"]], pa.list_(pa.int64())), "piece": pa.array([like["piece"]], pa.list_(pa.int32())), **{c: pa.array([like[c]], pa.list_(pa.int64())) for c in ("start", "length", "ids_crc32")}, "bin": pa.array([where], pa.list_(pa.int32()))})


def _bins(where: list[int]) -> Bins:
    found: dict[int, list[int]] = {}
    for i, b in enumerate(where):
        found.setdefault(b, []).append(i)
    return list(found.values())


def _founded(capacity: int, generations: int, population: int):
    def found(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("_id", "ascending"), ("piece", "ascending"), ("start", "ascending"), ("length", "ascending"), ("ids_crc32", "ascending")])
        like = {"id": rows["_id"].to_pylist()} | {c: rows[c].to_pylist() for c in ("piece", "start", "length", "ids_crc32")}
        group, island = (k.as_py() for k in key)
        people = _Population(like["length"], capacity, seed=group * 31 + island)
        return _solution(like, group, island, people.evolve([], generations, population))

    return found


def _epoch(capacity: int, generations: int, population: int, seed: int):
    def evolve(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        group, island = (k.as_py() for k in key)
        people = _Population(rows[0]["length"], capacity, seed=(group * 31 + island) * 31 + seed)
        return _solution(rows[0], group, island, people.evolve(sorted(_bins(r["bin"]) for r in rows), generations, population))

    return evolve


def _best(capacity: int):
    def best(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        people = _Population(rows[0]["length"], capacity, seed=0)
        bins = min((_bins(r["bin"]) for r in rows), key=lambda b: (tuple(-x for x in people.fitness(b)), b))
        order = [i for b in bins for i in b]
        offsets = [x for b in bins for x in np.cumsum([0] + [people.sizes[i] for i in b[:-1]]).tolist()]
        numbers = [key[0].as_py() << 32 | k for k, b in enumerate(bins) for _ in b]
        return pa.table({**{c: pa.array([rows[0][c][i] for i in order], pa.int32() if c == "piece" else pa.int64()) for c in ("id", "piece", "start", "length", "ids_crc32")}, "sequence_id": pa.array(numbers, pa.int64()), "offset": pa.array(offsets, pa.int64())})

    return best


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None, group: int = GROUP, islands: int = ISLANDS, epochs: int = EPOCHS, generations: int = GENERATIONS, population: int = POPULATION) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and an end id, so a null or empty text is one piece of length 1. Only documents longer
    than capacity are cut. Rows with equal or null ids are packed as rows of their own. tokenizer is a path to a file of
    ranks that every executor has; by default the installed public vocabulary. An empty table gives an empty result;
    other columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    pieces = common.checkpoint(source.mapInArrow(_pieces(tokenizer, capacity), "_id long, piece int, start long, length long, ids_crc32 long"))
    full = pieces.where(F.col("length") == capacity).select(F.col("_id").alias("id"), "piece", "start", "length", "ids_crc32", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group))
    # Every island of a population holds the same pieces.
    dealt = short.withColumn("group", F.pmod(F.xxhash64("_id", "piece", "ids_crc32"), F.lit(groups))).withColumn("island", F.explode(F.array(*[F.lit(k) for k in range(islands)])))
    living = dealt.groupBy("group", "island").applyInArrow(_founded(capacity, generations, population), _SOLUTION)
    for epoch in range(1, epochs):
        if islands > 1:
            living = common.checkpoint(living)
            migrants = living.withColumn("island", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int"))
            living = living.union(migrants).groupBy("group", "island").applyInArrow(_epoch(capacity, generations, population, epoch), _SOLUTION)
    packed = living.groupBy("group").applyInArrow(_best(capacity), "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return packed.unionByName(full).withColumnRenamed("id", id_col)
