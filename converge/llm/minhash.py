"""Near-duplicate groups by SuperMinHash signatures, banding, verification on full shingle sets and union-find.

Equal shingle sets are brought together first, so a text with many copies is one representative. Documents that share a
band meet in a bucket; a bucket never emits all its pairs: each member is paired with the bucket's pivot, the member that
meets most others in all its buckets, as the original of many edited copies does. Links that are confirmed on the full
sets are grouped, and only buckets whose members are not yet in one group go on: there every member outside of the
bucket's largest group is paired with a pivot in it, and what still stays apart is compared in blocks of its buckets, inside
tasks, first by signatures and then, only what these do not refute, with texts; only links that hold on full sets leave
them. So each candidate pair is confirmed, refuted or joined already. A pivot that meets many is given its text once for
each MEETS of them, not once for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from converge.llm import common, graph
from converge.llm.common import U64

#: Bands and rows of a band. At a similarity of 0.75 a pair shares no band with probability (1 - 0.75**3)**24 < 2e-6.
BANDS, ROWS = 24, 3
#: Candidates whose signatures agree on a smaller share are not verified; at a similarity of 0.75, five standard deviations.
LEAST_AGREEMENT = 0.49
#: Bytes of text that are signed at a time: every shingle that is not settled at once has a permutation of its own.
SIGN_BYTES = 1 << 19
#: Documents of a block in which those that stay apart are compared; members that a pivot's text is sent along with.
BLOCK, MEETS = 1024, 64
#: Ids of documents to verify that may be broadcast (8 bytes each); beyond it they are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def super_minhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """Signatures of m slots; an empty set's slots stay infinite.

    In step i each element of each set puts i plus a fraction of its own into the slot at place i of its own random
    permutation (Fisher-Yates, a step at a time). After step i all values to come are at least i + 1, so a set stops as
    soon as its largest slot is below that.
    """
    sizes = np.array([len(s) for s in sets])
    signature = np.full((len(sets), m), np.inf)
    owner = np.repeat(np.arange(len(sets)), sizes)
    state = np.concatenate([s for s in sets] or [np.zeros(0, U64)]).astype(U64)
    place: np.ndarray | None = None
    flat = signature.reshape(-1)
    for i in range(m):
        if not len(owner):
            break
        state = common.mix(state + U64(0x9E3779B97F4A7C15))
        fraction = (state >> U64(32)).astype(np.float64) / 2.0**32
        j = i + (((state & U64(0xFFFFFFFF)) * U64(m - i)) >> U64(32)).astype(np.int64)
        if place is None:
            slot = j
        else:
            rows = np.arange(len(owner))
            slot = place[rows, j].astype(np.int64)
            place[rows, j] = place[rows, i]
            place[rows, i] = slot
        np.minimum.at(flat, owner * m + slot, i + fraction)
        going = (signature.max(axis=1) >= i + 1)[owner]
        if place is None:
            owner, state, slot = owner[going], state[going], slot[going]
            place = np.tile(np.arange(m, dtype=np.uint16), (len(owner), 1))
            rows = np.arange(len(owner))
            place[rows, slot] = 0
            place[rows, 0] = slot
        elif not going.all():
            owner, state, place = owner[going], state[going], place[going]
    return signature


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    bits = common.mix(signature.view(U64)).reshape(len(signature), -1, rows)
    key = np.arange(bits.shape[1], dtype=U64)[None, :] + U64(1)
    for k in range(rows):
        key = common.mix(key * U64(0x9E3779B97F4A7C15) + bits[:, :, k])
    return key


def _signer(bands: int, rows: int, width: int):
    m = bands * rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, data, off in common.pieces(batches, "_text", SIGN_BYTES):
            sets = common.shingle_sets(data, off, width)
            signature = super_minhash(sets, m)
            keys = band_keys(signature, rows).view(np.int64)
            short = (common.mix(signature.view(U64)) & U64(255)).astype(np.uint8)
            digests = [(0, 0) if not len(s) else (int(np.add.reduce(s).view(np.int64)), int(np.bitwise_xor.reduce(common.mix(s)).view(np.int64))) for s in sets]
            full = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [piece.column("_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()), pa.array([s.tobytes() for s in short], pa.binary()), pa.array([k if f else [] for k, f in zip(keys, full, strict=True)], pa.list_(pa.int64()))],
                names=["_id", "n", "d1", "d2", "sig", "keys"],
            )

    return sign


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array((a == b).mean(axis=1))], names=["a", "b", "agreement"])


def _set_of(text: bytes, width: int) -> np.ndarray:
    return common.shingle_sets(np.frombuffer(text, np.uint8), np.array([0, len(text)]), width)[0]


def _linked(mine: np.ndarray, theirs: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(mine, theirs, assume_unique=True))
    return 100 * shared >= percent * (len(mine) + len(theirs) - shared)


def _verifier(percent: int, width: int):
    def verify(members: pa.Table, pivots: pa.Table) -> pa.Table:
        """Links of one pivot with some of its members; ids that have several texts count with all of them."""
        own = [_set_of(t, width) for t in pivots["pivot"].to_pylist()]
        held = [any(_linked(x, y, percent) for x in own) for y in (_set_of(t, width) for t in members["text"].to_pylist())]
        return members.select(["a", "b"]).filter(pa.array(held, pa.bool_()))

    return verify


class _Links:
    """The candidates of one table of documents, and what is confirmed on full sets."""

    def __init__(self, texts: DataFrame, reps: DataFrame, percent: int, width: int) -> None:
        self.texts, self.reps, self.percent, self.width = texts, reps, percent, width

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs that the sizes of the sets allow and the signatures do not refute: a, b, agreement."""
        a, b = (self.reps.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}")) for x in "ab")
        sized = pairs.distinct().join(a, "a").join(b, "b").where(f"100 * least(na, nb) >= {self.percent} * greatest(na, nb)")
        return sized.select("a", "b", "sa", "sb").mapInArrow(_agreement, "a long, b long, agreement double").where(F.col("agreement") >= LEAST_AGREEMENT)

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (already stored) whose full sets are similar enough."""
        ids = pairs.select("a").union(pairs.select("b")).distinct().toDF("_id")
        texts = self.texts.join(F.broadcast(ids) if 2 * pairs.count() <= BROADCAST_IDS else ids, "_id", "left_semi").select("_id", F.encode("_text", "UTF-8").alias("text"))
        many = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEETS).alias("salts")).where("salts > 1")
        dealt = pairs.join(many, "a", "left").select("a", "b", F.pmod(F.xxhash64("b", F.lit(3)), F.coalesce("salts", F.lit(1))).alias("salt"))
        members = dealt.join(texts.withColumnRenamed("_id", "b"), "b")
        pivots = dealt.select("a", "salt").distinct().join(texts.withColumnRenamed("_id", "a"), "a").toDF("p", "part", "pivot")
        return members.groupBy("a", "salt").cogroup(pivots.groupBy("p", "part")).applyInArrow(_verifier(self.percent, self.width), "a long, b long")


def _hub(members: DataFrame) -> DataFrame:
    """The member of each bucket that meets most others, over all buckets."""
    return members.groupBy("key").agg(F.max(F.struct("degree", F.xxhash64("id", F.lit(1)), "id")).getField("id").alias("p"))


def _pivot(members: DataFrame, salt: int, where: Column | None = None) -> DataFrame:
    """One member of each bucket, drawn by a hash of member and bucket."""
    drawn = F.struct(F.xxhash64("id", "key", F.lit(salt)), "id")
    return members.groupBy("key").agg(F.min(drawn if where is None else F.when(where, drawn)).getField("id").alias("p"))


def _open_buckets(buckets: DataFrame, groups: DataFrame) -> DataFrame:
    """Members (key, id, g) of buckets that still hold more than one group, with `top`, the bucket's largest group."""
    named = buckets.join(groups.toDF("id", "g"), "id", "left").withColumn("g", F.coalesce("g", "id"))
    sizes = named.groupBy("key", "g").agg(F.count("*").alias("k"))
    mixed = sizes.groupBy("key").agg(F.max_by("g", F.struct("k", "g")).alias("top"), F.count("*").alias("groups")).where("groups > 1")
    return named.join(mixed.select("key", "top"), "key")


class _Block:
    """Rows of two blocks of a bucket: those that look (role 0), and all rows of the other block."""

    def __init__(self, table: pa.Table, percent: int) -> None:
        self.percent, self.key = percent, table["key"][0].as_py()
        self.ids, self.groups, self.n = (table[c].to_numpy() for c in ("id", "g", "n"))
        self.sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(len(self.ids), -1)
        self.open = [frozenset(k) for k in table["open"].to_pylist()]
        role = table["role"].to_numpy()
        self.looking, self.others = np.flatnonzero(role == 0), np.flatnonzero(role == 1)

    def candidates(self) -> Iterator[tuple[int, np.ndarray]]:
        """Rows that look, with the rows of other groups that size and signature do not refute. A pair is met in the least
        of the buckets that it shares, and nowhere else."""
        for x in self.looking.tolist():
            small, large = np.minimum(self.n[x], self.n[self.others]), np.maximum(self.n[x], self.n[self.others])
            near = self.others[(self.groups[self.others] != self.groups[x]) & (100 * small >= self.percent * large)]
            near = near[(self.sig[near] == self.sig[x]).mean(axis=1) >= LEAST_AGREEMENT]
            near = np.array([y for y in near.tolist() if min(self.open[x] & self.open[y]) == self.key], dtype=np.int64)
            if len(near):
                yield x, near


def _survivors(percent: int):
    def survive(table: pa.Table) -> pa.Table:
        """The rows that have a candidate in the block."""
        block, kept = _Block(table, percent), set()
        for x, near in block.candidates():
            kept.update([x, *near.tolist()])
        found = table.take(pa.array(sorted(kept), pa.int64()))
        return found.set_column(found.column_names.index("open"), "open", found["open"].cast(pa.list_(pa.int64())))

    return survive


def _compared(percent: int, width: int):
    def compare(table: pa.Table) -> pa.Table:
        """Links of candidates on full sets."""
        block, sets = _Block(table, percent), {}
        texts = table["text"]

        def set_of(row: int) -> np.ndarray:
            if row not in sets:
                sets[row] = _set_of(texts[row].as_py(), width)
            return sets[row]

        a, b = [], []
        for x, near in block.candidates():
            mine, theirs = set_of(x), [set_of(y) for y in near.tolist()]
            owner, every = np.repeat(np.arange(len(near)), [len(t) for t in theirs]), np.concatenate(theirs)
            at = np.minimum(np.searchsorted(mine, every), len(mine) - 1)
            shared = np.bincount(owner[mine[at] == every], minlength=len(near))
            union = len(mine) + np.array([len(t) for t in theirs]) - shared
            for y in near[100 * shared >= percent * union].tolist():
                a.append(min(block.ids[x], block.ids[y]))
                b.append(max(block.ids[x], block.ids[y]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


_ROWS = "key long, i int, j int, role int, id long, g long, n long, sig binary, open array<long>"


def _rest(open_: DataFrame, reps: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Links of what stays apart in buckets that several groups share.

    A bucket is cut into blocks of about BLOCK documents, and those outside of its largest group are compared with all
    documents of all its blocks, a pair of blocks in a task. Only ids, sizes and signatures are sent there; texts follow
    for the rows of a pair of blocks that have candidates in it.
    """
    nodes = open_.groupBy("id").agg(F.collect_set("key").alias("open")).join(reps.select("id", "n", "sig"), "id")
    sizes = open_.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = open_.join(nodes, "id").join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id", F.lit(9)), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    data = ["id", "g", "n", "sig", "open"]
    looking = own.where("g <> top").withColumn("j", F.explode(every)).select("key", F.col("block").alias("i"), "j", F.lit(0).alias("role"), *data)
    others = own.withColumn("i", F.explode(every)).select("key", "i", F.col("block").alias("j"), F.lit(1).alias("role"), *data)
    left = common.checkpoint(looking.union(others).groupBy("key", "i", "j").applyInArrow(_survivors(percent), _ROWS))
    with_text = left.join(texts.select(F.col("_id").alias("id"), F.encode("_text", "UTF-8").alias("text")), "id")
    return with_text.groupBy("key", "i", "j").applyInArrow(_compared(percent, width), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, width: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked if the sets of their width-word shingles have 100 * intersection >= percent * union. A null or
    blank text has an empty set and is linked with nothing; fewer words than width are one shingle. Rows with the same id
    are one node, linked through any of their texts' sets. A null id is linked with nothing, has a null component and is
    kept. Ties cannot occur: the smallest id of a group is kept. An empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    signed = common.checkpoint(source.mapInArrow(_signer(bands, rows, width), "_id long, n long, d1 long, d2 long, sig binary, keys array<long>"))
    known = signed.where("n > 0 and _id is not null")
    classes = common.checkpoint(known.groupBy("n", "d1", "d2").agg(F.min("_id").alias("id"), F.count("*").alias("copies")))
    reps = known.join(classes.select("id", "n", "d1", "d2").withColumnRenamed("id", "_id"), ["_id", "n", "d1", "d2"], "left_semi").dropDuplicates(["_id", "n", "d1", "d2"])
    reps = reps.select(F.col("_id").alias("id"), "n", "sig", "keys")
    entries = reps.select("id", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("k")).where("k > 1")
    meeting = common.checkpoint(entries.join(shared, "key"))
    degrees = meeting.groupBy("id").agg(F.sum("k").alias("degree"))
    buckets = common.checkpoint(meeting.select("key", "id").join(degrees, "id"))
    links = _Links(source, reps.select("id", "n", "sig"), percent, width)

    # Rows with one id but several texts join their sets' groups.
    same = known.join(classes.where("copies > 1"), ["n", "d1", "d2"]).where("_id <> id").select(F.col("id").alias("a"), F.col("_id").alias("b"))
    # First, each member with the pivots of its buckets; of these the one whose signature agrees best.
    star = buckets.join(_hub(buckets), "key").where("id <> p").select(F.col("p").alias("a"), F.col("id").alias("b"))
    star = common.checkpoint(links.likely(star))
    best = star.groupBy("b").agg(F.max_by("a", F.struct("agreement", "a")).alias("a")).select("a", "b")
    found = same.union(common.checkpoint(links.confirmed(common.checkpoint(best))))
    groups = graph.components(found)
    open_ = common.checkpoint(_open_buckets(buckets, groups))
    if not open_.isEmpty():
        # Every member outside of the largest group of its bucket, with a pivot in that group.
        pairs = open_.where("g <> top").join(_pivot(open_, 2, F.expr("g = top")), "key").select(F.col("p").alias("a"), F.col("id").alias("b"))
        pairs = common.checkpoint(links.likely(pairs).select("a", "b"))
        found = found.union(common.checkpoint(links.confirmed(pairs)))
        groups = graph.components(found)
        open_ = common.checkpoint(_open_buckets(buckets, groups))
    if not open_.isEmpty():
        groups = graph.components(found.union(_rest(open_, reps, source, percent, width)))
    out = signed.select("_id", "n").join(groups.toDF("_id", "component"), "_id", "left")
    component = F.coalesce("component", "_id")
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that near_duplicates keeps, with all their columns, whatever their names.

    Rows with a null id are kept, and so are all rows with the id that stays, repeated ones too. An empty table gives an
    empty result.
    """
    dropped = near_duplicates(docs, id_col, text_col, **options).where("not kept").select(F.col(id_col).alias("_dropped")).distinct()
    return common.restored(common.carried(docs, _id=F.col(id_col).cast("long")).join(dropped, F.col("_id") == F.col("_dropped"), "left_anti"), docs.columns)
