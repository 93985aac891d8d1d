"""Union-find grouping of links that no machine holds as a whole."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from converge.llm import common


#: Links that one task merges, about; their nodes fit in tens of megabytes.
LINKS = 200_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one partition, flushed as links to the roots when it holds a million nodes."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def flush() -> pa.RecordBatch:
        links = [(x, r) for x in list(parent) if (r := root(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([r for _, r in links], pa.int64())], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            p, q = root(a), root(b)
            if p != q:
                parent[max(p, q)] = min(p, q)
        if len(parent) > 1_000_000:
            yield flush()
            parent.clear()
    yield flush()


def _starred(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step: every node's larger neighbours, then all its smaller ones, go to the least of them."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    lower = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(lower, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return small.where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """True if every node points to one other, and none of these points on."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def _merged(links: DataFrame) -> DataFrame:
    """Links as a forest in each partition, of about LINKS links: small graphs are settled at once."""
    stored = common.checkpoint(links)
    few = -(-stored.count() // LINKS)
    return common.checkpoint(stored.coalesce(max(1, few)).mapInArrow(_forest, "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) to one row (id, component) for each node of a component, component being its smallest id.

    Union-find inside partitions first leaves a forest in each. Then stars are formed over all partitions, with union-find
    inside partitions between, until each node points to its component's smallest id. Nodes that are their component's
    smallest id are missing. Null ends and loops are ignored; no links, no rows.
    """
    edges = _merged(links.select("a", "b").where("a <> b"))
    while not _settled(edges):
        edges = _merged(_starred(edges))
    return edges.toDF("id", "component")
