"""Reconciliation of two stores: a full comparison, or bucket digests with a closer look at the buckets that differ.

A digest is a few sums of hashes over documents, so it needs no order and no group that holds its documents: sums of parts
are the sums of the whole. Digests of the smallest children are made from the documents in one pass, and those of all above
are added up. A drill walks over this tree of digests and reads documents only where it ends.

Snapshots have document_id, checksum, tenant_id, cohort and is_deleted. Documents are compared by one full outer join on the
id, scopes and counts by sums over each side; findings come from one aggregate of what differs in them. Lists of affected ids are cut to the first 25 by rank, before anything is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from converge.functions.hashing import bucket_id, child_bucket_id, lanes
from converge.lineage import cut

AFFECTED = 25
FIELDS = ["checksum", "tenant_id", "cohort", "is_deleted"]


def joined(source: DataFrame, target: DataFrame) -> DataFrame:
    """document_id with the source's and target's fields; an absent document has null is_deleted on its side."""
    a, b = (df.select("document_id", *[F.col(c).alias(f"{side}_{c}") for c in FIELDS]) for df, side in ((source, "s"), (target, "t")))
    return a.join(b, "document_id", "full_outer")


def _here(side: str) -> Column:
    return F.coalesce(~F.col(f"{side}_is_deleted"), F.lit(False))


def _gone(side: str) -> Column:
    return F.coalesce(F.col(f"{side}_is_deleted"), F.lit(False))


def _codes() -> dict[str, Column]:
    """When a document has each of the codes."""
    s, t = _here("s"), _here("t")
    return {
        "missing_documents": s & ~t,
        "unexpected_documents": t & ~s,
        "checksum_drift": s & t & (F.col("s_checksum") != F.col("t_checksum")),
        "delete_state_mismatch": _gone("s") != _gone("t"),
    }


def differences(both: DataFrame) -> DataFrame:
    """document_id and code of each document that differs; a document can have several codes."""
    codes = F.array_compact(F.array(*[F.when(when, F.lit(code)) for code, when in _codes().items()]))
    return both.select("document_id", F.explode(codes).alias("code"))


def _sides(source: DataFrame, target: DataFrame) -> DataFrame:
    """The documents of both sides, one below the other: what is counted of a side does not go through a join, which would
    count a document again for each other of its id."""
    sides = [df.select("tenant_id", "cohort", F.coalesce("is_deleted", F.lit(False)).alias("gone"), F.col("is_deleted").isNotNull().alias("known"), F.lit(side).alias("side")) for df, side in ((source, "s"), (target, "t"))]
    return sides[0].unionByName(sides[1]).withColumn("here", F.col("known") & ~F.col("gone"))


def scope_counts(source: DataFrame, target: DataFrame, field: str, deleted: bool = False) -> DataFrame:
    """Scopes with the number of documents on either side; null and empty scopes are left out."""
    one = _sides(source, target).where("gone" if deleted else "here").select(F.col(field).alias("scope"), "side").where("scope is not null and scope <> ''")
    return one.groupBy("scope").agg(F.count_if(F.col("side") == "s").alias("source_count"), F.count_if(F.col("side") == "t").alias("target_count"))


def _listed(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """The first AFFECTED values of each group in order, and how many there are."""
    ranked = rows.withColumn("_at", F.row_number().over(Window.partitionBy(*by).orderBy(value)))
    totals = rows.groupBy(*by).agg(F.count("*").alias("total_affected"))
    first = ranked.where(F.col("_at") <= AFFECTED).groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias("affected_ids"))
    return first.join(totals, by)


SCOPES = (("tenant_id", "tenant_scope_mismatch", False), ("cohort", "cohort_scope_mismatch", False), ("tenant_id", "tenant_delete_scope_mismatch", True))


def _unbalanced(source: DataFrame, target: DataFrame) -> DataFrame:
    """code and value of all that does not balance, and how often: documents that differ, scopes and the whole count."""
    one = lambda when, code, value, n: F.when(when, F.struct(F.lit(code).alias("code"), value.alias("value"), n.cast("long").alias("n")))
    exploded = lambda df, found: df.select(F.explode(F.array_compact(F.array(*found))).alias("x")).select("x.*")
    documents = exploded(joined(source, target), [one(when, code, F.col("document_id"), F.lit(1)) for code, when in _codes().items()])
    weight = F.when(F.col("side") == "s", 1).otherwise(-1)
    counted = [one(F.col("here"), "count_mismatch", F.lit(""), weight)]
    counted += [one(F.col("gone" if deleted else "here") & (F.col(field) != ""), code, F.col(field), weight) for field, code, deleted in SCOPES]
    # A scope is added up before it is shuffled, so that not more rows than there are scopes leave a task.
    balance = documents.unionByName(exploded(_sides(source, target), counted)).groupBy("code", "value").agg(F.sum("n").alias("n")).where("n <> 0")
    return balance.withColumn("n", F.when(F.col("code").isin(*_codes()), F.col("n")).otherwise(1))


def findings(source: DataFrame, target: DataFrame, source_count: int | None = None, target_count: int | None = None) -> DataFrame:
    """code, severity, affected_ids, total_affected. Counts can be overridden, as by a store that only reports one.

    Where a store has an id more than once, each pair of its documents is a finding of its own.
    """
    each = _unbalanced(source, target).select("code", "value", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    listed = _listed(each, ["code"], "value")
    counted = F.col("code") == "count_mismatch"
    out = listed.select("code", F.when(counted, F.array().cast("array<string>")).otherwise(F.col("affected_ids")).alias("affected_ids"), F.when(counted, 0).otherwise(F.col("total_affected")).alias("total_affected"))
    if source_count is not None or target_count is not None:
        n = lambda side, given: F.lit(given).cast("long") if given is not None else F.count_if(F.col("here") & (F.col("side") == side))
        counts = _sides(source, target).agg(n("s", source_count).alias("a"), n("t", target_count).alias("b")).where("a <> b").select(F.lit("count_mismatch").alias("code"), F.array().cast("array<string>").alias("affected_ids"), F.lit(0).cast("long").alias("total_affected"))
        out = out.where(~counted).unionByName(counts)
    return out.withColumn("severity", F.lit("critical"))


def passed(findings_: DataFrame) -> DataFrame:
    """One row: whether no finding is critical."""
    return findings_.agg((~F.coalesce(F.bool_or(F.col("severity") == "critical"), F.lit(False))).alias("passed"))


def in_buckets(snapshot: DataFrame, buckets: int = 1024) -> DataFrame:
    return snapshot.withColumn("bucket_id", bucket_id(F.col("document_id"), buckets))


def in_children(snapshot: DataFrame, depth: int, fanout: int = 16) -> DataFrame:
    """Documents in the children of their buckets."""
    return snapshot.withColumn("bucket_id", child_bucket_id(F.col("bucket_id"), depth, F.col("document_id"), fanout))


#: Numbers of 32 bits in a digest, 128 bits of a hash; their sums have room for 2**31 documents.
LANES = 4
_SUMS = {"aggregate": "_line", "tenant_scope": "_tenant", "cohort_scope": "_cohort"}


def _weighed(documents: DataFrame) -> DataFrame:
    """What each document adds to its buckets' digests: its line, its tenant and its cohort, each hashed into lanes."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = F.concat_ws("|", F.col("document_id"), part("checksum"), part("tenant_id"), part("cohort"), F.when(F.col("is_deleted"), "1").otherwise("0"))
    scope = lambda c: F.when(part(c) != "", lanes(F.md5(part(c).cast("binary")), LANES))
    return documents.withColumns({"_line": lanes(F.md5(line.cast("binary")), LANES), "_tenant": scope("tenant_id"), "_cohort": scope("cohort")})


def _sums() -> list[Column]:
    hashed = [F.coalesce(F.sum(F.get(c, F.lit(k))), F.lit(0)).alias(f"{name}_{k}") for name, c in _SUMS.items() for k in range(LANES)]
    return [F.count_if(~F.col("is_deleted")).alias("active_count"), F.count_if("is_deleted").alias("deleted_count"), *hashed]


def _told(sums: DataFrame) -> DataFrame:
    """Digests as texts in the place of their sums."""
    checksums = {f"{name}_checksum": F.sha2(F.concat_ws(":", *[F.col(f"{name}_{k}").cast("string") for k in range(LANES)]), 256) for name in _SUMS}
    return sums.withColumns(checksums).drop(*[f"{name}_{k}" for name in _SUMS for k in range(LANES)])


def digests(bucketed: DataFrame) -> DataFrame:
    """A row per bucket: active_count, deleted_count and three checksums, of its documents and of its scopes' counts."""
    return _told(_weighed(bucketed).groupBy("bucket_id").agg(*_sums()))


def with_paths(snapshot: DataFrame, buckets: int = 1024, depths: int = 3, fanout: int = 16) -> DataFrame:
    """Documents with path, the ids of their bucket, of its child and so on, as many as there are depths."""
    # Each id is a generated row's, so that it is not made again in those of its children and wherever paths are used.
    ids = lambda df, k, made: df.select("*", F.explode(F.array(made)).alias(f"_at{k}"))
    out = ids(snapshot, 1, bucket_id(F.col("document_id"), buckets))
    for depth in range(1, depths):
        out = ids(out, depth + 1, child_bucket_id(F.col(f"_at{depth}"), depth, F.col("document_id"), fanout))
    return out.select(*snapshot.columns, F.array(*[F.col(f"_at{k}") for k in range(1, depths + 1)]).alias("path"))


def tree(paths: DataFrame, depths: int = 3) -> DataFrame:
    """depth, bucket_id, parent and the digest of every bucket and child; documents are read once, for the deepest.

    All digests above are sums of those below, as many rows as there are children.
    """
    leaves = cut(_weighed(paths).groupBy("path").agg(*_sums()))
    sums = [c for c in leaves.columns if c != "path"]
    levels = [leaves]
    for depth in range(depths - 1, 0, -1):
        levels.append(levels[-1].groupBy(F.slice("path", 1, depth).alias("path")).agg(*[F.sum(c).alias(c) for c in sums]))
    every = reduce(DataFrame.unionByName, levels)
    depth = F.size("path")
    return _told(every.select(depth.alias("depth"), F.element_at("path", -1).alias("bucket_id"), F.coalesce(F.get("path", depth - 2), F.lit("")).alias("parent"), *sums))


DIGEST = ["active_count", "deleted_count", "aggregate_checksum", "tenant_scope_checksum", "cohort_scope_checksum"]


def compare_digests(source: DataFrame, target: DataFrame) -> DataFrame:
    """bucket_id and code (bucket_missing or bucket_mismatch) of the buckets that differ, with their larger size."""
    a, b = (df.select("bucket_id", F.struct(*DIGEST).alias(side)) for df, side in ((source, "s"), (target, "t")))
    both = a.join(b, "bucket_id", "full_outer").where(~F.col("s").eqNullSafe(F.col("t")))
    size = lambda side: F.coalesce(F.col(side)["active_count"] + F.col(side)["deleted_count"], F.lit(0))
    return both.select("bucket_id", F.when(F.col("s").isNull() | F.col("t").isNull(), "bucket_missing").otherwise("bucket_mismatch").alias("code"), F.greatest(size("s"), size("t")).alias("size"))


def compare_leaves(source: DataFrame, target: DataFrame) -> DataFrame:
    """Findings of each bucket, of active documents only: bucket_id, code, affected_ids, total_affected."""
    a, b = (df.where("not is_deleted").select("bucket_id", "document_id", F.col("checksum").alias(side)) for df, side in ((source, "s"), (target, "t")))
    both = a.join(b, ["bucket_id", "document_id"], "full_outer")
    code = F.when(F.col("t").isNull(), "bucket_missing_documents").when(F.col("s").isNull(), "bucket_unexpected_documents").when(F.col("s") != F.col("t"), "bucket_checksum_drift")
    return _listed(both.select("bucket_id", "document_id", code.alias("code")).where("code is not null"), ["bucket_id", "code"], "document_id")


def drilled(source: DataFrame, target: DataFrame, buckets: int = 1024, most_buckets: int | None = 16, depths: int = 3, leaf_size: int = 128, fanout: int = 16, remote: bool = False) -> DataFrame:
    """All findings of a comparison by buckets: bucket_id, code, severity, affected_ids, total_affected.

    Buckets that differ, the first most_buckets of them (None: all, as for remote stores), are compared document by document if
    they are small or deep enough, and else split into children. A remote comparison looks only into children whose digests
    differ and reports these; a local one looks into all. A bucket on one side only has a warning locally and nothing more.

    Each side is read twice: for its tree of digests, and for the documents of the buckets where the walk ended.
    """
    paths = [with_paths(df, buckets, depths, fanout) for df in (source, target)]
    found, leaves = walked(*[tree(p, depths) for p in paths], most_buckets, depths, leaf_size, remote)
    return found.unionByName(ended(*paths, leaves))


def walked(source_tree: DataFrame, target_tree: DataFrame, most_buckets: int | None, depths: int, leaf_size: int, remote: bool) -> tuple[DataFrame, DataFrame]:
    """What a walk over two trees finds by digests, and the buckets and children in which it ends, which are to be compared."""
    a, b = (t.select("depth", "bucket_id", "parent", F.struct(*DIGEST).alias(side)) for t, side in ((source_tree, "s"), (target_tree, "t")))
    size = lambda side: F.coalesce(F.col(side)["active_count"] + F.col(side)["deleted_count"], F.lit(0))
    code = F.when(F.col("s").isNull() | F.col("t").isNull(), "bucket_missing").otherwise("bucket_mismatch")
    # A row per bucket and child, however many documents there are.
    both = a.join(b, ["depth", "bucket_id", "parent"], "full_outer")
    nodes = cut(both.select("depth", "bucket_id", "parent", code.alias("code"), F.greatest(size("s"), size("t")).alias("size"), (~F.col("s").eqNullSafe(F.col("t"))).alias("differs")))
    reported = lambda rows, code, severity: rows.select("bucket_id", code.alias("code"), F.lit(severity).alias("severity"), F.array("bucket_id").alias("affected_ids"), F.lit(1).cast("long").alias("total_affected"))
    off = nodes.where("depth = 1 and differs")
    found = [reported(off, F.col("code"), "critical")]
    open_ = off if most_buckets is None else off.orderBy("bucket_id").limit(most_buckets)
    ends = []
    for depth in range(1, depths + 1):
        if depth > 1:
            inside = ends[-1].where(~F.col("leaf")).select(F.col("bucket_id").alias("parent"))
            open_ = nodes.where((F.col("depth") == depth) & (F.col("differs") | F.lit(not remote))).join(inside, "parent", "left_semi")
            if remote:
                found.append(reported(open_, F.col("code"), "critical"))
        if not remote:
            found.append(reported(open_.where("code = 'bucket_missing'"), F.lit("bucket_drilldown_unavailable"), "warning"))
        ends.append(cut(open_.where("code <> 'bucket_missing'").select("depth", "bucket_id", ((F.col("size") <= leaf_size) | (F.col("depth") == depths)).alias("leaf"))))
    return reduce(DataFrame.unionByName, found), reduce(DataFrame.unionByName, ends).where("leaf").select("bucket_id")


def ended(source_paths: DataFrame, target_paths: DataFrame, leaves: DataFrame) -> DataFrame:
    """Findings of the documents in the buckets and children where a walk ended."""
    top = leaves.select(F.substring_index("bucket_id", "/", 1).alias("_top")).distinct()
    mine = lambda df: df.join(top, F.get("path", F.lit(0)) == F.col("_top"), "left_semi").withColumn("bucket_id", F.explode("path")).join(leaves, "bucket_id", "left_semi")
    compared = compare_leaves(mine(source_paths), mine(target_paths))
    return compared.select("bucket_id", "code", F.lit("critical").alias("severity"), "affected_ids", "total_affected")
