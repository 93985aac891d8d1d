"""A remote store of documents that is read page by page, as a data source: a partition for each bucket, tokens inside it.

A filter on bucket_id is pushed into the source, so buckets that nobody asks for are not fetched. A store says which buckets
it has and gives a page of a bucket and the token of the next one; it goes to the executors, so it holds addresses only.
"""

from __future__ import annotations

import base64
import json
import pickle
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from converge.operators import reconcile

SCHEMA = "bucket_id string, document_id string, checksum string, tenant_id string, cohort string, is_deleted boolean"
PAGE = 1000
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@dataclass(frozen=True)
class FolderStore:
    """Pages as JSON files below a folder of any file system that pyarrow knows: a folder for each bucket, a file for each page."""

    folder: str

    def _files(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.folder if "://" in self.folder or self.folder.startswith("file:") else f"file://{self.folder}")

    def buckets(self) -> list[str]:
        from pyarrow import fs

        files, root = self._files()
        return sorted(f.base_name.partition("=")[2] for f in files.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.Directory and f.base_name.startswith("bucket="))

    def page(self, bucket: str, token: str | None, size: int) -> tuple[list[dict], str | None]:
        """Up to `size` documents from the token on; the token is a byte and the file that it is in, so a page reads no more than itself."""
        from pyarrow import fs

        files, root = self._files()
        at, _, name = (token or "0/").partition("/")
        start, found, names = int(at), [], None
        while True:
            if name:
                with files.open_input_file(f"{root}/bucket={bucket}/{name}") as file:
                    lines, start, more = _lines(file, start, size - len(found))
                found += [json.loads(x) for x in lines]
                if more:
                    return found, f"{start}/{name}"
            # The folder is listed where a file ends, not for each page.
            if names is None:
                names = sorted(f.base_name for f in files.get_file_info(fs.FileSelector(f"{root}/bucket={bucket}", allow_not_found=True)) if f.base_name.startswith("part-"))
            name, start = next((n for n in names if n > name), None), 0
            if name is None:
                return found, None
            if len(found) == size:
                return found, f"0/{name}"


#: Bytes that a page is first looked for in, for each of its lines; more are read where lines are longer.
LINE = 256


def _lines(file, start: int, count: int) -> tuple[list[bytes], int, bool]:
    """Up to `count` lines of an open file from a byte on, the byte after them, and whether any are left."""
    file.seek(start)
    whole = file.size()
    read, parts, ends, step = 0, [], 0, max(1, count) * LINE
    while ends < count and start + read < whole:
        part = file.read(step)
        if not part:
            break
        parts.append(part)
        read, ends, step = read + len(part), ends + part.count(b"\n"), step * 2
    lines = b"".join(parts).split(b"\n")
    # What follows the last end of a line is a line too, if the file ends with it.
    if len(lines) > count or start + read < whole or not lines[-1]:
        lines = lines[: min(count, len(lines) - 1)]
    at = min(whole, start + sum(len(x) + 1 for x in lines))
    return lines, at, at < whole


def write_pages(snapshot: DataFrame, folder: str, buckets: int = 1024) -> FolderStore:
    """Store a snapshot for FolderStore."""
    rows = reconcile.in_buckets(snapshot, buckets).select(F.col("bucket_id").alias("bucket"), "document_id", "checksum", "tenant_id", "cohort", "is_deleted")
    rows.repartition("bucket").write.partitionBy("bucket").option("ignoreNullFields", False).json(folder)
    return FolderStore(folder)


class _Bucket(InputPartition):
    def __init__(self, bucket: str) -> None:
        self.bucket = bucket


class _Reader(DataSourceReader):
    def __init__(self, store, size: int) -> None:
        self.store, self.size, self.wanted = store, size, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("bucket_id",):
                named = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = named if self.wanted is None else self.wanted & named
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        return [_Bucket(b) for b in self.store.buckets() if self.wanted is None or b in self.wanted]

    def read(self, partition: _Bucket) -> Iterator[tuple]:
        token = None
        while True:
            rows, token = self.store.page(partition.bucket, token, self.size)
            for r in rows:
                yield partition.bucket, r["document_id"], r["checksum"], r["tenant_id"], r["cohort"], r["is_deleted"]
            if token is None:
                return


class PagedDocuments(DataSource):
    """Options: store (see read) and pageSize."""

    @classmethod
    def name(cls) -> str:
        return "paged_documents"

    def schema(self) -> StructType | str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(pickle.loads(base64.b64decode(self.options["store"])), int(self.options.get("pageSize", PAGE)))


def read(spark: SparkSession, store, page_size: int = PAGE) -> DataFrame:
    """All documents of a store, with bucket_id; a filter on it leaves buckets out before they are fetched."""
    spark.conf.set(PUSHDOWN, True)
    spark.dataSource.register(PagedDocuments)
    packed = base64.b64encode(pickle.dumps(store)).decode()
    return spark.read.format(PagedDocuments.name()).option("store", packed).option("pageSize", page_size).load()


def drilled(spark: SparkSession, source, source_tree: DataFrame, target, target_tree: DataFrame, buckets: int = 1024, depths: int = 3, leaf_size: int = 128, fanout: int = 16, page_size: int = PAGE) -> DataFrame:
    """All findings between two remote stores, of which each keeps its tree of digests (reconcile.tree): see reconcile.drilled.

    Documents are fetched for those buckets only in which the walk ended.
    """
    found, leaves = reconcile.walked(source_tree, target_tree, None, depths, leaf_size, True)
    # No more ids than there are buckets.
    tops = sorted(r[0] for r in leaves.select(F.substring_index("bucket_id", "/", 1)).distinct().collect())
    sides = [reconcile.with_paths(read(spark, s, page_size).where(F.col("bucket_id").isin(tops)).drop("bucket_id"), buckets, depths, fanout) for s in (source, target)]
    return found.unionByName(reconcile.ended(*sides, leaves))
