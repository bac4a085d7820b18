"""Delivered folders and file footers, looked up inside tasks.

A destination is a tree of Hive folders. Tasks list it, tenant by tenant, and open
footers, file by file; rows about partitions come back, and no file status passes
through the driver. Where Arrow has no file system for a root, Spark's own listing
serves instead, with its file index in the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ..columns import TENANT
from ..storage import path_exists, task_path, task_settings, task_store

FIELDS = "array<struct<name: string, type: string>>"
FOOTERS = f"path string, file string, rows bigint, bytes bigint, fields {FIELDS}"
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def visible(name: str) -> bool:
    """Names that Spark reads: no marks, no unfinished writes."""
    return not name.startswith(".") and (not name.startswith("_") or "=" in name)


def listed(store: pafs.FileSystem, folder: str) -> tuple[list[str], list[str]]:
    """Visible folders below ``folder`` and Parquet files in it, in order of name."""
    entries = store.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    shown = sorted((entry for entry in entries if visible(entry.base_name)), key=lambda entry: entry.base_name)
    folders = [entry.path for entry in shown if entry.type == pafs.FileType.Directory]
    return folders, [entry.path for entry in shown if entry.type == pafs.FileType.File and entry.base_name.endswith(".parquet")]


def below_tenant(folder: str) -> str:
    """The partition's path, from the tenant's folder on; empty outside of any."""
    parts = folder.rstrip("/").split("/")
    first = next((k for k, part in enumerate(parts) if part.startswith(f"{TENANT}=")), len(parts))
    return "/".join(parts[first:])


def _tenant_folders(store: pafs.FileSystem, folder: str) -> Iterator[str]:
    if below_tenant(folder):
        yield folder
        return
    for child in listed(store, folder)[0]:
        yield from _tenant_folders(store, child)


def _walk(store: pafs.FileSystem, folder: str) -> Iterator[tuple[str, list[str]]]:
    """Folders with Parquet files, and those files."""
    folders, files = listed(store, folder)
    if files:
        yield folder, files
    for child in folders:
        yield from _walk(store, child)


def _spread(paths: DataFrame) -> DataFrame:
    """Paths dealt over the cores; adaptive execution would pack so few bytes together."""
    return paths.repartition(paths.sparkSession.sparkContext.defaultParallelism, paths.columns[0])


def _expanded(paths: DataFrame, rows_of: Callable[[str], Iterable[tuple]], schema: str, kinds: dict[str, pa.DataType]) -> DataFrame:
    """What ``rows_of`` finds at each path, a thousand rows at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for path in batch.column(0).to_pylist():
                for row in rows_of(path):
                    rows.append(row)
                    if len(rows) == 1000:
                        yield _record_batch(rows, kinds)
                        rows = []
            if rows:
                yield _record_batch(rows, kinds)

    return paths.mapInArrow(run, schema)


def _record_batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))


class Tree:
    """A destination as tasks see it: where it starts and how to reach it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.exists = spark, path_exists(spark, root)
        self.settings = task_settings(spark, root)
        self.start = task_path(spark, root)

    @property
    def reachable(self) -> bool:
        return self.settings is not None

    def folders(self) -> DataFrame:
        """``(folder)`` of each tenant; the root's own listing is one task's work."""
        if not self.exists:
            return self.spark.createDataFrame([], "folder string")
        start = self.spark.createDataFrame([(self.start,)], "folder string").coalesce(1)
        if below_tenant(self.start):
            return start
        return _spread(_expanded(start, partial(_tenants_at, self.settings), "folder string", {"folder": pa.string()}))

    def partitions(self) -> DataFrame:
        """``(path)`` of each folder with files, spelled from the tenant on."""
        return _expanded(self.folders(), partial(_partitions_at, self.settings), "path string", {"path": pa.string()})

    def files(self, one_each: bool = False) -> DataFrame:
        """``(file)`` in all partitions, or the first one in each."""
        rows_of = partial(_files_at, self.settings, one_each)
        return _expanded(self.folders(), rows_of, "file string", {"file": pa.string()})


def _tenants_at(settings: dict[str, str], folder: str) -> Iterator[tuple]:
    for found in _tenant_folders(task_store(settings), folder):
        yield (found,)


def _partitions_at(settings: dict[str, str], folder: str) -> Iterator[tuple]:
    for found, _ in _walk(task_store(settings), folder):
        yield (below_tenant(found),)


def _files_at(settings: dict[str, str], one_each: bool, folder: str) -> Iterator[tuple]:
    for _, files in _walk(task_store(settings), folder):
        for file in files[:1] if one_each else files:
            yield (file,)


def _footer_at(settings: dict[str, str], file: str) -> Iterator[tuple]:
    """Path, name, rows, bytes and typed columns of one file, from its footer."""
    with task_store(settings).open_input_file(file) as opened:
        size, footer = opened.size(), pq.read_metadata(opened)
    written = (footer.metadata or {}).get(_SPARK_SCHEMA)
    if written:
        fields = json.loads(written)["fields"]
    else:  # not Spark's own file
        fields = from_arrow_schema(footer.schema.to_arrow_schema()).jsonValue()["fields"]
    named = [{"name": field["name"], "type": json.dumps(field["type"])} for field in fields]
    folder, _, name = file.rpartition("/")
    yield below_tenant(folder), name, footer.num_rows, size, named


def footers(spark: SparkSession, root: str, one_each: bool = False) -> DataFrame:
    """``(path, file, rows, bytes, fields)`` of every file below ``root``, or of one
    file of each partition.

    A load writes all files of a partition alike, so one of them tells its columns.
    """
    tree = Tree(spark, root)
    if not tree.reachable:
        raise ValueError(f"tasks cannot open files below {root}")
    kinds = {
        "path": pa.string(), "file": pa.string(), "rows": pa.int64(), "bytes": pa.int64(),
        "fields": pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())])),
    }
    return _expanded(_spread(tree.files(one_each)), partial(_footer_at, tree.settings), FOOTERS, kinds)


def column_history(found: DataFrame) -> DataFrame:
    """``(name, types, last_path, place)`` of every column that footers name: the
    types it ever had, the last partition that has it, and its place there."""
    columns = found.select("path", F.posexplode("fields").alias("place", "field"))
    newest = F.max(F.struct("path", "place"))
    grouped = columns.groupBy(F.col("field.name").alias("name")).agg(
        F.sort_array(F.collect_set("field.type")).alias("types"), newest.alias("newest")
    )
    return grouped.select("name", "types", F.col("newest.path").alias("last_path"), F.col("newest.place").alias("place"))


def partition_totals(found: DataFrame) -> DataFrame:
    """``(path, files, rows, bytes)`` of each partition that footers were read of."""
    return found.groupBy("path").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")
    )
