"""Replacing partitions of a Parquet or JSON table so that no crash loses a row.

New partitions are first written below ``_pending/<version>``, which readers of the table
do not see. Then one small manifest is put in place in a single rename: it names each
partition of the version and its files, and from then on the version counts. Only then are
the old folders swapped for the new ones, one by one. Whoever finds a manifest knows what is
still to be swapped: :func:`read_table` takes those partitions from the version, and the
next writer (:func:`recover`) swaps them before it does anything else. A version without a
manifest never counted and is dropped.

Beside the data lies ``_schema``, one file for each schema the table has had. Reading by the
last of them needs no footers, and gives null where an older file lacks a column.

One writer at a time. Between crashes the folder is an ordinary partitioned table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.session import read_if_exists

PENDING, SCHEMAS, MANIFEST = "_pending", "_schema", "manifest.json"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Folder:
    """A folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.root = path.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        """What lies directly in a folder, in order."""
        if not self.exists(name):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(name)))

    def files(self, name: str) -> list[str]:
        """All data files below a folder, relative to it."""
        base = self._fs.makeQualified(self._path(name)).toString().rstrip("/") + "/"
        found, each = [], self._fs.listFiles(self._path(name), True)
        while each.hasNext():
            relative = each.next().getPath().toString().removeprefix(base)
            if not relative.rpartition("/")[2].startswith(("_", ".")):
                found.append(relative)
        return found

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {self.root}/{source} to {target}")

    def write(self, name: str, text: str) -> None:
        """A small file, there as a whole or not at all."""
        part = f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(part), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(part, name)

    def read(self, name: str) -> str:
        source = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()


def _pending(folder: Folder) -> dict | None:
    """The manifest of a version that may not be wholly published."""
    name = f"{PENDING}/{MANIFEST}"
    return json.loads(folder.read(name)) if folder.exists(name) else None


def _published(folder: Folder, partition: str, files: Sequence[str]) -> bool:
    """Whether a partition's folder holds all files of the version."""
    return set(files) <= set(folder.names(partition))


def _publish(folder: Folder, manifest: dict) -> None:
    """Swap what is not swapped yet; may be stopped and run again at any point."""
    version = f"{PENDING}/{manifest['version']}"
    for partition in manifest["emptied"]:
        folder.delete(partition)
    for partition, files in manifest["partitions"].items():
        if not _published(folder, partition, files):
            folder.delete(partition)
            folder.move(f"{version}/{partition}", partition)
    folder.delete(f"{PENDING}/{MANIFEST}")
    folder.delete(PENDING)


def recover(spark: SparkSession, path: str) -> None:
    """Finish the version of a writer that was stopped, or drop what never counted."""
    folder = Folder(spark, path)
    if not folder.exists(PENDING):
        return
    manifest = _pending(folder)
    if manifest is None:
        folder.delete(PENDING)
    else:
        _publish(folder, manifest)


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    file_format: str = "parquet",
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    touched: Sequence[str] = (),
) -> None:
    """Replace the partitions present in ``df``, all of them or none; leave others alone.

    Partitions named in ``touched`` (as folders) that have no row any more are removed.

    ``df`` may read the table itself. The rebalance hint brings a partition's rows together
    so that small ones become one file, while AQE splits a partition too big for one task.
    ``finish`` is a narrow last step on the rows as they are written.
    """
    spark = df.sparkSession
    recover(spark, path)
    folder, version = Folder(spark, path), uuid.uuid4().hex
    rows = df.hint("rebalance", *partition_by)
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    staged = f"{folder.root}/{PENDING}/{version}"
    finish(rows).write.partitionBy(*partition_by).format(file_format).save(staged)
    partitions: dict[str, list[str]] = {}
    for file in folder.files(f"{PENDING}/{version}"):
        partition, _, name = file.rpartition("/")
        if partition:
            partitions.setdefault(partition, []).append(name)
    emptied = [p for p in touched if p not in partitions and folder.exists(p)]
    if not partitions and not emptied:
        folder.delete(PENDING)
        return
    manifest = {"version": version, "partitions": partitions, "emptied": emptied}
    folder.write(f"{PENDING}/{MANIFEST}", json.dumps(manifest))
    _publish(folder, manifest)


def partition_name(spark: SparkSession, values: Mapping[str, object]) -> str:
    """The folder of a partition, as Spark names it."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(
        utils.getPartitionPathString(name, None if value is None else str(value))
        for name, value in values.items()
    )


def partition_values(partition: str) -> dict[str, str | None]:
    """Names and values of a partition's folder, as ``day=2025-03-01/bucket=3``."""
    pairs = [part.partition("=") for part in partition.split("/")]
    return {name: None if value == _NO_VALUE else unquote(value) for name, _, value in pairs}


def _within(partitions: Sequence[str], schema: T.StructType) -> Column:
    def one(partition: str) -> Column:
        return reduce(and_, [
            F.col(name).eqNullSafe(F.lit(value).cast(schema[name].dataType))
            for name, value in partition_values(partition).items()
        ])

    return reduce(or_, [one(partition) for partition in partitions])


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    file_format: str = "parquet",
) -> DataFrame | None:
    """The table at ``path``, or None when nothing was written yet.

    What a stopped writer had not swapped yet is read from its version.
    """
    folder = Folder(spark, path)
    if not folder.exists():
        return None
    if schema is None:
        schema = last_schema(spark, path)
    published = _read(spark, folder.root, schema, file_format)
    manifest = _pending(folder)
    if manifest is None:
        return published
    waiting = [p for p, files in manifest["partitions"].items() if not _published(folder, p, files)]
    outdated = [*waiting, *(p for p in manifest["emptied"] if folder.exists(p))]
    if published is not None and outdated:
        published = published.filter(~_within(outdated, published.schema))
    if not waiting:
        return published
    staged = _read(spark, f"{folder.root}/{PENDING}/{manifest['version']}", schema, file_format)
    staged = staged.filter(_within(waiting, staged.schema))
    if published is None:
        return staged
    return published.unionByName(staged, allowMissingColumns=True)


def _read(spark: SparkSession, path: str, schema, file_format: str) -> DataFrame | None:
    if file_format == "parquet":
        return read_if_exists(spark, path, schema)
    try:
        return spark.read.schema(schema).format(file_format).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def schema_history(spark: SparkSession, path: str) -> list[T.StructType]:
    """Every schema the table has had, the newest last."""
    folder = Folder(spark, path)
    return [
        T.StructType.fromJson(json.loads(folder.read(f"{SCHEMAS}/{name}")))
        for name in folder.names(SCHEMAS)
        if not name.startswith(".")
    ]


def last_schema(spark: SparkSession, path: str) -> T.StructType | None:
    folder = Folder(spark, path)
    names = [name for name in folder.names(SCHEMAS) if not name.startswith(".")]
    return T.StructType.fromJson(json.loads(folder.read(f"{SCHEMAS}/{names[-1]}"))) if names else None


def record_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Note a schema before the first file is written by it; the order of columns is no change."""
    folder = Folder(spark, path)
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    known, last = folder.names(SCHEMAS), last_schema(spark, path)
    if last is None or {f.name: f.dataType for f in last} != {f.name: f.dataType for f in nullable}:
        folder.write(f"{SCHEMAS}/{len(known) + 1:06d}.json", json.dumps(nullable.jsonValue()))


def newest_partition(spark: SparkSession, path: str, column: str) -> str | None:
    """The greatest value of the first partition column, from folder names alone.

    Folders count, not rows; their values are compared as text, which orders ISO days.
    """
    folder = Folder(spark, path)
    names = folder.names()
    manifest = _pending(folder) if PENDING in names else None
    for partition in (manifest or {"partitions": {}})["partitions"]:
        names.append(partition.partition("/")[0])
    found = [partition_values(name)[column] for name in names if name.startswith(f"{column}=")]
    return max((value for value in found if value is not None), default=None)
