"""File listings, sizes and small pointer files, through the file system that Spark uses for a path.

All access to Hadoop's file systems is in this module; it needs a classic session.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratalake.session import scratch_dir

FILE_FIELDS = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("modified", T.LongType(), False),
    ]
)

#: Files held by the driver at a time while a folder is listed.
PAGE = 20_000


def _located(spark: SparkSession, path: str):
    """Hadoop path and the file system it belongs to."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def literal(path: str) -> str:
    """A path whose characters mean themselves where Spark accepts glob patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def from_metadata(file_path: str) -> str:
    """The path behind ``_metadata.file_path``, which is encoded like an address."""
    return unquote(file_path)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, files = _located(spark, path)
    return files.exists(hadoop)


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob pattern."""
    hadoop, files = _located(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(hadoop) or []]


def total_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes below the paths (or glob patterns); a path that does not exist counts nothing."""
    total = 0
    for path in paths:
        for found in matches(spark, path):
            hadoop, files = _located(spark, found)
            total += files.getContentSummary(hadoop).getLength()
    return total


def delete(spark: SparkSession, path: str) -> None:
    hadoop, files = _located(spark, path)
    files.delete(hadoop, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within a file system; one that does not exist is left out."""
    hadoop, files = _located(spark, source)
    if not files.exists(hadoop):
        return
    goal, _ = _located(spark, target)
    files.mkdirs(goal.getParent())
    if not files.rename(hadoop, goal):
        raise OSError(f"{source} cannot be moved to {target}")


def _visible(name: str) -> bool:
    """Spark's own rule: ``_name`` and ``.name`` are hidden, ``_name=value`` is a partition."""
    return not (name.startswith(".") or (name.startswith("_") and "=" not in name))


def _pages(spark: SparkSession, root: str, page: int) -> Iterator[list[tuple[str, int, int]]]:
    start, files = _located(spark, root)
    held: list[tuple[str, int, int]] = []
    folders = [start] if files.exists(start) else []
    while folders:
        entries = files.listStatusIterator(folders.pop())
        while entries.hasNext():
            status = entries.next()
            path = status.getPath()
            name = path.toString()
            if not _visible(name.rsplit("/", 1)[1]):
                continue
            if status.isDirectory():
                folders.append(path)
                continue
            held.append((name, status.getLen(), status.getModificationTime()))
            if len(held) == page:
                yield held
                held = []
    if held:
        yield held


def list_files(spark: SparkSession, root: str, page: int = PAGE) -> DataFrame:
    """``(path, length, modified)`` of every visible file below ``root``, as a stored table.

    The file system hands the entries over one by one; the driver keeps a page of them
    and appends it to the table, so its memory does not grow with the folder.
    """
    target, empty = scratch_dir(spark, "listing"), True
    for rows in _pages(spark, root, page):
        spark.createDataFrame(rows, FILE_FIELDS).coalesce(1).write.mode("append").parquet(target)
        empty = False
    return spark.createDataFrame([], FILE_FIELDS) if empty else spark.read.schema(FILE_FIELDS).parquet(target)


def read_pointer(spark: SparkSession, path: str) -> dict | None:
    """What ``write_pointer`` stored, or None."""
    hadoop, files = _located(spark, path)
    if not files.exists(hadoop):
        return None
    stream = files.open(hadoop)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def write_pointer(spark: SparkSession, path: str, content: dict) -> None:
    """Replace a small file in one step: readers see the old content or the new one, never a part.

    The content is written beside it and renamed over it.
    """
    target, files = _located(spark, path)
    beside, _ = _located(spark, f"{path}.{uuid.uuid4().hex}")
    stream = files.create(beside, True)
    stream.write(json.dumps(content).encode())
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(beside), files.makeQualified(target), options)
