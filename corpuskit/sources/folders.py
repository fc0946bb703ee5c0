"""Folders of very many small files, which tasks write, list and open themselves.

Spark's writer makes a folder for each file and sets its rights by a process; its
reader lists all files at the driver and opens 32 in a task. On local and mounted
paths tasks do all of this here; other stores are left to Spark.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = "path string, length bigint, content binary"
#: A batch of opened files ends at so many files or bytes.
AT_ONCE, BYTES = 1024, 8 << 20
#: Files are dealt to so many folders by their names.
FOLDERS = 256


def _tasks(spark: SparkSession) -> int:
    return max(8, 4 * spark.sparkContext.defaultParallelism)


def _store(spark: SparkSession, path: str):
    """(path, file system), both Hadoop's, the path in full."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(where), fs


def _pattern(spark: SparkSession, glob: str) -> str:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern.compile(glob).pattern()


def local_roots(spark: SparkSession, folder: str) -> list[str] | None:
    """What a path, which may have wildcards, names on this machine's file system; none if it is another or nothing is there."""
    where, fs = _store(spark, folder)
    path, roots = where.toUri().getPath(), [""]
    if fs.getUri().getScheme() != "file" or re.search(r"\{[^}]*/", path):
        return None
    for part in path.strip("/").split("/"):
        if re.search(r"[*?\[{\\]", part):
            fits = re.compile(_pattern(spark, part), re.DOTALL)
            roots = [f"{r}/{n}" for r in roots if os.path.isdir(r or "/") for n in sorted(os.listdir(r or "/")) if fits.fullmatch(n)]
        else:
            roots = [f"{r}/{part}" for r in roots]
    return [r for r in roots if os.path.exists(r)] or None


def _hidden(name: str) -> bool:
    """As Spark has it."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def files_in(root: str, named: re.Pattern, deep: bool) -> Iterator[tuple[str, int]]:
    """(path, length) of a file, or of the files in a folder; of folders in it if ``deep``, or if they are named as partitions are."""
    if not os.path.isdir(root):
        if named.fullmatch(name := os.path.basename(root)) and not _hidden(name):
            yield root, os.path.getsize(root)
        return
    todo = [root]
    while todo:
        with os.scandir(todo.pop()) as entries:
            for e in entries:
                if _hidden(e.name):
                    continue
                if e.is_dir():
                    if deep or "=" in e.name:
                        todo.append(e.path)
                elif named.fullmatch(e.name):
                    yield e.path, e.stat().st_size


def open_files(spark: SparkSession, folder: str, glob: str, deep: bool = False) -> DataFrame | None:
    """(path, length, content) of all files, those without bytes as well; lazy. None where ``local_roots`` is.

    Folders are listed by tasks, files dealt to tasks by their paths and opened a
    bounded number of bytes at a time, so no list of files is held anywhere.
    """
    if (roots := local_roots(spark, folder)) is None:
        return None
    named = _pattern(spark, glob)

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits = re.compile(named, re.DOTALL)

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["path", "length"])

        rows = []
        for b in batches:
            for root in b.column(0).to_pylist():
                for row in files_in(root, fits, deep):
                    rows.append(row)
                    if len(rows) == AT_ONCE:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            arrays = [pa.array([f"file:{r[0]}" for r in rows], pa.string()), pa.array([len(r[1]) for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["path", "length", "content"])

        rows, size = [], 0
        for b in batches:
            for path in b.column(0).to_pylist():
                with open(path, "rb") as file:
                    rows.append((path, file.read()))
                size += len(rows[-1][1])
                if len(rows) == AT_ONCE or size >= BYTES:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)

    sc = spark.sparkContext
    # From an RDD, of which Spark doesn't take the size to be small: by that of the list, the files would be broadcast in a join.
    listed = spark.createDataFrame(sc.parallelize([(r,) for r in roots], min(len(roots), _tasks(spark))), "root string").mapInArrow(listing, "path string, length bigint")
    return listed.repartition(_tasks(spark), "path").mapInArrow(opened, FILES)


def write_files(rows: DataFrame, path: str, end: str = "\n") -> None:
    """A text file ``name``.txt for each row of ``name`` (not null) and ``value``, which ``end`` follows.

    Rows that share a name have a file each, in folders of their own. A file is
    written aside and renamed, and tasks that run again write the same files.
    On other stores Spark writes a folder for each name, where ``name_of`` finds it as well.
    """
    spark = rows.sparkSession
    where, fs = _store(spark, path)
    rows = rows.select("name", "value").repartition(_tasks(spark), "name")
    if fs.getUri().getScheme() != "file":
        rows.write.partitionBy("name").option("lineSep", end).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
        return
    top, last = where.toUri().getPath(), end.encode()
    os.makedirs(top, exist_ok=True)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there, before, repeat = set(), None, 0
        for b in batches:
            for name, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if name is None:
                    raise ValueError("a file has a name")
                before, repeat = name, repeat + 1 if name == before else 0
                folder = f"{top}/{zlib.crc32(name.encode()) % FOLDERS:02x}" + (f"-{repeat}" if repeat else "")
                if folder not in there:
                    os.makedirs(folder, exist_ok=True)
                    there.add(folder)
                aside = f"{folder}/.{uuid.uuid4().hex}"
                with open(aside, "wb") as file:
                    file.write((value or b"") + last)
                os.replace(aside, f"{folder}/{name}.txt")
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    bytes_of = rows.sortWithinPartitions("name", "value").select("name", F.col("value").cast("binary"))
    bytes_of.mapInArrow(put, "n bigint").agg(F.sum("n")).first()


def name_of(path: Column) -> Column:
    """The name by which ``write_files`` wrote a file."""
    return F.regexp_extract(F.regexp_replace(path, r"name=([^/]+)/[^/]*$", "$1.txt"), r"([^/]*)\.txt$", 1)
