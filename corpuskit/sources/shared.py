"""Tables written to the cluster's shared folder, to cut lineage and to survive lost executors."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Tables that this process wrote and has not dropped.
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Only in local mode, as in tests, can it be unset: then a temporary folder is
    set, and removed at the end. A cluster's machines would each write to a
    folder of their own, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        folder = tempfile.mkdtemp(prefix="corpuskit-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/corpuskit/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def write(df: DataFrame, name: str) -> str:
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def read_back(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back."""
    return read_back(df, write(df, name))


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def put_once(spark: SparkSession, path: str, line: str) -> bool:
    """Write a small file by a rename that fails where there is one; returns whether it is this one that is there now."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    there = hadoop.Path(path)
    made = hadoop.Path(there.getParent(), f".{uuid.uuid4().hex}")
    fs = made.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(there.getParent())
    out = fs.create(made, False)
    out.write(bytearray(line.encode()))
    out.close()
    files = hadoop.FileContext.getFileContext(made.toUri() if fs.getUri().getScheme() is None else fs.getUri(), sc._jsc.hadoopConfiguration())
    try:
        files.rename(made, there, sc._gateway.new_array(hadoop.Options.Rename, 0))
    except Py4JJavaError as e:
        fs.delete(made, False)
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    return True


def children(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """What lies in a folder, as (address, length, time of the last change); nothing if it isn't there. One call."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(where)] if fs.exists(where) else []


@contextmanager
def dropping(spark: SparkSession) -> Iterator[list[str]]:
    """Afterwards, delete the tables written inside, but for the paths that are put into the list."""
    start, kept = len(_written), []
    yield kept
    for path in [p for p in _written[start:] if p not in kept]:
        drop(spark, path)
    _written[start:] = kept


def clear(spark: SparkSession) -> None:
    """Delete all tables that this process wrote here; for when results that read them are done with."""
    while _written:
        drop(spark, _written.pop())
