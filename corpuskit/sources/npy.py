"""Vectors in ``.npy`` files as a data source: read in parallel by ranges of rows, written a file for each task.

Files are opened through pyarrow's file systems, which know local paths and the
common stores. A reader parses the headers at the driver, some hundred bytes a file,
and cuts every file into ranges of rows; a task seeks to its range. A file in the
order of Fortran is read a column's range at a time.

    spark.dataSource.register(NpySource)
    spark.read.format("npy").schema("row bigint, vector array<float>").load(path)
"""

from __future__ import annotations

import ast
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructType

MAGIC = b"\x93NUMPY"


@dataclass
class Header:
    dtype: str
    fortran: bool
    rows: int
    width: int
    start: int


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def read_header(file) -> Header:
    """The header of a matrix of numbers, or of a list of numbers, which is one column."""
    begin = file.read(8)
    if begin[:6] != MAGIC:
        raise ValueError("not an .npy file")
    size = struct.unpack("<H", file.read(2))[0] if begin[6] == 1 else struct.unpack("<I", file.read(4))[0]
    about = ast.literal_eval(file.read(size).decode("utf-8" if begin[6] == 3 else "latin1"))
    shape, kind = about["shape"], np.dtype(about["descr"])
    if len(shape) not in (1, 2) or kind.kind not in "fiu":
        raise ValueError(f"one or two dimensions of numbers are read, not {kind} {shape}")
    return Header(about["descr"], about["fortran_order"] and len(shape) == 2, shape[0], shape[1] if len(shape) == 2 else 1, file.tell())


def files_of(path: str) -> list[tuple[str, str]]:
    """(path, name) of the ``.npy`` files in a folder, by name, or of one file."""
    store, inner = open_store(path)
    if store.get_file_info(inner).type == fs.FileType.File:
        return [(inner, inner.rsplit("/", 1)[-1])]
    found = store.get_file_info(fs.FileSelector(inner))
    return sorted((i.path, i.base_name) for i in found if i.is_file and i.base_name.endswith(".npy"))


@dataclass
class Range(InputPartition):
    file: str
    header: Header
    first: int
    last: int
    ahead: int


class NpyReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = {f.name: f.dataType for f in schema.fields}
        self.path, self.most = options["path"], int(options.get("bytesPerTask", 64 << 20))
        bad = [n for n, t in self.names.items() if n not in ("row", "vector") or n == "vector" and t not in (ArrayType(FloatType()), ArrayType(DoubleType()))]
        if bad:
            raise ValueError(f"columns are row bigint and vector array<float> or array<double>, not {bad}")

    def partitions(self) -> list[Range]:
        store, parts, ahead = open_store(self.path)[0], [], 0
        for path, _ in files_of(self.path):
            with store.open_input_file(path) as file:
                h = read_header(file)
            step = max(1, self.most // max(1, h.width * np.dtype(h.dtype).itemsize))
            parts += [Range(path, h, a, min(a + step, h.rows), ahead) for a in range(0, h.rows, step)]
            ahead += h.rows
        return parts or [None]

    def read(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:
            return
        h, kind = part.header, np.dtype(part.header.dtype)
        wanted = self.names.get("vector")
        step = max(1, (4 << 20) // max(1, h.width * kind.itemsize))
        store = open_store(self.path)[0]
        with store.open_input_file(part.file) as file:
            for a in range(part.first, part.last, step):
                b = min(a + step, part.last)
                columns = {"row": pa.array(np.arange(part.ahead + a, part.ahead + b))}
                if wanted is not None:  # else no byte of the vectors is read
                    if h.fortran:
                        raw = [file.read_at((b - a) * kind.itemsize, h.start + (j * h.rows + a) * kind.itemsize) for j in range(h.width)]
                        block = np.stack([np.frombuffer(r, kind) for r in raw], 1) if raw else np.empty((b - a, 0), kind)
                    else:
                        size = h.width * kind.itemsize
                        block = np.frombuffer(file.read_at((b - a) * size, h.start + a * size), kind).reshape(b - a, h.width)
                    flat = np.ascontiguousarray(block, np.float32 if wanted.elementType == FloatType() else np.float64).ravel()
                    columns["vector"] = pa.ListArray.from_arrays(pa.array((np.arange(b - a + 1) * h.width).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([columns[n] for n in self.names], names=list(self.names))


@dataclass
class Written(WriterCommitMessage):
    made: str | None
    name: str


class NpyWriter(DataSourceWriter):
    """A task writes one file, by the number of its partition; files are renamed when all are written."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.kind = options["path"], "<f4" if schema["vector"].dataType.elementType == FloatType() else "<f8"
        self.run = uuid.uuid4().hex

    def write(self, rows) -> Written:
        from pyspark import TaskContext

        store, inner = open_store(self.path)
        store.create_dir(inner, recursive=True)
        number = TaskContext.get().partitionId()
        made, n, width = f"{inner}/.{self.run}-{number}-{uuid.uuid4().hex}", 0, None
        head = lambda n, w: (text := f"{{'descr': '{self.kind}', 'fortran_order': False, 'shape': ({n:>20}, {w:>10}), }}") + " " * (117 - len(text)) + "\n"
        body = f"{made}.body"
        with store.open_output_stream(body) as out:
            for row in rows:
                vector = np.asarray(row["vector"], self.kind)
                width = len(vector) if width is None else width
                if len(vector) != width:
                    raise ValueError("vectors of one file have one length")
                out.write(vector.tobytes())
                n += 1
        if n:  # the header holds the number of rows, so it is written when they are known
            with store.open_output_stream(made) as out, store.open_input_stream(body) as source:
                out.write(MAGIC + b"\x01\x00" + struct.pack("<H", 118) + head(n, width).encode())
                while piece := source.read(1 << 20):
                    out.write(piece)
        store.delete_file(body)
        return Written(made if n else None, f"part-{number:05d}.npy")

    def commit(self, messages: list[Written]) -> None:
        store, inner = open_store(self.path)
        for m in messages:
            if m is not None and m.made:
                store.move(m.made, f"{inner}/{m.name}")

    def abort(self, messages: list[Written | None]) -> None:
        store, inner = open_store(self.path)
        if store.get_file_info(inner).type == fs.FileType.Directory:
            for info in store.get_file_info(fs.FileSelector(inner)):
                if info.base_name.startswith(f".{self.run}-"):
                    store.delete_file(info.path)


class NpySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return "row bigint, vector array<double>"

    def reader(self, schema: StructType) -> NpyReader:
        return NpyReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> NpyWriter:
        return NpyWriter(self.options, schema)


def read_npy(spark: SparkSession, path: str, kind: str = "double", vectors: bool = True, bytes_per_task: int = 64 << 20) -> DataFrame:
    """(row, vector) of a file, or of the files of a folder one after the other; without ``vectors`` only the rows' numbers."""
    spark.dataSource.register(NpySource)
    schema = "row bigint" + (f", vector array<{kind}>" if vectors else "")
    return spark.read.format("npy").schema(schema).option("bytesPerTask", bytes_per_task).load(path)


def write_npy(vectors: DataFrame, path: str) -> None:
    """The column ``vector``, a file for each partition, rows in their order; vectors of a partition have one length, null none."""
    vectors.sparkSession.dataSource.register(NpySource)
    vectors.select("vector").write.format("npy").mode("append").save(path)


def read_or_compute_npy(spark: SparkSession, path: str, make, kind: str = "double") -> DataFrame:
    """Vectors kept at ``path``, made and written there if there are none."""
    store, inner = open_store(path)
    if store.get_file_info(inner).type == fs.FileType.NotFound or not files_of(path):
        write_npy(make(), path)
    return read_npy(spark, path, kind)
