"""A table of JSON lines that grows by commits, each of which counts once or not at all.

A commit writes its rows to a folder of its own; then a small file that names the
folder and its number of rows is renamed into place, which file systems do at once
or not. Readers follow these files only. So rows of a run that was killed, or whose
commit was beaten by another of the same name, are never seen, and a run that starts
again finds all that was committed and nothing else.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.sources.shared import drop, exists, put_once

COMMIT = "batch string, folder string, n bigint"


class Ledger:
    """The table at ``path``, with rows of ``schema``."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def commits(self) -> list[dict]:
        """The commits by name; one small file each, listed by the driver."""
        if not exists(self.spark, f"{self.path}/commits"):
            return []
        found = self.spark.read.schema(COMMIT).json(f"{self.path}/commits/*.json").collect() if self._names("commits") else []
        return sorted((r.asDict() for r in found), key=lambda c: c["batch"])

    def _names(self, folder: str) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        fs = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def read(self) -> DataFrame:
        """All committed rows; before the first commit, none."""
        folders = [f"{self.path}/{c['folder']}" for c in self.commits() if c["n"]]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).json(folders)

    def append(self, rows: DataFrame, batch: str | None = None) -> bool:
        """Commit ``rows`` as ``batch``; false, and nothing is added, if a batch of this name is there already."""
        batch = batch or uuid.uuid4().hex
        if "/" in batch or batch.startswith((".", "_")):
            raise ValueError("the name of a batch is a file's name")
        if f"{batch}.json" in self._names("commits"):
            return False
        folder = f"data/{batch}-{uuid.uuid4().hex[:8]}"
        rows.write.json(f"{self.path}/{folder}")
        n = self.spark.read.schema(self.schema).json(f"{self.path}/{folder}").count()
        if put_once(self.spark, f"{self.path}/commits/{batch}.json", json.dumps({"batch": batch, "folder": folder, "n": n})):
            return True
        drop(self.spark, f"{self.path}/{folder}")
        return False

    def resume(self, todo: DataFrame, key: str, make: Callable[[DataFrame], DataFrame], chunks: int = 8, done: Column | None = None) -> int:
        """Do what is left of ``todo``, in ``chunks`` by the hash of ``key``, a commit for each; returns the commits made.

        What ``make`` returns for a chunk must have the key's value in ``done`` (by default
        a column of its name). A row whose key no committed row has is done again,
        as are rows that ``make`` gave nothing for. A kill loses the chunk at hand at most.
        """
        made = 0
        for part in range(chunks):
            mine = todo.where(F.pmod(F.xxhash64(key), F.lit(chunks)) == part)
            left = mine.join(self.read().select((F.col(key) if done is None else done).alias(key)).distinct(), key, "left_anti")
            if not left.isEmpty():
                made += self.append(make(left))
        return made

    def append_new(self, rows: DataFrame, key: str, order: list[str], batch: str | None = None) -> bool:
        """Commit those rows whose ``key`` no committed row has; of rows that share one, the first in ``order``. Null keys are left out."""
        whole = F.struct(*rows.columns)
        first = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min_by(whole, F.struct(*order)).alias("_row")).select("_row.*")
        return self.append(first.join(self.read().select(key), key, "left_anti"), batch)

    def sweep(self) -> int:
        """Delete folders that no commit names; not while another run writes."""
        named = {c["folder"].removeprefix("data/") for c in self.commits()}
        lost = [n for n in self._names("data") if n not in named]
        for name in lost:
            drop(self.spark, f"{self.path}/data/{name}")
        return len(lost)
