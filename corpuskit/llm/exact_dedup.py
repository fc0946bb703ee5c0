"""Exact deduplication with a log-structured merge index of text digests.

* A *memtable* is a batch of rows. It is flushed, without a shuffle, as a run on
  level 0: entries of (digest, the row that stays, number of rows), sorted by
  digest in each file. Every flush is a generation; a row is known by its
  generation and its number in it, which the run, once written, keeps.
* *Compaction* merges the runs of a level into a single run of the next level,
  with one entry for each digest: the row that stays and the number of rows. The
  runs that went into it leave the index. Equal digests meet already before the
  shuffle, so that a text that a third of all rows hold costs one entry a task.
* Each run has a *filter*, a bitmap of bounded size over its digests, and a
  merged one a second, over its digests of several rows. A lookup asks every
  run's filter and joins only the hits, run by run. Filters belong to a run and
  are never changed, so none can be out of date.
* Hits are *verified by their bytes*: the least and the greatest text under a
  digest must be the same bytes. Digests under which texts differ are settled by
  the texts themselves.

Everything is DataFrame operations: no Python on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm import scratch
from corpuskit.llm.rows import Bitmap, without


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@dataclass
class Run:
    """Entries (digest, best: id, generation and row of the one that stays, n), sorted; ``merged``: each digest once."""

    level: int
    entries: DataFrame
    path: str
    merged: bool
    _seen: Bitmap | None = None
    _several: Bitmap | None = None

    @property
    def seen(self) -> Bitmap:
        """The filter over all digests."""
        if self._seen is None:
            self._seen = Bitmap(self.entries.select("digest"), "digest")
        return self._seen

    @property
    def several(self) -> Bitmap:
        """The filter over digests of several rows; of merged runs."""
        if self._several is None:
            self._several = Bitmap(self.entries.where("n > 1").select("digest"), "digest")
        return self._several


class DigestIndex:
    """Runs by level: as they were flushed on level 0, merged on the others."""

    def __init__(self, spark: SparkSession, root: str | None = None, keep: str = "max", digest=sha256):
        if keep not in ("min", "max"):
            raise ValueError("keep is min or max")
        self.spark, self.best, self.digest = spark, F.max if keep == "max" else F.min, digest
        self.root = root or scratch.new_path(spark, "digests")
        self.runs: list[Run] = []
        self.generation = 0

    def _write(self, entries: DataFrame, level: int, merged: bool) -> Run:
        path = f"{self.root}/level={level}/run={self.generation}"
        self.generation += 1
        entries.sortWithinPartitions("digest").write.parquet(path)
        return Run(level, self.spark.read.schema(entries.schema).parquet(path), path, merged)

    def flush(self, docs: DataFrame, id_col: str, text_col: str) -> Run:
        """Write a memtable as a run on level 0, with an entry for each row."""
        rows = docs.select(self.digest(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"), F.col(id_col).alias("id"), F.lit(self.generation).alias("generation"), F.monotonically_increasing_id().alias("row"))
        run = self._write(rows.select("digest", F.struct("id", "generation", "row").alias("best"), F.lit(1).cast("bigint").alias("n")), 0, False)
        self.runs.append(run)
        return run

    def _merge(self, entries: DataFrame) -> DataFrame:
        return entries.groupBy("digest").agg(self.best("best").alias("best"), F.sum("n").alias("n"))

    def compact(self, level: int = 0, drop: bool = True) -> Run | None:
        """Merge all runs of a level, and those already on the next, into one run there; with ``drop``, delete what was merged."""
        old = [r for r in self.runs if r.level in (level, level + 1)]
        if not old:
            return None
        run = self._write(self._merge(reduce(DataFrame.union, (r.entries for r in old))), level + 1, True)
        self.runs = [r for r in self.runs if r not in old] + [run]
        for r in old if drop else []:
            scratch.drop(self.spark, r.path)
        return run

    def lookup(self, rows: DataFrame) -> DataFrame:
        """The entry (``digest``, ``best``, ``n`` over all runs) of each different digest of ``rows`` that the index holds."""
        asked = rows.select("digest").distinct()
        found = [run.seen.mark(asked, "digest").where("hit").select("digest").join(run.entries, "digest") for run in self.runs]
        if not found:
            return asked.where("false").select("digest", F.lit(None).alias("best"), F.lit(0).cast("bigint").alias("n"))
        return self._merge(reduce(DataFrame.union, found))


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", digest=sha256) -> DataFrame:
    """Find rows with identical texts.

    Returns a row for each row of ``docs``: the id, ``keep_id`` (the id of the
    row that stays), ``group_size``, ``kept`` and ``digest``. Of equal texts the
    row with the largest id stays (``keep="min"``: the smallest).

    A null text counts as empty. Null ids sort below all others. Rows that
    repeat both id and text are copies as well: exactly one of them is kept.
    An empty table gives an empty result. Only the two named columns are read,
    so others may have any names. ``digest`` maps a text column to a binary one;
    texts under one digest that differ are told apart by their bytes.
    """
    index = DigestIndex(docs.sparkSession, keep=keep, digest=digest)
    flushed = index.flush(docs, id_col, text_col).entries
    merged = index.compact(drop=False)  # the flushed rows are asked about below
    text = F.coalesce(F.col(text_col), F.lit(""))
    hits = merged.several.mark(docs.select(text.alias("text"), digest(text).alias("digest")), "digest").where("hit").drop("hit")
    several = merged.entries.where("n > 1").select("digest")
    # Bytes of all texts under a digest, least and greatest; both are aggregated before the shuffle.
    spread = hits.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high")).where("low <> high").select("digest")
    clash = scratch.materialise(spread.join(several, "digest", "left_semi"), "clash")
    clashing = not clash.isEmpty()
    rows = merged.several.mark(flushed.select("digest", F.col("best.id").alias("id"), F.col("best.row").alias("row")), "digest")
    once = rows.where("not hit").select("id", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"))
    more = rows.where("hit").select("id", "digest", "row").join(merged.entries, "digest")
    if clashing:
        more = more.join(clash, "digest", "left_anti")
    more = more.select("id", "digest", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("best.row")).alias("kept"))
    result = once.union(more)
    if clashing:
        result = result.union(_by_bytes(docs, clash, id_col, text_col, keep, digest))
    return result.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "digest")


def _by_bytes(docs: DataFrame, clash: DataFrame, id_col: str, text_col: str, keep: str, digest) -> DataFrame:
    """Rows under digests that different texts share: the same merge, with the texts themselves as keys."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), digest(text).alias("digest")).join(clash, "digest", "left_semi")
    rows = scratch.materialise(rows.withColumn("row", F.monotonically_increasing_id()), "bytes")
    best = F.max if keep == "max" else F.min
    groups = rows.groupBy(F.col("text").alias("t")).agg(best(F.struct("id", "row")).alias("best"), F.count("*").alias("n"))
    joined = rows.join(groups, rows.text == groups.t)
    return joined.select("id", "digest", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("best.row")).alias("kept"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", digest=sha256) -> DataFrame:
    """``docs`` without copies: of equal texts one row stays, with all its columns. Takes nulls as ``find_copies`` does.

    Rows without copies are not shuffled.
    """
    key = F.struct(F.col(id_col).alias("id"), digest(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"))
    keyed = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    found = find_copies(keyed, "key", "text", keep, digest).where("group_size > 1").select("key", "kept")
    # A key is one id and one text; of rows that repeat it one may stay.
    keys = scratch.materialise(found.groupBy("key").agg(F.count_if("kept").alias("kept"), F.count("*").alias("n")), "keys")
    return without(docs, key, keys.where("kept = 0").select("key"), keys.where("kept > 0 and n > 1").select("key"))
